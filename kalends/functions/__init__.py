"""Column functions: text, URLs, dates, regions."""
