"""Training-data operators: tokens, archives, quality, toxicity, language model, packing, neighbours, near copies."""
