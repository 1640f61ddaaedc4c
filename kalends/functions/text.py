"""Text functions as Column expressions: titles, summaries, places, prices, sentences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from kalends import rules
from kalends.functions.gates import trie_pattern


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once: keeps expressions that use it often from doubling at every step."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blank(c: Column) -> Column:
    """Null for null, empty and white-space texts: all of these count as missing."""
    return F.when(F.length(F.trim(c)) > 0, c)


def has(c: Column, pattern: str) -> Column:
    """Whether the pattern is found, ignoring case; false for null."""
    return F.coalesce(c.rlike(f"(?i){pattern}"), F.lit(False))


def holds(low: Column, pattern: str) -> Column:
    """Whether a lower-case text holds a pattern of lower-case words; false for null. Cheaper than has() where one text meets many patterns."""
    return F.coalesce(low.rlike(pattern), F.lit(False))


def named(choices: list[tuple[str, Column]]) -> Column:
    """The names whose conditions are true, in order; names hold no comma. Compiled code, unlike filters over arrays."""
    joined = F.concat_ws(",", *[F.when(condition, F.lit(name)) for name, condition in choices])
    return F.array_remove(F.split(joined, ","), "")  # names the joined text once, so its conditions are tried once


def sub(c: Column, pattern: str, by: str = " ", case: bool = False) -> Column:
    return F.regexp_replace(c, pattern if case else f"(?i){pattern}", by)


def found(c: Column, pattern: str, group: int = 0, case: bool = False) -> Column:
    """The first match, null if there is none."""
    return F.nullif(F.regexp_extract(c, pattern if case else f"(?i){pattern}", group), F.lit(""))


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def contains_any(c: Column, words: list[str]) -> Column:
    """Whether the lower-cased text holds any of the words as a substring."""
    return holds(F.lower(c), trie_pattern(words))


def clean_title(c: Column) -> Column:
    """STR1: strips page-builder tails; null for generic titles and site taglines."""
    head = lambda t: F.trim(F.regexp_extract(t, "^(.*?)\\s*[–—]", 1))
    before_dash = lambda p: lambda t: F.when(t.rlike(p), head(t)).otherwise(t)

    def tidy(t: Column) -> Column:
        bad = has(t, rules.GENERIC_TITLE) | has(t, rules.TITLE_TAGLINE)
        dashed = F.contains(t, F.lit("–")) | F.contains(t, F.lit("—"))
        short = F.when(dashed, let(let(t, before_dash(rules.TITLE_STUFFED)), before_dash(rules.TITLE_DASH_TAGLINE))).otherwise(t)
        short = F.trim(F.substring_index(F.trim(sub(short, rules.TITLE_PLACE_TAIL, "")), " | ", 1))
        return F.when(~bad, F.nullif(F.trim(F.regexp_replace(short, "[.,]+$", "")), F.lit("")))

    return let(squeeze(c), tidy)


def title_case(c: Column) -> Column:
    """STR2: capitalised words, small words in lower case except at the start, "Mrs.b" as "Mrs. B"."""
    small = F.array(*map(F.lit, rules.SMALL_WORDS))

    def one(low: Column, i: Column) -> Column:
        cap = F.concat(F.upper(F.substring(low, 1, 1)), F.substring(low, 2, 1_000_000))
        return F.when((i == 0) | ~F.array_contains(small, low), cap).otherwise(low)

    def repaired(cap: Column) -> Column:
        parts = F.concat(F.regexp_extract(cap, r"^(.*\.)[a-z]$", 1), F.lit(" "), F.upper(F.regexp_extract(cap, r"\.([a-z])$", 1)))
        return F.when(cap.rlike(r"\.[a-z]$"), parts).otherwise(cap)

    words = F.transform(F.split(F.lower(squeeze(c)), " "), one)
    # few titles hold such a word; the others are not looked at word by word again
    return F.when(c.rlike(r"(?i)\.[a-z](?:\s|$)"), F.array_join(F.transform(words, repaired), " ")).otherwise(F.array_join(words, " "))


#: Named entities that listings use; numeric ones are decoded as well.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&ndash;": "–", "&mdash;": "—", "&rsquo;": "’", "&lsquo;": "‘", "&rdquo;": "”", "&ldquo;": "“", "&hellip;": "…", "&eacute;": "é", "&copy;": "©", "&reg;": "®", "&bull;": "•", "&amp;": "&"}


def unescape(c: Column) -> Column:
    """HTML entities as characters: the named ones above and any decimal number."""
    numbers = F.array_distinct(F.regexp_extract_all(c, F.lit(r"(&#[0-9]{1,6};)"), 1))
    c = F.aggregate(numbers, c, lambda t, n: F.replace(t, n, F.decode(F.unhex(F.lpad(F.hex(F.regexp_extract(n, "[0-9]+", 0).cast("long")), 8, "0")), "UTF-32")))
    for name, char in ENTITIES.items():
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def clean_summary(c: Column) -> Column:
    """STR3: no shortcodes, entities or tags; null if under 20 characters, generic, or a venue's blurb."""
    def judged(t: Column) -> Column:
        generic = F.regexp_replace(F.lower(t), r"\.+$", "").isin(rules.GENERIC_SUMMARIES)
        return F.when((F.char_length(t) >= 20) & ~generic & ~has(t, rules.SUMMARY_BLURB), t)

    # what only a mark can begin is looked for in texts with that mark
    coded = F.when(F.contains(c, F.lit("[")), F.regexp_replace(c, "(?i)" + rules.SHORTCODE, " ")).otherwise(c)
    plain = F.when(F.contains(c, F.lit("&")), let(coded, unescape)).otherwise(coded)
    untagged = let(plain, lambda t: F.when(F.contains(t, F.lit("<")), F.regexp_replace(t, "<[^>]+>", " ")).otherwise(t))
    return let(squeeze(untagged), judged)


#: What every match of a pattern of ADDRESS_SPACING holds; their replacements make none of it, so texts without it stay as they are.
RUN_TOGETHER = r"[a-z.][A-Z]|[WE][A-Z][a-z]|[A-Z]\d{5}|\d{5}[A-Z]"


def address_spacing(c: Column) -> Column:
    """STR7: separates street, direction, state and ZIP parts that were run together."""
    parted = c
    for pattern, by in rules.ADDRESS_SPACING:
        parted = F.regexp_replace(parted, pattern, by)
    return squeeze(F.when(c.rlike(RUN_TOGETHER), parted).otherwise(c))


def before(t: Column, pattern: str) -> Column:
    """The text before the pattern's first match; the whole text without one."""
    return let(F.regexp_instr(t, F.lit(pattern)), lambda at: F.when(at > 0, F.substring(t, F.lit(1), at - 1)).otherwise(t))


def clean_place(c: Column) -> Column:
    """STR4: struct(text, address): repeated words, boilerplate, phones and "Address..." tails removed."""
    glued = r"\bAddress[A-Z\d]"

    def parts(t: Column) -> Column:
        at = F.when(F.contains(t, F.lit("Address")), F.regexp_instr(t, F.lit(glued))).otherwise(0)
        text = lambda p: F.when(p > 0, F.substring(t, F.lit(1), p - 1)).otherwise(t)
        address = lambda p: F.when(p > 0, address_spacing(F.trim(F.substring(t, p + 7, F.lit(1_000_000)))))
        return let(at, lambda p: F.struct(F.trim(F.regexp_replace(F.trim(text(p)), "[,:;]+$", "")).alias("text"), address(p).alias("address")))

    once = F.regexp_replace(squeeze(c), r"(?i)\b(\w+)\s+\1\b", "$1")
    cut = let(once, lambda t: before(t, "(?i)" + rules.PLACE_BOILERPLATE))
    called = let(F.trim(cut), lambda t: F.when(t.rlike(r"\d{3}"), F.trim(F.regexp_replace(t, rules.PHONE, ""))).otherwise(t))
    return let(called, parts)


def street_position(c: Column) -> Column:
    """STR5: 1-based position where a street address begins, null without one."""
    at = lambda p: F.nullif(F.regexp_instr(c, F.lit(p)), F.lit(0))
    return F.coalesce(*map(at, rules.STREET_STARTS))


def split_venue(c: Column) -> Column:
    """STR6: struct(venue, address), split at the last comma before the street number."""

    def cut(at: Column) -> Column:
        head = F.substring(c, F.lit(1), at - 1)
        return F.when(F.contains(head, F.lit(",")), F.char_length(head) - F.char_length(F.substring_index(head, ",", -1))).otherwise(at)

    def parts(at: Column) -> Column:
        venue = F.trim(F.regexp_replace(F.trim(F.substring(c, F.lit(1), at - 1)), ",+$", ""))
        address = F.trim(F.regexp_replace(F.trim(F.substring(c, at, F.lit(1_000_000))), "^,+", ""))
        whole = F.struct(c.alias("venue"), F.lit(None).cast("string").alias("address"))
        split = let(venue, lambda v: F.when(F.coalesce(v, F.lit("")) == "", whole).otherwise(F.struct(v.alias("venue"), address.alias("address"))))
        return F.when(at.isNull(), whole).otherwise(split)

    return let(let(F.when(c.rlike("[0-9]"), street_position(c)), cut), parts)  # a street address begins with a number


def strip_bullet(c: Column) -> Column:
    """STR8: drops a bullet and what follows it."""
    def cut(t: Column) -> Column:
        t = F.trim(F.regexp_replace(t, rules.BULLET_CITY, ""))
        return let(t, lambda t: F.when(F.contains(t, F.lit(" • ")), F.trim(F.substring_index(t, " • ", 1))).otherwise(t))

    return F.trim(F.regexp_replace(F.when(F.contains(c, F.lit("•")), cut(c)).otherwise(F.trim(c)), "[,:;]+$", ""))


def county_of(c: Column) -> Column:
    """JOIN4: struct(county, city): the first county with a keyword in the text, and that keyword as the city."""
    def area(low: Column) -> Column:
        found = nowhere = F.struct(F.lit(None).cast("string").alias("county"), F.lit(None).cast("string").alias("city"))
        for name, words in reversed(rules.COUNTIES.items()):
            first = F.coalesce(*[F.when(F.contains(low, F.lit(w)), F.lit(w.title())) for w in words])
            found = F.when(low.rlike(trie_pattern(words)), F.struct(F.lit(name).alias("county"), first.alias("city"))).otherwise(found)
        # one scan for all counties' words: most places name none
        return F.when(low.rlike(trie_pattern([w for words in rules.COUNTIES.values() for w in words])), found).otherwise(nowhere)

    return let(F.lower(c), area)


def location(c: Column) -> Column:
    """STR9: struct(location_name, location_address, city, county); all null for a missing text."""
    def place(tidy: Column, split: Column, area: Column) -> Column:
        address = F.coalesce(F.nullif(split["address"], F.lit("")), F.nullif(tidy["address"], F.lit("")))
        return F.struct(F.nullif(strip_bullet(split["venue"]), F.lit("")).alias("location_name"), address_spacing(address).alias("location_address"), area["city"].alias("city"), area["county"].alias("county"))

    return let(clean_place(c), lambda tidy: let(let(tidy["text"], split_venue), lambda split: let(county_of(c), lambda area: place(tidy, split, area))))


def price_text(c: Column) -> Column:
    """STR12: squeezed, at most 200 characters, null if empty."""
    return F.nullif(F.substring(squeeze(c), 1, 200), F.lit(""))


LONG_PRICE = r"(?:free(?:\s+for\s+\w+|\s+with\s+\w+|\s+admission)?|(?:registration|program|class|course|entry|admission|materials?|ticket)\s+fee[^.\n]{0,60}|suggested\s+donation[^.\n]{0,40}|members?\s+free[^.\n]{0,60}|(?:cost|price|fee|admission|tickets?)\s*[:\-]\s*[^.\n]{0,40}|\$\s*\d[\d,.]*(?:\s*(?:[-/]|to)\s*\$?\d[\d,.]*)?(?:\s*(?:per\s+\w+|each|/\w+))?|\bno\s+(?:charge|fee|cost)\b)"


def salvaged_price(c: Column) -> Column:
    """STR13: short texts as they are; of longer ones the first price-shaped snippet."""
    return let(squeeze(c), lambda t: F.nullif(F.when(F.char_length(t) <= 200, t).otherwise(F.trim(found(t, LONG_PRICE))), F.lit("")))


def snippet(c: Column, patterns: list[str] = rules.SNIPPETS) -> Column:
    """STR14: the match of the first pattern that has one, trimmed of marks, at most 200 characters."""
    tidy = lambda m: F.nullif(F.substring(F.regexp_replace(F.regexp_replace(F.trim(m), r"^[,.;:]+|[,.;:]+$", ""), r"\s+", " "), 1, 200), F.lit(""))
    chosen = F.coalesce(*[found(c, p) for p in patterns])
    return tidy(chosen)


def card_price(c: Column) -> Column:
    """STR15: a price snippet in a card's description."""
    return F.trim(found(c, r"\$\s*\d[\d,.]*(?:\s*(?:per\s+\w+|/\w+|each))?|\bfree\b"))


def several_sentences(c: Column) -> Column:
    """STR16: two or more sentences, where a full stop after a known short form ends none."""
    parts = F.split(F.regexp_replace(F.rtrim(c), r"[.!?]+$", ""), r"[.!?]\s+(?=[A-Z])")
    short = F.array(*map(F.lit, rules.SHORT_FORMS))
    last = lambda p: F.lower(F.regexp_replace(F.element_at(F.split(F.trim(p), r"\s+"), -1), r"[.!?,;:]+$", ""))
    ends = F.exists(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: (F.trim(p) != "") & ~F.array_contains(short, last(p)))
    # few texts hold a mark that may end a sentence before another; the others are not cut up
    return F.coalesce(c.rlike(r"[.!?]\s+[A-Z]") & ends, F.lit(False))


def machine_name(c: Column) -> Column:
    """STR17: one capitalised token of more than six characters."""
    return F.coalesce(c.rlike(r"^[A-Z][a-z]+(?:\.[A-Z][a-z]+)?$") & (F.char_length(c) > 6), F.lit(False))


def generic_page_title(c: Column) -> Column:
    """STR19: missing, of six characters or fewer, or a known generic page title."""
    t = F.trim(c)
    return F.coalesce(t, F.lit("")).eqNullSafe("") | (F.char_length(t) <= 6) | has(t, rules.GENERIC_TITLE) | has(t, r"^(?:access\s*denied|forbidden)$") | has(t, rules.TITLE_TAGLINE)


def place_text(venue: Column, address: Column) -> Column:
    """STR20: the parts that are there, joined by a comma; null if none is."""
    return F.nullif(F.concat_ws(", ", F.trim(blank(venue)), F.trim(blank(address))), F.lit(""))


def geo_query(c: Column) -> Column:
    """STR10: a place as a geocoder would be asked for it."""
    t = F.regexp_replace(squeeze(c), r"(?i)\b(\w+)\s+\1\b", "$1")
    t = F.regexp_replace(F.regexp_replace(t, rules.PHONE, ""), r"https?://\S+", "")
    cut = let(t, lambda t: before(t, "(?i)" + rules.PLACE_BOILERPLATE))
    return F.trim(F.regexp_replace(squeeze(cut), r"[,:;.\s]+$", ""))


def without_room(c: Column) -> Column:
    """STR11: a venue without its room; never empty."""
    t = F.trim(F.regexp_replace(c, r"(?i)\s*[,\-–:(]\s*(?:meeting\s+room|conference\s+room|children'?s\s+(?:room|area)|community\s+room|program\s+room|room|auditorium|lobby|suite)\b.*$", ""))
    return F.coalesce(F.nullif(t, F.lit("")), c)
