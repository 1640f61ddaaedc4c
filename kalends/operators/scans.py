"""All rules of a kind in one scan of a text (TAG1, SCO2, PRC1): a number with a bit for each rule that is met.

Listings' own classifiers stay patterns inside one compiled projection (tags, scores, pricing), where a scan in Python
measured slower, for everything derived from its result has to be planned apart. A scan pays where texts are only to be
labelled, above all long ones: its work follows the words of a text, not the number of rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kalends import rules
from kalends.functions.phrases import bit, found_rules

#: kind -> (rule -> phrases, what must not follow an alternative)
TABLES: dict[str, tuple[dict[str, list[str]], dict[str, str]]] = {
    "tags": (rules.TAGS, rules.TAG_NOT_BEFORE),
    "relevance": (rules.FAMILY_RULES | rules.ACTIVITY_RULES | rules.RESCUE_RULES | {f"adult:{n}": p for n, p in rules.ADULT_RULES.items()}, rules.ADULT_NOT_BEFORE),
    "prices": (
        {
            "mixed": rules.MIXED_PHRASES, "donation": rules.DONATION_PHRASES, "strong_paid": rules.STRONG_PAID_PHRASES, "explicit_free": rules.EXPLICIT_FREE_PHRASES,
            "false_alarm": rules.PAID_FALSE_ALARM_PHRASES, "registration": rules.REGISTRATION_PHRASES, "paid_program": rules.PAID_PROGRAM_PHRASES,
        }, {},
    ),
}


def scanned(text: Column, kind: str) -> Column:
    """A bit for each rule of the kind that the text holds a phrase of, in the table's order; 0 for null."""
    table, not_before = TABLES[kind]
    return found_rules(F.lower(text), list(table.values()), not_before)


def rules_met(text: Column, kind: str) -> Column:
    """The names of the rules that the text meets, in the table's order."""
    found = scanned(text, kind)
    return F.array_compact(F.array(*[F.when(bit(found, k), F.lit(name)) for k, name in enumerate(TABLES[kind][0])]))
