"""Price classification as one ladder over texts (PRC1-PRC6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends import rules
from kalends.functions.gates import trie_pattern
from kalends.functions.text import contains_any, found, has, holds, price_text, snippet
from kalends.operators.tags import GATE

#: reason -> (price_type, cost_type, is_free)
OUTCOMES = {
    "zero_cost_value": ("free", "free", True),
    "library_default_free_no_context": ("free", "free", True),
    "public_source_default_free_no_context": ("free", "free", True),
    "no_context": ("unknown", "unknown", None),
    "mixed_pricing": ("mixed", "paid", False),
    "donation_language": ("donation", "suggested_donation", False),
    "strong_paid_signal": ("paid", "paid", False),
    "dollar_amount": ("paid", "paid", False),
    "conflicting_free_and_paid": ("mixed", "paid", False),
    "explicit_free_text": ("free", "free", True),
    "weak_paid_signal": ("paid", "paid", False),
    "paid_program_format_no_price": ("unknown", "unknown", None),
    "library_default_free": ("free", "free", True),
    "public_source_default_free": ("free", "free", True),
    "free_word_only": ("free", "free", True),
    "unknown_no_signals": ("unknown", "unknown", None),
}


def is_library(name: Column, url: Column, venue: Column) -> Column:
    """PRC3."""
    return contains_any(name, rules.LIBRARY_NAMES) | contains_any(url, rules.LIBRARY_URLS) | contains_any(venue, rules.LIBRARY_VENUES)


def is_public(name: Column, venue: Column) -> Column:
    """PRC3."""
    return contains_any(name, rules.PUBLIC_NAMES) | contains_any(venue, rules.PUBLIC_VENUES)


#: What every match of a price pattern holds somewhere: texts without it are not searched for the pattern.
SURE = {
    "mixed": ["member", "free", "included"],
    "strong": ["fee", "ticket", "per", "paid", "price", "includes", "book", "reserve", "cost", "admission", "usd", "dollar", "required"],
    "explicit": ["free", "charge", "cost", "fee", "complimentary", "price", "0"],
    "weak": ["ticket", "admission", "fee", "cost", "price", "paid"],
    "registration": ["regist", "rsvp", "must", "advance", "ticket"],
    "snippet": ["fee", "cost", "price", "admission", "ticket", "$", "free", "donation"],
}


def sure(low: Column, kind: str) -> Column:
    return holds(low, trie_pattern(SURE[kind]))


def weak_paid(low: Column) -> Column:
    """PRC2: a paid-sounding word of a lower-case text that is not part of a phrase such as "no fee"."""
    return sure(low, "weak") & holds(F.regexp_replace(low, rules.PAID_FALSE_ALARMS, " "), rules.WEAK_PAID)


def joined(*parts: Column) -> Column:
    return F.trim(F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts]))


def reason(text: Column, price: Column, library: Column, public: Column, met: Column | None = None) -> Column:
    """The first rule that applies to a lower-case text; every other field follows from it.

    Rules that share a condition stand in one branch: a branch tries its condition anew.
    """
    zero = F.coalesce(F.lower(F.trim(price)).isin(rules.ZERO_PRICES), F.lit(False))
    explicit, paid = sure(text, "explicit") & holds(text, rules.EXPLICIT_FREE), weak_paid(text)
    return (
        F.when(zero, "zero_cost_value")
        .when((text == "") & library, "library_default_free_no_context")
        .when((text == "") & public, "public_source_default_free_no_context")
        .when(text == "", "no_context")
        .when(sure(text, "mixed") & holds(text, rules.MIXED), "mixed_pricing")
        .when(GATE.may(met, "price:donation") & holds(text, rules.DONATION), "donation_language")
        .when(sure(text, "strong") & holds(text, rules.STRONG_PAID), "strong_paid_signal")
        .when(holds(text, rules.DOLLAR), "dollar_amount")
        .when(explicit, F.when(paid, "conflicting_free_and_paid").otherwise("explicit_free_text"))
        .when(paid, "weak_paid_signal")
        .when(library | public, F.when(GATE.may(met, "price:program") & holds(text, rules.PAID_PROGRAM), "paid_program_format_no_price").when(library, "library_default_free").otherwise("public_source_default_free"))
        .when(holds(text, r"\bfree\b"), "free_word_only")
        .otherwise("unknown_no_signals")
    )


def outcome(why: Column, k: int) -> Column:
    table = F.create_map(*[F.lit(x) for r, o in OUTCOMES.items() for x in (r, o[k] if o[k] is not None else None)]) if k < 2 else F.create_map(*[F.lit(x) for r, o in OUTCOMES.items() if o[k] is not None for x in (r, o[k])])
    return F.try_element_at(table, why)


def with_pricing(df: DataFrame, price: str = "price_text", summary: str = "summary", title: str = "title", source_name: str = "source_name", source_url: str = "source_url", venue: str = "location_name", registration_url: str = "registration_url", out: str = "pricing", met: Column | None = None) -> DataFrame:
    """PRC1 with PRC4 and PRC5: adds a struct of the ten pricing fields; missing columns count as null. met: GATE's bits, where they are known."""
    col = lambda n: F.col(n).cast("string") if n in df.columns else F.lit(None).cast("string")
    p, s, t, v, reg = col(price), col(summary), col(title), col(venue), col(registration_url)
    df = df.withColumn("_text", joined(p, s, t)).withColumn("_low", F.lower("_text")).withColumn("_reason", reason(F.col("_low"), p, is_library(col(source_name), col(source_url), v), is_public(col(source_name), v), met))
    text, why = F.col("_text"), F.col("_reason")
    zero, cost = why == "zero_cost_value", outcome(why, 1)
    df = df.withColumn("_short", F.when(sure(F.col("_low"), "snippet"), snippet(text)))
    short = F.col("_short")
    extracted = F.coalesce(price_text(p), short)
    brief = F.coalesce(price_text(short), extracted)
    fee = snippet(text, rules.SNIPPETS[:1])
    fee_wanted = ((why == "mixed_pricing") & F.contains(F.lower(text), F.lit("registration")) & has(text, rules.DOLLAR)) | ((why == "strong_paid_signal") & F.contains(F.lower(F.coalesce(found(text, rules.STRONG_PAID), F.lit(""))), F.lit("registration")))
    mark = F.coalesce(
        *[F.when(why == r, F.concat(F.lit(f"{label}:"), found(text, rx))) for r, label, rx in (("mixed_pricing", "mixed", rules.MIXED), ("donation_language", "donation", rules.DONATION), ("strong_paid_signal", "strong_paid", rules.STRONG_PAID), ("dollar_amount", "dollar_amount", rules.DOLLAR), ("explicit_free_text", "explicit_free", rules.EXPLICIT_FREE), ("conflicting_free_and_paid", "explicit_free", rules.EXPLICIT_FREE), ("weak_paid_signal", "weak_paid", rules.WEAK_PAID), ("paid_program_format_no_price", "paid_program_keyword", rules.PAID_PROGRAM))],
        F.when(zero, F.concat(F.lit("zero_value:"), p)), F.when(why == "library_default_free", F.lit("library_default")), F.when(why == "public_source_default_free", F.lit("public_default")), F.when(why == "free_word_only", F.lit("free_word")),
    )
    fields = {
        "price_type": outcome(why, 0), "cost_type": cost, "is_free": outcome(why, 2),
        "pricing_summary": F.when(zero, F.lit("Free")).otherwise(brief),
        "price_text": F.when(zero, F.lit("Free")).otherwise(F.coalesce(price_text(p), F.when(cost.isin("paid", "suggested_donation"), brief))),
        "registration_required": ~zero & ((sure(F.col("_low"), "registration") & has(text, rules.REGISTRATION)) | ((F.coalesce(reg, F.lit("")) != "") & (text != ""))),
        "registration_fee_text": F.when(fee_wanted, fee), "extracted_price_text": F.when(zero, F.trim(p)).otherwise(extracted),
        "reason": why, "matched_patterns": F.array_compact(F.array(mark, F.when(why == "conflicting_free_and_paid", F.lit("conflicting_weak_paid")))),
    }
    return df.withColumn(out, F.struct(*[c.alias(n) for n, c in fields.items()])).drop("_text", "_low", "_reason", "_short")


def legacy_cost(df: DataFrame, pricing: str = "pricing") -> DataFrame:
    """PRC6: (cost_type, price_text, reason), free rows with the text "Free"."""
    p = F.col(pricing)
    return df.withColumns({"cost_type": p["cost_type"], "cost_text": F.when((p["cost_type"] == "free") & p["price_text"].isNull(), F.lit("Free")).otherwise(p["price_text"]), "cost_reason": p["reason"]})
