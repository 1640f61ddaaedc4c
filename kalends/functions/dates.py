"""Date and time functions as Column expressions; the clock is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kalends.functions.spelled import spelled
from kalends.functions.text import let, named

#: Formats that the producers emit, tried in order, after a weekday name is dropped.
FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd", "MMM d yyyy h:mma", "MMM d yyyy h:mm a", "MMMM d yyyy h:mma", "MMMM d yyyy h:mm a", "MMM d yyyy ha", "MMM d yyyy", "MMMM d yyyy", "M/d/yyyy h:mm a", "M/d/yyyy"]
#: The whole of a text in the first format.
READY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"


def parse_datetime(c: Column, year: int) -> Column:
    """DT1: a timestamp without zone; dates without a year or with a past one are lifted to ``year``.

    Then offsets are converted to UTC and dropped. Texts that no format fits go through the grammar of
    ``spelled``. Null when that gives nothing either, or when the lifted date does not exist (29 February).
    """
    def lift(got: Column) -> Column:
        moved = F.try_to_timestamp(F.concat(F.lit(str(year)), F.date_format(got, "-MM-dd HH:mm:ss")), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
        return F.when(F.year(got) < year, moved).otherwise(got)

    def zoned(t: Column) -> Column:
        at = lambda x: F.try_to_timestamp(F.regexp_replace(x, "Z$", "+00:00")).cast("timestamp_ntz")
        past = F.substring(t, 1, 4).try_cast("int") < year
        return F.when(~past, at(t)).when(past & at(t).isNotNull(), at(F.concat(F.lit(str(year)), F.substring(t, 5, 100))))

    def read(t: Column) -> Column:
        plain = F.trim(F.regexp_replace(F.regexp_replace(t, ",", " "), r"\s+", " "))
        dated = F.when(plain.rlike(r"\b\d{4}\b"), plain).otherwise(F.regexp_replace(plain, r"^([A-Za-z]+\.? \d{1,2})\b", f"$1 {year}"))
        tried = let(dated, lambda d: F.coalesce(*[F.try_to_timestamp(d, F.lit(f)) for f in FORMATS]).cast("timestamp_ntz"))
        lifted = let(tried, lambda got: F.when(got.isNotNull(), lift(got)).otherwise(spelled(c, year)))
        return F.when(t.rlike(r"T\d.*\d(?:Z|[+-]\d\d:?\d\d)$"), F.coalesce(zoned(t), spelled(c, year))).otherwise(lifted)

    t = F.trim(F.regexp_replace(F.regexp_replace(c, r"(?i)\bat\b", " "), r"(?i)^\s*(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+", ""))
    # a text just as the first format has it, of no past year, needs no step before or after; compiled, unlike what let() holds
    ready = F.when(c.rlike(READY) & (F.substring(c, 1, 4) >= f"{year:04}"), F.try_to_timestamp(c, F.lit(FORMATS[0])).cast("timestamp_ntz"))
    return F.coalesce(ready, F.when(F.length(F.trim(c)) > 0, let(t, read)))


def week_monday(c: Column) -> Column:
    """DT2."""
    return F.to_date(F.date_trunc("WEEK", c))


def time_tags(start: Column) -> Column:
    """DT3: weekend or weekday; morning 5-12, afternoon 12-17, evening 17-22."""
    hour = F.hour(start)
    day = F.weekday(start)
    return named([("weekend", day >= 5), ("weekday", day < 5), ("morning", hour.between(5, 11)), ("afternoon", hour.between(12, 16)), ("evening", hour.between(17, 21))])


def schedule_date(c: Column) -> Column:
    """DT4: an ISO date, or the date part of an ISO date and time; null if neither."""
    return F.try_to_timestamp(F.substring(F.trim(c), 1, 10), F.lit("yyyy-MM-dd")).cast("date")


def schedule_time(c: Column) -> Column:
    """DT4: HH:mm:ss from the five accepted forms."""
    t = F.upper(F.regexp_replace(F.trim(c), r"\s+", " "))
    got = F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in ("H:mm", "H:mm:ss", "h:mm a", "h:mma", "h a")])
    return F.date_format(got, "HH:mm:ss")


def weekday_codes(days: Column) -> Column:
    """DT5: the first three letters, lower case."""
    return F.transform(days, lambda d: F.lower(F.substring(F.trim(d), 1, 3)))


def iso(c: Column) -> Column:
    """DT7: ISO text, with microseconds only where there are any."""
    return F.when(F.date_format(c, "SSSSSS") == "000000", F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def listing_times(c: Column) -> Column:
    """DT6: "Day, Mon DD, t1 - t2" as struct(start_text, end_text, all_day)."""
    parts = F.split(F.trim(c), ", ", 3)
    date = F.get(parts, F.lit(1))
    times = F.split(F.get(parts, F.lit(2)), r"\s+-\s+", 2)
    all_day = F.coalesce(F.lower(F.trim(F.get(parts, F.lit(2)))).isin("all day", "all-day"), F.lit(False))
    first, second = F.get(times, F.lit(0)), F.get(times, F.lit(1))
    return F.struct(F.when(all_day | first.isNull(), date).otherwise(F.concat(date, F.lit(", "), F.trim(first))).alias("start_text"), F.when(~all_day & second.isNotNull(), F.concat(date, F.lit(", "), F.trim(second))).alias("end_text"), all_day.alias("all_day"))
