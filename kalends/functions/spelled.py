"""Dates in free wording, for texts that no fixed format fits (the rest of DT1).

The grammar reads one calendar date, at most one time of day and at most one offset right behind it, in
any order and between other words. A number that is left over afterwards makes the text ambiguous (a
second time, a room, a span), and then it has no date: a wrong start is worse than a rejected row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from kalends.functions.text import let

NAMES = "janfebmaraprmayjunjulaugsepoctnovdec"
MONTH = r"(?<![a-z])(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)(?![a-z])\.?"
DAY = r"(?<![\d:/.])(\d{1,2})(?:st|nd|rd|th)?(?![\d:]|\s*[ap]\.?m\b)"
YEAR = r"'?(\d{4}|\d{2})(?![\d:]|\s*[ap]\.?m\b)"
GAP = r"[\s,./-]+"
#: Forms of a date and the places of year, month and day among a form's groups, counted from 1; 0 is no year.
DATES = [
    (r"(?<!\d)(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?!\d)", (1, 2, 3)),
    (rf"(?<!\d)(\d{{4}}){GAP}{MONTH}[\s,./-]*{DAY}", (1, 2, 3)),
    (rf"{DAY}(?:\s+of\b)?[\s,./-]*{MONTH}(?:{GAP}{YEAR})?", (3, 2, 1)),
    (rf"{MONTH}[\s,./-]*{DAY}(?:{GAP}{YEAR})?", (3, 1, 2)),
    (r"(?<![\d/.:-])(1[3-9]|[23]\d)[/.-](\d{1,2})[/.-](\d{4}|\d{2})(?![\d/.:-])", (3, 2, 1)),
    (r"(?<![\d/.:-])(\d{1,2})[/.-](\d{1,2})[/.-](\d{4}|\d{2})(?![\d/.:-])", (3, 1, 2)),
    (r"(?<![\d/.:-])(\d{1,2})/(\d{1,2})(?![\d/.:-])", (0, 1, 2)),
]
CLOCK = r"(?<![\d:./-])(\d{1,2})"
MINUTES = r":(\d{2})(?::(\d{2}(?:\.\d{1,6})?))?"
OFFSET = r"(?:\s*([+-])(\d{2}):?(\d{2})(?!\d))?"
#: Forms of a time: hour, minute, second, a or p, sign, hours and minutes of the offset.
TIMES = [rf"{CLOCK}(?:{MINUTES})?\s*([ap])\.?m\b\.?{OFFSET}", rf"{CLOCK}{MINUTES}(?!\d)(){OFFSET}"]
COMPACT = [(r"(?<!\d)((?:19|20)\d\d)(\d\d)(\d\d)(?=t\d|(?!\d))", "$1-$2-$3 "), (r"\bt(\d\d)(\d\d)\b", " $1:$2"), (r"\bt(\d\d)(\d\d)(\d\d)\b", " $1:$2:$3")]


def cut(t: Column, form: str, groups: tuple[int, ...]) -> Column:
    """The form's groups and, last, the text around its first match, joined by bars; null if it does not occur."""
    inside = "|".join(f"${g + 1}" if g else "" for g in groups)
    after = re.compile(form).groups + 2
    return F.when(t.rlike(form), F.regexp_replace(t, f"(?s)^(.*?){form}(.*)$", f"{inside}|$1 ${after}"))


def number(c: Column) -> Column:
    return F.coalesce(c.try_cast("int"), F.lit(0))


def spelled(c: Column, year: int) -> Column:
    """A timestamp without zone; null where the grammar gives no date or numbers are left over.

    A missing year is ``year``, a missing time midnight, two digits of a year are the nearest such year, an
    earlier year is lifted to ``year``. After that offsets are converted to UTC and dropped; other zone names are words.
    """
    def with_time(date: Column) -> Column:
        rest = date[3]
        clock = F.coalesce(*[cut(rest, f, (1, 2, 3, 4, 5, 6, 7)) for f in TIMES], F.concat(F.lit("|" * 7), rest))
        return let(F.split(clock, r"\|", 8), lambda time: stamp(date, time))

    def stamp(date: Column, time: Column) -> Column:
        y, m, hour = number(date[0]), date[1], number(time[0])
        near = y + year // 100 * 100
        near = F.when(near >= year + 50, near - 100).when(near < year - 50, near + 100).otherwise(near)
        whole = F.when(date[0] == "", year).when(F.length(date[0]) == 2, near).otherwise(y)
        month = F.when(m.rlike("^[a-z]"), F.floor((F.instr(F.lit(NAMES), F.substring(m, 1, 3)) + 2) / 3)).otherwise(number(m)).cast("int")
        hour = F.when((time[3] == "p") & (hour < 12), hour + 12).when((time[3] == "a") & (hour == 12), 0).otherwise(hour)
        second = F.coalesce(time[2].try_cast("decimal(8,6)"), F.lit(0).cast("decimal(8,6)"))
        at = lambda y: F.try_make_timestamp_ntz(y, month, number(date[2]), hour, number(time[1]), second)
        read = F.when(at(whole).isNotNull(), at(F.greatest(whole, F.lit(year))))
        behind = (number(time[5]) * 60 + number(time[6])) * F.when(time[4] == "-", -1).otherwise(1)
        return F.when(~time[7].rlike(r"\d"), read - F.make_dt_interval(mins=behind))

    def with_date(t: Column) -> Column:
        return let(F.split(F.coalesce(*[cut(t, f, g) for f, g in DATES]), r"\|", 4), with_time)

    t = F.lower(F.trim(F.regexp_replace(c, r"(?i)\bat\b", " ")))
    for form, out in COMPACT:
        t = F.regexp_replace(t, form, out)
    return let(t, with_date)
