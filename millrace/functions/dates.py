"""Publication dates (D1-D4): structured ISO texts, relative phrases, and the freshness rule. All native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import py_strip

HOUR = 3_600_000_000
DAY = 24 * HOUR
# Phrases of their own and how long before the reference time they lie, in seconds.
PHRASES = {"just now": 30, "moments ago": 60, "today": 3_600, "yesterday": 129_600}
# Units of relative dates, in seconds; months and years are 30 and 365 days.
UNITS = {"second": 1, "sec": 1, "minute": 60, "min": 60, "hour": 3_600, "hr": 3_600, "day": 86_400, "d": 86_400, "week": 604_800, "wk": 604_800, "month": 2_592_000, "year": 31_536_000}
SHORT = {"s": 1, "m": 60, "h": 3_600, "d": 86_400, "w": 604_800}
#: Ages beyond this many units are no dates (they would leave the calendar).
LARGEST = 100_000

def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: repeated subtrees would outgrow generated code."""
    return F.transform(F.array(value), body)[0]


ISO = (
    r"(?s)^(?:(\d{4})-(\d{2})-(\d{2})|(\d{4})(\d{2})(\d{2})|(\d{4})-?W(\d{2})(?:-?(\d))?)"
    r"(?:.(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?\s?([+-]\d{2}(?::?\d{2})?)?)?$"
)


def parse_structured(text: Column) -> Column:
    """struct(ts, iso) of an ISO 8601 text, null for anything else. Naive texts are UTC; ``iso`` keeps the offset."""
    t = F.replace(py_strip(text), F.lit("Z"), F.lit("+00:00"))
    groups = lambda x: F.when(x.rlike(ISO), F.array(*[F.regexp_extract(x, ISO, k) for k in range(1, 15)]))
    return let(t, lambda x: let(groups(x), lambda g: let(_date_of(g), lambda d: _instant(g, d))))


def _date_of(g: Column) -> Column:
    """The date of the groups of ISO: year, month, day with or without dashes, or year, week, weekday."""
    part = lambda a, b: F.when(g[a] == "", g[b]).otherwise(g[a])
    plain = F.try_to_timestamp(F.concat_ws("-", part(0, 3), part(1, 4), part(2, 5)), F.lit("yyyy-MM-dd")).cast("date")
    week, weekday = g[7].try_cast("int"), F.coalesce(g[8].try_cast("int"), F.lit(1))
    jan4 = F.concat(g[6], F.lit("-01-04")).try_cast("date")
    monday = F.date_add(F.date_sub(jan4, (F.dayofweek(jan4) + 5) % 7), (week - 1) * 7)
    by_week = F.when((week >= 1) & weekday.between(1, 7) & (F.year(F.date_add(monday, 3)) == g[6].try_cast("int")), F.date_add(monday, weekday - 1))
    return F.when(g[6] == "", plain).otherwise(by_week)


def _instant(g: Column, date: Column) -> Column:
    pad = lambda k: F.when(g[k] == "", F.lit("00")).otherwise(g[k])
    micros = F.rpad(F.substring(g[12], 1, 6), 6, "0")
    said = F.replace(g[13], F.lit(":"), F.lit(""))
    offset = F.when(said == "", F.lit("+00:00")).otherwise(F.concat(F.substring(said, 1, 3), F.lit(":"), F.when(F.length(said) > 3, F.substring(said, 4, 2)).otherwise(F.lit("00"))))

    def made(clock: Column) -> Column:
        hour, minute, second, off = clock["h"], clock["m"], clock["s"], clock["o"]
        ok = (hour < "24") & (minute < "60") & (second < "60") & (F.substring(off, 2, 2) < "24") & (F.substring(off, 5, 2) < "60") & (F.year(date) >= 1)
        minutes = (F.substring(off, 2, 2).try_cast("int") * 60 + F.substring(off, 5, 2).try_cast("int")) * F.when(F.substring(off, 1, 1) == "-", -1).otherwise(1)
        days = F.datediff(date, F.lit("1970-01-01").cast("date")).cast("bigint")
        us = (days * 86_400 + hour.try_cast("int") * 3_600 + minute.try_cast("int") * 60 + second.try_cast("int") - minutes * 60) * 1_000_000 + micros.try_cast("bigint")
        fraction = F.when(micros.try_cast("bigint") > 0, F.concat(F.lit("."), micros)).otherwise(F.lit(""))
        iso = F.concat(date.cast("string"), F.lit("T"), hour, F.lit(":"), minute, F.lit(":"), second, fraction, off)
        return F.when(ok & us.isNotNull(), F.struct(F.timestamp_micros(us).alias("ts"), iso.alias("iso")))

    return let(F.struct(pad(9).alias("h"), pad(10).alias("m"), pad(11).alias("s"), offset.alias("o")), made)


def seconds_ago(text: Column) -> Column:
    """Seconds before the reference time that a relative phrase says; null if it says none."""
    t = F.lower(py_strip(text))
    age = r"(?U)(\d+)\s*(second|sec|minute|min|hour|hr|day|d|week|wk|month|year)s?\s*ago"
    short = r"^(\d+)\s*([smhdw])$"
    units = lambda table, unit: F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[unit]
    count = lambda pattern: F.when(F.regexp_extract(t, pattern, 1).try_cast("bigint") <= LARGEST, F.regexp_extract(t, pattern, 1).try_cast("bigint"))
    out = F.when(t.isin(list(PHRASES)), units(PHRASES, t).cast("bigint"))
    out = out.when(t.rlike(age), count(age) * units(UNITS, F.regexp_extract(t, age, 2)))
    return out.when(t.rlike(short), count(short) * units(SHORT, F.regexp_extract(t, short, 2)))


def iso_utc(ts: Column) -> Column:
    """ISO text of an instant in UTC; the fraction only if it isn't zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    return F.concat(whole, F.when(micros > 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(F.lit("")), F.lit("+00:00"))


def normalize_publication(structured: Column, relative: Column, reference: Column) -> Column:
    """D3: struct(ts, iso_timestamp, confidence, is_fresh_24h). Structured first, then relative, else none (all null)."""
    none = F.struct(F.lit(None).cast("timestamp").alias("ts"), F.lit(None).cast("string").alias("iso_timestamp"), F.lit("none").alias("confidence"), F.lit(None).cast("boolean").alias("is_fresh_24h"))

    def said(s: Column) -> Column:
        age = F.unix_micros(reference) - F.unix_micros(s["ts"])
        return F.struct(s["ts"].alias("ts"), s["iso"].alias("iso_timestamp"), F.lit("structured").alias("confidence"), ((age >= 0) & (age <= DAY)).alias("is_fresh_24h"))

    def gone(ago: Column) -> Column:
        then = F.timestamp_micros(F.unix_micros(reference) - ago * 1_000_000)
        return F.struct(then.alias("ts"), iso_utc(then).alias("iso_timestamp"), F.lit("relative").alias("confidence"), (ago * 1_000_000 <= DAY).alias("is_fresh_24h"))

    by_phrase = let(seconds_ago(relative), lambda ago: F.when(ago.isNull(), none).otherwise(gone(ago)))
    return let(parse_structured(structured), lambda s: F.when(s.isNull(), by_phrase).otherwise(said(s)))


def is_new_since(previous: Column, current: Column) -> Column:
    """No earlier hash, or another one."""
    return ~previous.eqNullSafe(current)
