"""Normalising date texts of mixed form, precision and zone to one UTC instant.

A text is reduced to its shape mask in the JVM: every digit becomes ``0``, every word ``¤`` (``§`` if it has letters beyond
ASCII), but for the words that the forms know. So a mask tells which form its texts follow, and each distinct mask is mapped
to a parser once per worker (``parser_for``); all texts of one mask in an Arrow batch go through that parser together, and
local times are converted with numpy searches in versioned zone transition tables (``ZoneTable``), made for the centuries
that occur. No row is shuffled.

Defined results: null, blank, unknown shapes, impossible dates, bare years, ages in months or years, local times of an
unknown source, local times that a zone skips or shows twice, and years outside 1 to 9998 give null; texts of any length
are judged whole. Extra columns of the input pass through; the working columns carry a ``__ts_`` prefix.
"""

from __future__ import annotations

import datetime as dt
import functools
import re
import unicodedata
import zoneinfo

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NONE = np.iinfo(np.int64).min
SECOND, DAY = 1_000_000, 86_400_000_000
LO, HI = 1, 9998

# Month names of the languages the feeds are written in.
MONTHS = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "sept": 9, "oct": 10, "nov": 11, "dec": 12,
    "januar": 1, "februar": 2, "marz": 3, "mai": 5, "juni": 6, "juli": 7, "oktober": 10, "dezember": 12,
    "janvier": 1, "fevrier": 2, "mars": 3, "avril": 4, "juin": 6, "juillet": 7, "aout": 8, "septembre": 9, "octobre": 10, "novembre": 11, "decembre": 12,
    "enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7, "agosto": 8, "septiembre": 9, "setiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12,
}
# Zone abbreviations with one meaning in the feeds, as minutes east of UTC.
ABBREVIATIONS = {
    "utc": 0, "gmt": 0, "z": 0, "wet": 0, "bst": 60, "west": 60, "cet": 60, "cest": 120, "eet": 120, "eest": 180, "msk": 180, "ist": 330, "jst": 540, "kst": 540,
    "aest": 600, "aedt": 660, "acst": 570, "acdt": 630, "awst": 480, "nzst": 720, "nzdt": 780, "est": -300, "edt": -240, "cst": -360, "cdt": -300,
    "mst": -420, "mdt": -360, "pst": -480, "pdt": -420, "akst": -540, "akdt": -480, "hst": -600, "brt": -180, "brst": -120, "art": -180,
}
# Age units as seconds.
UNITS = {
    "second": 1, "seconds": 1, "sec": 1, "secs": 1, "minute": 60, "minutes": 60, "min": 60, "mins": 60, "hour": 3600, "hours": 3600, "hr": 3600, "hrs": 3600,
    "day": 86400, "days": 86400, "week": 604800, "weeks": 604800,
    "sekunde": 1, "sekunden": 1, "minuten": 60, "stunde": 3600, "stunden": 3600, "tag": 86400, "tage": 86400, "tagen": 86400, "woche": 604800, "wochen": 604800,
    "seconde": 1, "secondes": 1, "heure": 3600, "heures": 3600, "jour": 86400, "jours": 86400, "semaine": 604800, "semaines": 604800,
    "segundo": 1, "segundos": 1, "minuto": 60, "minutos": 60, "hora": 3600, "horas": 3600, "dia": 86400, "dias": 86400, "semana": 604800, "semanas": 604800,
}

DATE_YMD = r"(?P<Y>\d{4})-(?P<m>\d{2})-(?P<d>\d{2})"
CLOCK = r"(?P<H>\d{1,2}):(?P<M>\d{2})(?::(?P<S>\d{2})(?:[.,](?P<f>\d{1,9}))?)?"
AMPM = r"(?P<ap>[AaPp]\.?[Mm]\.?)"
OFFSET = r"(?P<off>Z|z|[+-]\d{2}(?::?\d{2})?)"
ZONE = r"(?P<zone>[A-Za-z]+(?:/[A-Za-z0-9_+\-]+)*)"
WORDY = r"(?P<d>\d{1,2})(?:\.|st|nd|rd|th)?\s+(?:de\s+)?(?P<mon>[^\W\d_]+)\.?\s+(?:de\s+)?(?P<Y>\d{4})"
MON_FIRST = r"(?P<mon>[^\W\d_]+)\.?\s+(?P<d>\d{1,2})(?:st|nd|rd|th)?,?\s+(?P<Y>\d{4})"
TIME_TAIL = rf"{CLOCK}(?:\s?{AMPM})?(?:\s?{OFFSET}|\s*\[{ZONE}\]|\s+{ZONE.replace('zone', 'zone2')})?"
#: The forms, tried in this order on a mask's first text. A mask fixes the lengths and places of all digits and letters.
FORMS: tuple[tuple[str, re.Pattern], ...] = tuple(
    (kind, re.compile(pattern))
    for kind, pattern in (
        ("epoch", r"(?P<epoch>\d{10}|\d{13}|\d{16}|\d{19})"),
        ("stamp", rf"(?P<Y>\d{{4}})(?P<m>\d{{2}})(?P<d>\d{{2}})(?:T?(?P<H>\d{{2}})(?P<M>\d{{2}})(?P<S>\d{{2}})?{OFFSET}?)?"),
        ("stamp", rf"{DATE_YMD}(?:(?:T|t|\s){TIME_TAIL})?"),
        ("stamp", rf"(?P<Y>\d{{4}})[/.](?P<m>\d{{1,2}})[/.](?P<d>\d{{1,2}})(?:,?\s+{TIME_TAIL})?"),
        ("week", rf"(?P<Y>\d{{4}})-?W(?P<w>\d{{2}})-?(?P<wd>\d)(?:T{TIME_TAIL})?"),
        ("ordered", rf"(?P<a>\d{{1,2}})(?P<sep>[/.\-])(?P<b>\d{{1,2}})(?P=sep)(?P<Y>\d{{4}})(?:,?\s+{TIME_TAIL})?"),
        ("stamp", rf"(?:(?P<dow>[A-Za-z]+),\s+)?{WORDY}(?:,?\s+{TIME_TAIL})?"),
        ("stamp", rf"{WORDY},?\s+(?:à|a las|um|at)\s+(?P<H>\d{{1,2}})[h:](?P<M>\d{{2}})(?:\s+Uhr)?"),
        ("stamp", rf"(?:(?P<dow>[A-Za-z]+),\s+)?{MON_FIRST}(?:,?\s+(?:at\s+)?{TIME_TAIL})?"),
        ("age", r"(?:[^\W\d_]+\s+){0,4}(?P<n>\d{1,6})\s+(?P<unit>[^\W\d_]+)(?P<ago>\s+ago)?"),
    )
)
AGE_WORDS = re.compile(r"(?:^|\s)(?:vor|hace|il y a)\s+\d")


def fold(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word.lower()) if not unicodedata.combining(c))


#: Words that forms know by themselves; any other word may stand for a month, a zone or a unit.
KNOWN = ["T", "t", "W", "Z", "z", "h", "de", "st", "nd", "rd", "th", "à", "a", "las", "um", "at", "Uhr", "ago", "vor", "hace", "il", "y", *(x for am in ("am", "pm") for x in (am, am.upper(), am.title(), am[0] + "M")), "A", "P", "M", "p", "m"]
PARSERS: dict[str, tuple[str, re.Pattern] | None] = {}


def parser_for(mask: str, example: str) -> tuple[str, re.Pattern] | None:
    """The form that a mask's texts follow; None if none fits. Looked up once for a mask, with its first text."""
    if mask not in PARSERS:
        if len(PARSERS) >= 50_000:
            PARSERS.clear()
        PARSERS[mask] = next(((kind, form) for kind, form in FORMS if form.fullmatch(example)), None)
    return PARSERS[mask]


def tz_version() -> str:
    """The version of the zone rules in use; the driver's and the workers' must agree."""
    try:
        import tzdata

        return tzdata.IANA_VERSION
    except ImportError:
        return "system"


class ZoneTable:
    """A zone's offsets between transitions: ``starts`` are UTC seconds, ``offsets`` seconds east of UTC from then on."""

    def __init__(self, zone: zoneinfo.ZoneInfo, century: int):
        utc, week = dt.timezone.utc, 7 * 86400
        epoch = dt.datetime(1970, 1, 1, tzinfo=utc)
        off = lambda s: int((epoch + dt.timedelta(seconds=s)).astimezone(zone).utcoffset().total_seconds())
        # a month more at both ends, for local times next to them
        lo = int((dt.datetime(max(1, 100 * century), 1, 1, tzinfo=utc) - epoch).total_seconds()) + (week if century == 0 else -4 * week)
        hi = int((dt.datetime(min(9999, 100 * century + 100), 1, 1, tzinfo=utc) - epoch).total_seconds()) + 4 * week
        starts, offsets, last = [lo], [off(lo)], off(lo)
        for s in range(lo + week, hi, week):
            if (now := off(s)) != last:
                a, b = s - week, s
                while b - a > 1:
                    mid = (a + b) // 2
                    a, b = (mid, b) if off(mid) == last else (a, mid)
                starts, offsets, last = [*starts, b], [*offsets, now], now
        self.starts, self.offsets = np.array(starts, np.int64), np.array(offsets, np.int64)

    def to_utc(self, local: np.ndarray) -> np.ndarray:
        """UTC seconds of local seconds; NONE where the zone's clock skips the local time or shows it twice."""
        found, n = np.full(len(local), NONE, np.int64), np.zeros(len(local), np.int8)
        near = np.searchsorted(self.starts, local, "right") - 1
        for k in (-1, 0, 1):
            i = np.clip(near + k, 0, len(self.starts) - 1)
            utc = local - self.offsets[i]
            ok = (np.searchsorted(self.starts, utc, "right") - 1 == i) & (near + k == i)
            n += ok
            found = np.where(ok, utc, found)
        return np.where(n == 1, found, NONE)


@functools.lru_cache(1400)
def zone_table(name: str, version: str, century: int) -> ZoneTable | None:
    if version != tz_version():
        raise RuntimeError(f"zone rules {tz_version()} here, {version} on the driver")
    try:
        return ZoneTable(zoneinfo.ZoneInfo(name), century)
    except (zoneinfo.ZoneInfoNotFoundError, ValueError, OSError, TypeError):
        return None


def parse_mask(kind: str, form: re.Pattern, text: pd.Series, zone: pd.Series, order: pd.Series, now: np.ndarray, version: str) -> np.ndarray:
    """UTC microseconds of all texts of one mask."""
    g = text.str.extract("^(?:" + form.pattern + ")$")
    number = lambda k: pd.to_numeric(g[k], errors="coerce") if k in g else pd.Series(np.nan, g.index)
    whole = lambda k, default=0: number(k).fillna(default).to_numpy(np.int64)
    out = np.full(len(g), NONE, np.int64)
    if kind == "epoch":
        value, size = whole("epoch"), int(g["epoch"].str.len().iloc[0] if g["epoch"].notna().any() else 10)
        us = {10: value * SECOND, 13: value * 1000, 16: value, 19: value // 1000}[size]
        return np.where(g["epoch"].notna().to_numpy(), us, NONE)
    if kind == "age":
        said = g["unit"].map(lambda u: UNITS.get(fold(u), 0), na_action="ignore").fillna(0).to_numpy(np.int64)
        ok = (said > 0) & (now != NONE) & (g["ago"].notna() | text.str.lower().str.contains(AGE_WORDS)).to_numpy(bool)
        return np.where(ok, now - whole("n") * said * SECOND, NONE)

    year, ok = whole("Y"), g["Y"].notna().to_numpy(bool)
    if kind == "week":
        w, wd = whole("w"), whole("wd")
        fourth = lambda y: (np.clip(y, LO, HI + 1) - 1970).astype("datetime64[Y]").astype("datetime64[D]").astype(np.int64) + 3
        jan4 = fourth(year)
        monday = jan4 - (jan4 + 3) % 7
        jan4_next = fourth(year + 1)
        ok &= (w >= 1) & (wd >= 1) & (wd <= 7) & (monday + 7 * w <= jan4_next - (jan4_next + 3) % 7)
        days = monday + 7 * (w - 1) + wd - 1
    else:
        if kind == "ordered":
            a, b, dmy = whole("a"), whole("b"), (order == "DMY").to_numpy(bool)
            day, month = np.where(dmy, a, b), np.where(dmy, b, a)
            ok &= order.isin(["DMY", "MDY"]).to_numpy(bool)
        else:
            day = whole("d")
            month = g["mon"].map(lambda m: MONTHS.get(fold(m), 0), na_action="ignore").fillna(0).to_numpy(np.int64) if "mon" in g else whole("m")
        ok &= (month >= 1) & (month <= 12) & (day >= 1)
        ym = (np.clip(year, LO, HI) - 1970) * 12 + np.clip(month, 1, 12) - 1
        first, after = (x.astype("datetime64[M]").astype("datetime64[D]").astype(np.int64) for x in (ym, ym + 1))
        days = first + day - 1
        ok &= days < after
    ok &= (year >= LO) & (year <= HI)
    hour, minute, second = whole("H"), whole("M"), whole("S")
    if "ap" in g and g["ap"].notna().any():
        said = g["ap"].notna().to_numpy(bool)
        pm = g["ap"].str.lower().str.startswith("p", na=False).to_numpy(bool)
        ok &= ~said | ((hour >= 1) & (hour <= 12))
        hour = np.where(said, hour % 12 + 12 * pm, hour)
    ok &= (hour <= 23) & (minute <= 59) & (second <= 59)
    micro = (g["f"].fillna("").str.ljust(9, "0").str[:6].astype(np.int64) if "f" in g else pd.Series(0, g.index)).to_numpy(np.int64)
    local = days * 86400 + hour * 3600 + minute * 60 + second

    named = (g["zone"].where(g["zone"].notna(), g["zone2"]) if "zone2" in g else g["zone"]) if "zone" in g else pd.Series(None, g.index, dtype=object)
    offset = g["off"] if "off" in g else pd.Series(None, g.index, dtype=object)
    fixed = offset.map(lambda o: 0 if o in "Zz" else (1 if o[0] == "+" else -1) * (int(o[1:3]) * 60 + (int(o[-2:]) if len(o) > 3 else 0)), na_action="ignore")
    fixed = fixed.where(fixed.notna(), named.map(lambda z: ABBREVIATIONS.get(z.lower()), na_action="ignore")).astype("float64")
    local_word = named.str.lower().isin(["uhr"]).to_numpy(bool) if named.notna().any() else np.zeros(len(g), bool)
    has = fixed.notna().to_numpy(bool)
    minutes = np.nan_to_num(fixed.to_numpy(np.float64)).astype(np.int64)
    ok &= np.abs(minutes) <= 18 * 60
    utc = np.where(has, local - minutes * 60, NONE)
    names = named.where(named.notna() & ~local_word, zone)
    for (name, century), at in names[~has & ok].groupby([names[~has & ok], pd.Series(year // 100, names.index)[~has & ok]]).groups.items():
        i = names.index.get_indexer(at)
        if (found := zone_table(name, version, int(century))) is not None:
            utc[i] = found.to_utc(local[i])
    good = ok & (utc != NONE)
    out[good] = utc[good] * SECOND + micro[good]
    return out


def instants(text: pd.Series, mask: pd.Series, zone: pd.Series, order: pd.Series, now: pd.Series, version: str) -> pd.Series:
    out, ref = np.full(len(text), NONE, np.int64), now.fillna(NONE).to_numpy(np.int64)
    text, zone, order = (s.reset_index(drop=True) for s in (text, zone, order))
    for m, at in mask.reset_index(drop=True).groupby(mask.to_numpy()).groups.items():
        i, here = np.asarray(at), text.iloc[at].reset_index(drop=True)
        if (found := parser_for(m, here.iloc[0])) is not None:
            pick = lambda s: s.iloc[i].reset_index(drop=True)  # noqa: B023, E731
            out[i] = parse_mask(*found, here, pick(zone), pick(order), ref[i], version)
    return pd.Series(out).where(out != NONE).astype("Int64")


def shape_mask(text: Column) -> Column:
    """ASCII digits to ``0``, words but for ``KNOWN`` to ``¤`` or ``§``; other characters stay."""
    known = "|".join(KNOWN)
    plain = F.regexp_replace(F.translate(text, "123456789", "000000000"), rf"(?<!\p{{L}})(?!(?:{known})(?!\p{{L}}))[A-Za-z]+(?!\p{{L}})", "¤")
    return F.regexp_replace(plain, rf"(?<!\p{{L}})(?!(?:{known})(?!\p{{L}}))\p{{L}}+", "§")


def normalize_instants(df: DataFrame, text: Column, zone: Column, day_order: Column, reference: Column, out: str = "utc_us") -> DataFrame:
    """``df`` with ``out``: UTC microseconds of ``text``, or null. ``reference`` is a TIMESTAMP or ISO text with offset."""
    version = tz_version()

    @F.pandas_udf(T.LongType())
    def convert(t: pd.Series, m: pd.Series, z: pd.Series, o: pd.Series, n: pd.Series) -> pd.Series:
        return instants(t, m, z, o, n, version)

    # else a filter on the result is pushed below the projection and the texts are parsed twice
    convert = convert.asNondeterministic()

    clean = F.regexp_replace(F.regexp_replace(text, r"(?U)[\s​﻿]+", " "), "^ | $", "")
    clean = F.when(clean.rlike("[0-9]"), clean)
    now = F.unix_micros(F.try_to_timestamp(reference.cast("string")))
    return (
        df.withColumn("__ts_text", clean)
        .withColumn("__ts_mask", shape_mask(F.col("__ts_text")))
        .withColumn(out, convert("__ts_text", "__ts_mask", zone, day_order, now))
        .drop("__ts_text", "__ts_mask")
    )
