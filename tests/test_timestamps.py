"""Instants of date texts (p2), against a brute-force parser that tries formats with the stdlib."""

import datetime as dt
import zoneinfo

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import timestamps
from millrace.operators.timestamps import NONE, ZoneTable, normalize_instants

SCHEMA = "id int, text string, zone string, order_ string, seen string, utc_us string, extra int"
SEEN = "2025-06-01T12:00:00.000000+00:00"


def us(*a):
    return int(dt.datetime(*a, tzinfo=dt.timezone.utc).timestamp() * 1_000_000)


CASES = [
    ("2025-01-05T20:30:58Z", us(2025, 1, 5, 20, 30, 58)), ("2025-01-06T12:10:34.470826000Z", us(2025, 1, 6, 12, 10, 34, 470826)), ("20250106T053436Z", us(2025, 1, 6, 5, 34, 36)),
    ("2025-01-07T04:03:03-09:30", us(2025, 1, 7, 13, 33, 3)), ("2025-01-07T04:03:03+0545", us(2025, 1, 6, 22, 18, 3)), ("2025-01-07 11:18:13.213+00", us(2025, 1, 7, 11, 18, 13, 213000)),
    ("Mon, 06 Jan 2025 22:15:22 +0100", us(2025, 1, 6, 21, 15, 22)), ("Fri, 10 Jan 2025 00:33:15 GMT", us(2025, 1, 10, 0, 33, 15)), ("1736576020", 1736576020 * 10**6), ("1736291868430", 1736291868430 * 1000), ("1736733657716643", 1736733657716643),
    ("2025-07-06", us(2025, 7, 5, 22)), ("2025/07/06", us(2025, 7, 5, 22)), ("05.01.2025 09:51", us(2025, 1, 5, 8, 51)), ("5/1/2025 9:19 PM", us(2025, 1, 5, 20, 19)), ("5/1/2025 12:19 AM", us(2025, 1, 4, 23, 19)), ("2025-W02-1", us(2025, 1, 5, 23)),
    ("6 January 2025, 09:03 CET", us(2025, 1, 6, 8, 3)), ("January 11, 2025 at 1:05 a.m. JST", us(2025, 1, 10, 16, 5)), ("2025-01-11T02:49 America/New_York", us(2025, 1, 11, 7, 49)), ("2025-01-11T02:49[Asia/Kolkata]", us(2025, 1, 10, 21, 19)),
    ("31. März 2024, 00:51 Uhr", us(2024, 3, 30, 23, 51)), ("27 octobre 2024 à 01h03", us(2024, 10, 26, 23, 3)), ("14 de junio de 2025, 03:02", us(2025, 6, 14, 1, 2)), ("5 février 2025", us(2025, 2, 4, 23)),
    ("3 hours ago", us(2025, 6, 1, 9)), ("Posted 2 days ago", us(2025, 5, 30, 12)), ("vor 5 Tagen", us(2025, 5, 27, 12)), ("il y a 4 heures", us(2025, 6, 1, 8)), ("Publicado hace 6 horas", us(2025, 6, 1, 6)), (" 2025-01-05T20:30:58Z ", us(2025, 1, 5, 20, 30, 58)),
    ("2350-07-01T00:00:00Z", us(2350, 7, 1)), ("1850-02-01 10:00+01", us(1850, 2, 1, 9)), ("2350-07-01 12:00", us(2350, 7, 1, 10)), ("Published by the desk and again on the front page of our paper edition, all times local to readers 2 hours ago", None),
    # no instant
    (None, None), ("", None), ("  ", None), ("unknown", None), ("2026", None), ("2026-02-29", None), ("31/02/2026", None), ("0000-00-00", None), ("25:61", None), ("2025-03-30T02:30:00", None), ("2024-10-27 02:30", None),
    ("13/13/2025", None), ("5/1/2025 13:19 PM", None), ("2 months ago", None), ("x" * 50_000 + "2025-01-05", None), ("2025-01-05T20:30:58 Mars/Base", None),
]


def test_cases(spark):
    rows = [(i, t, "Europe/Berlin", "DMY", SEEN, "old", 7) for i, (t, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["id"]: r["us"] for r in normalize_instants(df, F.col("text"), F.col("zone"), F.col("order_"), F.col("seen"), "us").collect()}
    wrong = [(t, got[i], want) for i, (t, want) in enumerate(CASES) if got[i] != want]
    assert wrong == []


def test_order_zone_and_repeats(spark):
    rows = [(1, "5/1/2025 09:00", "America/New_York", "MDY", SEEN, "", 0)] * 2 + [(2, "5/1/2025 09:00", None, "DMY", SEEN, "", 0), (3, "13/1/2025", "UTC", "MDY", SEEN, "", 0), (4, "1 hour ago", "UTC", "DMY", None, "", 0), (5, "5/1/2025", "UTC", None, SEEN, "", 0)]
    df = normalize_instants(spark.createDataFrame(rows, SCHEMA), F.col("text"), F.col("zone"), F.col("order_"), F.col("seen"), "us")
    got = sorted((r["id"], r["us"]) for r in df.filter("us IS NOT NULL").collect())
    assert got == [(1, us(2025, 5, 1, 13))] * 2
    assert df.count() == 6
    assert normalize_instants(spark.createDataFrame([], SCHEMA), F.col("text"), F.col("zone"), F.col("order_"), F.col("seen"), "us").count() == 0


@pytest.mark.parametrize("name", ["America/New_York", "Europe/London", "Australia/Sydney", "America/Sao_Paulo", "Asia/Kolkata", "Australia/Lord_Howe"])
def test_zone_table_against_zoneinfo(name):
    zone, tables = zoneinfo.ZoneInfo(name), [ZoneTable(zoneinfo.ZoneInfo(name), century) for century in (19, 20)]
    rng = np.random.default_rng(1)
    epoch = dt.datetime(1970, 1, 1)
    seconds = np.concatenate([rng.integers(0, 2_000_000_000, 300), *[s + o + rng.integers(-7200, 7200, 20) for table in tables for s, o in zip(table.starts[-40:], table.offsets[-40:]) if 0 < s < 2_000_000_000]]).astype(np.int64)
    got = np.where(seconds < 946_684_800, tables[0].to_utc(seconds), tables[1].to_utc(seconds))
    for s, g in zip(seconds.tolist(), got.tolist()):
        local = epoch + dt.timedelta(seconds=s)
        fits = {int(local.replace(tzinfo=zone, fold=f).timestamp()) for f in (0, 1)}
        fits = {u for u in fits if dt.datetime.fromtimestamp(u, zone).replace(tzinfo=None) == local}
        assert g == (fits.pop() if len(fits) == 1 else NONE)


def test_a_mask_tells_the_form(spark):
    texts = [f"{d}. {m} 2025, 0{d}:15 CET" for d in range(1, 9) for m in ("Mai", "Juni", "Juli", "April")] + ["5. Mars 2025, 01:15 CET"] + ["5. März 2025, 01:15 CET", "5 août 2025, 01:15 CET", "5 am 2025"]
    masks = {r["m"] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(timestamps.shape_mask(F.col("t")).alias("m")).collect()}
    assert masks == {"0. ¤ 0000, 00:00 ¤", "0. § 0000, 00:00 ¤", "0 § 0000, 00:00 ¤", "0 am 0000"}
    timestamps.PARSERS.clear()
    first = timestamps.parser_for("0. ¤ 0000, 00:00 ¤", texts[0])
    assert first is not None and timestamps.parser_for("0. ¤ 0000, 00:00 ¤", "no date at all") is first and len(timestamps.PARSERS) == 1
