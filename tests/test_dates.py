"""Publication dates: the stated vectors, quirks, and the stdlib's parser as a model."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates

REF = "2026-08-28 12:00:00"


def normalized(spark, rows):
    df = spark.createDataFrame(rows, "id int, structured string, relative string")
    d = dates.normalize_publication(F.col("structured"), F.col("relative"), F.lit(REF).cast("timestamp"))
    return {r["id"]: r["d"] for r in df.select("id", d.alias("d")).collect()}


def test_tiers(spark):
    got = normalized(spark, [
        (1, "2026-08-28T02:00:00Z", None), (2, "2026-08-25T02:00:00Z", None), (3, None, "3 days ago"), (4, None, None), (5, "not-a-real-date", "1 hour ago"),
        (6, "2026-08-27T12:00:00Z", None), (7, "2026-08-28T12:00:01Z", None), (8, "2026-08-28T02:00:00+05:30", None), (9, None, "24 hours ago"), (10, None, "1d"), (11, "", ""), (12, None, "yesterday"),
    ])
    said = {k: (v["confidence"], v["is_fresh_24h"]) for k, v in got.items()}
    assert said == {1: ("structured", True), 2: ("structured", False), 3: ("relative", False), 4: ("none", None), 5: ("relative", True), 6: ("structured", True), 7: ("structured", False), 8: ("structured", True), 9: ("relative", True), 10: ("relative", True), 11: ("none", None), 12: ("relative", False)}
    assert got[8]["iso_timestamp"] == "2026-08-28T02:00:00+05:30"
    assert got[4]["iso_timestamp"] is None
    assert got[9]["iso_timestamp"] == "2026-08-27T12:00:00+00:00"


@pytest.mark.parametrize(
    ("text", "seconds"),
    [
        ("2 hours ago", 7200), ("just now", 30), ("Yesterday", 129600), ("today", 3600), ("5h", 18000), ("5h ago", None), ("5m ago", None), ("an hour ago", None), ("3d ago", 259200),
        ("posted 3 days ago, updated 2 hours ago", 259200), ("2 months ago", 5184000), ("1 year ago", 31536000), ("", None), (None, None), ("99999999999999999999 days ago", None), ("  1D ", 86400),
    ],
)
def test_relative(spark, text, seconds):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(dates.seconds_ago(F.col("t"))).first()[0] == seconds


ACCEPTED = ["20260828", "2026-W35-5", "2026-W35", "2026-08-28x02:00", "2026-08-28T02:00:00,5", "2026-08-28 02:00", "2026-08-28T02", "2026-08-28T02:00:00.123456789Z", "20260828T020000+0000", "2026-08-28T02:00:00-0530", "2024-02-29", " 2026-08-28 ", "2020-W53-7"]
REJECTED = ["2026", "2026-08", "12:30", "2026-8-28", "2026-08-28T24:00:00", "2026-08-28T02:00:60", "Fri, 28 Aug 2026 02:00:00 GMT", "2026-02-29", "2026-13-01", "2026-W54-1", "2021-W53-1", "x", "2026-08-28T02:00:00 nonsense"]


def test_structured_agrees_with_stdlib(spark):
    df = spark.createDataFrame([(t,) for t in ACCEPTED + REJECTED], "t string")
    got = {r["t"]: r["s"] for r in df.select("t", dates.parse_structured(F.col("t")).alias("s")).collect()}
    for t in ACCEPTED:
        want = dt.datetime.fromisoformat(t.strip().replace("Z", "+00:00").replace(",", "."))
        want = want if want.tzinfo else want.replace(tzinfo=dt.timezone.utc)
        assert got[t] is not None, t
        assert got[t]["ts"] == want.astimezone(dt.timezone.utc).replace(tzinfo=None), t
        assert got[t]["iso"] == want.isoformat(), t
    assert [t for t in REJECTED if got[t] is not None] == []


def test_novelty(spark):
    df = spark.createDataFrame([("h1", "h2", True), ("h1", "h1", False), (None, "h3", True)], "prev string, now string, want boolean")
    assert df.filter(dates.is_new_since(F.col("prev"), F.col("now")) != F.col("want")).count() == 0
