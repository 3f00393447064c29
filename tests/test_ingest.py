"""News and job gates against a sequential model, in batch and on a stream; stats, typed records."""

import random

from pyspark.sql import functions as F

from millrace.operators import ingest
from millrace.streaming.news import stream_verdicts

SCHEMA = "seq long, url string, confidence string, fresh boolean, content_hash string"


def model(rows, state):
    state, out = dict(state), {}
    for seq, url, confidence, fresh, digest in sorted(rows):
        if confidence != "none":
            said = "kept" if fresh else "stale"
        else:
            said = "kept" if state.get(url) != digest else "duplicate"
        if said != "stale":
            state[url] = digest
        out[seq] = said
    return out, state


def random_rows(rng, n, start=0):
    rows = []
    for i in range(n):
        c = rng.choice(["structured", "relative", "none", "none"])
        rows.append((start + i, f"u{rng.randint(0, 5)}", c, None if c == "none" else rng.random() < 0.5, f"h{rng.randint(0, 2)}"))
    return rows


def dated(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("date", F.struct(F.col("confidence"), F.col("fresh").alias("is_fresh_24h"))).drop("confidence", "fresh")


def test_gate_equals_sequential_model(spark):
    rng = random.Random(3)
    for _ in range(6):
        first, second = random_rows(rng, 60), random_rows(rng, 60, 1000)
        want1, state1 = model(first, {})
        judged = ingest.gate_news(dated(spark, first))
        assert {r["seq"]: r["verdict"] for r in judged.collect()} == want1
        state = ingest.next_state(judged)
        assert {r["url"]: r["content_hash"] for r in state.collect()} == state1
        want2, state2 = model(second, state1)
        judged2 = ingest.gate_news(dated(spark, second), state)
        assert {r["seq"]: r["verdict"] for r in judged2.collect()} == want2
        assert {r["url"]: r["content_hash"] for r in ingest.next_state(judged2, state).collect()} == state2


def test_stream_equals_batch(spark, tmp_path):
    rng = random.Random(4)
    rows = random_rows(rng, 120)
    for i in range(3):
        dated(spark, rows[40 * i : 40 * i + 40]).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/{i}"))
    schema = dated(spark, rows[:1]).schema
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    q = stream_verdicts(src).writeStream.format("memory").queryName("verdicts").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = {r["seq"]: r["verdict"] for r in spark.sql("select * from verdicts").collect()}
    assert got == model(rows, {})[0]


def test_records_and_quarantine(spark):
    rows = [(1, "https://a/1", "h1", "kept", "none", None, "Acme hiring\nRemote engineer"), (2, "ftp://bad", "h2", "kept", "structured", "2026-08-28T02:00:00+00:00", "x"), (3, "https://a/3", "h3", "stale", "relative", "t", "y")]
    df = spark.createDataFrame(rows, "seq long, url string, content_hash string, verdict string, confidence string, iso string, full_text string")
    df = df.withColumn("date", F.struct(F.col("iso").alias("iso_timestamp"), F.col("confidence"), F.lit(None).cast("boolean").alias("is_fresh_24h"))).drop("iso", "confidence")
    ref = F.lit("2026-08-28 12:00:00").cast("timestamp")
    out = ingest.news_records(df, F.lit("src"), ref, F.lit("now")).collect()
    assert [(r["seq"], r["content"]["headline"], r["content"]["published_date"], r["date_confidence"]) for r in out] == [(1, "Acme hiring", "2026-08-28T12:00:00+00:00", "none")]
    good, bad = ingest.quarantine(df)
    assert (good.count(), bad.count()) == (2, 1)


def test_papers_take_the_newest_metrics(spark):
    import datetime as dt

    entries = spark.createDataFrame([("T", "see https://github.com/o/r. and more", "p1", ["A"], "d"), ("U", "none", "p2", [], None), ("V", "https://github.com/o/...", "p3", None, None)], "title string, summary string, paper_url string, authors array<string>, published string")
    t = dt.datetime(2025, 1, 1)
    stats = spark.createDataFrame([("o", "r", 5, t), ("o", "r", 9, t + dt.timedelta(days=1)), ("o", "", 3, t)], "owner string, repo string, stargazers_count long, fetched_at timestamp")
    out = {r["content"]["title"]: r["content"] for r in ingest.paper_records(entries, stats, F.lit("s"), F.lit("now")).collect()}
    assert (out["T"]["github_url"], out["T"]["github_stars"]) == ("https://github.com/o/r", 9)
    assert (out["U"]["github_url"], out["U"]["github_stars"]) == (None, None)
    assert (out["V"]["github_url"], out["V"]["github_stars"]) == ("https://github.com/o/", None)
