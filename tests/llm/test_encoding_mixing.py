"""Encoding (p8): equality with the tokenizer and an exact round trip. Mixing (p9): shares, caps, positions."""

import collections

from pyspark.sql import functions as F

from millrace.llm.encoding import decode_corpus, encode_corpus, encoder
from millrace.llm.mixing import mixture, shares, time_of, with_positions
from tests.helpers import connect, rows_of, rows_of_sql

TEXTS = [None, "", " ", "\n\n", "Hello  world!\n\n it's 2025 – naïve Straße", "日本語のテキスト。mixed", "👩‍🔬🚀 ​﻿ tab\t\tend ", "<|endoftext|> is text", "a" * 20_000, "word " * 5_000, "'s't'll'LL don't", "x\r\ny z w", "\U0001e030 new letters \U00011f02"]


def test_encoding(spark):
    rows = [(i, t, 1, "k") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], 1, "k"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, word string").repartition(3)
    got = [(r["doc_id"], r["ids"]) for r in encode_corpus(df, "doc_id", "text").collect()]
    assert len(got) == len(rows)
    enc = encoder("/opt/tokenizers/byte_bpe_50k.tiktoken")
    for doc, ids in got:
        assert ids == enc.encode_ordinary(TEXTS[doc] or "" if doc is not None else ""), doc
    once = encode_corpus(df.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), "doc_id", "text")
    back = {r["doc_id"]: r["text"] for r in decode_corpus(once, "doc_id").collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}
    assert encode_corpus(df.limit(0), "doc_id", "text").count() == 0


def test_words_outside_the_head(spark, monkeypatch):
    import millrace.llm.encoding as encoding

    monkeypatch.setattr(encoding, "HEAD_WORDS", 3)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    enc = encoder("/opt/tokenizers/byte_bpe_50k.tiktoken")
    for r in encode_corpus(df, "doc_id", "text").collect():
        assert r["ids"] == enc.encode_ordinary(TEXTS[r["doc_id"]] or "")


def test_decoded_sql(spark):
    from millrace.llm.registry import oracle_sql, queries

    d = "/root/testdata/sf0.001"
    assert rows_of(queries()["p8_decoded"](spark, d)) == rows_of_sql(connect(d), oracle_sql()["p8_decoded"])


def test_time_inverts_the_integral(spark):
    df = spark.range(0, 1001).select((F.col("id") / 1000).alias("u"))
    for tilt in (-0.9, -0.3, 0.0, 0.4, 0.9):
        t = time_of(F.col("u"), F.lit(tilt))
        worst = df.select(F.max(F.abs(t + tilt * (t * t - t) - F.col("u")))).first()[0]
        assert worst < 1e-9


def test_mixture(spark):
    docs = [(i, f"text number {i} of the large source " * 3, "big") for i in range(2000)]
    docs += [(10_000 + i, f"small {i} text " * 5, "small") for i in range(40)]
    docs += [(20_000 + i, "repeated text everywhere", s) for i, s in enumerate(["small", "big", "big", "other"])]
    docs += [(30_000, None, "big"), (30_001, "", "small"), (30_002, "unlisted", "other"), (30_003, "no source", None), (1, docs[1][1], "big")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.3, 4), ("absent", 0.1, 2), ("nothing", None, None)], "source_name string, target_share double, max_repeats int")
    mixed, plans = mixture(df, targets)
    rows = with_positions(mixed).collect()
    assert sorted(r["position"] for r in rows) == list(range(1, len(rows) + 1))
    assert [r["train_time"] for r in sorted(rows, key=lambda r: r["position"])] == sorted(r["train_time"] for r in rows)
    text = {d: t for d, t, _ in docs}
    used = collections.Counter(text[r["doc_id"]] for r in rows)
    cap = {"big": 1, "small": 4}
    for r in rows:
        assert used[text[r["doc_id"]]] <= cap[r["source"]]
    got = {r["source"]: r for r in shares(mixed, plans).collect()}
    assert abs(got["big"]["reached_share"] - 2 / 3) < 0.01 and abs(got["small"]["reached_share"] - 1 / 3) < 0.01
    assert got["absent"]["tokens"] == 0 and got["small"]["most_copies"] == 4
    late = [r["train_time"] for r in rows if r["source"] == "small"]
    assert sum(late) / len(late) > 0.52
    assert mixture(df.limit(0), targets)[0].count() == 0
