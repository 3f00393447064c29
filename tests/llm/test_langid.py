"""Languages (p10): held-out accuracy on the checked labels, segments, texts without language, the forward sum."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm.langid import UNKNOWN, Model, fit_models, has_language, label_code, lines_with_language, words_of
from millrace.session import table

DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def parts(spark):
    docs = table(spark, DIR, "documents").select("doc_id", "text", "lang")
    labels = table(spark, DIR, "lang_labels")
    held = labels.filter("doc_id % 2 = 0")
    return docs, held, fit_models(docs.join(held.select("doc_id"), "doc_id", "left_anti"), labels.filter("doc_id % 2 = 1"))


def test_held_out_accuracy(spark, parts):
    docs, held, model = parts
    found = lines_with_language(docs.join(held.select("doc_id"), "doc_id", "left_semi"), model).groupBy("doc_id").agg(F.first("doc_lang").alias("got"))
    both = held.join(found, "doc_id").collect()
    assert len(both) == held.count() and sum(r["got"] == r["lang"] for r in both) >= 0.99 * len(both)


def test_segments_and_nothing(spark, parts):
    model = parts[2]
    rows = [(1, "The group found three faults in its software last week.\n\nDas Unternehmen eröffnet ein zweites Büro in der Stadt und nennt keine Gründe.\nThe numbers remain thin, according to people close to the matter.", "en"), (2, None, "en"), (3, "", ""), (4, " \n\t", "de"), (5, "404 ... 12", None), (6, "for i in range(7):\n\tprint(i ** 2)\n", "en"), (7, "SELECT name, count(*) FROM t1 GROUP BY 1;", None), (8, "🚀🚀", "en"), (None, "The company opened an office.", None), (9, "Кто заплатит за это, пока неясно.", "en"), (10, "The company opened an office. " * 20_000, None)]
    got = [(r["doc_id"], r["line_no"], r["lang"], r["mixed"]) for r in lines_with_language(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model).collect()]
    assert sorted(got) == [(1, 1, "en", True), (1, 3, "de", True), (1, 4, "en", True), (9, 1, "ru", False), (10, 1, "en", False)]
    assert fit_models(spark.createDataFrame([], "doc_id long, text string, lang string"), None) is None


def test_forward_sums_all_segmentations():
    model = Model(["a", "b"])
    rng = np.random.default_rng(0)
    model.p = rng.random(model.p.shape)
    model.p /= model.p.sum(0)
    text, arcs = model.arcs("paper")
    total = np.zeros(2)
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(text)]
        p, start = np.ones(2), 0
        for e in ends:
            k = model.index.get(text[start:e])
            p = p * ((model.p[k] if k is not None else 0) + (UNKNOWN if e - start == 1 else 0))
            start = e
        total += p
    assert np.allclose(model.score("paper"), np.log(total))
    assert math.isfinite(model.score("字" * 500).max())
    words = ["paper", "字" * 500, "a", "papers", "paper"]
    assert np.allclose(model.lines([words, ["a"]]), [sum(model.score(w) for w in words), model.score("a")])
    assert words_of("aaaaaaaaaaaaaaaaaaaa one 漢漢漢漢漢漢漢漢漢漢漢漢漢漢") == ["one"]


@pytest.mark.parametrize(("label", "code"), [("English", "en"), ("pt-BR", "pt"), ("Deutsch", "de"), ("français", "fr"), ("und", ""), (None, ""), ("", ""), ("zh-Hans", "zh"), ("EN", "en"), ("jpn", "ja")])
def test_labels(label, code):
    assert label_code(label) == code


def test_code_lines():
    for line in ("$ run --steps 201 --out /tmp/x201.bin", '{"id": 0, "ok": true}', "x = [i for i in y]"):
        assert not has_language(line, words_of(line))
