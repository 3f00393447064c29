"""Template removal (p1) and residue (p6) where counts are large, lines long, or error pages common."""

import numpy as np

from millrace.llm import residue
from millrace.llm.pages import LONG, ROOT, TEMPLATE, Page, flagged
from millrace.llm.residue import p1_found, p6_found
from tests.llm.test_pages import BOTTOM, SCHEMA, TOP, site

COUNTS = "site long, h long, here long, letters long, heads long, leads long, led long, all long"


def news(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "news.parquet"))
    return str(tmp_path)


def test_error_pages_that_a_host_served_often(spark, tmp_path):
    rows = site()
    notices = [("404 Not Found", 6), ("Please enable JavaScript to view this page.", 5)]
    bad = [(200 + 10 * k + i, ("daily", f"https://daily.example/n{k}{i}"), (f"Report {i}", "\n".join([*TOP, x, *BOTTOM[2:]])), None, None) for k, (x, n) in enumerate(notices) for i in range(n)]
    bare = [(300 + i, ("tiny", f"https://tiny.example/{i}"), (f"Number {i}", "502 Bad Gateway\nngx/3.66"), None, None) for i in range(4)]
    # a notice that all pages carry is the site's: a page of it alone says nothing
    plain = [(r[0] + 1000, ("other", r[1][1]), (r[2][0], r[2][1] + "\nPlease enable JavaScript to view this page."), None, None) for r in rows]
    plain += [(2000, ("other", "https://other.example/x"), (rows[3][2][0], "\n".join([*TOP, *BOTTOM[2:], "Please enable JavaScript to view this page."])), None, None)]
    path = news(spark, tmp_path, rows + bad + bare + plain)
    want = {r[0] for r in bad + bare}
    assert {r["news_id"] for r in p6_found(spark, path).collect()} == want
    assert not {r["news_id"] for r in p1_found(spark, path).collect()} & want


def test_template_of_a_host_beyond_a_million_elements(spark):
    counts = spark.createDataFrame([(7, 1, 20_000_000, 1 << 34, -1, 0, 0, 21_000_000), (7, 2, 1_200_000, 1 << 30, -1, 0, 0, 1_200_000), (0, 3, 5, 500, 1, 5, 31, 5), (7, 4, 9_000_000, 1 << 33, -1, 8_000_000, -1, 9_000_000)], COUNTS)
    sizes = spark.createDataFrame([(7, 30_000_000, -1), (0, 50, -1)], "size_site long, host_pages long, host_heads long")
    flags = {r["all"]: (r["flags"], r["all"]) for r in flagged(counts, sizes).collect()}
    place = lambda n, of: (n << 8) + flags[of][0]
    page = Page("h", "everywhere\nhere and there\nnowhere", [place(0, 21_000_000), place(1, 1_200_000)], [21_000_000, 1_200_000])
    assert page.kind == ["T", "R", "U"] and flags[5][0] & TEMPLATE and flags[5][0] & ROOT and flags[9_000_000][0] & ROOT and not flags[21_000_000][0] & ROOT


LEGAL = "All rights in the texts, pictures and tables of this site are held by the publisher and its partners; no part may be stored, copied or passed on in any form without a written permit, and all prices, times and routes are given without warranty. The publisher answers for its own pages alone and not for those that other sites link to."
COOKIES = "This site and its 312 partners store small files on your device to measure visits and to show what may interest you; by going on you agree to this, and under Settings, at the foot of each page, you may at any time say which of them you want."


def test_long_template_goes_and_copies_of_an_article_stay(spark, tmp_path):
    assert len(LEGAL) > 230 and len(COOKIES) > 140
    rows = [(i, s, (h, t.replace("\n\n", f"\n{COOKIES}\n") + f"\n{LEGAL}"), None, None) for i, s, (h, t), _, _ in site()]
    again = [(100 + i, ("daily", f"https://daily.example/again{i}"), rows[3][2], None, None) for i in range(3)]
    lost = [(200 + i, ("daily", f"https://daily.example/lost{i}"), (f"Report {i}", "\n".join([*TOP, COOKIES, "404 Not Found", *BOTTOM[2:], LEGAL])), None, None) for i in range(6)]
    path = news(spark, tmp_path, rows + again + lost)
    got = {(r["news_id"], r["line_no"]) for r in p1_found(spark, path).collect()}
    for r in rows + again:
        assert {n for k, n in got if k == r[0]} == {1, 2, 3, 9, 10, 11, 12, 13}, r[0]
    assert {r["news_id"] for r in p6_found(spark, path).collect()} == {r[0] for r in lost}


def test_labels_and_roots_are_learnt_from_counts(spark, tmp_path):
    """A label with another value on each page and lists of stories under a root that no list of words knows."""
    rows = []
    for i, s, (h, t), _, _ in site():
        head, *rest = t.replace("Other stories\n", "Zwamp of the day\n").split("\n© 2026")
        rows.append((i, s, (h, f"{head}\nQuilt: {h.split()[-1]} and {i} more\n© 2026{rest[0]}"), None, None))
    got = {(r["news_id"], r["line_no"]) for r in p1_found(spark, news(spark, tmp_path, rows)).collect()}
    for r in rows:
        assert {n for k, n in got if k == r[0]} == {1, 2, 9, 10, 11, 12, 13}, r[0]


def test_prose_is_counted_over_all_pages(spark, monkeypatch):
    """The model of prose has every paragraph of every page, at the weight of FIT_PAGES pages."""
    rows = [*site(), (900, ("daily", "u"), ("x", f"short\n{LEGAL}\n{'Lorem ipsum dolor sit amet ' * 9}"), None, None), (901, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    paragraphs = [x for r in rows if r[2] for x in r[2][1].split("\n") if len(x) >= LONG and "Lorem" not in x]
    want = residue.counts_of(paragraphs)
    assert np.array_equal(residue.natural_counts(df), want) and want.sum() == sum(map(len, paragraphs))
    monkeypatch.setattr(residue, "FIT_PAGES", 4)
    assert np.allclose(residue.natural_counts(df), want * 4 / 41)


def test_residue_and_repeats_share_the_model_of_all_pages(spark, monkeypatch):
    """p5 and p6 take their model from screened_lines: no page's prose is left out of it."""
    df, made = spark.createDataFrame(site(), SCHEMA), []
    init = residue.Residue.__init__
    monkeypatch.setattr(residue, "FIT_PAGES", 10)
    monkeypatch.setattr(residue.Residue, "__init__", lambda self, *a: made.append(a) or init(self, *a))
    residue.screened_lines(df)
    (natural, counted), = made
    assert natural == [] and np.allclose(counted, residue.counts_of([x for r in site() for x in r[2][1].split("\n") if len(x) >= LONG]) / 4)
