"""Text scalars, chunking, merging, providers, feeds and sinks."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators import chunk as chunks
from millrace.operators import providers
from millrace.sources import feeds, sinks


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(("t", "family"), [("research engineer", "Engineering"), ("solutions engineer", "Engineering"), ("the answer", "Engineering"), ("build things", "Design"), ("PhD student", "Research"), ("", "Unclassified"), ("cook", "Unclassified")])
def test_roles(spark, t, family):
    assert one(spark, t, text.role_family) == family


@pytest.mark.parametrize(("t", "want"), [("Acme,Inc", "acmeinc"), ("AI Labs", ""), ("  Acme   Technologies Ltd. ", "acme"), (None, None)])
def test_normalized_names(spark, t, want):
    assert one(spark, t, text.normalized_name) == want


@pytest.mark.parametrize(("t", "want"), [("see https://github.com/o/r.", "https://github.com/o/r"), ("http://github.com/o/r.git", "https://github.com/o/r.git"), ("https://www.github.com/o/r", None), ("https://github.com/o/...", "https://github.com/o/"), (None, None)])
def test_repo(spark, t, want):
    assert one(spark, t, text.code_host_url) == want


def test_html(spark):
    assert one(spark, "<h1 class=x>A <b>B</b></h1>", text.page_title) == "A B"
    assert one(spark, "<p>x</p>", text.page_title) is None
    assert one(spark, "1,234 stars", text.stars_hint) == 1234
    assert one(spark, ", stars", text.stars_hint) is None
    walled = lambda h, s: spark.createDataFrame([(h, s)], "h string, s int").select(text.bot_walled(F.col("h"), F.col("s"))).first()[0]
    assert walled("x" * 199, 200) and not walled("x" * 200, 200) and walled("x" * 300, 403) and walled("Just a moment..." + "x" * 300, 200) and walled(None, 200)
    for u, ok in (("HTTP://a", False), ("/rel", False), ("https://a", True), (None, False)):
        assert one(spark, u, text.valid_url) is ok


def test_banners_and_tokens(spark):
    assert one(spark, "Subscribe to our newsletter today!\n\nBody text", text.strip_banner_lines) == "Body text"
    assert one(spark, "a\n\n\n\nb ", text.strip_banner_lines) == "a\n\nb"
    assert one(spark, "x" * 400, text.estimate_tokens) == 100
    assert one(spark, "", text.estimate_tokens) == 1
    assert one(spark, "a\n \nb\n\n\n", text.paragraphs) == ["a", "b"]
    assert one(spark, '{"retry_after": 0, "retryAfter": "2.5"}', text.retry_after) == 2.5
    assert one(spark, '{"retry_after": "soon"}', text.retry_after) is None
    assert one(spark, "not json", text.retry_after) is None


def chunked(spark, t, most, overlap=150):
    df = spark.createDataFrame([(1, t, "z")], "id int, text string, clean string")
    return [(r["index"], r["text"], r["estimated_tokens"]) for r in chunks.chunk(df, "id", "text", most, overlap).orderBy("index").collect()]


def test_chunks(spark):
    assert chunked(spark, "short", 6000) == [(0, "short", 1)]
    assert chunked(spark, "", 6000) == [(0, "", 1)]
    assert chunked(spark, None, 6000) == []
    keyless = spark.createDataFrame([(None, "y" * 900), (2**60 + 1, "z" * 900)], "id long, text string")
    assert {(r["id"], r["index"]) for r in chunks.chunk(keyless, "id", "text", 200).collect()} == {(None, 0), (None, 1), (2**60 + 1, 0), (2**60 + 1, 1)}
    hard = chunked(spark, "y" * 200_000, 1000)
    assert len(hard) == 50 and max(c[2] for c in hard) <= 1000
    paragraph = "Sentence number one here. " * 50
    many = chunked(spark, "\n\n".join([paragraph] * 10), 500)
    assert len(many) > 1 and all(c[2] <= 700 for c in many)
    two = chunked(spark, "\n\n".join(["A" * 400 + "."] * 5 + ["B" * 400 + "."] * 5), 300, 50)
    assert len(two) >= 2 and two[1][1].startswith(two[0][1][-200:])
    no_carry = chunked(spark, "\n\n".join(["A" * 400] * 6), 300, 0)
    assert "".join(c[1].replace("\n", "") for c in no_carry) == "A" * 2400


def test_merging(spark):
    rows = [(1, 0, None, None, ["a", "b"]), (1, 1, "t", 0, ["b", "c"]), (1, 2, "u", 5, None), (2, 0, "", None, ["x", "x"]), (3, 5, None, None, None)]
    df = spark.createDataFrame(rows, "id int, i int, title string, stars int, authors array<string>").repartition(3)
    got = {r["id"]: (r["title"], r["stars"], r["authors"]) for r in chunks.merge_typed(df, "id", "i", ["title", "stars"], ["authors"]).collect()}
    assert got == {1: ("t", 0, ["a", "b", "c"]), 2: (None, None, ["x", "x"]), 3: (None, None, None)}
    assert providers.merged([{"a": None, "n": 0, "l": []}, {"a": "x", "n": 1, "l": [1]}, {"a": ["y"], "l": [1, {"k": 1}]}]) == {"a": "x", "n": 0, "l": [1, {"k": 1}]}
    body = spark.createDataFrame([(1, 0, '{"a": null, "l": ["p"]}'), (1, 1, '{"a": "v", "l": ["p", "q"]}')], "doc_id int, chunk_idx int, body string")
    assert sorted((r["field"], r["value"]) for r in chunks.merge_json(body).collect()) == [("a", "v"), ("l", '["p","q"]')]


class Fake:
    def __init__(self, name, answers):
        self.name, self.answers, self.calls = name, answers, 0

    def complete_json(self, system, user):
        answer = self.answers[min(self.calls, len(self.answers) - 1)]
        self.calls += 1
        if isinstance(answer, Exception):
            raise answer
        return answer


def test_providers():
    slept = []
    policy = providers.Backoff(draw=lambda: 1.0, sleep=slept.append)
    assert [*policy.ceilings(), 60.0] == [1, 2, 4, 8, 16, 32, 60]
    ask = lambda *tried, policy=policy, prompt="p": [(o.provider, o.answer) for o in providers.Fallback(list(tried), "s", policy).outcomes(prompt)]
    flaky = Fake("a", [providers.RateLimited(7.0), providers.RateLimited(), {"x": 1}])
    assert ask(flaky) == [("a", {"x": 1})] and slept == [7.5, 2.0]
    assert ask(Fake("a", [ValueError("no")]), Fake("b", [{"y": 2}]), Fake("c", [{}])) == [("a", None), ("b", {"y": 2})]
    big = Fake("a", [providers.TooLarge(), {"k": "v"}, {"k": "w"}])
    assert ask(big, prompt="w " * 5000) == [("a", {"k": "v"})] and big.calls == 3
    never = Fake("a", [providers.RateLimited()])
    assert ask(never, policy=providers.Backoff(retries=1, sleep=slept.append)) == [("a", None)] and never.calls == 2
    assert providers.distinct([1, [2], 1, [2], 3]) == [1, [2], 3]


def packed_by_hand(text, most, overlap):
    """Paragraph by paragraph, on texts."""
    out, here, led = [], [], False
    size = lambda parts: sum(max(1, len(p) // 4) for p in parts)
    for p in [p for p in re.split(r"\n\s*\n", text) if p.strip()]:
        if size([p]) > most:
            out += ["\n\n".join(here)] if here else []
            out += [p[i : i + 4 * most] for i in range(0, len(p), 4 * most)]
            here = []
        elif size([*here, p]) > most:
            out.append("\n\n".join(here))
            here = [out[-1][-4 * overlap :], p] if overlap else [p]
        else:
            here.append(p)
    return out + (["\n\n".join(here)] if here else [])


@given(st.lists(st.integers(1, 90), max_size=14), st.integers(2, 15), st.integers(0, 6))
@settings(max_examples=300, deadline=None)
def test_packing_by_sizes_is_packing_by_hand(sizes, most, overlap):
    text = "\n\n".join(chr(97 + i) * n for i, n in enumerate(sizes))
    assert chunks.pack(text, most, overlap) == packed_by_hand(text, most, overlap)


def test_feeds(spark):
    xml = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>u1</id><title> A\nB </title><summary>s</summary><published>2025-01-01</published><author><name> N </name></author><author></author></entry><entry><title>C</title></entry></feed>'
    df = spark.createDataFrame([(1, xml), (2, "<feed"), (3, None)], "page int, xml string")
    rows = feeds.feed_entries(df).orderBy("entry_no").collect()
    assert [(r["page"], r["title"], r["summary"], r["published"], r["paper_url"], r["authors"]) for r in rows] == [(1, "A\nB", "s", "2025-01-01", "u1", ["N", ""]), (1, "C", "", None, "", [])]
    assert feeds.newest(feeds.feed_entries(df), 0).count() == 0
    assert [r["url"] for r in feeds.feed_requests(spark, "http://b/q", "cat:x", 150).orderBy("start").collect()] == [f"http://b/q?search_query=cat:x&start={s}&max_results=100&sortBy=submittedDate&sortOrder=descending" for s in (0, 100)]
    source = feeds.paged_feed_source(lambda start, size: [(str(start), f"<feed n='{size}'/>")])
    spark.dataSource.register(source)
    assert sorted((r["page"], r["xml"]) for r in spark.read.format("paged_feed").option("limit", "150").load().collect()) == [("0", "<feed n='100'/>"), ("100", "<feed n='50'/>")]
    links = feeds.listing_links(spark.createDataFrame([("L", '<a href="x">1</a><a href="y">2</a><a href="x">3</a>')], "url string, html string"))
    assert [(r["pos"], r["url"]) for r in links.orderBy("pos").collect()] == [(0, "x"), (1, "y"), (2, "x")]
    robots = spark.createDataFrame([("h", "User-agent: *\nDisallow: /no")], "host string, body string")
    urls = spark.createDataFrame([("http://h/no/1",), ("http://h/yes",), ("http://other/no",), (None,)], "url string")
    assert {r["url"]: r["allowed"] for r in feeds.robots_allowed(urls, robots).collect()} == {"http://h/no/1": False, "http://h/yes": True, "http://other/no": True, None: True}


def test_url_batch_keeps_errors(spark):
    def handler(row):
        if "bad" in row["url"]:
            raise ValueError("broken")
        return {"n": len(row["html"])}

    pages = spark.createDataFrame([("http://a/1", 200, "xyz"), ("http://a/bad", 200, ""), ("http://b/2", -1, "")], "url string, status int, html string")
    got = {r["url"]: (r["result"], r["error"]) for r in providers.run_url_batch(pages, handler).collect()}
    assert got == {"http://a/1": ('{"n": 3}', None), "http://a/bad": (None, "ValueError: broken")}


def test_extraction_inside_spark(spark):
    prompts = spark.createDataFrame([(2**60 + 1, 0, "p"), (None, 1, "fail")], "doc_id long, chunk_idx int, prompt string")

    class Echo:
        name = "echo"

        def complete_json(self, system, user):
            if user == "fail":
                raise ValueError("no")
            return {"said": user}

    got = providers.extract_chunks(prompts, lambda: [Echo()], "sys").orderBy("chunk_idx").collect()
    assert (got[0]["body"], got[0]["degraded"], got[0]["error"]) == ('{"said": "p"}', False, None) and got[0]["doc_id"] == 2**60 + 1
    assert got[1]["body"] is None and "no" in got[1]["error"]


def test_sinks(spark, tmp_path):
    log = spark.createDataFrame([("a", "A", 1.0, "exact", "u")], "raw_name string, canonical_name string, confidence double, method string, source_url string")
    papers = spark.createDataFrame([("1.0", "RESEARCH_PAPER", ("n", "u"), ("T", "p", ["A", None, "B"], None, None, None), "now")], "schemaVersion string, recordType string, source struct<name:string,url:string>, content struct<title:string,paper_url:string,authors:array<string>,github_url:string,github_stars:bigint,published_date:string>, collectedAt string")
    assert sinks.flat(papers, "Research Papers").first()["content.authors"] == "A; ; B"
    paths = sinks.write_all({"Entity Mapping Log": log, "Research Papers": papers}, str(tmp_path))
    paths = sinks.write_all({"Entity Mapping Log": log, "Research Papers": papers}, str(tmp_path))
    assert list(paths) == ["Research Papers", "Entity Mapping Log"] and spark.read.parquet(paths["Entity Mapping Log"]).count() == 1
