"""Template removal (p1), residue (p6) and repeats (p5) on a small site with known truth."""

import pytest
from pyspark.sql import functions as F

from millrace.llm.pages import Page, article_text
from millrace.llm.repeats import Words, articles, led_rounds, p5_found, p5_incremental, repeats_of, shingle_sets, verified, with_batch
from millrace.llm.residue import Residue, is_residue, p6_found, placeholder_as_value, template_lines

SCHEMA = "news_id long, source struct<name:string,url:string>, content struct<headline:string,full_text:string>, text string, host string"
TOPICS = "pumps bridges lenses turbines orchards violins ferries glaciers markets kilns looms beacons".split()
NAMES = "Tolani Vemura Kasodi Brenula Zumibo Rasketo Lipaven Sodrika Gamelu Fenotri Waluko Dribona".split()


def story(i):
    n, t = NAMES[i % 12], TOPICS[(i * 5) % 12]
    lines = [f"{n} opens plant {i} for {t}"]
    for k in range(4):
        lines.append(f"On day {k} the managers of {n} Works {i} said that the {t} programme number {k * 7 + i} had met {TOPICS[(i + k) % 12]} targets, although partners in {NAMES[(i + k + 1) % 12]} City asked for {k + i} more weeks of trials before any {TOPICS[(i * k + 3) % 12]} could be shipped.")
    return lines


TOP = ["Home | News | Sign in | Search", "We use cookies to measure visits. Accept all | Reject"]
BOTTOM = ["Other stories", "NEIGHBOUR", "Terms of use | Privacy | Contact", "© 2026 daily"]


def site(n=40):
    rows = []
    for i in range(n):
        article = story(i)
        bottom = [x if x != "NEIGHBOUR" else f"{NAMES[(i + 5) % 12]} group {i} wins prize" for x in BOTTOM]
        rows.append((i + 1, ("daily", f"https://daily.example/{i}"), (article[0], "\n".join([*TOP, "", *article, *bottom])), None, None))
    return rows


@pytest.fixture(scope="module")
def rows():
    base = site()
    base.append((101, ("daily", "u"), ("Error", "\n".join([*TOP, "404 Not Found", *BOTTOM[2:]])), None, None))
    base.append((102, ("daily", "u"), ("{{ headline }}", base[3][2][1]), None, None))
    base.append((103, ("daily", "u"), (base[4][2][0], "\n".join([*TOP, "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod.", *BOTTOM[2:]])), None, None))
    base.append((104, ("daily", "u"), (None, None), None, None))
    base.append((105, None, None, None, None))
    base.append((None, ("daily", "u"), ("Error", "404 Not Found"), None, None))
    base.append((106, (None, None), ("", "   \n\n"), None, None))
    base.append((107, ("daily", "u"), ("A story about errors", "\n".join([*TOP, *story(50), 'Visitors saw "404 Not Found" until the link was restored.', *BOTTOM[2:]])), None, None))
    return base


def test_template_lines(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["news_id"], r["line_no"]) for r in template_lines(df).collect()}
    for i in range(40):
        assert {n for k, n in got if k == i + 1} == {1, 2, 9, 10, 11, 12}, i
    assert not {k for k, _ in got} & {101, 102, 103, 104, 105, 106}
    assert template_lines(df.limit(0)).count() == 0


def test_residue_pages(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "news.parquet"))
    assert {r["news_id"] for r in p6_found(spark, str(tmp_path)).collect()} == {101, 102, 103}


@pytest.mark.parametrize(("t", "want"), [("Sales rose by {{ amount }} percent.", True), ("In the manual, a prompt such as {{ document }} is filled in.", False), ("Shipped [object Object] to hospitals", True), ("The template language writes variables as ${x}.", False), ("No sign of it.", False), ("[sic] he said", False)])
def test_placeholders(t, want):
    assert placeholder_as_value(t) is want


def test_screen_never_loses_residue():
    natural = [x for i in range(40) for x in story(i)[1:]]
    model = Residue(natural)
    texts = ["404 Not Found", "\n".join([*natural[:2], "Lorem ipsum dolor sit amet, consectetur adipiscing elit. " * 20]), "Please enable JavaScript to view this page.\nx", "\n".join(natural[:5]), "x" * 300_000]
    for t in texts:
        assert model.screen(["h"], [t]) == [2] or not is_residue(Page("h", t), model)
    assert model.screen([""] * 5, texts) == [model.screen([""], [t])[0] for t in texts]
    assert model.screen(["", "", ""], [texts[0], texts[1], texts[3]]) == [2, 2, 0]


def repeats_rows():
    base = site()
    light = story(3)
    light[2] = light[2].replace("managers", "bosses")
    cut = story(5)[:4]
    return base + [
        (201, ("other", "https://other.example/a"), ("x", "\n".join(light)), None, None),
        (202, ("other", "https://other.example/b"), ("x", "\n".join(cut)), None, None),
        (203, ("daily", "http://www.daily.example/7?utm=1"), (story(7)[0], "\n".join([*TOP, *story(7), *BOTTOM[2:]])), None, None),
        (204, ("daily", "https://daily.example/8"), (story(77)[0], "\n".join([*TOP, *story(77), *BOTTOM[2:]])), None, None),
        (205, ("other", None), ("x", "\n".join(light)), None, None),
        (206, ("other", None), (None, None), None, None),
    ]


def test_repeats(spark):
    rows = repeats_rows()
    df = spark.createDataFrame(rows + rows[-4:-2], SCHEMA)
    got = {(r["first_id"], r["repeat_id"]) for r in repeats_of(articles(df)).collect()}
    assert got == {(4, 201), (6, 202), (8, 203), (4, 205)}
    assert repeats_of(articles(df.limit(0))).count() == 0


def batches(arts, *edges):
    history, out = None, set()
    for low, high in zip((-1, *edges), (*edges, 10**9)):
        found, history = with_batch(arts.filter(f"news_id > {low} AND news_id <= {high}"), history)
        out |= {(r["first_id"], r["repeat_id"]) for r in found.collect()}
    return out, history


def test_links_are_the_same_in_any_batches(spark):
    """A copy that only agrees with an earlier repeat (4 -> 301 -> 302), and one that shares its bands with another article."""
    long = [x for k in range(4) for x in story(60 + k)]
    part = long[: len(long) // 2]
    chain = [
        (401, ("host401", None), (None, "\n".join(long)), None, None), (402, ("host402", None), (None, "\n".join(long[:14] + story(71)[1:4])), None, None), (403, ("host403", None), (None, "\n".join(part[6:] + story(71)[1:4])), None, None), (404, ("host404", None), (None, "\n".join(part)), None, None),
    ]
    arts = articles(spark.createDataFrame(repeats_rows() + chain, SCHEMA)).cache()
    want = {(r["first_id"], r["repeat_id"]) for r in repeats_of(arts).collect()}
    assert {(4, 201), (6, 202), (8, 203), (4, 205), (401, 402), (401, 403), (401, 404)} <= want
    for edges in ((200,), (200, 201, 203), (6, 202, 401, 402, 403)):
        got, history = batches(arts, *edges)
        assert got == want, edges
    assert history.sets.count() == arts.count() and history.tops.count() == len(want)
    assert batches(arts.limit(0))[0] == set()


def test_an_article_behind_another_of_its_bands(spark):
    """Bands led by an article that has nothing else in common go on to the next."""
    arts = articles(spark.createDataFrame(site(8), SCHEMA)).select("news_id", "address", "shingles").collect()
    same, other = arts[0]["shingles"], [r["shingles"] for r in arts[1:7]]
    rows = [(k + 1, None, s, [1, 2, 3, 4, 5]) for k, s in enumerate(other)] + [(50, None, same, [1, 2, 3, 4, 5]), (51, None, same, [1, 2, 3, 5, 9]), (52, None, other[0], [7, 8])]
    df = spark.createDataFrame(rows, "news_id long, address string, shingles binary, bands array<long>")
    assert {(r["first_id"], r["repeat_id"]) for r in repeats_of(df).collect()} == {(50, 51)}
    assert batches(df, 5, 50)[0] == {(50, 51)}


def test_queries_by_batch(spark, tmp_path):
    rows = [(*r[:3], 1 + (r[0] > 200) + (r[0] > 203)) for r in repeats_rows()]
    spark.createDataFrame(rows, "news_id long, source struct<name:string,url:string>, content struct<headline:string,full_text:string>, batch_no int").write.parquet(str(tmp_path / "news.parquet"))
    whole = {(r["first_id"], r["repeat_id"]) for r in p5_found(spark, str(tmp_path)).collect()}
    parts = [(r["first_id"], r["repeat_id"]) for r in p5_incremental(spark, str(tmp_path)).collect()]
    assert set(parts) == whole and len(parts) == len(whole) == 4


def test_recall_against_all_pairs(spark):
    df = spark.createDataFrame(repeats_rows(), SCHEMA)
    arts = articles(df).dropDuplicates(["news_id"]).cache()
    ids = arts.select(F.col("news_id").alias("first"))
    every = ids.crossJoin(arts.select(F.col("news_id").alias("repeat"))).filter("first < repeat")
    want = {r["repeat"] for r in verified(every, arts).collect()}
    assert {r["repeat"] for r in led_rounds(arts, lambda pairs: arts)[0].collect()} == want


def test_shingles():
    texts = ["one two three four", "", "a b c d e f Tolani h i j", "a b c d e f", "one two three four"]
    sets, bands = shingle_sets(texts, Words(frozenset()))
    assert [len(s) for s in sets] == [1, 0, 6, 2, 1] and bands.shape == (5, 48)
    assert (sets[0] == sets[4]).all() and (bands[0] == bands[4]).all() and (bands[1] == 0).all() and set(sets[3]) <= set(sets[2])
    for t, s, b in zip(texts, sets, bands):
        alone, its = shingle_sets([t], Words(frozenset()))
        assert (alone[0] == s).all() and (its[0] == b).all()
    assert article_text(Page("h", "")) == ""
