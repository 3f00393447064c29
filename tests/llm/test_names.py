"""Names: parsing, distance, mapping to a list (p3), linking of variants (p7)."""

import itertools

import pytest

from millrace.llm.distance import deletes, weighted_distance
from millrace.llm import linking
from millrace.llm.linking import channel_cost, link_forms, name_of, roots, typo_keys
from millrace.llm.matching import Dictionary, map_names
from millrace.llm.names import Grammar, sectors_of

SECTORS = "ai logistics foods software energy analytics compute cloud health systems research learning networks".split()
GRAMMAR = Grammar(SECTORS)
parse = GRAMMAR.parse


def form_of(raw):
    return linking.form_of(raw, GRAMMAR)


@pytest.mark.parametrize(
    ("raw", "core", "sector"),
    [
        ("Norvide Compute", ("norvide",), "compute"), ("NORVIDE  COMPUTE, INC.", ("norvide",), "compute"), ("Careers @ Norvide Compute", ("norvide",), "compute"), ("Norvide Compute (Remote)", ("norvide",), "compute"),
        ("Norvide Comp.", ("norvide",), "compute"), ("Compute, Tolani Vemu", ("tolani", "vemu"), "compute"), ("Tolani & Vemu Health plc", ("tolani", "vemu"), "health"), ("TVH – Tolani Vemu", ("tolani", "vemu"), ""),
        ("Ｔｏｌａｎｉ Vému Hlth", ("tolani", "vemu"), "health"), ("T0lani-Vemu", ("tolani", "vemu"), ""), ("The Tolani people", ("tolani",), ""), ("TolaniVemu AI", ("tolani", "vemu"), "ai"), ("Tоlаni Vemu, Goport office", ("tolani", "vemu"), ""),
    ],
)
def test_parse(raw, core, sector):
    assert (parse(raw).core, parse(raw).sector) == (core, sector)


def brute(a, b):
    """Unweighted edits with swaps of neighbours: an upper bound of the weighted distance."""
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_distance_and_deletes():
    words = ["tolani", "tolni", "otlani", "tolanni", "tolane", "vemu", "vmeu", ""]
    for a, b in itertools.product(words, words):
        w = weighted_distance(a, b, 9)
        assert w <= brute(a, b) and w >= 0.6 * brute(a, b) and (w == 0) == (a == b)
        if brute(a, b) <= 1:
            assert deletes(a, 1) & deletes(b, 1)
    assert weighted_distance("tolani", "zzzzzz", 2.0) == float("inf")


#: Names that make their last words sectors.
PEERS = [(100 * k + i, f"{head} {s.title()}", []) for k, s in enumerate(["ai", "foods", "energy", "compute", "health"], 1) for i, head in enumerate(["Kalufe", "Dimorr", "Petsan"])]
REFERENCE = [(1, "Norvide Compute", ["Norvide Compute Ltd", "NCOM", "Olden Foods"]), (2, "Tolani Vemu Health", []), (3, "Golzeno", None), (4, "Sabrilo AI", ["Sabrilo AI AG"])]


def test_mapping(spark):
    names = [
        ("Norvide Comptue", 1), ("norvide compute", 1), ("olden foods inc", 1), ("ncom", 1), ("Vemu Health Tolani", 2), ("Tolani V. Health", 2), ("tolani vemu", 2), ("Golzenno", 3), ("Golzeno Energy", -1), ("Sabrilo Au", 4), ("Sabrlio AI", 4),
        ("Norvide Foods", -1), ("Unrelated Trading", -1), ("n/a", -1), ("???", -1), ("x" * 20_000, -1), ("".join(chr(97 + i * i % 23) for i in range(20_000)), -1), (" ".join(f"w{chr(97 + i % 26)}{i}, x" for i in range(4_000)), -1), ("Norvide Compute", None), ("NCOM", None), (None, None), ("  ", None), ("", None), ("Golzenno", 3),
    ]
    df = spark.createDataFrame([(i, n, 5, "z") for i, (n, _) in enumerate(names)], "id int, raw string, __n int, listed string")
    ref = spark.createDataFrame(REFERENCE + PEERS, "ord int, canonical string, aliases array<string>")
    got = {r["id"]: r["entry"] for r in map_names(df, "raw", ref, "entry").collect()}
    assert got == {i: o for i, (_, o) in enumerate(names) if o is not None}
    assert {r["id"]: r["entry"] for r in map_names(df, "raw", ref, "entry", 7).collect()} == got  # a list beyond one block
    assert {r["entry"] for r in map_names(df, "raw", ref.limit(0), "entry").collect()} == {-1}
    assert map_names(df.limit(0), "raw", ref, "entry").count() == 0


def test_ties_go_to_the_smaller_entry():
    assert Dictionary([(7, "Tolani Health", []), (2, "Tolami Health", []), (9, "Other Health", [])]).find("Tolaxi Health")[1] == 2


def test_channel():
    cost = lambda v, m: channel_cost(name_of(form_of(v)), name_of(form_of(m)))
    assert cost("Tolani Vemu", "Tolani Vemu Health") < 1
    assert cost("Tolani V. Health", "Tolani Vemu Health") < 1
    assert cost("Vemu Tolani Health", "Tolani Vemu Health") < 1
    assert cost("tolanivemuhealth", "Tolani Vemu Health") < 1
    assert cost("Tolani Rasko", "Tolani Vemu Health") == float("inf")
    assert cost("Tolani Foods", "Tolani Health") == float("inf")
    assert cost("Tolani Health", "Tolani") == float("inf")


def test_linking(spark):
    names = ["Tolani Vemu Health"] * 6 + ["Tolani Vmeu Health", "TOLANI VEMU", "Vemu Health Tolani", "Tolani V. Health", "Tolani HQ", "Rasko Vemu Health", "Zumibo Katre Foods", "Zumibo Kater Foods", "Norvide Compute", "Olden Foods", "Bravono Limpe", "Bravono Sisti"]
    rows = {}
    for n in names:
        rows[form_of(n)] = rows.get(form_of(n), 0) + 1
    forms = spark.createDataFrame(list(rows.items()), "form string, n long")
    ref = spark.createDataFrame(REFERENCE[:1] + PEERS, "ord int, canonical string, aliases array<string>")
    root = {r["form"]: r["root"] for r in link_forms(forms, ref, GRAMMAR).collect()}
    of = lambda n: root[form_of(n)]
    assert len({of(n) for n in names[:10]} | {of("Tolani HQ")}) == 1
    assert of("Rasko Vemu Health") != of("Tolani Vemu Health")
    assert of("Zumibo Katre Foods") == of("Zumibo Kater Foods")
    assert of("Norvide Compute") == of("Olden Foods")
    assert of("Bravono Limpe") != of("Bravono Sisti")
    assert link_forms(forms.limit(0)).count() == 0


def test_roots_of_long_chains(spark):
    links = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(20)], "form string, parent string")
    assert {r["root"] for r in roots(links).collect()} == {"n20"}


def test_sectors_are_what_names_share():
    assert sectors_of(["A Foods", "B Foods", "C Foods", "A Inc", "B Inc", "C Inc", "D Cloud", "Solo"]) == ["foods"]
    g = Grammar("ai software research biosciences semiconductors compute energy security systems networks materials analytics".split())
    short = {"sw": "software", "rsrch": "research", "bio": "biosciences", "semi": "semiconductors", "comp": "compute", "en": "energy", "sys": "systems", "nets": "networks", "matls": "materials", "an": "analytics", "se": "", "ltd": ""}
    assert {w: g.sector_of(w) for w in short} == short


def test_keys_of_long_words_meet_within_two_edits():
    word = "".join(chr(97 + i * i % 23) for i in range(60))
    for other in (word[:10] + word[11:], word[:30] + "zz" + word[30:], word[:5] + "z" + word[6:40] + word[41:], word[1:] + "q", word):
        assert typo_keys(word, 2) & typo_keys(other, 2)
    assert len(typo_keys("".join(chr(97 + i * i % 23) for i in range(5_000)), 2)) <= 75
    assert not typo_keys(word, 2) & typo_keys(word[::-1], 2)


def test_rows_of_keys_are_not_broadcast(spark, tmp_path):
    """A small file of forms has many times its size in keys, which must not be gathered on the driver."""
    forms = [(i, f"tolani{chr(97 + i % 26)}{chr(97 + i // 26)} vemura|health|", 1 + i % 5) for i in range(300)]
    spark.createDataFrame(forms, "id long, form string, n long").write.parquet(str(tmp_path / "forms"))
    read = spark.read.parquet(str(tmp_path / "forms"))
    found = linking.attach(read, read, read)
    joined = [x for x in found._jdf.queryExecution().executedPlan().toString().split("\n") if "Join" in x and "key#" in x]
    assert joined and all("SortMergeJoin" in x for x in joined)
    assert found.count() > 0
