"""Company resolution: the stated vectors, tie order, and the stdlib's similarity as a model."""

import difflib

from millrace.operators.resolve import dimension, fuzzy_tier, indices, mapping_log, register, resolve, review_queue

DIM = {"Nordwind AI": ["Nordwind AI, Inc.", "Nord Wind", "Nordwind LP"], "Anthrasol": ["Anthrasol PBC"], "zAI": ["Z AI Corp"], "Weights & Beams": ["W&B"], "Kelvino Labs": []}


def resolved(spark, names, dim=None):
    df = spark.createDataFrame([(i, n, "https://x") for i, n in enumerate(names)], "seq int, raw_name string, source_url string")
    out = resolve(df, dim if dim is not None else dimension(spark, DIM))
    return [out.filter(f"seq = {i}").first() for i in range(len(names))]


def test_tiers(spark):
    r = resolved(spark, ["Nordwind AI", "Nordwind AI, Inc.", "nord wind", "Nordwind", "Z", "Anthrasl PBC", "Completely Unrelated Startup Nine Zero Zero", "AI Labs", None, ""])
    said = [(x["canonical_name"], x["method"], x["confidence"]) for x in r]
    assert said[0] == ("Nordwind AI", "exact", 1.0)
    assert said[1] == ("Nordwind AI", "alias", 0.98)
    assert said[2] == ("Nordwind AI", "alias", 0.98)
    assert said[3] == ("Nordwind AI", "alias", 0.95)
    assert said[4] == ("zAI", "alias", 0.95)
    assert said[5][0] == "Anthrasol" and said[5][1] == "fuzzy" and said[5][2] >= 0.86
    assert said[6][:2] == (None, "unresolved") and r[6]["best_guess"] is None
    assert said[7] == (None, "unresolved", 0.0)
    assert r[8]["canonical_name"] is None
    assert said[9] == (None, "unresolved", 0.0)


def test_scores_and_ties_against_stdlib(spark):
    dim = dimension(spark, {f"NATION_{i}": [] for i in range(25)})
    names = ["NATION_1x", "NATON_3", "NTION_10", "nation-22", "NATION", "QQQ"]
    keys = [(r["key"], r["canonical"]) for r in indices(dim)[2].orderBy("first").collect()]
    tiny = {r["raw_name"]: r["fuzzy_name"] for r in fuzzy_tier(spark.createDataFrame([(n, n.lower()) for n in names], "raw_name string, norm string"), dim, 7).collect()}
    for name, row in zip(names, resolved(spark, names, dim)):
        best, score = None, 0.0
        for key, canonical in keys:
            s = difflib.SequenceMatcher(None, name.lower(), key).ratio()
            if s > score:
                best, score = canonical, s
        assert row["confidence"] == round(score, 3)
        assert tiny[name] == best  # blocks of keys give the same
        assert row["best_guess"] == (best if score >= 0.70 else None)
        assert row["method"] == ("fuzzy" if score >= 0.86 else "unresolved")


def test_log_review_and_registration(spark):
    dim = register(dimension(spark, DIM), "Brand New Startup", ["BNS Inc"])
    df = spark.createDataFrame([(1, "Brand New Startup", "u"), (2, "BNS Inc", "u"), (3, "Totally Unknown Thing", "u"), (3, "Totally Unknown Thing", "u")], "seq int, raw_name string, source_url string")
    out = resolve(df, dim)
    log = sorted((r["raw_name"], r["canonical_name"], r["method"]) for r in mapping_log(out).collect())
    assert log == [("BNS Inc", "Brand New Startup", "alias"), ("Brand New Startup", "Brand New Startup", "exact")] + [("Totally Unknown Thing", "(unresolved)", "unresolved")] * 2
    assert review_queue(out).count() == 2
    assert dimension(spark, DIM).count() == 5
    assert resolve(df.limit(0), dim).count() == 0
