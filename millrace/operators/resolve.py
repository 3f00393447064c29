"""Company names against a canonical dimension in four tiers: exact, alias, normalised, fuzzy.

The dimension is a table (ord, canonical, aliases). The three equality tiers are joins on its keys. The distinct names that
none of them knows are a query set against the dimension's normalised keys, in blocks of ``BLOCK`` keys: in Arrow batches,
the letters that a name shares with each key bound their Ratcliff-Obershelp similarity from above, and only keys whose bound
exceeds the best score so far are scored. Null names resolve to nothing; ties go to the entry that came first.
"""

from __future__ import annotations

import difflib
import functools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import normalized_name, py_strip
from millrace.session import shuffle_width

ACCEPT, REVIEW = 0.86, 0.70
BLOCK = 50_000  # keys that are broadcast at once, with 64 bytes of letter counts each
RESOLUTION = "raw_name string, fuzzy_name string, fuzzy_score double, first_ord int, first_pos int"


def dimension(spark, mapping: dict[str, list[str]]) -> DataFrame:
    """The dimension from an ordered mapping of canonical names to aliases."""
    return spark.createDataFrame([(i, c, a) for i, (c, a) in enumerate(mapping.items())], "ord int, canonical string, aliases array<string>")


def register(dim: DataFrame, canonical: str, aliases: list[str]) -> DataFrame:
    """A new version of the dimension with one more entry; the old one stays as it was."""
    last = dim.agg(F.coalesce(F.max("ord") + 1, F.lit(0)).alias("ord"))
    new = last.select(F.col("ord").cast("int").alias("ord"), F.lit(canonical).alias("canonical"), F.array(*[F.lit(a) for a in aliases]).cast("array<string>").alias("aliases"))
    return dim.select("ord", "canonical", "aliases").unionByName(new)


def indices(dim: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """R2: (key, canonical) for the exact and alias tiers, (key, canonical, first: where the key
    comes first) for the normalised one."""
    named = dim.filter("canonical IS NOT NULL").select("ord", "canonical", F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"))
    alias = named.select("ord", "canonical", F.posexplode("aliases").alias("pos", "alias")).filter("alias IS NOT NULL")
    exact = named.groupBy(F.lower(py_strip(F.col("canonical"))).alias("key")).agg(F.max_by("canonical", "ord").alias("canonical"))
    by_alias = alias.groupBy(F.lower(py_strip(F.col("alias"))).alias("key")).agg(F.max_by("canonical", F.struct("ord", "pos")).alias("canonical"))
    spelled = named.select("ord", F.lit(-1).alias("pos"), "canonical", normalized_name(F.col("canonical")).alias("key")).unionByName(alias.select("ord", "pos", "canonical", normalized_name(F.col("alias")).alias("key")))
    # a canonical name takes a key from aliases, later ones from earlier; an alias takes only a free key
    norm = spelled.filter("key <> ''").groupBy("key").agg(
        F.coalesce(F.max_by("canonical", F.when(F.col("pos") == -1, F.col("ord"))), F.min_by("canonical", F.struct("ord", "pos"))).alias("canonical"),
        F.min(F.struct("ord", "pos")).alias("first"),
    )
    return exact, by_alias, norm


def equality_tiers(names: DataFrame, dim: DataFrame) -> DataFrame:
    """raw_name, canonical_name, confidence, method of distinct ``names`` (raw_name); nulls where no tier knows it."""
    exact, by_alias, norm = indices(dim)
    low = F.lower(py_strip(F.col("raw_name")))
    tiers = (
        names.withColumn("low", low)
        .withColumn("norm", normalized_name(F.col("raw_name")))
        .join(exact.select(F.col("key").alias("k1"), F.col("canonical").alias("c1")), F.col("low") == F.col("k1"), "left")
        .join(by_alias.select(F.col("key").alias("k2"), F.col("canonical").alias("c2")), F.col("low") == F.col("k2"), "left")
        .join(norm.select(F.col("key").alias("k3"), F.col("canonical").alias("c3")), F.col("norm") == F.col("k3"), "left")
    )
    known = F.coalesce("c1", "c2", "c3")
    return tiers.select(
        "raw_name", "norm", known.alias("canonical_name"),
        F.when(F.col("c1").isNotNull(), 1.0).when(F.col("c2").isNotNull(), 0.98).when(F.col("c3").isNotNull(), 0.95).alias("confidence"),
        F.when(F.col("c1").isNotNull(), "exact").when(known.isNotNull(), "alias").alias("method"),
    )


def letter_counts(text: str) -> np.ndarray:
    """How often each letter occurs, over 64 classes of letters."""
    return np.minimum(np.bincount(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) % 64, minlength=64), 255).astype(np.uint8)


class Keys:
    """A block of the dimension's keys, in order, that finds the most similar one."""

    def __init__(self, rows: list[tuple[str, str, int, int]]):
        self.rows = rows

    @functools.cached_property
    def counts(self) -> np.ndarray:
        return np.array([letter_counts(r[0]) for r in self.rows]).reshape(-1, 64)

    @functools.cached_property
    def sizes(self) -> np.ndarray:
        return np.array([len(r[0]) for r in self.rows])

    @functools.lru_cache(4096)  # noqa: B019
    def matcher(self, at: int) -> difflib.SequenceMatcher:
        return difflib.SequenceMatcher(None, "", self.rows[at][0])

    def bounds(self, name: str) -> np.ndarray:
        """Twice the letters in common over all letters: no ratio is larger. Classes of 255 letters and more bound by 1."""
        own = letter_counts(name)
        if len(name) >= 255 or len(self.sizes) and self.sizes.max() >= 255:
            return np.minimum(1.0, 2.0 * np.minimum(self.sizes, len(name)) / (self.sizes + len(name)))
        return 2.0 * np.minimum(self.counts, own).sum(1, dtype=np.int64) / (self.sizes + len(name))

    def best(self, name: str, least: float = 0.0) -> tuple[float, int]:
        """The highest ratio of ``least`` or more, and the first key that has it (-1: none has, or no letter in common)."""
        score, found = 0.0, -1
        if not name or not self.rows:
            return score, found
        bounds = self.bounds(name)
        for at in np.argsort(-bounds, kind="stable"):
            if bounds[at] < max(score, least) or bounds[at] == 0:
                break
            matcher = self.matcher(int(at))
            matcher.set_seq1(name)
            ratio = matcher.ratio()
            if ratio >= least and (ratio > score or ratio == score and ratio > 0 and at < found):
                score, found = ratio, int(at)
        return score, found


def fuzzy_tier(names: DataFrame, dim: DataFrame, block: int = BLOCK, least: float = 0.0) -> DataFrame:
    """raw_name, fuzzy_name, fuzzy_score, fuzzy_rounded: the most similar key of the dimension (R6, R7); null and 0 where no
    score reaches ``least``."""
    spark = names.sparkSession
    norm = indices(dim)[2].select("key", "canonical", "first.ord", "first.pos")
    spread = names.select("raw_name", "norm").repartition(shuffle_width(spark))  # few names are costly too
    parts = []
    for rows in blocks(norm, block):
        shared = spark.sparkContext.broadcast(Keys(rows))

        def score(batches, shared=shared):
            keys = shared.value
            for b in batches:
                got = [(raw, *keys.best(name, least)) for raw, name in zip(b["raw_name"], b["norm"])]
                of = [keys.rows[at] if at >= 0 else (None, None, 0, 0) for _, _, at in got]
                yield pd.DataFrame({"raw_name": [g[0] for g in got], "fuzzy_name": [r[1] for r in of], "fuzzy_score": [g[1] for g in got], "first_ord": [r[2] for r in of], "first_pos": [r[3] for r in of]})

        parts.append(spread.mapInPandas(score, RESOLUTION))
    scored = functools.reduce(DataFrame.unionByName, parts)
    best = F.max_by(F.struct("fuzzy_name", "fuzzy_score"), F.struct("fuzzy_score", -F.col("first_ord"), -F.col("first_pos")))
    top = scored if len(parts) == 1 else scored.groupBy("raw_name").agg(best.alias("b")).select("raw_name", "b.*")
    # halves go to the even digit, as in the log that is compared with
    return top.select("raw_name", "fuzzy_name", "fuzzy_score", F.bround(F.col("fuzzy_score").cast("decimal(20,17)"), 3).cast("double").alias("fuzzy_rounded"))


def blocks(norm: DataFrame, block: int):
    """The keys in order, at most ``block`` on the driver at once."""
    held: list[tuple] = []
    for r in norm.orderBy("ord", "pos").toLocalIterator():
        held.append(tuple(r))
        if len(held) == block:
            yield held
            held = []
    yield held


def resolve(names: DataFrame, dim: DataFrame, name_col: str = "raw_name", least: float = 0.0) -> DataFrame:
    """``names`` with canonical_name, best_guess, confidence, method. ``best_guess`` holds names of the review band. Where
    no one reads the confidence of names that stay unresolved, ``least`` = ``REVIEW`` saves scoring them."""
    distinct = names.select(F.col(name_col).alias("raw_name")).filter("raw_name IS NOT NULL").distinct()
    tiers = equality_tiers(distinct, dim)
    fuzzy = fuzzy_tier(tiers.filter("canonical_name IS NULL"), dim, least=least)
    accepted = F.col("fuzzy_score") >= ACCEPT
    resolved = tiers.join(fuzzy, "raw_name", "left").select(
        F.col("raw_name").alias("__raw"),
        F.coalesce("canonical_name", F.when(accepted, F.col("fuzzy_name"))).alias("canonical_name"),
        F.coalesce("canonical_name", F.when(F.col("fuzzy_score") >= REVIEW, F.col("fuzzy_name"))).alias("best_guess"),
        F.coalesce("confidence", "fuzzy_rounded", F.lit(0.0)).alias("confidence"),
        F.coalesce("method", F.when(accepted, "fuzzy"), F.lit("unresolved")).alias("method"),
    )
    return names.join(resolved, F.col(name_col) == F.col("__raw"), "left").drop("__raw")


def mapping_log(resolved: DataFrame, source_url: str = "source_url") -> DataFrame:
    """One log row per resolved name; the review band's guess is logged, a name without one as (unresolved)."""
    return resolved.select("raw_name", F.coalesce("best_guess", F.lit("(unresolved)")).alias("canonical_name"), "confidence", "method", source_url)


def review_queue(resolved: DataFrame) -> DataFrame:
    """R10"""
    return resolved.filter("method = 'unresolved'")
