"""Mapping typed names to a canonical list (p3): a broadcast symmetric-delete dictionary and weighted ranking.

The reference list is met in blocks of bounded size; from each a dictionary of every string that remains after deleting up to
``DEPTH`` letters of an entry's spellings is built once and broadcast; a name takes the best entry of all blocks. A typed name is parsed, its own deletions are looked
up, and the candidates are ranked by weighted Damerau-Levenshtein distance, less a share for how often the entry occurs
under its exact spellings. Names out of reach are reported with -1.

Defined results: null, blank and exactly listed names are no cases; names that say nothing (``n/a``) and names without
letters give -1; equal ranks go to the smaller ``ord``; an empty reference gives -1 throughout.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.distance import deletes, weighted_distance
from millrace.llm.names import LEGAL, RECURS, Grammar, Name, says_nothing, sectors_of
from millrace.session import table

DEPTH = 2
NO_MATCH = (math.inf, -1)
#: Entries of the reference that are broadcast at once (about 2 KB of dictionary each); a larger list is met in blocks.
BLOCK = 50_000


def limit(length: int) -> float:
    """The distance that a spelling of so many letters may be away."""
    return 0.0 if length < 5 else 1.0 if length < 8 else 1.75 if length < 12 else 2.5


class Dictionary:
    """Spellings of the reference entries by what is left after deletions."""

    def __init__(self, entries: list[tuple[int, str, list[str] | None]], frequency: dict[int, int] | None = None, grammar: Grammar | None = None):
        self.grammar = grammar or Grammar(sectors_of(c for _, c, _ in entries))
        self.prior = {o: math.log1p((frequency or {}).get(o, 0)) for o, _, _ in entries}
        self.exact: dict[str, list[tuple[int, float]]] = defaultdict(list)
        self.initial: dict[tuple[str, str, str], set[int]] = defaultdict(set)
        self.short: dict[str, set[int]] = defaultdict(set)
        self.initial_heads: dict[str, list[str]] = defaultdict(list)
        for o, canonical, aliases in entries:
            for said in [canonical, *(aliases or [])]:
                if not said:
                    continue
                name = self.grammar.parse(said)
                if len(said) <= 5 and said.isupper():
                    self.short[said.lower()].add(o)
                for spelling, penalty in spellings(name):
                    if (o, penalty) not in self.exact[spelling]:
                        self.exact[spelling].append((o, penalty))
                if len(name.core) == 2:
                    for a, b in (name.core, name.core[::-1]):
                        self.initial[(a, b[0], name.sector)].add(o)
        self.longest = max(map(len, self.exact), default=0)
        self.near: dict[str, list[str]] = defaultdict(list)
        for spelling in self.exact:
            if limit(len(spelling)) > 0:
                for left in deletes(spelling, DEPTH if len(spelling) >= 8 else 1):
                    self.near[left].append(spelling)
        for a, _, _ in self.initial:
            if len(a) >= 5:
                for left in deletes(a, 1):
                    if a not in self.initial_heads[left]:
                        self.initial_heads[left].append(a)

    def find(self, raw: str) -> tuple[float, int]:
        """Rank (less is nearer) and entry of the best match; inf and -1 without one."""
        if says_nothing(raw):
            return NO_MATCH
        name = self.grammar.parse(raw)
        ranked: list[tuple[float, int]] = []
        if name.initials and len(name.core) == 1 and len(name.core[0]) <= self.longest + DEPTH:
            ranked = self.by_initial(name)
        joined = "".join(name.core) + name.initials + name.sector if len(name.core) > 1 or not name.initials else ""
        if len(joined) >= 2:
            if joined in self.short:
                ranked += [(0.0, o) for o in self.short[joined]]
            ranked += [(p, o) for o, p in self.exact.get(joined, ())]
            if not ranked and len(joined) <= self.longest + DEPTH and (most := limit(len(joined))):  # no edit lengthens a name by more
                seen = set()
                for left in deletes(joined, DEPTH if len(joined) >= 8 else 1):
                    for spelling in self.near.get(left, ()):
                        if spelling not in seen:
                            seen.add(spelling)
                            d = weighted_distance(joined, spelling, min(most, limit(len(spelling))))
                            if d < math.inf and agrees(joined, spelling, name):
                                ranked += [(d + p, o) for o, p in self.exact[spelling]]
        if not ranked:
            return NO_MATCH
        # a tenth of an edit for an e-fold of frequency: decides between equally near entries only
        return min((d - 0.02 * min(self.prior.get(o, 0), 10), o) for d, o in ranked)

    def by_initial(self, name: Name) -> list[tuple[float, int]]:
        head, letter = name.core[0], name.initials[0]
        found = [(0.1, o) for o in self.initial.get((head, letter, name.sector), ())]
        if not found and len(head) >= 5:
            heads = {h for left in deletes(head, 1) for h in self.initial_heads.get(left, ())}
            found = [(0.1 + d, o) for h in heads if (d := weighted_distance(head, h, 1.0)) < math.inf for o in self.initial.get((h, letter, name.sector), ())]
        return found


def agrees(joined: str, spelling: str, name: Name) -> bool:
    """Short sector words are no typos of one another: two edits must not turn one sector into none or into another."""
    return not (name.sector and not spelling.endswith(name.sector))


def spellings(name: Name) -> list[tuple[str, float]]:
    """The joined forms under which a name may be typed, with what they cost."""
    core, sector = name.core, name.sector
    out = [("".join(core) + sector, 0.0)]
    if len(core) > 1:
        turned = [core[i:] + core[:i] for i in range(1, len(core))]
        out += [("".join(t) + sector, 0.05) for t in turned]
        if sector:
            out += [("".join(t), 0.2) for t in [core, *turned]]
    return [(s, p) for s, p in out if s]


def reference_blocks(reference: DataFrame, block: int = BLOCK) -> Iterator[list[tuple[int, str, list[str] | None]]]:
    """The reference list in order, at most ``block`` entries on the driver at once; one empty block for an empty list."""
    held: list[tuple] = []
    first = True
    for r in reference.select("ord", "canonical", "aliases").filter("canonical IS NOT NULL").orderBy("ord", "canonical").toLocalIterator():
        held.append((r["ord"], r["canonical"], r["aliases"]))
        if len(held) == block:
            yield held
            held, first = [], False
    if held or first:
        yield held


def grammar_of(reference: DataFrame | None) -> Grammar:
    """The grammar of a reference list of any size: its sectors are counted in Spark."""
    if reference is None:
        return Grammar()
    name = F.lower(F.trim("canonical"))
    parts = reference.select(F.regexp_extract(name, r"^(.*\S)\s+\p{L}+$", 1).alias("head"), F.regexp_extract(name, r"\s(\p{L}+)$", 1).alias("last"))
    counted = parts.filter("last <> ''").groupBy("last").agg(F.count_distinct("head").alias("n")).filter(F.col("n") >= RECURS)
    return Grammar(r["last"] for r in counted.orderBy(F.desc("n"), "last").collect() if r["last"] not in LEGAL)


def finder(dictionary):
    @F.pandas_udf("rank double, ord int")
    def entry(raw: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([dictionary.value.find(x) for x in raw], columns=["rank", "ord"])

    return entry


def map_names(records: DataFrame, name_col: str, reference: DataFrame, out: str = "ord", block: int = BLOCK) -> DataFrame:
    """``records`` whose name is neither null, blank nor listed, with the entry meant or -1. Extra columns pass through."""
    spark = records.sparkSession
    said = F.explode(F.concat(F.array("canonical"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("__listed")
    listed = reference.select("ord", said).groupBy("__listed").agg(F.min("ord").alias("ord"))  # of several the smaller, as among equal ranks
    counted = records.groupBy(F.col(name_col).alias("__raw")).agg(F.count(F.lit(1)).alias("__n")).filter(r"__raw IS NOT NULL AND __raw RLIKE '(?U)[^\\s]'")
    known = counted.join(listed, F.col("__raw") == F.col("__listed"), "left")
    uses = known.filter("ord IS NOT NULL").groupBy("ord").agg(F.sum("__n").alias("n"))
    grammar = grammar_of(reference)
    unknown, parts = known.filter("ord IS NULL").select("__raw"), []
    for entries in reference_blocks(reference, block):
        within = (F.col("ord") >= entries[0][0]) & (F.col("ord") <= entries[-1][0]) if entries else F.lit(False)
        frequency = {r["ord"]: r["n"] for r in uses.filter(within).collect()}  # at most one row an entry of the block
        dictionary = spark.sparkContext.broadcast(Dictionary(entries, frequency, grammar))

        # nondeterministic: a filter on the result must not look names up again
        parts.append(unknown.withColumn("__e", finder(dictionary).asNondeterministic()("__raw")))
    found = reduce(DataFrame.unionByName, parts)
    # a miss has an infinite rank: of several blocks the nearest entry counts
    mapped = found.select("__raw", F.col("__e.ord").alias("__ord")) if len(parts) == 1 else found.groupBy("__raw").agg(F.min("__e").getField("ord").alias("__ord"))
    # rows of one hot spelling are split by the adaptive skew join: the distinct side has one row a spelling
    return records.join(mapped, F.col(name_col) == F.col("__raw")).withColumn(out, F.col("__ord")).drop("__raw", "__ord")


def named_records(spark, sf_dir: str) -> DataFrame:
    jobs = table(spark, sf_dir, "jobs").select(F.lit("job").alias("rec_kind"), F.col("job_id").alias("rec_id"), F.col("content.rawcompany").alias("raw"))
    log = table(spark, sf_dir, "entity_mapping_log").select(F.lit("log").alias("rec_kind"), F.col("log_id").alias("rec_id"), F.col("raw_name").alias("raw"))
    return jobs.unionByName(log)


def p3_found(spark, sf_dir: str) -> DataFrame:
    return map_names(named_records(spark, sf_dir), "raw", table(spark, sf_dir, "canonical_entities")).select("rec_kind", "rec_id", "ord")


def p3_misses(spark, sf_dir: str) -> DataFrame:
    """Unmatched spellings and how many records carry them."""
    found = map_names(named_records(spark, sf_dir), "raw", table(spark, sf_dir, "canonical_entities"))
    return found.filter("ord = -1").groupBy("raw").agg(F.count(F.lit(1)).alias("n_records"))
