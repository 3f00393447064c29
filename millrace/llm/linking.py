"""Linking the spellings of one organisation (p7): noisy-channel attribution of variants to frequent spellings.

Every spelling is parsed to a form. A form's canonical form is the one that most probably was meant: the prior is how many
records use the candidate, the channel gives each edit, dropped sector, initial, turned word order or joined word its
probability. Candidates share a word up to one deletion. Two rounds keep the work linear in the forms: first all forms
against the frequent ones, then those still alone among themselves. Spellings listed for one entry of the reference list
(renamings, acronyms) mean that entry.

Defined results: null and blank names and names that say nothing are linked to nothing; equal posteriors go to the more
complete, then more frequent, then smaller form; a form is never attached to a less complete one.
"""

from __future__ import annotations

import functools
import math
import zlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.distance import deletes, weighted_distance
from millrace.llm.matching import grammar_of, reference_blocks
from millrace.llm.names import Grammar, Name, letter_mask, says_nothing
from millrace.session import materialize, table, tidy

#: Records from which a form is met by the rarer ones, level by level: each level first meets the roots above it.
LEVELS = (32, 4, 0)
EDIT = 4.6  # -log probability of one edit
DROPPED, INITIAL, TURNED, JOINED = 0.4, 0.3, 0.1, 0.1  # in edits
LONGEST_CUT = 40  # letters of a word whose deletions are all keys
CERTAIN = 0.75  # posterior share among whole names from which a name cut to its first word means one of them
LARGEST = 1 << 62
LISTED = 8  # records that being on the reference list stands for
OWN = 10.0  # posterior that a form beyond this many nats is an organisation of its own


def form_of(raw: str, grammar: Grammar) -> str:
    """The parsed name as text: words, sector and initials between bars; empty if the name says nothing."""
    if says_nothing(raw):
        return ""
    name = grammar.parse(raw)
    return f"{' '.join(name.core)}|{name.sector}|{name.initials}" if name.core else ""


def name_of(form: str) -> Name:
    core, sector, initials = form.split("|")
    return Name(tuple(core.split(" ")), sector, initials, "")


def completeness(name: Name) -> int:
    return 2 * min(len(name.core), 2) + (1 if name.sector else 0) + (1 if name.initials else 0)


def limit(length: int) -> float:
    return 0.0 if length < 5 else 1.0 if length < 8 else 1.75 if length < 12 else 2.6


mask_of = functools.lru_cache(200_000)(letter_mask)


def may_be(x: str, y: str) -> bool:
    """Whether two edits can turn one word into the other: an edit changes two letters at most, at 0.75 or more."""
    return x == y or (mask_of(x) ^ mask_of(y)).bit_count() * 0.375 <= 2.0


def channel_cost(variant: Name, meant: Name) -> float:
    """Edits that the channel took from ``meant`` to ``variant``; inf if it can't have."""
    if meant.initials:
        return math.inf
    if variant.sector and meant.sector and variant.sector != meant.sector:
        return math.inf
    a, b = variant.core, meant.core
    if variant.initials:
        if len(a) != 1 or len(b) != 2 or variant.sector != meant.sector:
            return math.inf
        best = math.inf
        for first, second in (b, b[::-1]):
            if second[0] == variant.initials[0]:
                best = min(best, INITIAL + weighted_distance(a[0], first, 1.0 if len(first) >= 5 else 0.0) + (0 if first == b[0] else TURNED))
        return best
    if variant.sector and not meant.sector:
        return math.inf
    extra = 0.0
    if meant.sector and not variant.sector and len(a) == 1 and len(b) == 2 and len(a[0]) > len(b[0]) + len(b[1]) + 1:
        whole = [b[0] + b[1] + meant.sector, b[1] + b[0] + meant.sector, b[1] + meant.sector + b[0]]  # all joined
        return JOINED + min(weighted_distance(a[0], w, 2.0) for w in whole)
    if meant.sector and not variant.sector:
        if len(b) >= 2 and len(a) == len(b) or len(b) >= 2 and len(a) == 1:
            extra = DROPPED
        elif len(a) == len(b) + 1:  # the sector's letters are a core word with typos, or not
            x, y = "".join(a), "".join(b) + meant.sector
            return weighted_distance(x, y, min(limit(len(x)), limit(len(y))))
        elif len(a) == len(b) == 1:  # joined with the sector
            return JOINED + weighted_distance(a[0], b[0] + meant.sector, 1.0) if len(a[0]) > len(b[0]) else math.inf
        else:
            return math.inf
    if len(a) == len(b):
        if len(a) == 1:
            return extra + weighted_distance(a[0], b[0], min(limit(len(a[0]) + len(variant.sector)), limit(len(b[0]) + len(meant.sector))))
        best = math.inf
        for k in range(len(b)):
            cost = TURNED if k else 0.0
            for x, y in zip(a, b[k:] + b[:k]):
                cost += weighted_distance(x, y, 2.0 if min(len(x), len(y)) >= 6 else 1.0) if may_be(x, y) else math.inf
                if cost > 3.2:
                    break
            best = min(best, cost)
        return extra + best if best <= 3.2 else math.inf
    if 1 in (len(a), len(b)):  # words joined or split
        x, y = "".join(a), "".join(b)
        costs = [weighted_distance(x, y, limit(min(len(x), len(y))))]
        if len(b) == 2:
            costs.append(TURNED + weighted_distance(x, b[1] + b[0], limit(min(len(x), len(y)))))
        return extra + JOINED + min(costs)
    return math.inf


def posterior(variant: Name, n_variant: int, meant: Name, n_meant: int) -> float:
    """Log of prior times channel likelihood, less that of the variant being its own form; -inf if out of reach."""
    cost = channel_cost(variant, meant)
    if cost == math.inf:
        return -math.inf
    if n_variant >= 20 and n_meant < 5 * n_variant and cost > 0.5:
        return -math.inf  # both are in wide use: two names
    return math.log(n_meant + 1) - EDIT * cost + OWN


def signature(form: str) -> int:
    """Bit set of the letters of a form's core words."""
    return letter_mask(form.split("|", 1)[0].replace(" ", ""))


def typo_keys(word: str, depth: int) -> set[str]:
    """Keys that two words share if ``depth`` deletions on both sides make them equal. Words of more than ``LONGEST_CUT``
    letters, whose deletions would be many, are cut in parts instead, one more than edits: one part stays whole and moves
    by ``depth`` letters at most."""
    if len(word) <= LONGEST_CUT:
        return deletes(word, depth)
    out, n, parts = set(), len(word), depth + 1
    for size in range(n - depth, n + depth + 1):  # letters of the other word
        for p in range(parts):
            a, b = size * p // parts, size * (p + 1) // parts
            out |= {f"~{p}:{size}:{word[s : s + b - a]}" for s in range(max(0, a - depth), min(a + depth, n - b + a) + 1)}
    return out


def variant_keys(form: str) -> set[str]:
    """Keys that a variant shares with what it may stand for: its words up to one deletion, joined words marked."""
    name = name_of(form)
    out: set[str] = set()
    for w in name.core:
        if len(w) > 1:
            out |= typo_keys(w, 1) if len(w) >= 5 else {w}
    if len(name.core) == 1:
        w = name.core[0]
        if len(w) >= 9:
            out |= {"+" + d for d in typo_keys(w, 1)}
        if len(w) >= 5 and not name.initials:  # two edits in the only word
            out |= {d + "+" + name.sector for d in typo_keys(w, 2)}
    return {k for k in out if len(k) >= 3}


def meant_keys(form: str) -> set[str]:
    """Keys of a candidate: as a variant's, and its words joined, with and without its sector."""
    name = name_of(form)
    out = variant_keys(form)
    if len(name.core) == 2:
        x, y = name.core
        out |= {"+" + d for joined in (x + y, y + x) for d in typo_keys(joined, 1)}
        if name.sector:  # longer: met exactly, or with a letter too many in the variant
            out |= {"+" + joined for joined in (x + y + name.sector, y + x + name.sector, y + name.sector + x)}
    elif len(name.core) == 1 and name.sector:
        out |= {"+" + d for d in typo_keys(name.core[0] + name.sector, 1)}
    return out


def with_keys(forms: DataFrame, keys) -> DataFrame:
    """id, n, mask, sector, initials, words, key: a row for each key of each form."""

    def emit(batches):
        for b in batches:
            parts = [f.split("|") for f in b["form"]]
            yield pd.DataFrame(
                {
                    "id": b["id"], "n": b["n"], "mask": b["form"].map(signature), "key": b["form"].map(lambda f: list(keys(f))),
                    "whole": [completeness(name_of(f)) for f in b["form"]], "sector": [zlib.crc32(p[1].encode()) if p[1] else -1 for p in parts], "initial": [bool(p[2]) for p in parts], "words": [p[0].count(" ") + 1 for p in parts],
                }
            ).explode("key").dropna()

    out = forms.select("id", "form", "n").mapInPandas(emit, "id long, n long, mask long, key string, whole int, sector long, initial boolean, words int")
    return out.withColumn("key", F.xxhash64("key"))


def attach(variants: DataFrame, candidates: DataFrame, forms: DataFrame) -> DataFrame:
    """form, parent: each variant's most probable candidate, where one is in reach and ranks before it."""
    left = with_keys(variants, variant_keys)
    right = with_keys(candidates, meant_keys).filter("NOT initial").select([F.col(c).alias("m_" + c) for c in ("id", "n", "mask", "whole", "sector", "words")] + ["key"])
    apart = F.bit_count(F.col("mask").bitwiseXOR(F.col("m_mask")))
    fits = (F.col("sector") == F.col("m_sector")) | (F.col("sector") == -1)
    # what the channel can't do is left out before the pairs are shuffled: a mask differs by two bits an edit at most
    same = (F.col("words") != F.col("m_words")) | F.col("initial") | (apart <= 7)
    # a form is only attached to one that is more complete, or as complete and more frequent (ties: the smaller id)
    alike = F.col("m_whole") == F.col("whole")
    before = (F.col("m_whole") > F.col("whole")) | (alike & ((F.col("m_n") > F.col("n")) | ((F.col("m_n") == F.col("n")) & (F.col("m_id") < F.col("id"))))) | ((F.col("m_n") > F.col("n")) & ~alike)
    # rows of keys are many times the file they are made from, whose size Spark goes by: they must not reach the driver
    pairs = left.join(right.hint("merge"), (left["key"] == right["key"]) & (F.col("id") != F.col("m_id")) & before & fits & same).select("id", "m_id").distinct()
    named = pairs.join(forms.select(F.col("id").alias("m_id"), F.col("form").alias("meant"), F.col("n").alias("n_meant")), "m_id").join(forms.select("id", "form", "n"), "id")

    def judge(batches):
        for b in batches:
            names = {f: name_of(f) for f in {*b["form"], *b["meant"]}}
            score, order = [], []
            for v, nv, c, nc in zip(b["form"], b["n"], b["meant"], b["n_meant"]):
                x, y = names[v], names[c]
                score.append(posterior(x, nv, y, nc))
                order.append(completeness(y))
            yield b.assign(score=score, whole=order)[["form", "meant", "n_meant", "score", "whole"]].query("score > 0")

    judged = named.select("form", "n", "meant", "n_meant").mapInPandas(judge, "form string, meant string, n_meant long, score double, whole int")
    best = F.max(F.struct("score", "whole", "n_meant", F.col("meant")))
    return judged.groupBy("form").agg(best.getField("meant").alias("parent"))


def roots(links: DataFrame) -> DataFrame:
    """form, root of a forest of form -> parent, by pointer jumping: the number of steps is the log of the depth."""
    links = materialize(links.select("form", F.col("parent").alias("root")), "links")
    while True:
        up = links.select(F.col("form").alias("root"), F.col("root").alias("higher"))
        step = materialize(links.join(up, "root", "left").select("form", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved")), "links")
        if step.filter("moved").limit(1).count() == 0:
            return step.select("form", "root")
        links = step.select("form", "root")


def link_forms(forms: DataFrame, reference: DataFrame | None = None, grammar: Grammar | None = None) -> DataFrame:
    """form, root for every form of ``forms`` (form, n). ``reference`` adds its spellings and what they mean."""
    spark = forms.sparkSession
    known = []
    grammar = grammar or grammar_of(reference)
    for entries in reference_blocks(reference) if reference is not None else ():
        for _, canonical, aliases in entries:
            target = form_of(canonical, grammar)
            known += [(form_of(a, grammar), target) for a in [canonical, *(aliases or [])] if a and target and form_of(a, grammar)]
    listed = spark.createDataFrame(sorted(set(known)), "form string, parent string")
    extra = listed.select(F.col("parent").alias("form"), F.lit(0).cast("long").alias("n"))
    extra = extra.unionByName(listed.select("form", F.lit(0).cast("long").alias("n"))).distinct()
    all_forms = forms.filter("form <> ''").unionByName(extra).groupBy("form").agg(F.sum("n").alias("n"))
    fixed = listed.groupBy("form").agg(F.min("parent").alias("parent")).withColumn("listed", F.lit(True))
    all_forms = all_forms.join(fixed.select("form", "listed"), "form", "left").select(F.xxhash64("form").alias("id"), "form", F.when(F.col("listed"), F.greatest("n", F.lit(LISTED))).otherwise(F.col("n")).alias("n"), F.coalesce("listed", F.lit(False)).alias("listed"))
    all_forms = materialize(all_forms, "forms")
    free = all_forms.filter("NOT listed")
    # the reference list's spellings are met like roots from the start; those that mean another one are links already
    top = all_forms.filter("listed").select("id", "form", "n")
    links, above = fixed.filter("form <> parent").select("form", "parent"), LARGEST
    for least in LEVELS:
        level = free.filter((F.col("n") >= least) & (F.col("n") < above)).select("id", "form", "n")
        up = materialize(attach(level, top, all_forms), "up")
        rest = materialize(level.join(up.select("form"), "form", "left_anti"), "rest")
        among = materialize(attach(rest, rest, rest), "among")
        top = top.unionByName(rest.join(among.select("form"), "form", "left_anti").select("id", "form", "n"))
        links, above = links.unionByName(up).unionByName(among), least
        tidy(spark)  # what a level broadcast and shuffled is not held on to
    # forms without sector or with initials may stand for a more complete one that is rarer
    top = materialize(top, "top")
    partial = top.filter(r"form RLIKE ' .*[|][|]$|[|][^|]+$'").join(listed_only(all_forms), "form", "left_anti")
    late = materialize(attach(partial, top, top), "late")
    links = links.unionByName(late)
    placed = all_forms.join(roots(links), "form", "left").select("form", "n", F.coalesce("root", "form").alias("root"))
    placed = materialize(placed, "placed")
    nick = materialize(short_names(placed), "short")
    return placed.join(nick, "form", "left").select("form", F.coalesce("whole", "root").alias("root"))


def listed_only(forms: DataFrame) -> DataFrame:
    return forms.filter("listed").select("form")


def short_names(placed: DataFrame) -> DataFrame:
    """form, whole: one-word names without sector, as what was left of a two-word name that begins with the word. The
    channel cuts all of these alike, so the posterior of one is its share of the records of all; it must be ``CERTAIN``."""
    first = F.split("root", r"[ |]")[0]
    heads = placed.filter(r"root RLIKE '^[^ |]+ [^ |]+[|]'").groupBy(F.col("root").alias("whole"), first.alias("head")).agg(F.sum("n").alias("n"))
    words = placed.filter(r"form = root AND form RLIKE '^[^ |]{4,}[|][|]$'").select("form", F.split("form", r"\|")[0].alias("word"))
    cut = words.join(heads, F.col("word") == F.col("head")).groupBy("form").agg(F.max(F.struct("n", "whole")).alias("best"), F.sum("n").alias("all"))
    return cut.filter(F.col("best.n") >= CERTAIN * F.col("all")).select("form", F.col("best.whole").alias("whole"))


def organisations(spark, sf_dir: str, grammar: Grammar) -> DataFrame:
    """key, kind, form of each listing and job with a name."""

    shared = spark.sparkContext.broadcast(grammar)

    @F.pandas_udf(T.StringType())
    def to_form(raw: pd.Series) -> pd.Series:
        return raw.map(lambda r: form_of(r, shared.value) if r else "")

    said = r"(?U)[^\s]"
    startups = table(spark, sf_dir, "startups").filter("listing_id IS NOT NULL")
    raw = F.col("content.rawname")
    # rawname is fixed per listing where it is given; an earlier resolver's choice stands in where it never is
    listings = startups.groupBy("listing_id").agg(F.max(F.when(raw.rlike(said), raw)).alias("raw"), F.min("content.entityname").alias("named"))
    listings = listings.select(F.concat(F.lit("startup:"), F.lpad(F.col("listing_id").cast("string"), 10, "0")).alias("key"), F.coalesce("raw", "named").alias("raw"))
    jobs = table(spark, sf_dir, "jobs").filter("job_id IS NOT NULL").select(F.concat(F.lit("job:"), F.lpad(F.col("job_id").cast("string"), 10, "0")).alias("key"), F.col("content.rawcompany").alias("raw"))
    both = listings.withColumn("is_job", F.lit(False)).unionByName(jobs.withColumn("is_job", F.lit(True))).filter(F.col("raw").rlike(said))
    # written before it is filtered: else the filter, and with it the parsing, is pushed below the distinct and the join
    forms = materialize(both.select(F.col("raw").alias("spelled")).distinct().select("spelled", to_form("spelled").alias("form")), "forms")
    return both.join(forms.filter("form <> ''"), F.col("raw") == F.col("spelled")).select("key", "is_job", "form")


def linked(spark, sf_dir: str) -> DataFrame:
    """key, is_job, root of each listing and job."""
    reference = table(spark, sf_dir, "canonical_entities")
    grammar = grammar_of(reference)
    records = materialize(organisations(spark, sf_dir, grammar), "organisations")
    forms = records.groupBy("form").agg(F.count(F.lit(1)).alias("n"))
    return records.join(link_forms(forms, reference, grammar), "form").select("key", "is_job", "root")


def p7_found(spark, sf_dir: str) -> DataFrame:
    members = materialize(linked(spark, sf_dir), "members")
    listings = members.filter("NOT is_job").select(F.col("key").alias("key_l"), "root")
    # the hot organisations' jobs are split by the adaptive skew join; each pair is a row of the result
    pairs = members.join(listings, "root").filter("is_job OR key < key_l")
    return pairs.select(F.least("key", "key_l").alias("key_a"), F.greatest("key", "key_l").alias("key_b"))


def p7_members(spark, sf_dir: str) -> DataFrame:
    """Each record with the canonical form it is attributed to."""
    return linked(spark, sf_dir).select("key", F.col("root").alias("canonical_form"))
