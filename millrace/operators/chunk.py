"""Chunking text under a token budget (T1) and merging what was extracted from chunks (A1, A3, M5).

A text that fits is one chunk, made natively. For longer ones the cuts are decided first, on the paragraphs' sizes alone:
a chunk's end is a search in their running sum. The text is sliced afterwards, in Arrow batches. Null texts give no chunk;
an empty text gives one empty chunk; an overlap of 0 carries nothing.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import BANNER_WORDS, estimate_tokens, strip_banner_lines

PER_TOKEN = 4  # letters that count as a token
BREAK = re.compile(r"\n\s*\n")
BANNER = re.compile(rf"(?im)^\s*({'|'.join(BANNER_WORDS)}).{{0,80}}$")
MORE_BREAKS = re.compile(r"\n{3,}")


def tokens(letters: int) -> int:
    return max(1, letters // PER_TOKEN)


class Cut(NamedTuple):
    first: int  # paragraphs first..end-1
    end: int
    carried: int  # letters of the chunk before that lead this one; -1: one paragraph beyond the budget, cut hard


def cuts(sizes: list[int], most: int, overlap: int) -> list[Cut]:
    """Where paragraphs of these sizes are cut: as many to a chunk as the budget holds, one at least."""
    need = [tokens(n) for n in sizes]
    reach = [0, *accumulate(need)]
    beyond = [i for i, n in enumerate(need) if n > most] + [len(sizes)]
    out: list[Cut] = []
    at, carried = 0, 0
    while at < len(sizes):
        if at == beyond[0]:
            out.append(Cut(at, at + 1, -1))
            at, carried = beyond.pop(0) + 1, 0
            continue
        room = most - (tokens(carried) if carried else 0)
        end = min(beyond[0], max(at + 1, bisect_right(reach, reach[at] + room) - 1))
        out.append(Cut(at, end, carried))
        letters = sum(sizes[at:end]) + 2 * (end - at - 1) + (carried + 2 if carried else 0)
        # only a chunk that ends for want of room leads into the next
        carried = min(letters, overlap * PER_TOKEN) if end < beyond[0] else 0
        at = end
    return out


def pack(clean: str, most: int, overlap: int) -> list[str]:
    """The chunks of a text that exceeds the budget."""
    paragraphs = [p for p in BREAK.split(clean) if p.strip()]
    out: list[str] = []
    for cut in cuts([len(p) for p in paragraphs], most, overlap):
        if cut.carried < 0:
            whole, width = paragraphs[cut.first], most * PER_TOKEN
            out += [whole[k : k + width] for k in range(0, len(whole), width)]
        else:
            lead = [out[-1][-cut.carried :]] if cut.carried else []
            out.append("\n\n".join(lead + paragraphs[cut.first : cut.end]))
    return out


def chunks_of(text: str, most: int, overlap: int = 150) -> list[str]:
    """``chunk`` of one text, outside Spark: for requests that a provider found too large."""
    clean = MORE_BREAKS.sub("\n\n", BANNER.sub("", text)).strip()
    return [clean] if tokens(len(clean)) <= most else pack(clean, most, overlap)


def chunk(df: DataFrame, key: str, text: str, most: int = 6000, overlap: int = 150) -> DataFrame:
    """key, index, text, estimated_tokens"""
    clean = df.select(F.col(key), strip_banner_lines(F.col(text)).alias("clean")).filter("clean IS NOT NULL")
    fits = estimate_tokens(F.col("clean")) <= most
    short = clean.filter(fits).select(key, F.lit(0).alias("index"), F.col("clean").alias("text"))
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            rows = [(k, i, c) for k, x in zip(b[key], b["clean"]) for i, c in enumerate(pack(x, most, overlap))]
            yield pd.DataFrame(rows, columns=[key, "index", "text"])

    # the key travels as text: null keys stay null in Arrow batches, and large ones exact
    as_text = clean.filter(~fits).withColumn(key, F.col(key).cast("string"))
    long = as_text.mapInPandas(run, f"{key} string, index int, text string").withColumn(key, F.col(key).cast(kind))
    return short.unionByName(long).withColumn("estimated_tokens", estimate_tokens(F.col("text")))


def merge_typed(rows: DataFrame, key: str, index: str, scalars: list[str], lists: list[str]) -> DataFrame:
    """A1 over typed columns: the first value that is neither null nor empty text; lists united in order of first sight,
    a list alone stays as it is."""
    first = [F.min_by(c, F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.col(index))).alias(c) for c in scalars]
    seen = lambda c: F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(F.col(index).alias("i"), F.col(c).alias("v")))))
    united = [F.transform(seen(c), lambda x: x["v"]).alias(c) for c in lists]
    merged = rows.groupBy(key).agg(*first, *united)
    for c in lists:
        merged = merged.withColumn(c, F.when(F.size(c) > 1, F.array_distinct(F.flatten(c))).when(F.size(c) == 1, F.col(c)[0]))
    return merged


def choose_responses(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M5 over captured responses (doc_id, chunk_idx, provider, provider_rank, status, body): per chunk the first provider
    in order with status 200 and a JSON body; and the chunks without one."""
    usable = (F.col("status") == 200) & F.try_parse_json("body").isNotNull()
    best = F.min(F.when(usable, F.struct("provider_rank", "provider", "body")))
    chosen = responses.groupBy("doc_id", "chunk_idx").agg(best.alias("b"))
    good = chosen.filter("b IS NOT NULL").select("doc_id", "chunk_idx", F.col("b.provider").alias("provider"), F.col("b.provider_rank").alias("provider_rank"), F.col("b.body").alias("body"))
    return good, chosen.filter("b IS NULL").select("doc_id", "chunk_idx")


def provenance(chosen: DataFrame) -> DataFrame:
    """A3: provider of the first chunk, number of chunks, and whether any chunk fell back."""
    return chosen.groupBy("doc_id").agg(F.min_by("provider", "chunk_idx").alias("provider_used"), F.count(F.lit(1)).alias("chunks_used"), F.bool_or(F.col("provider_rank") > 0).alias("degraded"))


def merge_json(chosen: DataFrame) -> DataFrame:
    """A1 over JSON objects: doc_id, field, value (JSON text) of every field's first value that says something, in chunk
    order; two or more lists of a field that begins as a list are united."""
    fields = chosen.select("doc_id", "chunk_idx", F.explode(F.from_json("body", "map<string,string>")).alias("field", "value")).filter("value IS NOT NULL AND value NOT IN ('', 'null')")
    first = Window.partitionBy("doc_id", "field").orderBy("chunk_idx")
    is_list = F.col("value").startswith("[")
    ranked = fields.withColumn("rn", F.row_number().over(first)).withColumn("lead_list", F.first(is_list).over(first))
    single = ranked.filter("rn = 1 AND NOT lead_list").select("doc_id", "field", "value")
    listed = ranked.filter(F.col("lead_list") & is_list)
    items = listed.groupBy("doc_id", "field").agg(F.array_sort(F.collect_list(F.struct("chunk_idx", F.from_json("value", "array<string>").alias("v")))).alias("ls"))
    flat = F.transform("ls", lambda x: x["v"])
    united = items.select("doc_id", "field", F.to_json(F.when(F.size("ls") > 1, F.array_distinct(F.flatten(flat))).otherwise(flat[0])).alias("value"))
    return single.unionByName(united)
