"""Encoding a corpus with a public byte-level BPE tokenizer (p8) through a table of its distinct words.

Texts are split into words in Spark by the tokenizer's own pattern. Each distinct word is encoded once. The ids come back
by join on the word: the most frequent words, a table of bounded size, by broadcast, so that no hot word is shuffled; the
others by shuffle. Each text's ids are then put together by position. Decoding joins ids with the vocabulary's pieces.

Defined results: null and empty texts have no ids (an empty list); texts of white space and very long texts are encoded
like any other; special tokens' strings are ordinary text; repeated rows each get their ids (rows of one key are kept apart
by a row number of their own); extra columns are left out.
"""

from __future__ import annotations

import base64
import functools

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import materialize, table

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pattern that belongs to the vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same for Java: its \s is ASCII only unless white space is named.
SPACE = r"\p{IsWhite_Space}"
JAVA_PATTERN = PATTERN.replace(r"[^\s", rf"[^{SPACE}").replace(r"\s", SPACE).replace(r"(?!\S)", rf"(?!\P{{IsWhite_Space}})")
#: The broadcast table of frequent words: at most so many words of at most so many letters (under 10 MB).
HEAD_WORDS, HEAD_LETTERS = 60_000, 40


@functools.lru_cache(4)
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def split_words(text: Column) -> Column:
    """The text's words in order. Characters that Java's tables don't know go through the tokenizer's own tables."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def newer(t: pd.Series) -> pd.Series:
        import regex

        find = regex.compile(PATTERN).findall
        return t.map(lambda x: None if x is None else find(x))

    unknown = text.rlike(r"\p{Cn}")
    return F.coalesce(newer(F.when(unknown, text)), F.regexp_extract_all(text, F.lit(JAVA_PATTERN), F.lit(0)))


def encode_words(words: DataFrame, path: str) -> DataFrame:
    """word, n, ids: each distinct word is encoded once."""

    def run(batches):
        piece = encoder(path)._core_bpe.encode_single_piece
        for b in batches:
            yield pd.DataFrame({"word": b["word"], "n": b["n"], "ids": b["word"].map(lambda w: piece(w.encode("utf-8")))})

    return words.select("word", "n").mapInPandas(run, "word string, n long, ids array<int>")


def word_table(split: DataFrame, path: str) -> DataFrame:
    """word, n, ids of the distinct words of ``split`` (words), counted over all rows."""
    counts = split.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return materialize(encode_words(counts, path), "encoded")


def encode_corpus(docs: DataFrame, key: str, text: str, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """key, ids of every row of ``docs``."""
    spark = docs.sparkSession
    # the key travels as text: null keys stay null in Arrow batches, and large ones exact
    kind = docs.schema[key].dataType.simpleString()
    split = docs.select(F.col(key).cast("string").alias("__key"), F.monotonically_increasing_id().alias("__row"), split_words(F.coalesce(F.col(text), F.lit(""))).alias("words"))
    split = materialize(split, "words")
    encoded = word_table(split, path)
    # count, then word, decides: the head is the same whatever the partitions. It is bounded in words and letters.
    head = encoded.filter(F.length("word") <= HEAD_LETTERS).orderBy(F.desc("n"), "word").limit(HEAD_WORDS).select("word", "ids")
    known = spark.sparkContext.broadcast({r["word"]: r["ids"] for r in head.toLocalIterator()})

    def place(batches):
        ids_of = known.value.get
        for b in batches:
            ids, missing = [], []
            for words in b["words"]:
                out, rest = [], []
                for w in words:
                    if (found := ids_of(w)) is not None:
                        out += found
                    else:
                        out.append(-1)
                        rest.append(w)
                ids.append(out)
                missing.append(rest)
            yield pd.DataFrame({"__key": b["__key"], "__row": b["__row"], "ids": ids, "missing": missing})

    placed = materialize(split.mapInPandas(place, "__key string, __row long, ids array<int>, missing array<string>"), "placed")
    gaps = placed.filter(F.size("missing") > 0)
    fills = gaps.select("__row", F.posexplode("missing").alias("pos", "word")).join(encoded.select("word", F.col("ids").alias("piece")), "word")
    fills = fills.groupBy("__row").agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("fills"))

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def fill(ids: pd.Series, fills: pd.Series) -> pd.Series:
        def one(row, pieces):
            take, out = iter(pieces), []
            for i in row:
                if i >= 0:
                    out.append(i)
                else:
                    out += list(next(take)["piece"])
            return out

        return pd.Series([one(r, p) for r, p in zip(ids, fills)])

    filled = gaps.select("__key", "__row", "ids").join(fills, "__row").select(F.col("__key").cast(kind).alias(key), fill("ids", "fills").alias("ids"))
    return placed.filter(F.size("missing") == 0).select(F.col("__key").cast(kind).alias(key), "ids").unionByName(filled)


def vocabulary(spark, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """id, piece: one row per id of the public vocabulary, 50,256 at any scale."""
    ranks = encoder(path)._mergeable_ranks
    return spark.createDataFrame([(i, bytearray(p)) for p, i in ranks.items()], "id int, piece binary")


def decode_corpus(encoded: DataFrame, key: str, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """key, text of rows of ids with unique keys, by join with the vocabulary's pieces; rows without ids give ''."""
    pieces = F.broadcast(vocabulary(encoded.sparkSession, path))
    placed = encoded.select(key, F.posexplode("ids").alias("pos", "id")).join(pieces, "id")
    text = F.decode(F.unhex(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.hex("piece").alias("hex")))), lambda x: x["hex"]), "")), "UTF-8")
    return encoded.select(key).join(placed.groupBy(key).agg(text.alias("text")), key, "left").select(key, F.coalesce("text", F.lit("")).alias("text"))


def p8_ids(spark, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_decoded(spark, sf_dir: str) -> DataFrame:
    """Digest of each text decoded from its ids: the exact round trip."""
    ids = materialize(p8_ids(spark, sf_dir), "ids")
    return decode_corpus(ids, "doc_id").select("doc_id", F.sha2("text", 256).alias("text_sha256"))


DECODED_SQL = "SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents"
