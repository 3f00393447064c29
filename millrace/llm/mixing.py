"""Mixing sources to target shares of all tokens (p9): a time-varying curriculum over the mixture.

Each source has a weight schedule, piecewise linear over the training time 0..1, whose integral is its target share. The
schedule's integral is the source's cumulative token demand; inverting it at a document's place in its source's token
order gives the document's training time, and a range sort by time gives positions. The mixture is as large as every
listed source that has documents can fill with at most ``max_repeats`` copies of a text.

Defined results: a text is used for one source only (that of its smallest doc_id among the listed sources), however many
rows and sources repeat it; null, empty and tokenless texts and unlisted or null sources are left out; a listed source
without documents gets nothing, its share is spread over the others in proportion, and the report says so; a copy is
taken if its middle lies within its source's demand, so a source misses its demand by half a text at most; shares that
are null or not positive take nothing; without any usable source the mixture is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.encoding import DEFAULT_VOCABULARY, encode_corpus
from millrace.session import materialize, shuffle_width, table

#: Weight of a repeated source at the beginning and at the end, in units of its mean: scarce sources come late.
TILT = 0.4
BUCKETS = 1024


def prefix_sums(df: DataFrame, group: list[str], order: str, size: str, out: str) -> DataFrame:
    """``out``: sum of ``size`` over the rows of the group that come before in ``order`` (a uniform 64-bit hash, then
    doc_id). In two levels, by hash range and within it, so that a group of any share of the rows is spread."""
    df = df.withColumn("__bucket", F.shiftrightunsigned(order, 64 - 10).cast("int"))
    totals = df.groupBy(*group, "__bucket").agg(F.sum(size).alias("__total"))
    before = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group, "__bucket", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__before"))  # at most BUCKETS rows a group
    inside = Window.partitionBy(*group, "__bucket").orderBy(F.shiftrightunsigned(F.shiftleft(order, 10), 10), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("__local", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    return local.join(F.broadcast(offsets), [*group, "__bucket"]).withColumn(out, F.col("__before") + F.col("__local")).drop("__bucket", "__before", "__local")


def usable_texts(docs: DataFrame, targets: DataFrame, path: str) -> DataFrame:
    """doc_id, source, n_tokens, text_hash: one row per distinct text of the listed sources."""
    listed = F.broadcast(targets.select(F.col("source_name").alias("source")).distinct())  # mix_targets: 12 rows, fixed
    rows = docs.select("doc_id", "source", "text").filter("text IS NOT NULL AND text <> ''").join(listed, "source")
    first = rows.withColumn("text_hash", F.sha2("text", 256)).groupBy("text_hash").agg(F.min(F.struct("doc_id", "source")).alias("f"))
    chosen = first.select("text_hash", F.col("f.doc_id").alias("doc_id"), F.col("f.source").alias("source"))
    once = rows.select("doc_id", "source", "text", F.sha2("text", 256).alias("text_hash")).join(chosen, ["doc_id", "source", "text_hash"]).dropDuplicates(["text_hash"])
    once = materialize(once, "texts")
    sizes = encode_corpus(once, "doc_id", "text", path).select("doc_id", F.size("ids").cast("long").alias("n_tokens"))
    return materialize(once.select("doc_id", "source", "text_hash").join(sizes, "doc_id").filter("n_tokens > 0"), "sizes")


def plan(supply: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_share, max_repeats, supply, weight, demand, epochs, tilt: a row per listed source."""
    t = targets.groupBy(F.col("source_name").alias("source")).agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    joined = t.join(supply, "source", "left").withColumn("supply", F.coalesce("supply", F.lit(0)))
    able = (F.col("supply") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    every = Window.partitionBy()  # over the 12 rows of the target table
    joined = joined.withColumn("weight", F.when(able, F.col("target_share")).otherwise(0.0))
    joined = joined.withColumn("weight", F.try_divide("weight", F.sum("weight").over(every)))
    most = F.min(F.when(F.col("weight") > 0, F.col("supply") * F.col("max_repeats") / F.col("weight"))).over(every)
    joined = joined.withColumn("demand", F.coalesce(F.floor(most * F.col("weight") + 1e-6), F.lit(0)).cast("long"))
    joined = joined.withColumn("epochs", F.when(F.col("supply") > 0, F.least(F.ceil(F.col("demand") / F.greatest("supply", F.lit(1))), F.col("max_repeats"))).otherwise(0).cast("int"))
    # repeated sources rise over time; the others fall so that the weights add up to one at any time
    rising = F.when(F.col("epochs") > 1, F.col("weight")).otherwise(0.0)
    up, rest = F.sum(rising).over(every), F.sum(F.when(F.col("epochs") == 1, F.col("weight")).otherwise(0.0)).over(every)
    slope = F.least(F.lit(TILT), F.try_divide(rest, up) * 0.9)
    tilt = F.when((up > 0) & (rest > 0), F.when(F.col("epochs") > 1, slope).otherwise(-slope * up / rest)).otherwise(0.0)
    return joined.withColumn("tilt", F.coalesce(tilt, F.lit(0.0)))


def time_of(share, tilt):
    """Inverse of the integrated schedule: weight 1 + tilt·(2t - 1) has the integral t + tilt·(t² - t)."""
    root = F.sqrt(F.pow(1 - tilt, 2) + 4 * tilt * share)
    return F.when(F.abs(tilt) < 1e-9, share).otherwise(2 * share / ((1 - tilt) + root))


def mixture(docs: DataFrame, targets: DataFrame, path: str = DEFAULT_VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, copy_no, n_tokens, train_time) of each copy in the mixture, and the plan."""
    texts = usable_texts(docs, targets, path)
    plans = materialize(plan(texts.groupBy("source").agg(F.sum("n_tokens").alias("supply")), targets), "plan")
    wanted = F.broadcast(plans.filter("epochs > 0").select("source", "supply", "demand", "epochs", "tilt"))
    copies = texts.join(wanted, "source").withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("epochs"))))
    copies = copies.withColumn("order", F.xxhash64("text_hash", "copy_no"))
    placed = prefix_sums(copies, ["source", "copy_no"], "order", "n_tokens", "offset")
    start = (F.col("copy_no") - 1) * F.col("supply") + F.col("offset")
    taken = placed.withColumn("middle", start + F.col("n_tokens") / 2).filter("middle < demand")
    share = F.col("middle") / F.col("demand")
    return taken.select("doc_id", "source", "copy_no", "n_tokens", time_of(share, F.col("tilt")).alias("train_time")), plans


def with_positions(mixed: DataFrame) -> DataFrame:
    """``position``: rank by training time, source, doc_id and copy; the rows come range-sorted."""
    mixed = mixed.withColumn("slot", F.least(F.floor(F.col("train_time") * 4096), F.lit(4095)).cast("int"))
    counts = mixed.groupBy("slot").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("slot", F.coalesce(F.sum("n").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # 4096 rows
    rank = F.row_number().over(Window.partitionBy("slot").orderBy("train_time", "source", "doc_id", "copy_no"))
    ranked = mixed.withColumn("rank", rank).join(F.broadcast(before), "slot").withColumn("position", F.col("before") + F.col("rank"))
    width = shuffle_width(mixed.sparkSession)
    return ranked.select("position", "doc_id", "source", "copy_no", "n_tokens", "train_time").repartitionByRange(width, "position").sortWithinPartitions("position")


def shares(mixed: DataFrame, plans: DataFrame) -> DataFrame:
    """Per listed source: target and reached share of all tokens, tokens, copies, supply, and whether it could be filled."""
    got = mixed.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("copies"), F.max("copy_no").alias("most_copies"))
    total = F.sum("tokens").over(Window.partitionBy())  # over the 12 rows of the target table
    full = plans.select("source", "target_share", "max_repeats", "supply").join(got, "source", "left").na.fill({"tokens": 0, "copies": 0, "most_copies": 0})
    return full.withColumn("reached_share", F.coalesce(F.try_divide("tokens", total), F.lit(0.0)))


def p9_mixture(spark, sf_dir: str) -> DataFrame:
    mixed, _ = mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))
    return with_positions(materialize(mixed, "mixture"))


def p9_shares(spark, sf_dir: str) -> DataFrame:
    mixed, plans = mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))
    return shares(mixed, plans)
