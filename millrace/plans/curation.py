"""The general record-curation queries: instants of date texts (p2) and histories of changing attributes (p4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.history import versions
from millrace.operators.timestamps import normalize_instants
from millrace.session import table


def dated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rec_kind, rec_id, source_name, date_text, collectedat of every record that carries a date text."""
    parts = [
        table(spark, sf_dir, name).select(F.lit(kind).alias("rec_kind"), F.col(key).alias("rec_id"), F.col("source.name").alias("source_name"), F.col(f"content.{field}").alias("date_text"), "collectedat")
        for kind, name, key, field in (("news", "news", "news_id", "published_date"), ("job", "jobs", "job_id", "date"), ("paper", "papers", "capture_id", "published_date"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    # feed_sources is a fixed dimension: one row per feed, 48 rows at any scale
    feeds = table(spark, sf_dir, "feed_sources").select(F.col("source_name").alias("feed"), "zone_name", "day_order").dropDuplicates(["feed"])
    joined = dated_records(spark, sf_dir).join(F.broadcast(feeds), F.col("source_name") == F.col("feed"), "left")
    done = normalize_instants(joined, F.col("date_text"), F.col("zone_name"), F.col("day_order"), F.col("collectedat"))
    return done.filter("utc_us IS NOT NULL").select("rec_kind", "rec_id", "utc_us")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rec_kind, rec_key, at, loaded_at, capture_id, value of the captures in papers and startups."""
    papers = table(spark, sf_dir, "papers").select(
        F.lit("paper").alias("rec_kind"), F.col("content.paper_url").alias("rec_key"), F.col("collectedat").alias("at"), "loaded_at", "capture_id", F.col("content.github_stars").alias("value")
    )
    startups = table(spark, sf_dir, "startups").select(
        F.lit("startup").alias("rec_kind"), F.col("listing_id").cast("string").alias("rec_key"), F.col("collectedat").alias("at"), "loaded_at", "capture_id", F.col("content.data.employeecount").alias("value")
    )
    return papers.unionByName(startups)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions(captures(spark, sf_dir)).select("rec_kind", "rec_key", "valid_from")


def p4_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each version with its value and the end of its validity (null: still valid)."""
    found = versions(captures(spark, sf_dir))
    after = Window.partitionBy("rec_kind", "rec_key").orderBy("valid_from")
    return found.withColumn("valid_to", F.lead("valid_from").over(after))


#: p2 has no SQL form: its grammar of date texts is checked against a brute-force parser on a fixture instead.
P4_SQL = """
WITH captures AS (
  SELECT 'paper' AS rec_kind, content.paper_url AS rec_key, collectedat AS seen_at, loaded_at, capture_id, content.github_stars AS value FROM papers
  UNION ALL
  SELECT 'startup', CAST(listing_id AS VARCHAR), collectedat, loaded_at, capture_id, content.data.employeecount FROM startups
), kept AS (
  SELECT *, row_number() OVER (PARTITION BY rec_kind, rec_key, seen_at ORDER BY loaded_at DESC, capture_id DESC) AS rn FROM captures WHERE rec_key IS NOT NULL AND seen_at IS NOT NULL
), seen AS (
  SELECT rec_kind, rec_key, seen_at, value, lag(value) OVER (PARTITION BY rec_kind, rec_key ORDER BY seen_at) AS before FROM kept WHERE rn = 1 AND value >= 0
), found AS (
  SELECT rec_kind, rec_key, seen_at AS valid_from, value FROM seen WHERE before IS NULL OR before <> value
)
"""


def queries() -> dict:
    return {"p2_found": p2_found, "p4_found": p4_found, "p4_versions": p4_versions}


def oracle_sql() -> dict[str, str]:
    return {
        "p4_found": P4_SQL + "SELECT rec_kind, rec_key, valid_from FROM found",
        "p4_versions": P4_SQL + "SELECT *, lead(valid_from) OVER (PARTITION BY rec_kind, rec_key ORDER BY valid_from) AS valid_to FROM found",
    }
