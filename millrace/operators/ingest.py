"""Ingest of crawled news and job pages: dates, freshness, change detection, names, typed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import dates, text
from millrace.operators.resolve import REVIEW, resolve


def with_dates(crawl: DataFrame, reference: Column) -> DataFrame:
    """``crawl`` (seq, url, structured_meta, relative_text, full_text) with the struct ``date`` and ``content_hash``."""
    return crawl.withColumn("date", dates.normalize_publication(F.col("structured_meta"), F.col("relative_text"), reference)).withColumn("content_hash", text.content_hash(F.col("full_text")))


def gate_news(dated: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """``dated`` with ``verdict``: kept, stale or duplicate (P5, W1). ``state``: url, content_hash of earlier runs.

    A dated row is kept if fresh, else stale. An undated row is kept if its page's content isn't that of the last row of
    the page that wasn't stale; stale rows register nothing. Every page's rows are ordered by ``seq``."""
    stale = (F.col("date.confidence") != "none") & ~F.coalesce(F.col("date.is_fresh_24h"), F.lit(False))
    live = dated.filter(~stale)
    before = F.lag("content_hash").over(Window.partitionBy("url").orderBy("seq"))
    if state is not None:
        known = state.select(F.col("url").alias("state_url"), F.col("content_hash").alias("state_hash"))
        live = live.join(known, F.col("url") == F.col("state_url"), "left").drop("state_url")
    else:
        live = live.withColumn("state_hash", F.lit(None).cast("string"))
    live = live.withColumn("previous", F.coalesce(before, F.col("state_hash")))
    kept = (F.col("date.confidence") != "none") | dates.is_new_since(F.col("previous"), F.col("content_hash"))
    judged = live.withColumn("verdict", F.when(kept, "kept").otherwise("duplicate")).drop("previous", "state_hash")
    return judged.unionByName(dated.filter(stale).withColumn("verdict", F.lit("stale")))


def next_state(judged: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """url, content_hash after a run: the last row of a page that wasn't stale; pages without one keep theirs."""
    new = judged.filter("verdict <> 'stale'").groupBy("url").agg(F.max_by("content_hash", "seq").alias("content_hash"))
    if state is None:
        return new
    return new.unionByName(state.select("url", "content_hash").join(new.select("url"), "url", "left_anti"))


def source_struct(name: Column, url: Column) -> Column:
    return F.struct(name.alias("name"), url.alias("url"))


def news_records(judged: DataFrame, source_name: Column, reference: Column, collected_at: Column) -> DataFrame:
    """Typed news records of the kept rows; undated ones carry the reference time and keep their confidence."""
    kept = judged.filter("verdict = 'kept'").filter(text.valid_url(F.col("url")))
    return kept.select(
        "seq",
        source_struct(source_name, F.col("url")).alias("source"),
        F.struct(
            text.headline(F.col("full_text")).alias("headline"), F.col("full_text"),
            F.coalesce("date.iso_timestamp", dates.iso_utc(reference)).alias("published_date"), F.array().cast("array<string>").alias("entities_mentioned"),
        ).alias("content"),
        F.lit("1.0").alias("schemaVersion"), F.lit("NEWS").alias("recordType"), collected_at.alias("collectedAt"), F.col("date.confidence").alias("date_confidence"),
    )


def gate_jobs(dated: DataFrame) -> DataFrame:
    """Undated and not fresh rows are both stale."""
    return dated.withColumn("verdict", F.when(F.coalesce(F.col("date.is_fresh_24h"), F.lit(False)), "kept").otherwise("stale"))


def job_records(judged: DataFrame, dim: DataFrame, source_name: Column, collected_at: Column, apply_review_band: bool = True) -> DataFrame:
    """Typed job records of the kept rows. ``apply_review_band`` lets guesses below the accept threshold name the company."""
    kept = judged.filter("verdict = 'kept'").filter(text.valid_url(F.col("url"))).withColumn("raw_name", text.raw_company(F.col("full_text")))
    named = resolve(kept, dim, least=REVIEW)
    company = F.coalesce(F.col("best_guess" if apply_review_band else "canonical_name"), F.col("raw_name"))
    return named.select(
        "seq",
        source_struct(source_name, F.col("url")).alias("source"),
        F.struct(
            company.alias("company"), F.col("date.iso_timestamp").alias("date"), F.col("raw_name").alias("rawCompany"), F.lit(None).cast("string").alias("title"),
            text.is_remote(F.col("full_text")).alias("is_remote"), text.role_family(F.col("full_text")).alias("role_family"),
        ).alias("content"),
        F.lit("1.0").alias("schemaVersion"), F.lit("JOB").alias("recordType"), collected_at.alias("collectedAt"),
    )


def ingest_stats(judged: DataFrame, group: Column) -> DataFrame:
    """A2: counters per group; ``fetched`` counts the listing page too."""
    count = lambda c: F.count_if(c)
    return judged.groupBy(group.alias("source_name")).agg(
        (F.count(F.lit(1)) + 1).alias("fetched"),
        count(F.col("verdict") == "kept").alias("fresh_kept"),
        count(F.col("verdict") == "stale").alias("stale_dropped"),
        count(F.col("verdict") == "duplicate").alias("dedup_dropped"),
        count(F.col("date.confidence") == "none").alias("no_date_signal"),
    )


def quarantine(records: DataFrame, url: str = "url") -> tuple[DataFrame, DataFrame]:
    """Rows with a valid URL, and the others."""
    ok = text.valid_url(F.col(url))
    return records.filter(ok), records.filter(~ok)


def paper_records(entries: DataFrame, repo_stats: DataFrame, source_name: Column, collected_at: Column, host: str = "github.com") -> DataFrame:
    """Papers with the newest star count of the repository their summary links; no link or no metrics gives null."""
    owner, repo = text.code_host_repo(F.col("summary"), host)
    linked = entries.withColumn("owner", owner).withColumn("repo", repo)
    newest = repo_stats.groupBy(F.col("owner").alias("s_owner"), F.col("repo").alias("s_repo")).agg(F.max_by("stargazers_count", "fetched_at").alias("github_stars"))
    joined = linked.join(newest, (F.col("owner") == F.col("s_owner")) & (F.col("repo") == F.col("s_repo")) & (F.col("repo") != ""), "left")
    return joined.select(
        source_struct(source_name, F.col("paper_url")).alias("source"),
        F.struct(
            "title", "paper_url", "authors", F.concat(F.lit(f"https://{host}/"), "owner", F.lit("/"), "repo").alias("github_url"), "github_stars", F.col("published").alias("published_date"),
        ).alias("content"),
        F.lit("1.0").alias("schemaVersion"), F.lit("RESEARCH_PAPER").alias("recordType"), collected_at.alias("collectedAt"),
    )
