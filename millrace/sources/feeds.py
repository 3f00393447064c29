"""Captured feeds, listings, robots files and repository lookups as DataFrames."""

from __future__ import annotations

import urllib.robotparser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import authority, py_strip

ENTRY = "STRUCT<id: STRING, title: STRING, summary: STRING, published: STRING, author: ARRAY<STRUCT<name: STRING>>>"


def feed_entries(pages: DataFrame, xml: str = "xml") -> DataFrame:
    """A row per entry of Atom feeds: page columns, entry_no, title, summary, published, paper_url, authors.
    Missing title, summary and id are '', a missing date is null; a feed that doesn't parse gives no entry."""
    parsed = F.from_xml(F.col(xml), f"entry ARRAY<{ENTRY}>", {"ignoreSurroundingSpaces": "false"})
    rows = pages.withColumn("__feed", parsed).select("*", F.posexplode("__feed.entry").alias("entry_no", "__e")).drop("__feed", xml)
    text = lambda c: py_strip(F.coalesce(F.col(f"__e.{c}"), F.lit("")))
    authors = F.transform(F.coalesce("__e.author", F.array().cast("array<struct<name:string>>")), lambda a: py_strip(F.coalesce(a["name"], F.lit(""))))
    return rows.select(
        *[c for c in rows.columns if c != "__e"], text("title").alias("title"), text("summary").alias("summary"), F.col("__e.published").alias("published"),
        F.coalesce("__e.id", F.lit("")).alias("paper_url"), authors.alias("authors"),
    )


def newest(entries: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` entries submitted last; none for a limit of 0 or less."""
    return entries.orderBy(F.desc("published"), "paper_url").limit(max(0, limit))


def repo_links(papers: DataFrame, responses: DataFrame) -> DataFrame:
    """S3: papers with the captured JSON of their repositories, unchanged (paper_id, body)."""
    return papers.join(responses.select("paper_id", F.col("body").alias("repositories")), "paper_id", "left")


def listing_links(listings: DataFrame, html: str = "html", pattern: str = r'href="([^"]+)"') -> DataFrame:
    """Detail addresses of listing pages in order, repeats kept: listing_url, pos, url."""
    return listings.select(F.col("url").alias("listing_url"), F.posexplode(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1))).alias("pos", "url"))


def detail_pages(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Each link with its fetched page; pages that weren't fetched have null."""
    return links.join(pages.select("url", "status", "html"), "url", "left")


def robots_allowed(urls: DataFrame, robots: DataFrame, agent: str = "*", url: str = "url") -> DataFrame:
    """``urls`` with ``allowed`` by the robots file of their host (host, body). A host without a file allows all.

    One row of rules per host travels by an ordinary join, so any number of hosts is fine; addresses are judged in Arrow
    batches, each host's rules parsed once a batch."""

    @F.pandas_udf(T.BooleanType())
    def judge(address: pd.Series, body: pd.Series) -> pd.Series:
        parsers: dict[str, urllib.robotparser.RobotFileParser] = {}
        out = []
        for a, b in zip(address, body):
            if a is None or b is None:
                out.append(True)
                continue
            if b not in parsers:
                parsers[b] = urllib.robotparser.RobotFileParser()
                parsers[b].parse(b.splitlines())
            out.append(parsers[b].can_fetch(agent, a))
        return pd.Series(out)

    rules = robots.groupBy(F.col("host").alias("__host")).agg(F.max("body").alias("__body"))
    joined = urls.join(rules, authority(F.col(url)) == F.col("__host"), "left")
    return joined.withColumn("allowed", judge(F.col(url), F.col("__body"))).drop("__host", "__body")


def feed_requests(spark, base: str, search: str, limit: int, page_size: int = 100) -> DataFrame:
    """The requests that page through a feed: start, max_results, url."""
    pages = -(-max(0, limit) // page_size)
    starts = spark.range(pages).select((F.col("id") * page_size).alias("start"))
    from millrace.functions.text import feed_query_url

    return starts.select("start", F.lit(page_size).alias("max_results"), feed_query_url(base, F.lit(search), F.col("start"), F.lit(page_size)).alias("url"))


def paged_feed_source(fetch, page_size: int = 100):
    """A Python data source over pages of a feed; ``fetch(start, size) -> list[(id, xml)]`` is injected. One input
    partition per page, so pages are read in parallel and a lost task reads its page again."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class Page(InputPartition):
        def __init__(self, start: int):
            self.start = start

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.limit = int(options.get("limit", "1000"))

        def partitions(self):
            return [Page(s) for s in range(0, max(0, self.limit), page_size)]

        def read(self, partition):
            yield from fetch(partition.start, min(page_size, self.limit - partition.start))

    class FeedSource(DataSource):
        @classmethod
        def name(cls):
            return "paged_feed"

        def schema(self):
            return "page string, xml string"

        def reader(self, schema):
            return Reader(self.options)

    return FeedSource


def host_of(url: Column) -> Column:
    return authority(url)
