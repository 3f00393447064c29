"""Flat tables of the typed records and their files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of each tab, in order.
ENVELOPE = ["schemaVersion", "recordType", "source.name", "source.url"]
TABS = {
    "Startups": [*ENVELOPE, "content.entityName", "content.data.employeeCount", "collectedAt"],
    "Products": [*ENVELOPE, "content.startupName", "content.productName", "content.pricingModel", "collectedAt"],
    "Research Papers": [*ENVELOPE, "content.title", "content.authors", "content.paper_url", "content.github_url", "content.github_stars", "content.published_date", "collectedAt"],
    "Jobs": [*ENVELOPE, "content.company", "content.rawCompany", "content.date", "content.is_remote", "content.role_family", "collectedAt"],
    "News": [*ENVELOPE, "content.headline", "content.published_date", "collectedAt"],
    "Entity Mapping Log": ["raw_name", "canonical_name", "confidence", "method", "source_url"],
}


def flat(records: DataFrame, tab: str) -> DataFrame:
    """The tab's columns under their dotted names; author lists joined by '; ' (null names as '')."""

    def column(path: str):
        c = F.col(path)
        if path == "content.authors":
            c = F.array_join(F.transform(c, lambda a: F.coalesce(a, F.lit(""))), "; ")
        return c.alias(path)

    return records.select(*[column(path) for path in TABS[tab]])


def write_tab(rows: DataFrame, base: str, tab: str, fmt: str = "parquet") -> str:
    """Replaces the tab's folder, which is made if missing."""
    path = f"{base}/{tab.lower().replace(' ', '_')}"
    safe = rows.select(*[F.col(f"`{c}`").alias(c.replace(".", "_")) for c in rows.columns])
    writer = safe.write.mode("overwrite")
    (writer.option("header", True).csv if fmt == "csv" else writer.json if fmt == "json" else writer.parquet)(path)
    return path


def write_all(tables: dict[str, DataFrame], base: str, fmt: str = "parquet") -> dict[str, str]:
    """K9: the tabs in their fixed order; tabs that aren't given are left alone."""
    return {tab: write_tab(flat(tables[tab], tab), base, tab, fmt) for tab in TABS if tab in tables}
