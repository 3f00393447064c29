"""Scalar expressions over text, URLs and HTML. All are native Spark columns; none needs Python workers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens of a legal form or filler word that a name is compared without.
SUFFIXES = ["inc", "incorporated", "llc", "ltd", "limited", "corp", "corporation", "co", "pbc", "plc", "gmbh", "sas", "technologies", "labs", "ai", "ml"]
# Texts of a bot check in place of a page.
BOT_WALL = ["checking your browser", "cf-browser-verification", "just a moment...", "datadome", "enable javascript and cookies"]
# Role families in order of precedence and the substrings that select them.
ROLES = [
    ("Engineering", ["engineer", "developer", "swe", "infrastructure", "backend", "frontend"]),
    ("Research", ["research scientist", "research engineer", "phd"]),
    ("Data", ["data scientist", "data analyst", "analytics"]),
    ("Product", ["product manager", "product owner"]),
    ("Design", ["designer", "ux", "ui"]),
    ("Sales", ["sales", "account executive", "solutions engineer"]),
]
# Pricing models.
PRICING = ["FREE", "FREEMIUM", "PAID", "ENTERPRISE", "UNKNOWN"]
# Words that begin a banner line.
BANNER_WORDS = ["cookie", "subscribe", "sign up", "advertisement", "newsletter"]
WS = r"[\s\x1c-\x1f]"


def py_strip(x: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(x, rf"(?U)^{WS}+|{WS}+$", "")


def valid_url(url: Column) -> Column:
    """Begins, case-sensitively, with http:// or https://. Null is invalid."""
    return F.coalesce(url.startswith("http://") | url.startswith("https://"), F.lit(False))


def bot_walled(html: Column, status: Column) -> Column:
    """A bot check, a nearly empty page (null is empty), or a 403."""
    html = F.coalesce(html, F.lit(""))
    low = F.lower(html)
    marked = F.lit(False)
    for marker in BOT_WALL:
        marked = marked | F.contains(low, F.lit(marker))
    return marked | (F.length(py_strip(html)) < 200) | F.coalesce(status == 403, F.lit(False))


def first_line(text: Column, most: int) -> Column:
    """The text before the first newline, at most so many code points, not stripped."""
    return F.substring(F.substring_index(text, "\n", 1), 1, most)


def headline(text: Column) -> Column:
    return first_line(text, 200)


def raw_company(text: Column) -> Column:
    return first_line(text, 120)


def is_remote(text: Column) -> Column:
    """P9"""
    return F.contains(F.lower(text), F.lit("remote"))


def role_family(text: Column, roles=ROLES) -> Column:
    """P10: the first family, in order, one of whose substrings occurs."""
    low, out = F.lower(text), None
    for family, words in roles:
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(low, F.lit(w))
        out = F.when(hit, F.lit(family)) if out is None else out.when(hit, F.lit(family))
    return out.otherwise(F.lit("Unclassified"))


def pricing_model(x: Column, known=PRICING) -> Column:
    """A known value, else UNKNOWN."""
    return F.coalesce(F.when(x.isin(known), x), F.lit("UNKNOWN"))


def code_host_repo(text: Column, host: str = "github.com") -> tuple[Column, Column]:
    """Owner and repository of the first repository address, null without one. Dots that end the name are dropped."""
    pattern = rf"(?U)https?://{host.replace('.', '[.]')}/([\w.\-]+)/([\w.\-]+)"
    owner = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    repo = F.regexp_replace(F.regexp_extract(text, pattern, 2), r"\.+$", "")
    return owner, F.when(owner.isNotNull(), repo)


def code_host_url(text: Column, host: str = "github.com") -> Column:
    owner, repo = code_host_repo(text, host)
    return F.concat(F.lit(f"https://{host}/"), owner, F.lit("/"), repo)


def strip_tags(html: Column) -> Column:
    """E2"""
    return F.regexp_replace(html, r"<[^>]+>", "")


def page_title(html: Column) -> Column:
    """Text of the first h1, tags removed, stripped, entities as they are; null without h1."""
    return F.when(html.rlike(r"(?s)<h1[^>]*>.*?</h1>"), py_strip(strip_tags(F.regexp_extract(html, r"(?s)<h1[^>]*>(.*?)</h1>", 1))))


def stars_hint(html: Column) -> Column:
    """Digits before the first 'star(s)'; null where no digit is left (a bare comma)."""
    said = F.regexp_extract(html, r"(?i)([\d,]+)\s*stars?", 1)
    return F.replace(F.nullif(said, F.lit("")), F.lit(","), F.lit("")).try_cast("bigint")


def estimate_tokens(text: Column) -> Column:
    """A quarter of the code points, at least one."""
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4).cast("int"))


def strip_banner_lines(text: Column) -> Column:
    """Lines that begin as banners do and have at most 80 more letters go; three newlines become two; stripped."""
    once = F.regexp_replace(text, rf"(?imduU)^{WS}*({'|'.join(BANNER_WORDS)}).{{0,80}}$", "")
    return py_strip(F.regexp_replace(once, r"\n{3,}", "\n\n"))


def paragraphs(text: Column) -> Column:
    """E5: pieces between blank lines, blank ones dropped."""
    return F.filter(F.split(text, rf"(?U)\n{WS}*\n"), lambda p: p.rlike(r"(?U)[^\s\x1c-\x1f]"))


def authority(url: Column) -> Column:
    """Host with port and user, case kept; null for what is no URL."""
    return F.try_parse_url(url, F.lit("AUTHORITY"))


def content_hash(text: Column) -> Column:
    """SHA-256 of the first 2,000 code points. A change detector's definition of content, not a text operator."""
    return F.sha2(F.substring(text, 1, 2000), 256)


def retry_after(body: Column) -> Column:
    """Seconds named by a JSON body under either key; a value that is no number, or zero, falls through or is null."""
    first, second = F.get_json_object(body, "$.retry_after"), F.get_json_object(body, "$.retryAfter")
    falsy = first.isNull() | first.isin("", "0", "0.0", "false")
    return F.when(falsy, second).otherwise(first).try_cast("double")


def extraction_prompt(url: Column, schema_hint: Column, chunk: Column) -> Column:
    """Header and chunk; braces in any part are plain text."""
    return F.concat(F.lit("SOURCE URL: "), url, F.lit("\nTARGET SCHEMA: "), schema_hint, F.lit("\n\nTEXT:\n"), chunk)


def normalized_name(name: Column) -> Column:
    """Without dots and commas, without legal suffixes anywhere, single spaces, lower case."""
    bare = F.regexp_replace(name, "[.,]", "")
    bare = F.regexp_replace(bare, rf"(?iuU)\b(?:{'|'.join(SUFFIXES)})\b", "")
    return F.lower(py_strip(F.regexp_replace(bare, rf"(?U){WS}+", " ")))


def feed_query_url(base: str, search: Column, start: Column, most: Column) -> Column:
    """Newest first; nothing is encoded."""
    return F.concat(F.lit(base + "?search_query="), search, F.lit("&start="), start.cast("string"), F.lit("&max_results="), most.cast("string"), F.lit("&sortBy=submittedDate&sortOrder=descending"))
