"""Queries of the ingest operators over the test tables, each with the SQL it is compared with.

The crawl is derived from events and documents by integer keys, the same way on both sides. The SQL side never parses
dates: it computes from the keys what the texts were made from.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import dates, text
from millrace.operators import chunk as chunks
from millrace.operators import ingest, providers
from millrace.operators.resolve import equality_tiers, mapping_log, register, resolve, review_queue
from millrace.session import shared_dir, table
from millrace.sources import feeds, sinks

REFERENCE = "2024-01-30 12:00:00"
COLLECTED = "2024-01-30T12:00:00+00:00"


def stamp():
    return F.lit(REFERENCE).cast("timestamp")


VISITS = 25  # of each page; its content is another document after every three

CRAWL_SQL = f"""
WITH crawl AS (
  SELECT event_id AS seq, event_type, ts,
    'https://' || event_type || '.example.org/' || (event_id % pages) AS url,
    CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' WHEN 2 THEN 'on ' || strftime(ts, '%d.%m.') END AS structured_meta,
    CASE event_id % 4 WHEN 1 THEN (event_id % 60) || ' hours ago' WHEN 2 THEN (event_id % 5) || 'd' END AS relative_text,
    coalesce(d.text, '') AS full_text,
    TIMESTAMP '{REFERENCE}' AS ref
  FROM (SELECT *, greatest(1, (SELECT count(*) FROM events) // {VISITS}) AS pages, (SELECT count(*) FROM documents) AS docs FROM events)
  LEFT JOIN documents d ON d.doc_id = 1 + (event_id // (3 * pages) * pages + event_id % pages) % docs
), dated AS (
  SELECT *,
    CASE event_id_mod WHEN 0 THEN 'structured' WHEN 3 THEN 'none' ELSE 'relative' END AS confidence,
    CASE event_id_mod WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN ref - to_hours(CAST(seq % 60 AS INTEGER)) WHEN 2 THEN ref - to_days(CAST(seq % 5 AS INTEGER)) END AS pub,
    sha256(substring(full_text, 1, 2000)) AS content_hash
  FROM (SELECT *, seq % 4 AS event_id_mod FROM crawl)
), fresh AS (
  SELECT *, CASE WHEN confidence = 'none' THEN NULL ELSE pub <= ref AND pub >= ref - INTERVAL 24 HOUR END AS is_fresh FROM dated
), live AS (
  SELECT *, lag(content_hash) OVER (PARTITION BY url ORDER BY seq) AS before FROM fresh WHERE confidence = 'none' OR is_fresh
), judged AS (
  SELECT seq, url, event_type, full_text, confidence, pub, content_hash, CASE WHEN confidence <> 'none' OR before IS NULL OR before <> content_hash THEN 'kept' ELSE 'duplicate' END AS verdict FROM live
  UNION ALL SELECT seq, url, event_type, full_text, confidence, pub, content_hash, 'stale' FROM fresh WHERE confidence <> 'none' AND NOT is_fresh
)
"""
ISO_SQL = "CASE confidence WHEN 'none' THEN '2024-01-30T12:00:00+00:00' ELSE strftime(pub, '%Y-%m-%dT%H:%M:%S') || '+00:00' END"


def crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits of pages whose content changes now and then, made from all events and all documents."""
    e, d = table(spark, sf_dir, "events"), table(spark, sf_dir, "documents")
    pages, docs = max(1, e.count() // VISITS), max(1, d.count())
    k, page = F.col("event_id") % 4, F.col("event_id") % pages
    e = e.select(
        F.col("event_id").alias("seq"), "event_type",
        F.concat(F.lit("https://"), "event_type", F.lit(".example.org/"), page.cast("string")).alias("url"),
        F.when(k == 0, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).when(k == 2, F.concat(F.lit("on "), F.date_format("ts", "dd.MM."))).alias("structured_meta"),
        F.when(k == 1, F.concat((F.col("event_id") % 60).cast("string"), F.lit(" hours ago"))).when(k == 2, F.concat((F.col("event_id") % 5).cast("string"), F.lit("d"))).alias("relative_text"),
        (1 + (F.floor(F.col("event_id") / (3 * pages)) * pages + page) % docs).alias("page_doc"),
    )
    d = d.select(F.col("doc_id").alias("page_doc"), "text")
    return e.join(d, "page_doc", "left").withColumn("full_text", F.coalesce("text", F.lit(""))).drop("page_doc", "text")


def dated(spark, sf_dir):
    return ingest.with_dates(crawl(spark, sf_dir), stamp())


def date_normalize(spark, sf_dir):
    return dated(spark, sf_dir).select("seq", F.col("date.iso_timestamp").alias("iso_timestamp"), F.col("date.confidence").alias("confidence"), F.col("date.is_fresh_24h").alias("is_fresh_24h"))


def freshness_structured(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("meta"))
    d = e.withColumn("date", dates.normalize_publication(F.col("meta"), F.lit(None).cast("string"), stamp()))
    return d.filter("date.is_fresh_24h").select("event_id", F.unix_seconds("date.ts").alias("ts_seconds"))


def date_relative(spark, sf_dir):
    return crawl(spark, sf_dir).filter("relative_text IS NOT NULL").select("seq", dates.seconds_ago(F.col("relative_text")).alias("seconds_ago"))


def news_judged(spark, sf_dir):
    return ingest.gate_news(dated(spark, sf_dir))


def news_ingest(spark, sf_dir):
    records = ingest.news_records(news_judged(spark, sf_dir), F.col("event_type"), stamp(), F.lit(COLLECTED))
    return records.select("seq", F.col("source.url").alias("url"), F.col("content.headline").alias("headline"), F.col("content.published_date").alias("published_date"), "date_confidence", F.sha2("content.full_text", 256).alias("text_sha256"))


def news_state(spark, sf_dir):
    """Two runs: the second begins with the state of the first."""
    rows = dated(spark, sf_dir)
    half = (F.col("seq") % 1000) < 500
    first = ingest.gate_news(rows.filter(half))
    state = ingest.next_state(first)
    second = ingest.gate_news(rows.filter(~half), state)
    return second.select("seq", "verdict")


def job_ingest(spark, sf_dir):
    records = ingest.job_records(ingest.gate_jobs(dated(spark, sf_dir)), table(spark, sf_dir, "canonical_entities"), F.col("event_type"), F.lit(COLLECTED))
    c = F.col("content")
    return records.select("seq", c["rawCompany"].alias("raw_company"), c["company"].alias("company"), c["date"].alias("date"), c["is_remote"].alias("is_remote"), c["role_family"].alias("role_family"))


def ingest_stats(spark, sf_dir):
    return ingest.ingest_stats(news_judged(spark, sf_dir), F.col("event_type"))


def content_hash_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", "source", text.content_hash(F.col("text")).alias("content_hash"))
    before = F.lag("content_hash").over(Window.partitionBy("source").orderBy("doc_id"))
    return docs.withColumn("before", before).filter(dates.is_new_since(F.col("before"), F.col("content_hash"))).select("doc_id", "content_hash")


def text_projections(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", text.headline(t).alias("headline"), text.raw_company(t).alias("raw_company"), text.is_remote(t).alias("is_remote"), text.role_family(t).alias("role_family"))


ROLE_SQL = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(lower(text), '{w}')" for w in words) + f" THEN '{family}'" for family, words in text.ROLES) + " ELSE 'Unclassified' END"
WS_SQL = r"[\t-\r\x1c-\x20\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WS_SQL}+|{WS_SQL}+$', '', 'g')"


def norm_sql(x: str) -> str:
    bare = rf"regexp_replace(regexp_replace({x}, '[.,]', '', 'g'), '(?i)\b({'|'.join(text.SUFFIXES)})\b', '', 'g')"
    return f"lower({strip_sql(f"regexp_replace({bare}, '{WS_SQL}+', ' ', 'g')")})"


#: The equality tiers, from the dictionary's definition: a later canonical name takes a key from earlier ones and from aliases.
TIERS_SQL = f"""
alias AS (SELECT ord, canonical, unnest(aliases) AS alias, unnest(range(len(aliases))) AS pos FROM canonical_entities WHERE canonical IS NOT NULL),
exact AS (SELECT lower({strip_sql("canonical")}) AS key, arg_max(canonical, ord) AS c FROM canonical_entities WHERE canonical IS NOT NULL GROUP BY 1),
by_alias AS (SELECT lower({strip_sql("alias")}) AS key, max(struct_pack(o := ord, p := pos, c := canonical)).c AS c FROM alias WHERE alias IS NOT NULL GROUP BY 1),
spelled AS (SELECT {norm_sql("canonical")} AS key, ord, -1 AS pos, canonical FROM canonical_entities WHERE canonical IS NOT NULL UNION ALL SELECT {norm_sql("alias")}, ord, pos, canonical FROM alias WHERE alias IS NOT NULL),
norm AS (SELECT key, coalesce(max(struct_pack(o := ord, c := canonical)) FILTER (pos = -1).c, min(struct_pack(o := ord, p := pos, c := canonical)).c) AS c FROM spelled WHERE key <> '' GROUP BY 1)
""".replace("max(struct_pack(o := ord, c := canonical)) FILTER (pos = -1).c", "(max(struct_pack(o := ord, c := canonical)) FILTER (pos = -1)).c")
NAMES_SQL = f"""
WITH {TIERS_SQL.strip()},
names AS (SELECT 'job' AS kind, job_id AS id, content.rawcompany AS raw_name FROM jobs UNION ALL SELECT 'log', log_id, raw_name FROM entity_mapping_log),
tiers AS (
  SELECT n.*, e.c AS c1, a.c AS c2, x.c AS c3 FROM names n LEFT JOIN exact e ON lower({strip_sql("n.raw_name")}) = e.key LEFT JOIN by_alias a ON lower({strip_sql("n.raw_name")}) = a.key
  LEFT JOIN norm x ON {norm_sql("n.raw_name")} = x.key WHERE n.raw_name IS NOT NULL
)
"""


def raw_names(spark, sf_dir):
    """The names of all postings and of the whole log, as they were typed."""
    jobs = table(spark, sf_dir, "jobs").select(F.lit("job").alias("kind"), F.col("job_id").alias("id"), F.col("content.rawcompany").alias("raw_name"), F.col("source.url").alias("source_url"))
    log = table(spark, sf_dir, "entity_mapping_log").select(F.lit("log").alias("kind"), F.col("log_id").alias("id"), "raw_name", "source_url")
    return jobs.unionByName(log).filter("raw_name IS NOT NULL")


def entities(spark, sf_dir):
    return table(spark, sf_dir, "canonical_entities")


def tiered(spark, sf_dir):
    names = raw_names(spark, sf_dir)
    return names.join(equality_tiers(names.select("raw_name").distinct(), entities(spark, sf_dir)), "raw_name")


def resolve_exact_alias_norm(spark, sf_dir):
    return tiered(spark, sf_dir).filter("canonical_name IS NOT NULL").select("kind", "id", "raw_name", "canonical_name", "confidence", "method")


def unresolved_anti(spark, sf_dir):
    names = raw_names(spark, sf_dir)
    tiers = equality_tiers(names.select("raw_name").distinct(), entities(spark, sf_dir))
    return names.join(tiers.filter("canonical_name IS NOT NULL"), "raw_name", "left_anti").select("kind", "id", "raw_name")


def resolve_fuzzy(spark, sf_dir):
    return resolve(raw_names(spark, sf_dir), entities(spark, sf_dir)).select("kind", "id", "raw_name", "canonical_name", "best_guess", "confidence", "method")


def mapping_log_query(spark, sf_dir):
    return mapping_log(resolve(raw_names(spark, sf_dir), entities(spark, sf_dir)))


def review(spark, sf_dir):
    return review_queue(resolve(raw_names(spark, sf_dir), entities(spark, sf_dir))).select("kind", "id", "raw_name", "best_guess", "confidence")


def html_pages(spark, sf_dir):
    d = table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    head = F.translate(F.substring("text", 1, 60), "<>\n", "()_")
    html = F.concat(F.lit("<html><h1 class=\"t\">"), head, F.lit(" <b>x</b></h1><p>"), F.translate("text", "<>", "()"), F.lit("</p><i>"), F.format_number("n_chars", 0), F.lit(" stars</i><a href=\"https://github.com/o"), F.col("doc_id").cast("string"), F.lit("/r.x.\">l</a></html>"))
    return d.select("doc_id", "url", html.alias("html"), F.when(F.col("doc_id") % 7 == 0, 403).otherwise(200).alias("status"))


HTML_SQL = """
WITH pages AS (
  SELECT doc_id, url, '<html><h1 class="t">' || translate(substring(text, 1, 60), '<>' || chr(10), '()_') || ' <b>x</b></h1><p>' || translate(text, '<>', '()') || '</p><i>' || format('{:,}', n_chars) || ' stars</i><a href="https://github.com/o' || doc_id || '/r.x.">l</a></html>' AS html,
    CASE WHEN doc_id % 7 = 0 THEN 403 ELSE 200 END AS status, substring(text, 1, 60) AS head, n_chars, text
  FROM documents WHERE text IS NOT NULL
)
"""


def page_fields(spark, sf_dir):
    h = F.col("html")
    return html_pages(spark, sf_dir).select("doc_id", F.length(text.strip_tags(h)).alias("bare_length"), text.stars_hint(h).alias("stars"), text.code_host_url(h).alias("repo_url"), text.bot_walled(h, F.col("status")).alias("bot_walled"))


def page_title(spark, sf_dir):
    return html_pages(spark, sf_dir).select("doc_id", text.page_title(F.col("html")).alias("title"))


def page_host(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.authority(F.col("url")).alias("host"))


def url_quarantine(spark, sf_dir):
    jobs = table(spark, sf_dir, "jobs").select("job_id", F.col("source.url").alias("url"))
    good, bad = ingest.quarantine(jobs)
    return good.withColumn("valid", F.lit(True)).unionByName(bad.withColumn("valid", F.lit(False))).groupBy("valid").agg(F.count(F.lit(1)).alias("n"))


def repo_stats_join(spark, sf_dir):
    """Papers as entries whose summary holds their repository address; metrics are their own earlier captures."""
    papers = table(spark, sf_dir, "papers")
    url = F.regexp_replace("content.github_url", "^https://codehost[.]example/", "https://codehost.example/")
    owner, repo = text.code_host_repo(url, "codehost.example")
    stats = papers.filter("content.github_url IS NOT NULL").select(owner.alias("owner"), repo.alias("repo"), F.col("content.github_stars").alias("stargazers_count"), F.struct("loaded_at", "capture_id").alias("fetched_at"))
    entries = papers.select("capture_id", F.col("content.title").alias("title"), F.coalesce(F.concat(F.lit("see "), url, F.lit(".")), F.lit("no code")).alias("summary"), F.col("content.paper_url").alias("paper_url"), F.col("content.authors").alias("authors"), F.col("content.published_date").alias("published"))
    made = ingest.paper_records(entries.withColumn("authors", F.coalesce("authors", F.array().cast("array<string>"))), stats, F.lit("feed"), F.lit(COLLECTED), "codehost.example")
    c = F.col("content")
    return made.groupBy(c["github_url"].alias("github_url"), c["github_stars"].alias("github_stars")).agg(F.count(F.lit(1)).alias("n"))


def atom_feed(spark, sf_dir):
    d = table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    xml = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://x/'), F.col("doc_id").cast("string"), F.lit("</id><title>  "), esc(F.substring("text", 1, 40)), F.lit(" </title><summary>"), esc(F.col("text")), F.lit("</summary><published>2024-01-02T03:04:05Z</published><author><name>A "), F.col("doc_id").cast("string"), F.lit("</name></author><author><name>B</name></author></entry></feed>"))
    entries = feeds.feed_entries(d.select("doc_id", xml.alias("xml")))
    return entries.select("doc_id", "paper_url", "published", F.sha2("title", 256).alias("title_sha"), F.length("summary").alias("summary_length"), F.array_join("authors", "|").alias("authors"))


def listing_details(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    listings = docs.groupBy(F.coalesce("source", F.lit("none")).alias("url")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda i: F.concat(F.lit('<a href="'), i.cast("string"), F.lit('">x</a>'))), "").alias("html"))
    links = feeds.listing_links(listings)
    pages = docs.select(F.col("doc_id").cast("string").alias("url"), F.lit(200).alias("status"), F.col("text").alias("html"))
    return feeds.detail_pages(links, pages).select("listing_url", "pos", "url", F.length("html").alias("page_length"))


def robots(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "url")
    hosts = table(spark, sf_dir, "feed_sources").select("host", F.when(F.length("host") % 2 == 0, F.lit("User-agent: *\nDisallow: /doc/1")).otherwise(F.lit("")).alias("body"))
    return feeds.robots_allowed(docs, hosts).select("doc_id", "allowed")


def token_estimate(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", text.estimate_tokens(F.col("text")).alias("tokens"))


def strip_boilerplate(spark, sf_dir):
    t = F.concat(F.lit("Subscribe to our newsletter\n\n\n\n"), F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n\n")), F.lit("\n  Cookie note\nend"))
    return table(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", F.sha2(text.strip_banner_lines(t), 256).alias("clean_sha256"))


def chunked(spark, sf_dir, made: str, most: int, overlap: int = 150):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.expr(made).alias("text"))
    return chunks.chunk(docs, "doc_id", "text", most, overlap).select("doc_id", "index", "estimated_tokens", F.sha2("text", 256).alias("text_sha256"))


#: Texts whose lines are paragraphs.
PARAGRAPHS = "replace(text, '\n', '\n\n')"


def chunk_fit(spark, sf_dir):
    return chunked(spark, sf_dir, "text", 10_000)


def chunk_hard_slice(spark, sf_dir):
    """Paragraphs beyond the budget, among others."""
    return chunked(spark, sf_dir, "text", 50)


def chunk_packed(spark, sf_dir):
    return chunked(spark, sf_dir, PARAGRAPHS, 120, 20)


def chunk_sql(made: str, most: int, overlap: int = 150) -> str:
    """Chunks by recursion from paragraph to paragraph: doc_id, index, piece."""
    carry = f"right(open, {4 * overlap})"
    return f"""WITH RECURSIVE cleaned AS (
      SELECT doc_id, {strip_sql(f"regexp_replace(regexp_replace({made}, '(?im)^{WS_SQL}*({'|'.join(text.BANNER_WORDS)}).{{0,80}}$', '', 'g'), chr(10) || '{{3,}}', chr(10) || chr(10), 'g')")} AS clean FROM documents WHERE text IS NOT NULL
    ), pars AS (
      SELECT doc_id, p, greatest(1, length(p) // 4) AS need, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS i FROM (
        SELECT doc_id, unnest(ps) AS p, unnest(range(len(ps))) AS k FROM (SELECT doc_id, regexp_split_to_array(clean, chr(10) || '{WS_SQL}*' || chr(10)) AS ps FROM cleaned WHERE length(clean) // 4 > {most})
      ) WHERE regexp_matches(p, '[^{WS_SQL[1:]}')
    ), step AS (
      SELECT doc_id, 0::BIGINT AS i, NULL::VARCHAR AS open, 0::BIGINT AS load, []::VARCHAR[] AS done FROM (SELECT DISTINCT doc_id FROM pars)
      UNION ALL
      SELECT s.doc_id, p.i,
        CASE WHEN need > {most} THEN NULL WHEN load + need > {most} THEN {f"{carry} || chr(10) || chr(10) ||" if overlap else ""} p ELSE coalesce(open || chr(10) || chr(10), '') || p END,
        CASE WHEN need > {most} THEN 0 WHEN load + need > {most} THEN {f"greatest(1, length({carry}) // 4)" if overlap else "0"} + need ELSE load + need END,
        CASE WHEN need > {most} THEN list_concat(CASE WHEN open IS NULL THEN [] ELSE [open] END, list_transform(range(CAST(ceil(length(p) / {4.0 * most}) AS BIGINT)), lambda k: substring(p, k * {4 * most} + 1, {4 * most}))) WHEN load + need > {most} THEN [open] ELSE [] END
      FROM step s JOIN pars p ON p.doc_id = s.doc_id AND p.i = s.i + 1
    ), pieces AS (
      SELECT doc_id, i, unnest(done) AS piece, unnest(range(len(done))) AS k FROM step
      UNION ALL SELECT doc_id, 1 + max(i), arg_max(open, i), 0 FROM step GROUP BY doc_id HAVING max(struct_pack(i := i, o := open)).o IS NOT NULL
    ), chunks AS (
      SELECT doc_id, 0 AS index, clean AS piece FROM cleaned WHERE length(clean) // 4 <= {most}
      UNION ALL SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i, k) - 1 AS INTEGER), piece FROM pieces
    ) """


CHUNKS_OUT = "SELECT doc_id, index, CAST(greatest(1, length(piece) // 4) AS INTEGER) AS estimated_tokens, sha256(piece) AS text_sha256 FROM chunks"


def chunk_rows(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    return l.select(
        F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("chunk_idx"), F.when(F.col("l_linenumber") % 3 == 0, F.col("l_returnflag")).alias("title"),
        F.when(F.col("l_quantity") > 20, F.col("l_partkey")).alias("stars"), F.array(F.col("l_returnflag"), F.col("l_linestatus")).alias("authors"),
    )


def merge_extractions(spark, sf_dir):
    rows = chunk_rows(spark, sf_dir).groupBy("doc_id", "chunk_idx").agg(F.max("title").alias("title"), F.max("stars").alias("stars"), F.max("authors").alias("authors"))
    merged = chunks.merge_typed(rows, "doc_id", "chunk_idx", ["title", "stars"], ["authors"])
    return merged.select("doc_id", "title", "stars", F.array_join("authors", "|").alias("authors"))


def responses(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()  # noqa: E741
    r = l.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("chunk_idx"), F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("provider_rank"))
    k = (F.col("doc_id") + F.col("chunk_idx") + F.col("provider_rank")) % 5
    return r.withColumns({"provider": F.concat(F.lit("p"), F.col("provider_rank").cast("string")), "status": F.when(k == 0, 429).when(k == 1, 500).otherwise(200), "body": F.when(k == 2, F.lit("not json")).otherwise(F.concat(F.lit('{"v": '), F.col("chunk_idx").cast("string"), F.lit("}")))})


def provider_fallback(spark, sf_dir):
    return chunks.choose_responses(responses(spark, sf_dir))[0].select("doc_id", "chunk_idx", "provider")


def extract_provenance(spark, sf_dir):
    return chunks.provenance(chunks.choose_responses(responses(spark, sf_dir))[0])


def extraction_failures(spark, sf_dir):
    return chunks.choose_responses(responses(spark, sf_dir))[1]


def merge_json_values(spark, sf_dir):
    return chunks.merge_json(chunks.choose_responses(responses(spark, sf_dir))[0])


RESPONSES_SQL = """
WITH r AS (
  SELECT doc_id, chunk_idx, rank, (doc_id + chunk_idx + rank) % 5 AS k FROM (SELECT DISTINCT l_orderkey AS doc_id, l_linenumber AS chunk_idx FROM lineitem), (VALUES (0), (1), (2)) v(rank)
), good AS (SELECT doc_id, chunk_idx, min(rank) AS rank FROM r WHERE k >= 3 GROUP BY ALL)
"""


def backoff_ceiling(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select((F.col("n_nationkey") % 10).alias("attempt")).distinct()
    return n.select("attempt", providers.delay_ceiling(F.col("attempt")).alias("ceiling"))


def typed(spark, sf_dir, name):
    t = table(spark, sf_dir, name)
    return t.select("source", "content", F.col("schemaversion").alias("schemaVersion"), F.col("recordtype").alias("recordType"), F.col("collectedat").alias("collectedAt"))


def undot(df):
    return df.select(*[F.col(f"`{c}`").alias(c.replace(".", "_")) for c in df.columns])


def sink_startups(spark, sf_dir):
    return undot(sinks.flat(typed(spark, sf_dir, "startups"), "Startups"))


def sink_papers(spark, sf_dir):
    return undot(sinks.flat(typed(spark, sf_dir, "papers"), "Research Papers"))


def sink_jobs(spark, sf_dir):
    return undot(sinks.flat(typed(spark, sf_dir, "jobs"), "Jobs"))


def sink_news(spark, sf_dir):
    return undot(sinks.flat(typed(spark, sf_dir, "news"), "News"))


def sink_products(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    content = F.struct(F.col("p_brand").alias("startupName"), F.col("p_name").alias("productName"), text.pricing_model(F.when(F.col("p_size") % 2 == 0, "PAID").otherwise(F.col("p_type"))).alias("pricingModel"))
    rows = p.select(F.struct(F.lit("parts").alias("name"), F.concat(F.lit("https://parts.example/"), F.col("p_partkey").cast("string")).alias("url")).alias("source"), content.alias("content"), F.lit("1.0").alias("schemaVersion"), F.lit("PRODUCT").alias("recordType"), F.lit(COLLECTED).alias("collectedAt"))
    return undot(sinks.flat(rows, "Products"))


def sink_mapping_log(spark, sf_dir):
    return sinks.flat(table(spark, sf_dir, "entity_mapping_log"), "Entity Mapping Log")


def feed_newest(spark, sf_dir):
    """The last 100 entries submitted; the limit is the operator."""
    e = table(spark, sf_dir, "papers").select("capture_id", F.col("collectedat").alias("published"), F.concat(F.lit("x"), F.lpad(F.col("capture_id").cast("string"), 12, "0")).alias("paper_url"))
    return feeds.newest(e, 100).select("capture_id")


def feed_requests(spark, sf_dir):
    """The requests that page through a feed of as many entries as there are papers."""
    return feeds.feed_requests(spark, "https://feed.example/query", "cat:cs.AI", table(spark, sf_dir, "papers").count())


def repo_links(spark, sf_dir):
    papers = table(spark, sf_dir, "papers").select(F.col("content.paper_url").alias("paper_id")).filter("paper_id IS NOT NULL").distinct()
    captured = papers.filter(F.length("paper_id") % 2 == 0).select("paper_id", F.concat(F.lit('{"paper": "'), "paper_id", F.lit('"}')).alias("body"))
    return feeds.repo_links(papers, captured)


def extraction_prompts(spark, sf_dir):
    """Prompts of the chunks, with a schema hint full of braces."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "url", "text")
    made = chunks.chunk(docs, "doc_id", "text", 10_000).join(docs.select("doc_id", "url"), "doc_id")
    prompt = text.extraction_prompt(F.coalesce("url", F.lit("")), F.lit('{"title": "string"}'), F.col("text"))
    return made.select("doc_id", "index", F.sha2(prompt, 256).alias("prompt_sha256"))


def retry_after(spark, sf_dir):
    k = F.col("n_nationkey")
    body = F.when(k % 4 == 0, F.concat(F.lit('{"retry_after": '), k.cast("string"), F.lit("}"))).when(k % 4 == 1, F.concat(F.lit('{"retry_after": 0, "retryAfter": "'), k.cast("string"), F.lit('.5"}'))).when(k % 4 == 2, F.lit('{"retry_after": "soon"}')).otherwise("not json")
    return table(spark, sf_dir, "nation").select("n_nationkey", text.retry_after(body).alias("seconds"))


def resolve_registered(spark, sf_dir):
    """A name that a new version of the dimension knows and the old one doesn't."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("seq"), F.when(F.col("s_suppkey") % 2 == 0, "Unrelated Trading House").otherwise("uth").alias("raw_name"))
    dim = register(entities(spark, sf_dir), "Unrelated Trading House", ["UTH"])
    return s.join(equality_tiers(s.select("raw_name").distinct(), dim), "raw_name").select("seq", "canonical_name", "confidence", "method")


#: Forms of one instant: the text as Spark's pattern, and the instant's unit.
ISO_FORMS = [
    ("yyyy-MM-dd'T'HH:mm:ss'Z'", "second"), ("yyyyMMdd'T'HHmmss", "second"), ("yyyy-MM-dd", "day"), ("yyyy-MM-dd HH:mm", "minute"), ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "microsecond"), ("yyyy-MM-dd'T'HH:mm:ss,SSS", "millisecond"),
    ("yyyyMMdd'T'HH", "hour"), ("yyyy-MM-dd'x'HH:mm:ss'+05:30'", "second"), ("yyyy-MM-dd'T'HHmm'-0100'", "minute"), ("yyyy-DDD", ""), ("dd MMM yyyy", ""),
]
SHIFTED = {7: 19_800, 8: -3_600}


def date_iso_forms(spark, sf_dir):
    """Instants of texts in basic, week, fraction and offset forms, and of texts that are no dates."""
    k = F.col("event_id") % (len(ISO_FORMS) + 1)
    # the day's ISO week, in the basic form for every second one
    thursday = F.date_add(F.to_date("ts"), 3 - F.weekday("ts"))
    week = F.concat(F.year(thursday).cast("string"), F.lit("-W"), F.lpad(F.weekofyear("ts").cast("string"), 2, "0"), F.lit("-"), (F.weekday("ts") + 1).cast("string"))
    said = F.when(F.col("event_id") % 2 == 0, F.replace(week, F.lit("-"), F.lit(""))).otherwise(week)
    for i, (form, _) in enumerate(ISO_FORMS):
        said = F.when(k == i, F.date_format("ts", form)).otherwise(said)
    return table(spark, sf_dir, "events").select("event_id", said.alias("said")).select("event_id", F.unix_micros(dates.parse_structured(F.col("said"))["ts"]).alias("us"))


ISO_FORMS_SQL = "SELECT event_id, CASE event_id % " + str(len(ISO_FORMS) + 1) + " " + " ".join(f"WHEN {i} THEN " + (f"epoch_us(date_trunc('{unit}', ts)) - {SHIFTED.get(i, 0)}000000" if unit else "NULL") for i, (_, unit) in enumerate(ISO_FORMS)) + " ELSE epoch_us(date_trunc('day', ts)) END AS us FROM events"
#: Phrases by n, with the seconds they lie back (as SQL of n); NULL: no age.
PHRASES = [
    ("just now", "30"), (" Moments ago ", "60"), ("TODAY", "3600"), ("yesterday", "129600"), ("# seconds ago", "n"), ("#min ago", "60 * n"), ("posted # hrs ago, updated 1 day ago", "3600 * n"), ("#d", "86400 * n"), ("# W", "604800 * n"), ("# weeks ago", "604800 * n"),
    ("# months ago", "2592000 * n"), ("# year ago", "31536000 * n"), ("an hour ago", "NULL"), ("#h ago", "NULL"), ("#m ago", "NULL"), ("in # days", "NULL"), ("", "NULL"),
]


def date_phrases(spark, sf_dir):
    """Every kind of relative phrase."""
    k, n = F.col("event_id") % len(PHRASES), (F.col("event_id") % 97).cast("string")
    said = F.lit(None).cast("string")
    for i, (phrase, _) in enumerate(PHRASES):
        said = F.when(k == i, F.replace(F.lit(phrase), F.lit("#"), n)).otherwise(said)
    return table(spark, sf_dir, "events").select("event_id", dates.seconds_ago(said).alias("seconds_ago"))


PHRASES_SQL = "SELECT event_id, CAST(CASE event_id % " + str(len(PHRASES)) + " " + " ".join(f"WHEN {i} THEN {said}" for i, (_, said) in enumerate(PHRASES)) + " END AS BIGINT) AS seconds_ago FROM (SELECT event_id, event_id % 97 AS n FROM events)"


def sink_files(spark, sf_dir):
    """All tabs written as files, the same again over them, and read back."""
    names = {"Startups": "startups", "Research Papers": "papers", "Jobs": "jobs", "News": "news"}
    tabs = {tab: typed(spark, sf_dir, name) for tab, name in names.items()} | {"Entity Mapping Log": table(spark, sf_dir, "entity_mapping_log")}
    base = f"{shared_dir(spark)}/millrace-tabs-{uuid.uuid4().hex}"
    sinks.write_all({"News": tabs["News"]}, base)
    paths = sinks.write_all(tabs, base)
    counts = [spark.read.parquet(path).agg(F.lit(tab).alias("tab"), F.count(F.lit(1)).alias("n")) for tab, path in paths.items()]
    return reduce(DataFrame.unionByName, counts)


def url_batch(spark, sf_dir):
    """A handler over all postings' addresses as fetched pages, some of them disallowed, some failing."""
    k = F.col("job_id") % 5
    jobs = table(spark, sf_dir, "jobs").select(F.concat_ws("#", "source.url", F.col("job_id").cast("string")).alias("url"), F.when(k == 0, -1).otherwise(200).alias("status"), F.when(k == 1, "").otherwise(F.col("content.title")).alias("html"))

    def handler(row):
        if not row["html"]:
            raise ValueError("empty page")
        return {"letters": len(row["html"])}

    return providers.run_url_batch(jobs, handler)


def paragraph_counts(spark, sf_dir):
    """E5"""
    return table(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", F.size(text.paragraphs(F.expr(PARAGRAPHS))).alias("n"))


def collected(spark, sf_dir):
    """How many records each run has collected so far, by the stamp that the run's start gave them."""
    rows = table(spark, sf_dir, "news").select(F.to_date("loaded_at").cast("string").alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    # one row a day: the window holds the calendar, not the data
    return rows.withColumn("so_far", F.sum("n").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)))


QUERIES = {
    "feed_requests": feed_requests, "repo_links": repo_links, "date_iso_forms": date_iso_forms, "date_phrases": date_phrases, "sink_files": sink_files, "url_batch": url_batch, "paragraph_counts": paragraph_counts, "collected": collected, "extraction_prompts": extraction_prompts, "retry_after": retry_after, "resolve_registered": resolve_registered,
    "freshness_structured": freshness_structured, "date_relative": date_relative, "date_normalize": date_normalize, "news_ingest": news_ingest, "news_state": news_state, "job_ingest": job_ingest,
    "ingest_stats": ingest_stats, "content_hash_dedup": content_hash_dedup, "text_projections": text_projections, "resolve_exact_alias_norm": resolve_exact_alias_norm, "resolve_fuzzy": resolve_fuzzy,
    "mapping_log": mapping_log_query, "unresolved_anti": unresolved_anti, "review_queue": review, "page_fields": page_fields, "page_title": page_title, "page_host": page_host, "url_quarantine": url_quarantine,
    "repo_stats_join": repo_stats_join, "atom_feed": atom_feed, "feed_newest": feed_newest, "listing_details": listing_details, "robots": robots, "token_estimate": token_estimate, "strip_boilerplate": strip_boilerplate,
    "chunk_fit": chunk_fit, "chunk_hard_slice": chunk_hard_slice, "chunk_packed": chunk_packed, "merge_extractions": merge_extractions, "merge_json": merge_json_values, "provider_fallback": provider_fallback,
    "extract_provenance": extract_provenance, "extraction_failures": extraction_failures, "backoff_ceiling": backoff_ceiling, "sink_startups": sink_startups, "sink_products": sink_products, "sink_papers": sink_papers,
    "sink_jobs": sink_jobs, "sink_news": sink_news, "sink_mapping_log": sink_mapping_log,
}

SQL = {
    "feed_requests": "SELECT s AS start, 100 AS max_results, 'https://feed.example/query?search_query=cat:cs.AI&start=' || s || '&max_results=100&sortBy=submittedDate&sortOrder=descending' AS url FROM (SELECT unnest(range(0, (SELECT count(*) FROM papers), 100)) AS s)",
    "repo_links": """SELECT DISTINCT content.paper_url AS paper_id, CASE WHEN length(content.paper_url) % 2 = 0 THEN '{"paper": "' || content.paper_url || '"}' END AS repositories FROM papers WHERE content.paper_url IS NOT NULL""",
    "retry_after": "SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN nullif(n_nationkey::DOUBLE, 0) WHEN 1 THEN n_nationkey + 0.5 END::DOUBLE AS seconds FROM nation",
    "resolve_registered": "SELECT s_suppkey AS seq, 'Unrelated Trading House' AS canonical_name, CASE WHEN s_suppkey % 2 = 0 THEN 1.0::DOUBLE ELSE 0.98::DOUBLE END AS confidence, CASE WHEN s_suppkey % 2 = 0 THEN 'exact' ELSE 'alias' END AS method FROM supplier",
    "freshness_structured": f"SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS ts_seconds FROM events WHERE date_trunc('second', ts) <= TIMESTAMP '{REFERENCE}' AND date_trunc('second', ts) >= TIMESTAMP '{REFERENCE}' - INTERVAL 24 HOUR",
    "date_relative": "SELECT event_id AS seq, CASE event_id % 4 WHEN 1 THEN (event_id % 60) * 3600 ELSE (event_id % 5) * 86400 END AS seconds_ago FROM events WHERE event_id % 4 IN (1, 2)",
    "date_normalize": CRAWL_SQL + "SELECT seq, strftime(pub, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS iso_timestamp, confidence, is_fresh AS is_fresh_24h FROM fresh",
    "news_ingest": CRAWL_SQL + f"SELECT seq, url, substring(split_part(full_text, chr(10), 1), 1, 200) AS headline, {ISO_SQL} AS published_date, confidence AS date_confidence, sha256(full_text) AS text_sha256 FROM judged WHERE verdict = 'kept'",
    "news_state": CRAWL_SQL.replace("), judged AS (", "), unused AS (", 1).rstrip() + """, alive AS (SELECT *, seq % 1000 < 500 AS first_run FROM fresh WHERE confidence = 'none' OR is_fresh),
      state AS (SELECT url, arg_max(content_hash, seq) AS content_hash FROM alive WHERE first_run GROUP BY url),
      second AS (SELECT a.seq, a.url, a.confidence, a.content_hash, coalesce(lag(a.content_hash) OVER (PARTITION BY a.url ORDER BY a.seq), s.content_hash) AS earlier FROM alive a LEFT JOIN state s ON s.url = a.url WHERE NOT first_run)
      SELECT seq, CASE WHEN confidence <> 'none' OR earlier IS NULL OR earlier <> content_hash THEN 'kept' ELSE 'duplicate' END AS verdict FROM second
      UNION ALL SELECT seq, 'stale' FROM fresh WHERE confidence <> 'none' AND NOT is_fresh AND seq % 1000 >= 500""",
    "job_ingest": CRAWL_SQL.rstrip() + f", {TIERS_SQL.strip()} SELECT seq, substring(split_part(text, chr(10), 1), 1, 120) AS raw_company, coalesce(e.c, a.c, x.c, substring(split_part(text, chr(10), 1), 1, 120)) AS company, {ISO_SQL} AS date, contains(lower(text), 'remote') AS is_remote, {ROLE_SQL} AS role_family FROM (SELECT *, full_text AS text, substring(split_part(full_text, chr(10), 1), 1, 120) AS said FROM fresh) LEFT JOIN exact e ON lower({strip_sql("said")}) = e.key LEFT JOIN by_alias a ON lower({strip_sql("said")}) = a.key LEFT JOIN norm x ON {norm_sql("said")} = x.key WHERE coalesce(is_fresh, false)",
    "ingest_stats": CRAWL_SQL + "SELECT event_type AS source_name, count(*) + 1 AS fetched, count(*) FILTER (verdict = 'kept') AS fresh_kept, count(*) FILTER (verdict = 'stale') AS stale_dropped, count(*) FILTER (verdict = 'duplicate') AS dedup_dropped, count(*) FILTER (confidence = 'none') AS no_date_signal FROM judged GROUP BY 1",
    "content_hash_dedup": "SELECT doc_id, content_hash FROM (SELECT doc_id, content_hash, lag(content_hash) OVER (PARTITION BY source ORDER BY doc_id) AS before FROM (SELECT doc_id, source, sha256(substring(text, 1, 2000)) AS content_hash FROM documents WHERE text IS NOT NULL)) WHERE before IS NULL OR before <> content_hash",
    "text_projections": f"SELECT doc_id, substring(split_part(text, chr(10), 1), 1, 200) AS headline, substring(split_part(text, chr(10), 1), 1, 120) AS raw_company, contains(lower(text), 'remote') AS is_remote, {ROLE_SQL} AS role_family FROM documents WHERE text IS NOT NULL",
    "resolve_exact_alias_norm": NAMES_SQL + "SELECT kind, id, raw_name, coalesce(c1, c2, c3) AS canonical_name, CASE WHEN c1 IS NOT NULL THEN 1.0::DOUBLE WHEN c2 IS NOT NULL THEN 0.98::DOUBLE ELSE 0.95::DOUBLE END AS confidence, CASE WHEN c1 IS NOT NULL THEN 'exact' ELSE 'alias' END AS method FROM tiers WHERE coalesce(c1, c2, c3) IS NOT NULL",
    "unresolved_anti": NAMES_SQL + "SELECT kind, id, raw_name FROM tiers WHERE coalesce(c1, c2, c3) IS NULL",
    "page_fields": HTML_SQL + "SELECT doc_id, length(regexp_replace(html, '<[^>]+>', '', 'g')) AS bare_length, try_cast(nullif(replace(regexp_extract(html, '(?i)([0-9,]+)\\s*stars?', 1), ',', ''), '') AS BIGINT) AS stars, 'https://github.com/o' || doc_id || '/r.x' AS repo_url, status = 403 OR length(html) < 200 OR " + " OR ".join(f"contains(lower(html), '{m}')" for m in text.BOT_WALL) + " AS bot_walled FROM pages",
    "page_title": HTML_SQL + f"SELECT doc_id, {strip_sql("translate(head, '<>' || chr(10), '()_') || ' x'")} AS title FROM pages",
    "page_host": "SELECT doc_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM documents",
    "url_quarantine": "SELECT coalesce(starts_with(source.url, 'http://') OR starts_with(source.url, 'https://'), false) AS valid, count(*) AS n FROM jobs GROUP BY 1",
    "repo_stats_join": "WITH p AS (SELECT capture_id, loaded_at, content.github_stars AS stars, content.github_url AS url FROM papers), s AS (SELECT url, max(struct_pack(l := loaded_at, c := capture_id, s := stars)).s AS github_stars FROM p WHERE url IS NOT NULL GROUP BY url) SELECT p.url AS github_url, s.github_stars, count(*) AS n FROM p LEFT JOIN s ON p.url = s.url GROUP BY 1, 2",
    "atom_feed": f"SELECT doc_id, 'http://x/' || doc_id AS paper_url, '2024-01-02T03:04:05Z' AS published, sha256({strip_sql("substring(text, 1, 40)")}) AS title_sha, length({strip_sql("text")}) AS summary_length, 'A ' || doc_id || '|B' AS authors FROM (SELECT doc_id, replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text FROM documents WHERE text IS NOT NULL AND NOT regexp_matches(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]'))",
    "feed_newest": "SELECT capture_id FROM papers ORDER BY collectedat DESC, capture_id LIMIT 100",
    "listing_details": "SELECT coalesce(source, 'none') AS listing_url, CAST(row_number() OVER (PARTITION BY coalesce(source, 'none') ORDER BY doc_id) - 1 AS INTEGER) AS pos, CAST(doc_id AS VARCHAR) AS url, length(text) AS page_length FROM documents",
    "robots": "SELECT doc_id, coalesce(NOT (length(host) % 2 = 0 AND starts_with(regexp_extract(d.url, '^https?://[^/]+(/.*)$', 1), '/doc/1')), true) AS allowed FROM documents d LEFT JOIN feed_sources f ON regexp_extract(d.url, '^https?://([^/]+)', 1) = f.host",
    "token_estimate": "SELECT doc_id, CAST(greatest(1, length(text) // 4) AS INTEGER) AS tokens FROM documents WHERE text IS NOT NULL",
    "strip_boilerplate": f"SELECT doc_id, sha256({strip_sql(f"regexp_replace(regexp_replace('Subscribe to our newsletter' || repeat(chr(10), 4) || replace(text, chr(10), repeat(chr(10), 3)) || chr(10) || '  Cookie note' || chr(10) || 'end', '(?im)^{WS_SQL}*({'|'.join(text.BANNER_WORDS)}).{{0,80}}$', '', 'g'), chr(10) || '{{3,}}', chr(10) || chr(10), 'g')")}) AS clean_sha256 FROM documents WHERE text IS NOT NULL",
    "chunk_fit": chunk_sql("text", 10_000) + CHUNKS_OUT,
    "chunk_packed": chunk_sql("replace(text, chr(10), chr(10) || chr(10))", 120, 20) + CHUNKS_OUT,
    "extraction_prompts": chunk_sql("text", 10_000) + """SELECT c.doc_id, c.index, sha256('SOURCE URL: ' || coalesce(d.url, '') || chr(10) || 'TARGET SCHEMA: {"title": "string"}' || chr(10) || chr(10) || 'TEXT:' || chr(10) || c.piece) AS prompt_sha256 FROM chunks c JOIN documents d ON d.doc_id = c.doc_id""",
    "date_iso_forms": ISO_FORMS_SQL,
    "date_phrases": PHRASES_SQL,
    "sink_files": " UNION ALL ".join(f"SELECT '{tab}' AS tab, count(*) AS n FROM {name}" for tab, name in (("Startups", "startups"), ("Research Papers", "papers"), ("Jobs", "jobs"), ("News", "news"), ("Entity Mapping Log", "entity_mapping_log"))),
    "url_batch": """SELECT concat_ws('#', source.url, job_id) AS url, CASE WHEN job_id % 5 <> 1 AND length(content.title) > 0 THEN '{"letters": ' || length(content.title) || '}' END AS result, CASE WHEN job_id % 5 = 1 OR coalesce(length(content.title), 0) = 0 THEN 'ValueError: empty page' END AS error FROM jobs WHERE job_id % 5 <> 0""",
    "paragraph_counts": f"SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(replace(text, chr(10), chr(10) || chr(10)), chr(10) || '{WS_SQL}*' || chr(10)), lambda q: regexp_matches(q, '[^{WS_SQL[1:]}'))) AS INTEGER) AS n FROM documents WHERE text IS NOT NULL",
    "collected": "SELECT CAST(CAST(loaded_at AS DATE) AS VARCHAR) AS day, count(*) AS n, CAST(sum(count(*)) OVER (ORDER BY CAST(loaded_at AS DATE)) AS BIGINT) AS so_far FROM news GROUP BY CAST(loaded_at AS DATE)",
    "chunk_hard_slice": chunk_sql("text", 50) + CHUNKS_OUT,
    "merge_extractions": """WITH r AS (SELECT l_orderkey AS doc_id, l_linenumber AS i, max(CASE WHEN l_linenumber % 3 = 0 THEN l_returnflag END) AS title, max(CASE WHEN l_quantity > 20 THEN l_partkey END) AS stars, max([l_returnflag, l_linestatus]) AS authors FROM lineitem GROUP BY ALL)
      SELECT doc_id, arg_min(title, i) FILTER (title IS NOT NULL AND title <> '') AS title, arg_min(stars, i) FILTER (stars IS NOT NULL) AS stars,
        array_to_string(CASE WHEN count(*) = 1 THEN any_value(authors) ELSE list_filter(flatten(list(authors ORDER BY i)), lambda x, k: list_position(flatten(list(authors ORDER BY i)), x) = k) END, '|') AS authors FROM r GROUP BY doc_id""",
    "merge_json": RESPONSES_SQL + "SELECT doc_id, 'v' AS field, CAST(min(chunk_idx) AS VARCHAR) AS value FROM good GROUP BY doc_id",
    "provider_fallback": RESPONSES_SQL + "SELECT doc_id, chunk_idx, 'p' || rank AS provider FROM good",
    "extract_provenance": RESPONSES_SQL + "SELECT doc_id, 'p' || arg_min(rank, chunk_idx) AS provider_used, count(*) AS chunks_used, bool_or(rank > 0) AS degraded FROM good GROUP BY doc_id",
    "extraction_failures": RESPONSES_SQL + "SELECT DISTINCT doc_id, chunk_idx FROM r EXCEPT SELECT doc_id, chunk_idx FROM good",
    "backoff_ceiling": "SELECT DISTINCT n_nationkey % 10 AS attempt, least(60.0, pow(2.0, n_nationkey % 10))::DOUBLE AS ceiling FROM nation",
    "sink_startups": "SELECT schemaversion AS schemaVersion, recordtype AS recordType, source.name AS source_name, source.url AS source_url, content.entityname AS content_entityName, content.data.employeecount AS content_data_employeeCount, collectedat AS collectedAt FROM startups",
    "sink_products": "SELECT '1.0' AS schemaVersion, 'PRODUCT' AS recordType, 'parts' AS source_name, 'https://parts.example/' || p_partkey AS source_url, p_brand AS content_startupName, p_name AS content_productName, CASE WHEN p_size % 2 = 0 THEN 'PAID' ELSE 'UNKNOWN' END AS content_pricingModel, '2024-01-30T12:00:00+00:00' AS collectedAt FROM part",
    "sink_papers": "SELECT schemaversion AS schemaVersion, recordtype AS recordType, source.name AS source_name, source.url AS source_url, content.title AS content_title, array_to_string(content.authors, '; ') AS content_authors, content.paper_url AS content_paper_url, content.github_url AS content_github_url, content.github_stars AS content_github_stars, content.published_date AS content_published_date, collectedat AS collectedAt FROM papers",
    "sink_jobs": "SELECT schemaversion AS schemaVersion, recordtype AS recordType, source.name AS source_name, source.url AS source_url, content.company AS content_company, content.rawcompany AS content_rawCompany, content.date AS content_date, content.is_remote AS content_is_remote, content.role_family AS content_role_family, collectedat AS collectedAt FROM jobs",
    "sink_news": "SELECT schemaversion AS schemaVersion, recordtype AS recordType, source.name AS source_name, source.url AS source_url, content.headline AS content_headline, content.published_date AS content_published_date, collectedat AS collectedAt FROM news",
    "sink_mapping_log": "SELECT raw_name, canonical_name, confidence, method, source_url FROM entity_mapping_log",
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
