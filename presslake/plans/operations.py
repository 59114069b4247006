"""More queries of the ingestion engine: lookups, state changes, guards, outcomes, messages, pages and text functions, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslake.functions import dates, html, text, urls
from presslake.operators import guards, merge
from presslake.plans.ingestion import SQL as LISTING_SQL
from presslake.plans.ingestion import _LAST, _LOWER, _NORM, _URL, _WS, us
from presslake.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    """Register a query with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_E = lambda c: f"coalesce({c}, '')"
blank = lambda c: F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def _sources(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "news").where("record_kind = 'source'")


def _messages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "news").where("record_kind = 'news'")


# Sources and their state.


@query("SELECT n.id, s.id AS source_id FROM news n LEFT JOIN (SELECT source_key, min(id) AS id FROM news WHERE record_kind = 'source' GROUP BY source_key HAVING count(*) = 1) s ON s.source_key = n.source_key WHERE n.record_kind = 'news'")
def message_sources(spark: SparkSession, d: str) -> DataFrame:
    """The source row of each message by its key; a key must name one row."""
    s = _sources(spark, d).groupBy("source_key").agg(F.min("id").alias("source_id"), F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")
    return _messages(spark, d).select("id", "source_key").join(s, "source_key", "left").select("id", "source_id")


@query("SELECT source_key, desired_state, row_number() OVER (ORDER BY coalesce(created_at, updated_at), source_key) AS pos FROM news WHERE record_kind = 'source' AND desired_state = 'running' AND starts_with(source_key, 'telegram:')")
def running_telegram_sources(spark: SparkSession, d: str) -> DataFrame:
    """Sources of a type and state, in order of creation (there are few)."""
    s = _sources(spark, d).where("desired_state = 'running'").where(F.col("source_key").startswith("telegram:"))
    return s.select("source_key", "desired_state", F.row_number().over(Window.orderBy(F.coalesce("created_at", "updated_at"), "source_key")).cast("bigint").alias("pos"))


@query("SELECT source_key, id, CASE WHEN starts_with(source_key, 'telegram:') THEN substr(source_key, 10) ELSE source_key END AS identifier, CASE WHEN starts_with(source_key, 'telegram:') THEN 'telegram' ELSE 'website' END AS type, CASE WHEN starts_with(source_key, 'telegram:') THEN substr(source_key, 10) ELSE source_key END AS display_name FROM news WHERE record_kind = 'source'")
def source_properties(spark: SparkSession, d: str) -> DataFrame:
    is_channel = F.col("source_key").startswith("telegram:")
    name = F.when(is_channel, F.substr("source_key", F.lit(10))).otherwise(F.col("source_key"))
    return _sources(spark, d).select("source_key", "id", name.alias("identifier"), F.when(is_channel, "telegram").otherwise("website").alias("type"), name.alias("display_name"))


@query("SELECT source_key, id, CASE WHEN last_message_id % 2 = 0 THEN 'paused' ELSE 'running' END AS desired_state FROM news WHERE record_kind = 'source' AND last_message_id % 3 > 0")
def changed_states(spark: SparkSession, d: str) -> DataFrame:
    """Sources after some were paused or resumed; a change of an unknown source gives nothing."""
    s = _sources(spark, d).select("source_key", "id", "desired_state", "last_message_id")
    changes = s.where("last_message_id % 3 > 0").select("source_key", F.when(F.col("last_message_id") % 2 == 0, "paused").otherwise("running").alias("desired_state"))
    changes = changes.unionByName(spark.createDataFrame([("telegram:unknown", "paused")], changes.schema))
    return merge.set_states(s, changes, "source_key", "desired_state").select("source_key", "id", "desired_state")


@query("SELECT DISTINCT source_name AS source_key, 'running' AS desired_state, 0 AS last_message_id FROM raw_ingest r WHERE NOT EXISTS (SELECT 1 FROM news s WHERE s.record_kind = 'source' AND s.source_key = r.source_name) UNION ALL SELECT source_key, desired_state, last_message_id FROM news WHERE record_kind = 'source'")
def ensured_sources(spark: SparkSession, d: str) -> DataFrame:
    """The sources, and those that payloads name and the table lacks."""
    s = _sources(spark, d).select("source_key", "desired_state", "last_message_id")
    new = table(spark, d, "raw_ingest").select(F.col("source_name").alias("source_key"), F.lit("running").alias("desired_state"), F.lit(0).alias("last_message_id")).distinct()
    return merge.insert_missing(s, new, ["source_key"]).unionByName(s)


@query("SELECT 'articles' AS what, (SELECT count(*) FROM articles) AS n, 0::BIGINT AS n_after UNION ALL SELECT 'news', (SELECT count(*) FROM news WHERE record_kind = 'news'), 0 UNION ALL SELECT 'sources', count(*), count(*) FROM news WHERE record_kind = 'source'")
def reset_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows before and after a reset of all content."""
    articles, records, before = merge.reset_content(table(spark, d, "articles").select("id"), table(spark, d, "news").select("record_kind", "last_message_id"), "record_kind", "last_message_id")
    after = articles.agg(F.count(F.lit(1)).alias("n_after")).select(F.lit("articles").alias("what"), "n_after").unionByName(records.groupBy(F.lit("sources").alias("what")).agg(F.count_if(F.col("last_message_id") == 0).alias("n_after")))
    return before.join(after, "what", "left").select("what", "n", F.coalesce("n_after", F.lit(0)).alias("n_after"))


@query("SELECT source_key, max(last) AS last_message_id, count(*) FILTER (last > 0) AS n_advanced FROM (SELECT source_key, last_message_id AS last FROM news WHERE record_kind = 'source' UNION ALL SELECT n.source_key, try_cast(n.source_item_id AS BIGINT) FROM news n WHERE n.record_kind = 'news' AND EXISTS (SELECT 1 FROM news s WHERE s.record_kind = 'source' AND s.source_key = n.source_key)) GROUP BY source_key")
def advanced_checkpoints(spark: SparkSession, d: str) -> DataFrame:
    """Checkpoints of sources after all messages were seen; they only grow."""
    s = _sources(spark, d).select("source_key", F.col("last_message_id").cast("bigint").alias("last"))
    m = _messages(spark, d).select("source_key", F.col("source_item_id").try_cast("bigint").alias("last")).join(s.select("source_key"), "source_key", "left_semi")
    return s.unionByName(m).groupBy("source_key").agg(F.max("last").alias("last_message_id"), F.count_if(F.col("last") > 0).alias("n_advanced"))


@query("SELECT source_key, EXISTS (SELECT 1 FROM news n WHERE n.record_kind = 'news' AND n.source_key = s.source_key) AS has_messages FROM news s WHERE record_kind = 'source'")
def sources_with_messages(spark: SparkSession, d: str) -> DataFrame:
    seen = _messages(spark, d).select("source_key", F.lit(True).alias("seen")).distinct()
    return _sources(spark, d).select("source_key").join(seen, "source_key", "left").select("source_key", F.coalesce("seen", F.lit(False)).alias("has_messages"))


@query(f"SELECT source_key, lower({_E('source_key')}) LIKE '%xeber%' AS matches, CASE WHEN starts_with(source_key, 'telegram:peer:') THEN substr(source_key, 10) ELSE '@' || substr(source_key, 10) END AS suggested FROM news WHERE record_kind = 'source'")
def directory_search(spark: SparkSession, d: str) -> DataFrame:
    """Channels whose name has a text in it, and how to name them."""
    name = F.substr("source_key", F.lit(10))
    return _sources(spark, d).select("source_key", text.contains_folded(F.col("source_key"), "xeber").alias("matches"), F.when(name.startswith("peer:"), name).otherwise(F.concat(F.lit("@"), name)).alias("suggested"))


# Messages.


@query(f"SELECT n.id, CASE WHEN r.k IS NULL THEN {_E('n.body_text')} ELSE r.body END AS body_text, r.k IS NOT NULL AS applied FROM news n LEFT JOIN (SELECT source_name AS k, source_item_id AS i, min(coalesce({_NORM('raw_text')}, '')) AS body FROM raw_ingest WHERE source_event_type = 'telegram_message' GROUP BY ALL) r ON r.k = n.source_key AND r.i = n.source_item_id WHERE n.record_kind = 'news'")
def applied_messages(spark: SparkSession, d: str) -> DataFrame:
    """Stored messages with the body of their payload, where there is one."""
    r = table(spark, d, "raw_ingest").where("source_event_type = 'telegram_message'").groupBy(F.col("source_name").alias("source_key"), "source_item_id").agg(F.min(text.normalize_whitespace(F.col("raw_text"))).alias("body_text"))
    n = _messages(spark, d).select("id", "source_key", "source_item_id", blank("body_text").alias("body_text"))
    return merge.apply_normalized(n, r, ["source_key", "source_item_id"], ["body_text"]).select("id", "body_text", "applied")


_URLS = f"list_concat(regexp_extract_all({_E(_NORM('raw_text'))}, '(?i)(https?://\\S+)', 1), list_filter(coalesce(image_urls, []), lambda x: x IS NOT NULL))"
_KEPT_FIRST = lambda l: f"list_filter(list_transform(range(1, len({l}) + 1), lambda i: CASE WHEN list_position({l}, {l}[i]) = i THEN {l}[i] END), lambda x: x IS NOT NULL)"


@query(
    "SELECT raw_id, message_id, text, array_to_string(" + _KEPT_FIRST("l") + ", ' ') AS urls, array_to_string(list_filter(" + _KEPT_FIRST("l") + ", lambda x: regexp_matches(split_part(lower(x), '?', 1), '\\.(jpg|jpeg|png|webp|gif|bmp)$')), ' ') AS image_urls, "
    "CASE WHEN coalesce(message_id, 0) <= 0 THEN '' WHEN starts_with(source_name, 'telegram:peer:') THEN 'https://t.me/c/' || regexp_replace(regexp_extract(source_name, 'peer:-?(\\d+)$', 1), '^100', '') || '/' || message_id ELSE 'https://t.me/' || substr(source_name, 10) || '/' || message_id END AS permalink "
    f"FROM (SELECT raw_id, source_name, try_cast(source_item_id AS BIGINT) AS message_id, {_E(_NORM('raw_text'))} AS text, {_URLS} AS l FROM raw_ingest WHERE source_event_type = 'telegram_message')"
)
def serialized_messages(spark: SparkSession, d: str) -> DataFrame:
    """Messages as they are handed on: text, addresses in the text and beside it, those of images, permalink."""
    r = table(spark, d, "raw_ingest").where("source_event_type = 'telegram_message'")
    t = text.normalize_whitespace(F.col("raw_text"))
    found = F.array_distinct(F.concat(urls.extract_urls(t), F.filter(F.coalesce("image_urls", F.array().cast("array<string>")), lambda x: x.isNotNull())))
    r = r.select("raw_id", "source_name", F.col("source_item_id").try_cast("bigint").alias("message_id"), t.alias("text"), found.alias("l"))
    return r.select("raw_id", "message_id", "text", F.array_join("l", " ").alias("urls"), F.array_join(F.filter("l", urls.looks_like_image), " ").alias("image_urls"), urls.message_url(F.substr("source_name", F.lit(10)), F.col("message_id")).alias("permalink"))


@query("SELECT source_key, id, item, row_number() OVER (PARTITION BY source_key, chunk ORDER BY item, id) AS pos, chunk FROM (SELECT source_key, id, coalesce(try_cast(source_item_id AS BIGINT), 0) AS item, coalesce(try_cast(source_item_id AS BIGINT), 0) // 100 AS chunk FROM news WHERE record_kind = 'news')")
def reversed_batches(spark: SparkSession, d: str) -> DataFrame:
    """Batches of a hundred ids, the oldest first, as they are stored."""
    m = _messages(spark, d).select("source_key", "id", F.coalesce(F.col("source_item_id").try_cast("bigint"), F.lit(0)).alias("item")).withColumn("chunk", F.floor(F.col("item") / 100))
    return m.select("source_key", "id", "item", F.row_number().over(Window.partitionBy("source_key", "chunk").orderBy("item", "id")).cast("bigint").alias("pos"), "chunk")


@query("SELECT source_key, chunk, max(item) AS checkpoint, min(item) AS next_offset, count(*) AS n FROM (SELECT source_key, coalesce(try_cast(source_item_id AS BIGINT), 0) AS item, coalesce(try_cast(source_item_id AS BIGINT), 0) // 100 AS chunk FROM news WHERE record_kind = 'news') GROUP BY source_key, chunk")
def batch_checkpoints(spark: SparkSession, d: str) -> DataFrame:
    """What each batch moves the checkpoint to, and where the next one begins."""
    m = _messages(spark, d).select("source_key", F.coalesce(F.col("source_item_id").try_cast("bigint"), F.lit(0)).alias("item"))
    return m.groupBy("source_key", F.floor(F.col("item") / 100).alias("chunk")).agg(F.max("item").alias("checkpoint"), F.min("item").alias("next_offset"), F.count(F.lit(1)).alias("n"))


# Candidates: unions, guards, limits.


@query("SELECT stream, source_name, url_key, count(*) AS n FROM (SELECT unnest(discovery_sources) AS stream, source_name, " + _URL("url") + " AS url_key FROM candidates) GROUP BY ALL")
def discovery_streams(spark: SparkSession, d: str) -> DataFrame:
    """The streams that candidates come from, stacked, and how often each brings an address."""
    c = table(spark, d, "candidates").select("discovery_sources", "source_name", urls.normalize_url(F.col("url")).alias("url_key"))
    return c.select(F.explode("discovery_sources").alias("stream"), "source_name", "url_key").groupBy("stream", "source_name", "url_key").agg(F.count(F.lit(1)).alias("n"))


_HOST = lambda u: f"lower(regexp_extract(trim({u}), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
_PATH = lambda u: f"rtrim(regexp_extract(trim({u}), '^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)', 1), '/')"


@query(
    "SELECT seq, concat_ws(',', " + ", ".join(f"CASE WHEN NOT coalesce({t}, false) THEN '{n}' END" for n, t in (
        ("host", f"{_HOST('url')} IN (source_name, 'www.' || source_name) AND {_PATH('url')} <> '' AND {_PATH('url')} <> '/ru' AND NOT starts_with({_PATH('url')}, '/ru/') AND {_PATH('url')} <> '/en' AND NOT starts_with({_PATH('url')}, '/en/')"),
        ("slug", "NOT regexp_matches(slug, '^[0-9]')"), ("date", "NOT starts_with(coalesce(list_date_text, ''), '30.11.-0001')"),
        ("stream", "list_has_any(discovery_sources, ['rss', 'sitemap', 'latest'])"), ("category", "lower(trim(regexp_replace(coalesce(category, ''), '\\s+', ' ', 'g'))) <> 'religion'"), ("title", "coalesce(title, '') <> ''"), ("id", "source_article_id IS NOT NULL"),
    )) + ") AS reasons FROM candidates"
)
def guarded_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Why a candidate is left out: host and language, slug, corrupt date, stream, category, missing fields; '' where it is valid."""
    c = table(spark, d, "candidates")
    why = guards.reasons(
        host=guards.at_host(F.col("url"), F.col("source_name"), ["/ru", "/en"]), slug=guards.no_leading_digit(F.col("slug")), date=guards.no_corrupt_date(F.col("list_date_text")),
        stream=F.arrays_overlap("discovery_sources", F.array(F.lit("rss"), F.lit("sitemap"), F.lit("latest"))), category=~guards.in_categories(F.array(blank("category")), ["religion"]), title=blank("title") != "", id=F.col("source_article_id").isNotNull(),
    )
    return c.select("seq", F.array_join(why, ",").alias("reasons"))


@query("SELECT source_name, seq FROM (SELECT source_name, seq, row_number() OVER (PARTITION BY source_name ORDER BY seq) AS k FROM candidates WHERE coalesce(title, '') <> '' AND source_article_id IS NOT NULL) WHERE k <= 20")
def first_valid_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The first twenty valid candidates of each source: the limit counts what passed the filter."""
    c = table(spark, d, "candidates").select("source_name", "seq", "title", "source_article_id").where((blank("title") != "") & F.col("source_article_id").isNotNull())
    return c.withColumn("k", F.row_number().over(Window.partitionBy("source_name").orderBy("seq"))).where("k <= 20").select("source_name", "seq")


@query("SELECT source_name, seq FROM (SELECT source_name, seq, title, source_article_id, row_number() OVER (PARTITION BY source_name ORDER BY seq) AS k FROM candidates) WHERE k <= 20 AND coalesce(title, '') <> '' AND source_article_id IS NOT NULL")
def valid_of_first_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The valid ones of the first twenty candidates: the limit comes before the filter."""
    c = table(spark, d, "candidates").select("source_name", "seq", "title", "source_article_id")
    first = c.withColumn("k", F.row_number().over(Window.partitionBy("source_name").orderBy("seq"))).where("k <= 20")
    return first.where((blank("title") != "") & F.col("source_article_id").isNotNull()).select("source_name", "seq")


@query("SELECT c.seq, coalesce(nullif(a.title, ''), nullif(c.title, ''), '') AS title, coalesce(nullif(a.category, ''), nullif(c.category, ''), '') AS category, coalesce(nullif(a.image_url, ''), nullif(c.list_image_url, ''), '') AS image_url FROM candidates c LEFT JOIN (SELECT source_name, source_article_id, arg_max(coalesce(title, ''), id) AS title, arg_max(coalesce(category, ''), id) AS category, arg_max(coalesce(image_url, ''), id) AS image_url FROM articles GROUP BY ALL) a ON a.source_name = c.source_name AND a.source_article_id = c.source_article_id")
def article_fallbacks(spark: SparkSession, d: str) -> DataFrame:
    """Fields of the article, those of the candidate where they are missing, '' where both are."""
    fields = ["title", "category", "image_url"]
    a = merge.merge_versions(table(spark, d, "articles").select("source_name", "source_article_id", "id", *[blank(f).alias(f) for f in fields]), ["source_name", "source_article_id"], ["id"], [], fields)
    c = table(spark, d, "candidates").select("seq", "source_name", "source_article_id", F.col("title").alias("c_title"), F.col("category").alias("c_category"), F.col("list_image_url").alias("c_image_url"))
    x = c.join(a, ["source_name", "source_article_id"], "left")
    return x.select("seq", *[F.coalesce(F.nullif(F.col(f), F.lit("")), F.nullif(F.col(f"c_{f}"), F.lit("")), F.lit("")).alias(f) for f in fields])


# Outcomes of runs.

_STATUS = "CASE parse_status WHEN 'failed' THEN 500 WHEN 'pending' THEN CASE WHEN raw_id % 2 = 0 THEN 404 ELSE 200 END ELSE 200 END"
_KIND = f"CASE WHEN {_STATUS} IN (404, 410) THEN 'skipped' WHEN coalesce(parser_error, '') <> '' OR {_STATUS} >= 400 THEN 'error' ELSE 'ok' END"


def _outcomes(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("parse_status") == "failed", 500).when((F.col("parse_status") == "pending") & (F.col("raw_id") % 2 == 0), 404).otherwise(200)
    r = table(spark, d, "raw_ingest").select("raw_id", "source_name", "source_item_id", "origin_url", "parser_error", status.alias("status"))
    return r.withColumn("kind", guards.outcome(F.col("status"), F.col("parser_error"))).withColumn("action", F.when(F.col("raw_id") % 3 == 0, "updated").otherwise("inserted"))


@query(f"SELECT raw_id, {_KIND} AS kind, CASE WHEN {_KIND} = 'error' THEN coalesce(source_item_id, origin_url, '') || ': ' || coalesce(parser_error, '') ELSE '' END AS label, {_STATUS} IN (404, 410) OR regexp_matches(lower(coalesce(parser_error, '')), 'invalid canonical url|missing content container|missing milli article id|missing axar article id|missing title') AS ignorable FROM raw_ingest")
def fetch_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """What became of each fetch; pages that are gone are skipped in silence, other failures are labelled."""
    o = _outcomes(spark, d)
    label = F.when(F.col("kind") == "error", guards.error_label(F.col("source_item_id"), F.col("origin_url"), F.col("parser_error"))).otherwise("")
    return o.select("raw_id", "kind", label.alias("label"), guards.ignorable(F.col("status"), F.col("parser_error")).alias("ignorable"))


@query(f"SELECT source_name, count(*) AS n_listing, count(*) FILTER (kind = 'ok' AND raw_id % 3 > 0) AS n_new, count(*) FILTER (kind = 'ok' AND raw_id % 3 = 0) AS n_updated, count(*) FILTER (kind = 'skipped') AS n_skipped, count(*) FILTER (kind = 'error') AS n_errors FROM (SELECT source_name, raw_id, {_KIND} AS kind FROM raw_ingest) GROUP BY source_name")
def run_counters(spark: SparkSession, d: str) -> DataFrame:
    return guards.counters(_outcomes(spark, d), ["source_name"], "kind", "action")


@query(f"SELECT 'sync_complete source=' || source_name || ' listing=' || n || ' errors=' || e AS line FROM (SELECT source_name, count(*) AS n, count(*) FILTER ({_KIND} = 'error') AS e FROM raw_ingest GROUP BY source_name)")
def metric_lines(spark: SparkSession, d: str) -> DataFrame:
    """A line of metrics for each source."""
    c = guards.counters(_outcomes(spark, d), ["source_name"], "kind", "action")
    return c.select(F.format_string("sync_complete source=%s listing=%d errors=%d", "source_name", "n_listing", "n_errors").alias("line"))


@query("SELECT c.seq, a.id IS NOT NULL AS found, c.source_article_id IS NULL OR coalesce(c.source_article_id = a.source_article_id, false) AS accepted FROM candidates c LEFT JOIN (SELECT source_name, " + _LAST("article_url") + " AS address, min(id) AS id, arg_min(source_article_id, id) AS source_article_id FROM articles GROUP BY ALL) a ON a.source_name = c.source_name AND a.address = " + _LAST("c.url"))
def accepted_probes(spark: SparkSession, d: str) -> DataFrame:
    """Whether the article at a candidate's address is the one that was asked for."""
    a = table(spark, d, "articles").groupBy("source_name", urls.last_segment(F.col("article_url")).alias("address")).agg(F.min("id").alias("id"), F.min_by("source_article_id", "id").alias("found_id"))
    c = table(spark, d, "candidates").select("seq", "source_name", "source_article_id", urls.last_segment(F.col("url")).alias("address"))
    return c.join(a, ["source_name", "address"], "left").select("seq", F.col("id").isNotNull().alias("found"), guards.accepted_probe(F.col("source_article_id"), F.col("found_id")).alias("accepted"))


@query(f"SELECT r.raw_id, {_URL('r.origin_url')} = {_URL('a.article_url')} AS same_page FROM raw_ingest r JOIN (SELECT source_name, source_article_id::VARCHAR AS item, arg_min(article_url, id) AS article_url FROM articles WHERE source_article_id IS NOT NULL GROUP BY ALL) a ON a.source_name = r.source_name AND a.item = r.source_item_id")
def redirected_pages(spark: SparkSession, d: str) -> DataFrame:
    """Whether a page was stored under the address it was fetched from."""
    a = table(spark, d, "articles").where("source_article_id is not null").groupBy("source_name", F.col("source_article_id").cast("string").alias("source_item_id")).agg(F.min_by("article_url", "id").alias("article_url"))
    r = table(spark, d, "raw_ingest").select("raw_id", "source_name", "source_item_id", "origin_url")
    return r.join(a, ["source_name", "source_item_id"]).select("raw_id", guards.not_redirected(F.col("origin_url"), F.col("article_url")).alias("same_page"))


# Pages.


@query("SELECT raw_id, regexp_extract(raw_html, '(?is)<meta\\s[^>]*property=\"og:title\"[^>]*?content=\"([^\"]*)\"', 1) AS og_title, trim(regexp_replace(regexp_extract(raw_html, '(?is)<div class=\"date\">(.*?)</div>', 1), '\\s+', ' ', 'g')) AS date_text, len(regexp_extract_all(raw_html, '(?i)<a[\\s>]')) AS n_links, len(regexp_extract_all(raw_html, '(?i)<(?:p|br)[\\s/>]')) AS n_breaks, NOT contains(regexp_extract(raw_html, '(?is)<title>(.*?)</title>', 1), '404') AND regexp_extract(raw_html, '(?is)<title>(.*?)</title>', 1) <> '' AS no_error FROM raw_ingest WHERE coalesce(raw_html, '') <> ''")
def page_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Single fields and counts of nodes of each page, and whether it is no error page."""
    h = F.col("raw_html")
    r = table(spark, d, "raw_ingest").where("raw_html <> ''")
    title = F.regexp_extract(h, r"(?is)<title>(.*?)</title>", 1)
    count = lambda p: F.size(F.regexp_extract_all(h, F.lit(p), F.lit(0))).cast("bigint")
    return r.select("raw_id", F.regexp_extract(h, r'(?is)<meta\s[^>]*property="og:title"[^>]*?content="([^"]*)"', 1).alias("og_title"), html.element_by_class(h, "div", "date").alias("date_text"), count(r"(?i)<a[\s>]").alias("n_links"), count(r"(?i)<(?:p|br)[\s/>]").alias("n_breaks"), (guards.no_error_page(title, ["404"]) & (title != "")).alias("no_error"))


_CARDS = "'(?is)<div class=\"item\">\\s*<a href=\"([^\"]*)\">(.*?)</a>'"
_FLAT = lambda x: f"trim(regexp_replace(regexp_replace({x}, '<[^>]*>', '', 'g'), '\\s+', ' ', 'g'))"


@query(f"SELECT raw_id, pos, 'https://' || source_name || href AS url, {_FLAT('label')} AS title FROM (SELECT raw_id, source_name, unnest(range(1, len(regexp_extract_all(raw_html, {_CARDS}, 1)) + 1)) AS pos, unnest(regexp_extract_all(raw_html, {_CARDS}, 1)) AS href, unnest(regexp_extract_all(raw_html, {_CARDS}, 2)) AS label FROM raw_ingest WHERE coalesce(raw_html, '') <> '') WHERE NOT regexp_matches(label, '&|\\x{{a0}}') AND starts_with(href, '/')")
def listing_cards(spark: SparkSession, d: str) -> DataFrame:
    """Cards of other stories on each page as candidates; those with character references are left to ``parsed_pages``."""
    r = table(spark, d, "raw_ingest").where("raw_html <> ''")
    cards = html.listing_cards(F.col("raw_html"), r'(?is)<div class="item">\s*<a href="([^"]*)">(.*?)</a>')
    x = r.select("raw_id", "source_name", F.posexplode(cards).alias("p", "c")).where(~F.col("c.label").rlike("&|\\u00a0") & F.col("c.href").startswith("/"))
    return x.select("raw_id", (F.col("p") + 1).cast("bigint").alias("pos"), urls.make_absolute_url(F.concat(F.lit("https://"), "source_name", F.lit("/")), F.col("c.href")).alias("url"), F.trim(F.regexp_replace(F.regexp_replace("c.label", "<[^>]*>", ""), r"\s+", " ")).alias("title"))


# JSON: documents are made of the articles' fields and read again.


def _json_ld(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "articles").select("id", *[blank(c).alias(c) for c in ("title", "published_at", "category", "source_name")])
    news = F.struct(F.lit("NewsArticle").alias("@type"), F.col("title").alias("headline"), F.col("published_at").alias("datePublished"))
    site = F.struct(F.lit("WebSite").alias("@type"), F.col("source_name").alias("name"))
    crumbs = F.struct(F.lit("BreadcrumbList").alias("@type"), F.array(*[F.struct(F.lit(i).alias("position"), n.alias("name")) for i, n in ((1, F.col("source_name")), (2, F.col("category")), (3, F.col("title")))]).alias("itemListElement"))
    nested = lambda j: F.concat(F.lit('{"a":{"b":[{"c":{"x":[1,{"y":{"z":{"deep":['), j, F.lit("]}}}]}}]}}"))
    listed = F.concat(F.lit("["), F.to_json(site), F.lit(","), F.to_json(news), F.lit("]"))
    return a.select("id", listed.alias("flat"), F.concat(F.lit('{"@graph":'), listed, F.lit("}")).alias("graph"), nested(F.to_json(news)).alias("deep"), F.to_json(news).alias("single"), F.to_json(crumbs).alias("crumbs"))


@query(f"SELECT id, {_E('title')} AS flat, {_E('title')} AS graph, {_E('title')} AS deep, {_E('published_at')} AS published, {_E('source_name')} AS first_crumb, {_E('category')} AS second_to_last FROM articles")
def json_ld_fields(spark: SparkSession, d: str) -> DataFrame:
    """The news article of a page's JSON-LD, wherever it stands, and the breadcrumb of the category."""
    j = _json_ld(spark, d)
    names = html.breadcrumbs(F.col("crumbs"))
    field = lambda c, f: F.coalesce(F.get_json_object(c, f"$.{f}"), F.lit(""))
    return j.select(
        "id", field(html.article_of(F.col("flat")), "headline").alias("flat"), field(html.article_of(F.col("graph")), "headline").alias("graph"), field(html.nested_of_type(F.col("deep"), "newsarticle"), "headline").alias("deep"),
        html.json_ld_field(F.col("single"), "datePublished").alias("published"), F.coalesce(F.try_element_at(names, F.lit(1)), F.lit("")).alias("first_crumb"), F.coalesce(F.try_element_at(names, F.lit(-2)), F.lit("")).alias("second_to_last"),
    )


@query("SELECT raw_id, regexp_extract(raw_html, '[''\"]id[''\"]\\s*:\\s*(\\d+)', 1) AS script_id, regexp_extract(raw_html, '[''\"]t[''\"]\\s*:\\s*[''\"]([^''\"]*)[''\"]', 1) AS script_text FROM raw_ingest WHERE coalesce(raw_html, '') <> ''")
def script_values(spark: SparkSession, d: str) -> DataFrame:
    """Values that a page's scripts hold."""
    h = F.col("raw_html")
    return table(spark, d, "raw_ingest").where("raw_html <> ''").select("raw_id", html.js_number(h, "id").alias("script_id"), html.js_scalar(h, "t").alias("script_text"))


# Texts.


@query(
    f"SELECT id, CASE WHEN contains(raw, 'Tarix:') THEN trim(regexp_replace(substr(raw, position('Tarix:' IN raw) + 6), '{_WS}', ' ', 'g')) ELSE trim(regexp_replace(raw, '{_WS}', ' ', 'g')) END AS date_raw, "
    f"trim(replace({_NORM('content')}, 'davamı', ''), ' .') AS teaser, array_to_string(list_slice(str_split({_NORM("split_part(content, chr(10), 1)")}, ' '), 1, 18), ' ') AS first_words, contains(lower(content), 'manat') AS has_word, "
    f"translate(coalesce(source_name, ''), '/:', '__') AS file_name, sha256(coalesce(title, '') || chr(10) || content) AS message_hash, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS uuid, try_cast(trim(published_at) AS BIGINT) AS as_number, {_E(_NORM('title'))} AS title "
    "FROM (SELECT *, coalesce(published_at, '') AS raw, coalesce(content_text, '') AS content, sha256(concat_ws('|', source_name, id::VARCHAR)) AS h FROM articles)".replace("try_cast(trim(published_at) AS BIGINT)", "CASE WHEN regexp_matches(trim(published_at), '^[+-]?[0-9]+$') THEN try_cast(trim(published_at) AS BIGINT) END")
)
def text_fields(spark: SparkSession, d: str) -> DataFrame:
    """Small text functions over the articles."""
    c = blank("content_text")
    return table(spark, d, "articles").select(
        "id", text.published_date_raw(blank("published_at")).alias("date_raw"), text.clean_teaser(c).alias("teaser"), text.title_from_content(c).alias("first_words"), text.contains_folded(c, "manat").alias("has_word"),
        text.safe_name(blank("source_name")).alias("file_name"), text.message_hash(F.col("title"), c).alias("message_hash"), text.record_uuid(F.col("source_name"), F.col("id").cast("string")).alias("uuid"), text.safe_int(F.col("published_at")).alias("as_number"), text.first_non_empty(F.col("title")).alias("title"),
    )


@query(f"SELECT seq, coalesce(list_filter(l, lambda x: {_LOWER('x')} NOT IN ('uncategorized', 'religion'))[1], CASE WHEN len(list_filter(l, lambda x: {_LOWER('x')} = 'xəbərlər')) > 0 THEN 'Xəbərlər' END, list_filter(l, lambda x: {_LOWER('x')} <> 'home')[1], '') AS category FROM (SELECT seq, list_filter(CASE WHEN {_E(_NORM('category'))} = {_E('slug')} THEN [{_E(_NORM('category'))}] ELSE [{_E(_NORM('category'))}, {_E(_NORM('slug'))}] END, lambda x: x <> '') AS l FROM candidates)")
def primary_categories(spark: SparkSession, d: str) -> DataFrame:
    """The category of a candidate, its slug where that is noise."""
    return table(spark, d, "candidates").select("seq", text.primary_category(F.array("category"), ["uncategorized", "religion"], F.col("slug"), "Xəbərlər", ["home"]).alias("category"))


@query(f"SELECT id, source_key, CASE WHEN starts_with(source_key, 'telegram:') THEN 'telegram:' || lower(substr(source_key, 10)) END AS from_name, CASE WHEN regexp_matches(substr(source_key, 10), '^peer:') THEN 'telegram:' || substr(source_key, 10) ELSE 'telegram:' || lower(substr(source_key, 10)) END AS from_address FROM news WHERE record_kind = 'source'")
def source_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys of channels from their names and from their addresses."""
    name = F.substr("source_key", F.lit(10))
    address = F.when(name.startswith("peer:"), F.substr(name, F.lit(6))).otherwise(F.concat(F.lit("https://t.me/"), name, F.lit("/")))
    return _sources(spark, d).select("id", "source_key", urls.source_key(name).alias("from_name"), urls.source_key(address).alias("from_address"))


# Times: each parser over the texts as landed.

_X = _NORM("published_at")
_P = lambda p, k: f"regexp_extract({_X}, '{p}', {k})"
_DATE = lambda p, y, m, k: f"try_cast({_P(p, y)} || '-' || lpad({_P(p, m)}, 2, '0') || '-' || lpad({_P(p, k)}, 2, '0') AS DATE)::VARCHAR"
_CLOCK = lambda p, h: f"CASE WHEN try_cast({_P(p, h)} AS INT) <= 23 AND try_cast({_P(p, h + 1)} AS INT) <= 59 AND try_cast(coalesce(nullif({_P(p, h + 2)}, ''), '00') AS INT) <= 59 THEN lpad({_P(p, h)}, 2, '0') || ':' || {_P(p, h + 1)} || ':' || coalesce(nullif({_P(p, h + 2)}, ''), '00') END"
_AT = lambda p, y, m, k, h: f"CASE WHEN regexp_matches({_X}, '{p}') THEN {_DATE(p, y, m, k)} || 'T' || {_CLOCK(p, h)} || '+04:00' END"
_YMD, _AXAR, _XEB, _DMY, _ISO = r"^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$", r"^(\d{4})\.(\d{2})\.(\d{2}) / (\d{2}):(\d{2})()$", r"^(\d{2})-(\d{2})-(\d{4}) / (\d{2}):(\d{2})()$", r"^(\d{2})-(\d{2})-(\d{4})$", r"^(\d{4})-(\d{2})-(\d{2})[T ](\d{2}):(\d{2})(?::(\d{2})(?:\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?$"
_PLUS, _RFC, _JS = r"^(\d{4})-(\d{2})-(\d{2})\+(\d{2}):(\d{2}):(\d{2})([+-]\d{2})(\d{2})$", r"(\d{1,2}) ([A-Za-z]{3})[a-z]* (\d{4}) (\d{2}):(\d{2})(?::(\d{2}))? (?:([+-]\d{2}):?(\d{2})|GMT|UTC|Z)", r"^[A-Za-z]{3} ([A-Za-z]{3}) (\d{2}) (\d{4}) (\d{2}):(\d{2}):(\d{2}) GMT([+-]\d{2})(\d{2})"
_AMPM, _DOT = r"(?i)(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{2}):(\d{2})\s*(AM|PM)", r"^(\d{2})\.(\d{2})\.(\d{4})$"
_MON = lambda p, k: "MAP {" + ", ".join(f"'{n}': '{i:02d}'" for i, n in enumerate(dates.EN_MONTHS, 1)) + f"}}[lower({_P(p, k)})]"
_HALF = f"CASE WHEN try_cast({_P(_AMPM, 4)} AS INT) BETWEEN 1 AND 12 THEN try_cast({_P(_AMPM, 4)} AS INT) % 12 + CASE WHEN upper({_P(_AMPM, 7)}) = 'PM' THEN 12 ELSE 0 END END"


@query(
    f"SELECT seq, coalesce({_AT(_YMD, 1, 2, 3, 4)}, {_E(_X)}) AS azertag, coalesce({_AT(_AXAR, 1, 2, 3, 4)}, {_E(_X)}) AS axar, "
    f"coalesce({_AT(_XEB, 3, 2, 1, 4)}, {_DATE(_DMY, 3, 2, 1)}, CASE WHEN regexp_matches({_X}, '{_PLUS}') THEN {_DATE(_PLUS, 1, 2, 3)} || 'T' || {_CLOCK(_PLUS, 4)} || {_P(_PLUS, 7)} || ':' || {_P(_PLUS, 8)} END, '') AS xeberler, "
    f"coalesce(CASE WHEN regexp_matches({_X}, '{_ISO}') THEN {_DATE(_ISO, 1, 2, 3)} || 'T' || {_CLOCK(_ISO, 4)} || CASE {_P(_ISO, 7)} WHEN '' THEN '+04:00' WHEN 'Z' THEN '+00:00' ELSE left({_P(_ISO, 7)}, 3) || ':' || right({_P(_ISO, 7)}, 2) END END, '') AS iso, "
    f"coalesce({_DATE(_DOT, 3, 2, 1)}, {_DATE('^([0-9]{4})-([0-9]{2})-([0-9]{2})$', 1, 2, 3)}, '') AS day, "
    f"coalesce(CASE WHEN regexp_matches({_X}, '{_RFC}') THEN try_cast({_P(_RFC, 3)} || '-' || {_MON(_RFC, 2)} || '-' || lpad({_P(_RFC, 1)}, 2, '0') AS DATE)::VARCHAR || 'T' || {_CLOCK(_RFC, 4)} || CASE {_P(_RFC, 7)} WHEN '' THEN '+00:00' ELSE {_P(_RFC, 7)} || ':' || {_P(_RFC, 8)} END END, '') AS mail, "
    f"coalesce(CASE WHEN regexp_matches({_X}, '{_JS}') THEN try_cast({_P(_JS, 3)} || '-' || {_MON(_JS, 1)} || '-' || {_P(_JS, 2)} AS DATE)::VARCHAR || 'T' || {_CLOCK(_JS, 4)} || {_P(_JS, 7)} || ':' || {_P(_JS, 8)} END, '') AS script, "
    f"coalesce(CASE WHEN regexp_matches({_X}, '{_AMPM}') THEN {_DATE(_AMPM, 3, 1, 2)} || 'T' || lpad(({_HALF})::VARCHAR, 2, '0') || ':' || {_P(_AMPM, 5)} || ':' || {_P(_AMPM, 6)} || '+04:00' END, '') AS half_days FROM candidates"
)
def published_forms(spark: SparkSession, d: str) -> DataFrame:
    """Every parser of times over the candidates' texts."""
    p = F.col("published_at")
    return table(spark, d, "candidates").select(
        "seq", dates.azertag_datetime(p).alias("azertag"), dates.axar_datetime(p).alias("axar"), dates.xeberler_datetime(p).alias("xeberler"), dates.iso_with_offset(p).alias("iso"), dates.iso_or_dotted_date(p).alias("day"),
        dates.rfc2822(p).alias("mail"), dates.js_datetime(p).alias("script"), dates.islamazeri_datetime(text.normalize_whitespace(p)).alias("half_days"),
    )


# Migrations.


@query("SELECT n.id, n.source_key, s.id AS source_id, coalesce(n.published_at, '') AS published_at, coalesce(s.last_message_id, 0) AS last_message_id FROM news n JOIN news s ON s.record_kind = 'source' AND s.source_key = n.source_key WHERE n.record_kind = 'news'")
def joined_split_layout(spark: SparkSession, d: str) -> DataFrame:
    """Messages of the split layout with the state of their source."""
    s = _sources(spark, d).select("source_key", F.col("id").alias("source_id"), "last_message_id")
    return _messages(spark, d).join(s.withColumnRenamed("last_message_id", "m"), "source_key").select("id", "source_key", "source_id", blank("published_at").alias("published_at"), F.coalesce("m", F.lit(0)).alias("last_message_id"))


@query("SELECT r.raw_id, s.desired_state, coalesce(n.n, 0) AS n_stored, coalesce(n.first_us, epoch_us(r.observed_at)) AS first_us FROM raw_ingest r JOIN news s ON s.record_kind = 'source' AND s.source_key = r.source_name LEFT JOIN (SELECT source_key, source_item_id, count(*) AS n, min(epoch_us(created_at)) AS first_us FROM news WHERE record_kind = 'news' GROUP BY ALL) n ON n.source_key = r.source_name AND n.source_item_id = r.source_item_id")
def legacy_chain(spark: SparkSession, d: str) -> DataFrame:
    """Raw records, their source, and what was stored of them: an inner and a left join in a chain."""
    s = _sources(spark, d).select(F.col("source_key").alias("source_name"), "desired_state")
    n = _messages(spark, d).groupBy(F.col("source_key").alias("source_name"), "source_item_id").agg(F.count(F.lit(1)).alias("n"), F.min(us(F.col("created_at"))).alias("first_us"))
    r = table(spark, d, "raw_ingest").select("raw_id", "source_name", "source_item_id", "observed_at").join(s, "source_name").join(n, ["source_name", "source_item_id"], "left")
    return r.select("raw_id", "desired_state", F.coalesce("n", F.lit(0)).alias("n_stored"), F.coalesce("first_us", us(F.col("observed_at"))).alias("first_us"))


@query("SELECT t.what, t.n AS n_from, t.n AS n_to, true AS same FROM (SELECT 'articles' AS what, count(*) AS n FROM articles UNION ALL SELECT 'news', count(*) FROM news) t")
def copied_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each table and of its unified copy."""
    from presslake.plans.ingestion import unified_records

    count = lambda df, name: df.groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")
    old = count(table(spark, d, "articles"), "articles").unionByName(count(table(spark, d, "news"), "news"))
    new = unified_records(spark, d).groupBy(F.when(F.col("kind") == "article", "articles").otherwise("news").alias("what")).agg(F.count(F.lit(1)).alias("n_to"))
    return old.join(new, "what", "left").select("what", F.col("n").alias("n_from"), "n_to", F.col("n").eqNullSafe(F.col("n_to")).alias("same"))


@query("SELECT column_name FROM (VALUES ('body_text'), ('created_at'), ('fetched_at'), ('id'), ('last_message_id'), ('published_at'), ('record_kind'), ('source_key'), ('source_item_id'), ('updated_at')) t(column_name)")
def kept_columns(spark: SparkSession, d: str) -> DataFrame:
    """Columns of the records after the obsolete ones were dropped."""
    kept = table(spark, d, "news").drop("origin_url", "desired_state", "no_such_column").columns
    return spark.createDataFrame([(c,) for c in sorted(kept)], "column_name string")


# Addresses, sitemaps, id windows and whole records.


@query("SELECT id, CASE WHEN coalesce(trim(article_url), '') = '' THEN '' WHEN regexp_matches(trim(article_url), '^[A-Za-z][A-Za-z0-9+.-]*:') THEN trim(article_url) WHEN starts_with(trim(article_url), '/') THEN 'https://portal.example' || trim(article_url) ELSE 'https://portal.example/az/' || trim(article_url) END AS url, CASE WHEN lower(regexp_extract(trim(article_url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) IN ('gundemxett.example', 'xezersoz.example') THEN regexp_replace(trim(article_url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', 'https://az.example') ELSE trim(article_url) END AS one_host FROM articles")
def absolute_urls(spark: SparkSession, d: str) -> DataFrame:
    """Addresses as seen from a page, and with several hosts as one."""
    u = F.col("article_url")
    return table(spark, d, "articles").select("id", urls.make_absolute_url(F.lit("https://portal.example/az/index"), u).alias("url"), urls.unify_host(u, ["gundemxett.example", "xezersoz.example"], "https://az.example").alias("one_host"))


@query("SELECT source_name, page, row_number() OVER (PARTITION BY source_name, page ORDER BY seq) AS pos, url AS loc, published_at AS lastmod FROM (SELECT source_name, seq, seq // 50 AS page, trim(regexp_replace(url, '[<>&]', '', 'g')) AS url, trim(regexp_replace(coalesce(published_at, ''), '[<>&]', '', 'g')) AS published_at FROM candidates)")
def sitemap_entries(spark: SparkSession, d: str) -> DataFrame:
    """Sitemaps of the candidates, fifty at a time, written and read again by position."""
    clean = lambda c: F.trim(F.regexp_replace(blank(c), "[<>&]", ""))
    c = table(spark, d, "candidates").select("source_name", "seq", F.floor(F.col("seq") / 50).alias("page"), F.concat(F.lit("<url><loc>"), clean("url"), F.lit("</loc><lastmod>"), clean("published_at"), F.lit("</lastmod></url>")).alias("x"))
    xml = c.groupBy("source_name", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "x"))), lambda e: e["x"]), "\n").alias("xml"))  # at most fifty
    e = xml.select("source_name", "page", F.posexplode(html.zipped_sitemap(F.col("xml"))).alias("p", "e"))
    return e.select("source_name", "page", (F.col("p") + 1).cast("bigint").alias("pos"), F.col("e.loc").alias("loc"), F.col("e.lastmod").alias("lastmod"))


@query("SELECT source_name, 'forward' AS direction, unnest(range(coalesce(max(source_article_id), 0) + 1, coalesce(max(source_article_id), 0) + 21)) AS probe FROM articles GROUP BY source_name UNION ALL SELECT source_name, 'backward', unnest(range(greatest(coalesce(min(source_article_id), 1000) - 20, 1), coalesce(min(source_article_id), 1000))) FROM articles GROUP BY source_name")
def id_windows(spark: SparkSession, d: str) -> DataFrame:
    """Ids to probe beyond the highest and below the lowest known id of each source, with a start where none is known."""
    a = table(spark, d, "articles").groupBy("source_name").agg(F.coalesce(F.max("source_article_id"), F.lit(0)).alias("hi"), F.coalesce(F.min("source_article_id"), F.lit(1000)).alias("lo"))
    up = a.select("source_name", F.lit("forward").alias("direction"), F.explode(F.sequence(F.col("hi") + 1, F.col("hi") + 20)).alias("probe"))
    low = F.greatest(F.col("lo") - 20, F.lit(1))
    return up.unionByName(a.where(low < F.col("lo")).select("source_name", F.lit("backward").alias("direction"), F.explode(F.sequence(F.col("lo") - 1, low)).alias("probe")))


_FIELDS = ["title", "category", "content_text", "article_url", "image_url", "published_at", "fetched_at", "content_hash"]
_NOW = "2026-07-01T00:00:00Z"


@query(
    "SELECT source_name, source_article_id, " + ", ".join(f"coalesce(arg_max(coalesce({f}, ''), id) FILTER (late), arg_max(coalesce({f}, ''), id)) AS {f}" for f in _FIELDS if f not in ("published_at", "fetched_at"))
    + f", coalesce(arg_max(shown, id) FILTER (late), arg_max(shown, id)) AS published_at, CASE WHEN bool_or(late) THEN '{_NOW}' ELSE arg_max(coalesce(fetched_at, ''), id) END AS fetched_at, "
    "CASE WHEN NOT bool_or(late) THEN 'unchanged' WHEN bool_and(late) THEN 'inserted' ELSE 'updated' END AS action FROM (SELECT *, id % 2 = 0 AS late, CASE WHEN coalesce(published_at, '') <> '' THEN published_at ELSE 'Tarix: ' || coalesce(fetched_at, '') END AS shown FROM articles) GROUP BY source_name, source_article_id"
)
def upserted_records(spark: SparkSession, d: str) -> DataFrame:
    """A store of the deliveries with odd ids after those with even ids: all columns, the raw date where there is no other, the time of the run."""
    key = ["source_name", "source_article_id"]
    a = table(spark, d, "articles")
    shown = F.when(blank("published_at") != "", F.col("published_at")).otherwise(F.concat(F.lit("Tarix: "), blank("fetched_at")))
    rows = a.select(*key, "id", *[(shown if f == "published_at" else blank(f)).alias(f) for f in _FIELDS])
    base = merge.keep_last(rows.where("id % 2 = 1"), key, ["id"])
    delta = rows.where("id % 2 = 0").withColumn("fetched_at", F.lit(_NOW))
    return merge.upsert(base, delta, key, ["id"]).drop("id")


@query("SELECT count(*) AS n_rows, count(DISTINCT source_name) AS n_sources, count(*) FILTER (content_hash = sha256(coalesce(content_text, ''))) AS n_true_hashes, max(source_article_id) AS max_id, coalesce(min(source_article_id) FILTER (source_name = 'no such source'), 500000) AS start_id FROM articles")
def store_figures(spark: SparkSession, d: str) -> DataFrame:
    """Figures of the whole store; the start of a backfill is a constant where nothing is known."""
    return table(spark, d, "articles").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("source_name").alias("n_sources"), F.count_if(F.col("content_hash") == text.sha256_text(F.col("content_text"))).alias("n_true_hashes"),
        F.max("source_article_id").alias("max_id"), F.coalesce(F.min(F.when(F.col("source_name") == "no such source", F.col("source_article_id"))), F.lit(500000)).alias("start_id"),
    )


_ZONED = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$"


@query(
    "SELECT c.seq, CASE WHEN l.list_date = '' THEN '' ELSE l.list_date || 'T09:05:00+04:00' END AS with_clock, l.list_date AS bad_clock, CASE WHEN l.list_date = '' THEN '' ELSE l.list_date || 'T12:04:00+04:00' END AS bracketed, "
    f"CASE WHEN l.list_date = '' THEN trim({_E(_NORM('c.list_date_text'))} || ' 23:10') ELSE l.list_date || 'T23:10:00+04:00' END AS visible, CASE WHEN l.list_date = '' THEN '' ELSE l.list_date || 'T09:05:00+04:00' END AS card, "
    rf"coalesce(CASE WHEN regexp_matches({_NORM('c.published_at')}, '{_ZONED}') THEN strftime(make_timestamp(epoch_us(try_cast(regexp_replace({_NORM('c.published_at')}, '([+-]\d{{2}})(\d{{2}})$', '\1:\2') AS TIMESTAMPTZ)) + 14400000000), '%Y-%m-%dT%H:%M:%S') || '+04:00' END, '') AS fixed_offset "
    f"FROM candidates c JOIN ({LISTING_SQL['listing_dates']}) l ON l.seq = c.seq"
)
def listing_times(spark: SparkSession, d: str) -> DataFrame:
    """Times of listings, as cards and pages show them; the year of the run is 2026."""
    day, year = F.col("list_date_text"), F.lit(2026)
    with_ = lambda tail: F.concat(blank("list_date_text"), F.lit(tail))
    return table(spark, d, "candidates").select(
        "seq", dates.azerbaijani_datetime(day, F.lit("9:05"), year).alias("with_clock"), dates.azerbaijani_datetime(day, F.lit("25:05"), year).alias("bad_clock"), dates.apa_datetime(with_(" 12:04 (UTC +04:00)"), year).alias("bracketed"),
        dates.visible_datetime(with_(" 23:10"), year).alias("visible"), dates.card_datetime(day, F.lit("09:05"), year).alias("card"), dates.at_fixed_offset(F.col("published_at")).alias("fixed_offset"),
    )


@query(r"SELECT id, regexp_replace(coalesce(content_text, ''), '[^\x{20}-\x{7e}\x{a1}-\x{ff}]', '', 'g') AS restored FROM articles")
def restored_latin(spark: SparkSession, d: str) -> DataFrame:
    """Latin text read as latin-1 and restored: each article's letters up to U+00FF, garbled and brought back."""
    kept = F.regexp_replace(blank("content_text"), r"[^\x20-\x7e\u00a1-\u00ff]", "")
    garbled = F.decode(F.encode(kept, "UTF-8"), "ISO-8859-1")
    return table(spark, d, "articles").select("id", text.fix_utf8_mojibake(garbled).alias("restored"))
