"""Queries of the ingestion engine over the given tables, each with the same statement in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslake.functions import dates, html, text, urls
from presslake.operators import audit, merge
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


# Pieces of SQL that several statements share.
_WS = "[\\t-\\r \\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"
_NORM = lambda x: f"trim(regexp_replace({x}, '{_WS}', ' ', 'g'))"
_URL = lambda u: (
    f"CASE WHEN regexp_matches(trim({u}), '^[A-Za-z][A-Za-z0-9+.-]*://') THEN regexp_extract(trim({u}), '^([A-Za-z][A-Za-z0-9+.-]*:)//', 1) || '//' || regexp_extract(trim({u}), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"
    f" || CASE WHEN rtrim(regexp_extract(trim({u}), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') = '' THEN '/' ELSE rtrim(regexp_extract(trim({u}), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') END ELSE rtrim(trim({u}), '/') END"
)
_STAMP = lambda c: f"epoch_us({c})"
us = lambda c: F.unix_micros(c)


@query("SELECT source_key, CASE WHEN starts_with(source_key, 'telegram:') THEN substr(source_key, 10) ELSE source_key END AS identifier, desired_state, row_number() OVER (ORDER BY coalesce(created_at, updated_at), source_key) AS pos FROM news WHERE record_kind = 'source'")
def list_sources(spark: SparkSession, d: str) -> DataFrame:
    """Sources in order of creation (there are few; the position needs one task)."""
    s = table(spark, d, "news").where("record_kind = 'source'")
    w = Window.orderBy(F.coalesce("created_at", "updated_at"), "source_key")
    ident = F.when(F.col("source_key").startswith("telegram:"), F.substr("source_key", F.lit(10))).otherwise(F.col("source_key"))
    return s.select("source_key", ident.alias("identifier"), "desired_state", F.row_number().over(w).cast("bigint").alias("pos"))


@query("SELECT source_name, count(*) AS n FROM articles GROUP BY source_name")
def articles_by_source(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "articles").groupBy("source_name").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT source_name, max(source_article_id) AS max_id, min(source_article_id) AS min_id FROM articles GROUP BY source_name")
def article_id_range(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "articles").groupBy("source_name").agg(F.max("source_article_id").alias("max_id"), F.min("source_article_id").alias("min_id"))


@query("SELECT source_key, coalesce(min(try_cast(source_item_id AS BIGINT)), 0) AS oldest_id FROM news WHERE record_kind = 'news' GROUP BY source_key")
def oldest_message_id(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "news").where("record_kind = 'news'")
    return n.groupBy("source_key").agg(F.coalesce(F.min(F.col("source_item_id").try_cast("bigint")), F.lit(0)).alias("oldest_id"))


@query("SELECT count(*) FILTER (record_kind = 'source') AS n_sources, count(*) FILTER (record_kind = 'source' AND desired_state = 'running') AS n_running, count(*) FILTER (record_kind = 'source' AND desired_state = 'paused') AS n_paused, count(*) FILTER (record_kind = 'news') AS n_news FROM news")
def status_summary(spark: SparkSession, d: str) -> DataFrame:
    """All counts in one pass."""
    src = F.col("record_kind") == "source"
    return table(spark, d, "news").agg(
        F.count_if(src).alias("n_sources"), F.count_if(src & (F.col("desired_state") == "running")).alias("n_running"),
        F.count_if(src & (F.col("desired_state") == "paused")).alias("n_paused"), F.count_if(F.col("record_kind") == "news").alias("n_news"),
    )


_FIRST = "coalesce(arg_min({c}, seq) FILTER ({c} <> ''), '') AS {c}"


@query(
    "SELECT source_name, url_key, " + ", ".join(_FIRST.format(c=c) for c in ("title", "category", "published_at", "list_date_text", "teaser", "list_image_url", "slug"))
    + ", arg_min(source_article_id, seq) FILTER (source_article_id IS NOT NULL) AS source_article_id, coalesce(arg_max(url, seq) FILTER (url <> ''), '') AS url, count(*) AS n_merged FROM (SELECT *, " + _URL("url") + " AS url_key FROM candidates) GROUP BY source_name, url_key"
)
def merge_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Links found in several places as one candidate each; labels are compared in ``candidate_labels``."""
    c = table(spark, d, "candidates").withColumn("url_key", urls.normalize_url(F.col("url")))
    return merge.merge_candidates(c, ["source_name", "url_key"], "seq", ["title", "category", "published_at", "list_date_text", "teaser", "list_image_url", "slug"], ["source_article_id"], ["url"], [])


@query("SELECT source_name, url_key, array_to_string(list_sort(list_distinct(flatten(list(discovery_sources)))), ',') AS labels FROM (SELECT *, " + _URL("url") + " AS url_key FROM candidates) GROUP BY source_name, url_key")
def candidate_labels(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "candidates").withColumn("url_key", urls.normalize_url(F.col("url")))
    merged = merge.merge_candidates(c, ["source_name", "url_key"], "seq", [], [], [], ["discovery_sources"])
    return merged.select("source_name", "url_key", F.array_join("discovery_sources", ",").alias("labels"))


# The last step of a path stays where a portal redirects to another section.
_LAST = lambda u: f"regexp_replace(rtrim(regexp_extract(trim({u}), '^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)', 1), '/'), '^.*/', '')"


def _by_address(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(source_name, address) of candidates and of stored articles, relative addresses resolved; the address is the last step of its path."""
    c = table(spark, d, "candidates").select("source_name", urls.last_segment(F.col("url")).alias("address")).distinct()
    whole = urls.make_absolute_url(F.concat(F.lit("https://"), "source_name", F.lit("/")), F.col("article_url"))
    return c, table(spark, d, "articles").select("source_name", urls.last_segment(whole).alias("address"))


@query(f"SELECT DISTINCT source_name, {_LAST('url')} AS address FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM articles a WHERE a.source_name = c.source_name AND {_LAST('a.article_url')} = {_LAST('c.url')})")
def new_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Candidates that the store lacks."""
    c, a = _by_address(spark, d)
    return c.join(a, ["source_name", "address"], "left_anti")


@query(f"SELECT source_name, count(DISTINCT {_LAST('url')}) AS n_known FROM candidates c WHERE EXISTS (SELECT 1 FROM articles a WHERE a.source_name = c.source_name AND {_LAST('a.article_url')} = {_LAST('c.url')}) GROUP BY source_name")
def known_candidates(spark: SparkSession, d: str) -> DataFrame:
    c, a = _by_address(spark, d)
    return c.join(a, ["source_name", "address"], "left_semi").groupBy("source_name").agg(F.count(F.lit(1)).alias("n_known"))


@query("SELECT source_name, count(DISTINCT source_article_id) AS n_known FROM candidates c WHERE EXISTS (SELECT 1 FROM articles a WHERE a.source_name = c.source_name AND a.source_article_id = c.source_article_id) GROUP BY source_name")
def known_ids(spark: SparkSession, d: str) -> DataFrame:
    """Candidates whose id the store has."""
    key = ["source_name", "source_article_id"]
    c = table(spark, d, "candidates").select(*key).distinct()
    return c.join(table(spark, d, "articles").select(*key), key, "left_semi").groupBy("source_name").agg(F.count(F.lit(1)).alias("n_known"))


@query("SELECT source_name, source_article_id, arg_max(id, id) AS id, arg_max(title, id) AS title, arg_max(category, id) AS category, arg_max(content_hash, id) AS content_hash, count(*) AS n_versions FROM (SELECT id, source_name, source_article_id, coalesce(title, '') AS title, coalesce(category, '') AS category, coalesce(content_hash, '') AS content_hash FROM articles) GROUP BY source_name, source_article_id")
def upserted_articles(spark: SparkSession, d: str) -> DataFrame:
    """The last delivery of every article."""
    a = table(spark, d, "articles").select("id", "source_name", "source_article_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("title", "category", "content_hash")])
    return merge.merge_versions(a, ["source_name", "source_article_id"], ["id"], [], ["id", "title", "category", "content_hash"])


@query("SELECT source_name, source_article_id, max(id) AS id, CASE WHEN count(*) > 1 THEN 'updated' ELSE 'unchanged' END AS action FROM articles GROUP BY source_name, source_article_id")
def upsert_actions(spark: SparkSession, d: str) -> DataFrame:
    """First deliveries as the store, all later ones merged into it."""
    a = table(spark, d, "articles").select("source_name", "source_article_id", "id")
    key = ["source_name", "source_article_id"]
    base = merge.keep_first(a, key, ["id"])
    return merge.upsert(base, a.join(base.select("id"), "id", "left_anti").select(*base.columns), key, ["id"])


_MSG = "(coalesce(epoch_us(fetched_at), 0)::VARCHAR || ' ' || id)"


@query(f"SELECT source_key, source_item_id, arg_min(created_at, {_MSG}) AS created_us, arg_min(body, {_MSG}) AS body_text, arg_max(published, {_MSG}) AS published_at, arg_max(url, {_MSG}) AS origin_url, count(*) AS n_versions FROM (SELECT id, source_key, source_item_id, fetched_at, coalesce(epoch_us(created_at), -1) AS created_at, coalesce(body_text, '') AS body, coalesce(published_at, '') AS published, coalesce(origin_url, '') AS url FROM news WHERE record_kind = 'news') GROUP BY source_key, source_item_id")
def upserted_messages(spark: SparkSession, d: str) -> DataFrame:
    """Messages delivered again: creation and body of the first delivery, the rest of the last."""
    n = table(spark, d, "news").where("record_kind = 'news'").select(
        "source_key", "source_item_id", F.concat_ws(" ", F.coalesce(us(F.col("fetched_at")), F.lit(0)).cast("string"), "id").alias("o"), F.coalesce(us(F.col("created_at")), F.lit(-1)).alias("created_us"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("body_text", "published_at", "origin_url")],
    )
    return merge.merge_versions(n, ["source_key", "source_item_id"], ["o"], ["created_us", "body_text"], ["published_at", "origin_url"])


@query("SELECT source_name, url, min(seq) AS seq FROM candidates GROUP BY source_name, url")
def first_sightings(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "candidates").select("source_name", "url", "seq")
    return merge.keep_first(c, ["source_name", "url"], ["seq"])


@query("WITH r AS (SELECT raw_id, source_name, coalesce(raw_text, '') <> '' OR coalesce(raw_html, '') <> '' AS filled FROM raw_ingest), i AS (SELECT *, sum(filled::INT) OVER (PARTITION BY source_name ORDER BY raw_id) AS island FROM r) SELECT raw_id, source_name, CASE WHEN filled THEN 0 ELSE row_number() OVER (PARTITION BY source_name, island ORDER BY raw_id) - CASE WHEN island > 0 THEN 1 ELSE 0 END END AS streak FROM i")
def empty_payload_streaks(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "raw_ingest").select("raw_id", "source_name", "raw_text", "raw_html")
    filled = (F.coalesce("raw_text", F.lit("")) != "") | (F.coalesce("raw_html", F.lit("")) != "")
    return merge.empty_streaks(r, "source_name", "raw_id", filled).select("raw_id", "source_name", F.col("streak").cast("bigint").alias("streak"))


_PAGES = "SELECT source_name, page, string_agg(url, '|' ORDER BY seq) FILTER (rn <= 5) AS signature FROM (SELECT *, row_number() OVER (PARTITION BY source_name, page ORDER BY seq) AS rn FROM (SELECT source_name, seq, url, seq // 50 AS page FROM candidates)) GROUP BY source_name, page"


def _page_signatures(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "candidates").select("source_name", "seq", "url", F.floor(F.col("seq") / 50).alias("page"))
    # A listing page has 50 entries at most, so its list is short.
    first = F.slice(F.array_sort(F.collect_list(F.struct("seq", "url"))), 1, 5)
    return c.groupBy("source_name", "page").agg(F.array_join(F.transform(first, lambda x: x["url"]), "|").alias("signature"))


@query(_PAGES)
def page_signatures(spark: SparkSession, d: str) -> DataFrame:
    return _page_signatures(spark, d)


_THIRDS = f"SELECT source_name, page, CASE WHEN page % 4 = 2 THEN '' ELSE left(signature, 20) END AS signature FROM ({_PAGES})"


@query(f"SELECT source_name, page, coalesce(signature <> '' AND signature = last_value(nullif(signature, '') IGNORE NULLS) OVER (PARTITION BY source_name ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS repeated FROM ({_THIRDS})")
def repeated_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages like the last one before them that isn't empty; short signatures, and some pages empty, so that both happen."""
    p = _page_signatures(spark, d).withColumn("signature", F.when(F.col("page") % 4 == 2, "").otherwise(F.left("signature", F.lit(20))))
    return merge.repeated_signatures(p, "source_name", "page", "signature").select("source_name", "page", "repeated")


@query("SELECT id, source_key, max(try_cast(source_item_id AS BIGINT)) OVER (PARTITION BY source_key ORDER BY fetched_at, id ROWS UNBOUNDED PRECEDING) AS checkpoint FROM news WHERE record_kind = 'news'")
def running_checkpoints(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "news").where("record_kind = 'news'").withColumn("item", F.col("source_item_id").try_cast("bigint"))
    return merge.running_checkpoint(n, "source_key", ["fetched_at", "id"], "item").select("id", "source_key", "checkpoint")


@query("SELECT id, source_key, source_item_id FROM news WHERE record_kind = 'news' ORDER BY try_cast(source_item_id AS BIGINT) DESC NULLS LAST, id LIMIT 100")
def newest_by_id(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "news").where("record_kind = 'news'")
    return n.orderBy(F.col("source_item_id").try_cast("bigint").desc_nulls_last(), "id").limit(100).select("id", "source_key", "source_item_id")


@query("SELECT id, source_key FROM news WHERE record_kind = 'news' ORDER BY coalesce(published_at, '') DESC, coalesce(created_at, updated_at, fetched_at) DESC NULLS LAST, id LIMIT 100")
def newest_by_time(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "news").where("record_kind = 'news'")
    return n.orderBy(F.coalesce("published_at", F.lit("")).desc(), F.coalesce("created_at", "updated_at", "fetched_at").desc_nulls_last(), "id").limit(100).select("id", "source_key")


@query("SELECT source_name, source_article_id, (row_number() OVER (PARTITION BY source_name ORDER BY source_article_id, id) - 1) // 250 AS chunk, id FROM articles")
def backfill_chunks(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "articles").select("source_name", "source_article_id", "id").withColumn("nulls", F.col("source_article_id").isNull())
    return merge.chunks(a, "source_name", ["nulls", "source_article_id", "id"], 250).select("source_name", "source_article_id", "chunk", "id")


@query("SELECT 'article' AS kind, id::VARCHAR AS rec_id, coalesce(source_name, '') AS source, coalesce(content_text, '') AS body FROM articles UNION ALL SELECT record_kind, id, coalesce(source_key, ''), coalesce(body_text, '') FROM news")
def unified_records(spark: SparkSession, d: str) -> DataFrame:
    """Articles, sources and messages in one layout."""
    e = lambda c: F.coalesce(c, F.lit(""))
    a = table(spark, d, "articles").select(F.lit("article").alias("kind"), F.col("id").cast("string").alias("rec_id"), e("source_name").alias("source"), e("content_text").alias("body"))
    return a.unionByName(table(spark, d, "news").select(F.col("record_kind").alias("kind"), F.col("id").alias("rec_id"), e("source_key").alias("source"), e("body_text").alias("body")))


_LIVE = "SELECT DISTINCT source_name AS source_key, source_item_id FROM raw_ingest WHERE source_event_type = 'telegram_message' AND source_name IS NOT NULL AND source_item_id IS NOT NULL"
_STORED = "SELECT DISTINCT source_key, source_item_id FROM news WHERE record_kind = 'news' AND source_key IS NOT NULL AND source_item_id IS NOT NULL"
_FINDINGS = f"SELECT *, 'missing_in_db' AS finding FROM ({_LIVE} EXCEPT {_STORED}) UNION ALL SELECT *, 'extra_in_db' FROM ({_STORED} EXCEPT {_LIVE})"


def _audit(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    live = table(spark, d, "raw_ingest").where("source_event_type = 'telegram_message' and source_name is not null and source_item_id is not null").select(F.col("source_name").alias("source_key"), "source_item_id")
    stored = table(spark, d, "news").where("record_kind = 'news' and source_key is not null and source_item_id is not null").select("source_key", "source_item_id")
    return audit.audit(live, stored, ["source_key", "source_item_id"]), table(spark, d, "news").where("record_kind = 'source'")


@query(_FINDINGS)
def audit_findings(spark: SparkSession, d: str) -> DataFrame:
    return _audit(spark, d)[0]


@query(f"SELECT s.source_key, coalesce(n_missing, 0) AS n_missing, coalesce(n_extra, 0) AS n_extra, CASE WHEN coalesce(n_missing, 0) > 0 THEN 'fail' WHEN coalesce(n_extra, 0) > 0 THEN 'warning' ELSE 'pass' END AS status FROM (SELECT DISTINCT source_key FROM news WHERE record_kind = 'source') s LEFT JOIN (SELECT source_key, count(*) FILTER (finding = 'missing_in_db') AS n_missing, count(*) FILTER (finding = 'extra_in_db') AS n_extra FROM ({_FINDINGS}) GROUP BY source_key) f ON f.source_key = s.source_key")
def audit_statuses(spark: SparkSession, d: str) -> DataFrame:
    findings, sources = _audit(spark, d)
    return audit.audit_status(findings, sources, "source_key")


@query(f"SELECT id, {_NORM('title')} AS title, CASE WHEN length({_NORM('coalesce(content_text, $$$$)')}) <= 280 THEN {_NORM('coalesce(content_text, $$$$)')} ELSE rtrim(left({_NORM('coalesce(content_text, $$$$)')}, 277), ' ') || '...' END AS summary, sha256(coalesce(content_text, '')) AS digest FROM articles".replace("$$$$", "''"))
def article_texts(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "articles")
    return a.select("id", text.normalize_space(F.col("title")).alias("title"), text.summarize_text(F.col("content_text")).alias("summary"), text.sha256_text(F.col("content_text")).alias("digest"))


_FORM = lambda x: f"replace(url_encode(url_decode(replace({x}, '+', ' '))), '%20', '+')"


def _canon(u: str) -> str:
    """SQL of a canonical address."""
    x = f"regexp_replace(coalesce({_NORM(u)}, ''), '#.*$', '')"
    base, query_ = f"split_part({x}, '?', 1)", f"substr({x}, length(split_part({x}, '?', 1)) + 2)"
    host = f"regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)', 1)"
    pairs = f"list_filter(str_split({query_}, '&'), lambda p: p <> '' AND NOT regexp_matches(lower(url_decode(split_part(p, '=', 1))), '^(utm_|fbclid|gclid)'))"
    kept = f"array_to_string(list_transform({pairs}, lambda p: {_FORM("split_part(p, '=', 1)")} || '=' || {_FORM("substr(p, length(split_part(p, '=', 1)) + 2)")}), '&')"
    return f"rtrim(lower({host}) || substr({base}, length({host}) + 1) || CASE WHEN {kept} <> '' THEN '?' || {kept} ELSE '' END, '/')"


_LOWER = lambda x: f"lower(replace({x}, 'İ', 'i' || chr(775)))"


@query(f"SELECT id, CASE WHEN {_canon('article_url')} <> '' THEN 'url:' || {_canon('article_url')} WHEN coalesce(content_hash, '') <> '' THEN 'hash:' || content_hash ELSE 'sim:' || sha256({_LOWER('coalesce(' + _NORM('title') + ", '')")} || '|' || coalesce(try_cast(left(fetched_at, 10) AS DATE)::VARCHAR, '')) END AS dedupe_key FROM articles")
def dedupe_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys by canonical address, else by hash, else by title and day."""
    a = table(spark, d, "articles")
    day = F.try_to_date(F.when(F.left("fetched_at", F.lit(10)).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.left("fetched_at", F.lit(10))), "yyyy-MM-dd")
    return a.select("id", text.dedupe_key(urls.canonicalize_url(F.col("article_url")), F.col("content_hash"), F.col("title"), day).alias("dedupe_key"))


@query(f"SELECT seq, {_canon("u")} AS canonical FROM (SELECT seq, split_part(url, '#', 1) || '?b=&q=' || coalesce(title, '') || '&UTM_x=1&z=1%20a+b&' AS u FROM candidates)")
def canonical_urls(spark: SparkSession, d: str) -> DataFrame:
    """Canonical addresses of searches for the candidates' titles."""
    u = F.concat(F.substring_index("url", "#", 1), F.lit("?b=&q="), F.coalesce("title", F.lit("")), F.lit("&UTM_x=1&z=1%20a+b&"))
    return table(spark, d, "candidates").select("seq", urls.canonicalize_url(u).alias("canonical"))


@query("SELECT id, CASE WHEN h = 0 THEN 1 ELSE h END AS stable_id FROM (SELECT id, (('0x' || substr(sha256(coalesce(article_url, '')), 1, 16))::UBIGINT % 9223372036854775808)::BIGINT AS h FROM articles)")
def stable_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "articles").select("id", text.stable_bigint(F.col("article_url")).alias("stable_id"))


@query("SELECT seq, " + _URL("url") + " AS url_key, regexp_matches(split_part(lower(coalesce(list_image_url, '')), '?', 1), '\\.(jpg|jpeg|png|webp|gif|bmp)$') AS is_image FROM candidates")
def candidate_urls(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "candidates")
    return c.select("seq", urls.normalize_url(F.col("url")).alias("url_key"), urls.looks_like_image(F.col("list_image_url")).alias("is_image"))


@query("SELECT raw_id, array_to_string(list_distinct_first, ' ') AS gallery, coalesce(list_distinct_first[1], '') AS main_image FROM (SELECT raw_id, list_filter(list_transform(range(1, len(l) + 1), lambda i: CASE WHEN list_position(l, l[i]) = i THEN l[i] END), lambda x: x IS NOT NULL) AS list_distinct_first FROM (SELECT raw_id, list_filter(list_concat([coalesce(primary_image_url, '')], coalesce(image_urls, [])), lambda x: x IS NOT NULL AND x <> '') AS l FROM raw_ingest))")
def galleries(spark: SparkSession, d: str) -> DataFrame:
    """Images of a payload, the primary one first, each once."""
    g = text.unique_in_order(F.concat(F.array(F.coalesce("primary_image_url", F.lit(""))), F.coalesce("image_urls", F.array().cast("array<string>"))))
    return table(spark, d, "raw_ingest").select("raw_id", g.alias("g")).select("raw_id", F.array_join("g", " ").alias("gallery"), F.coalesce(F.try_element_at("g", F.lit(1)), F.lit("")).alias("main_image"))


_BODY = "coalesce(" + _NORM("body_text") + ", '')"


_MEDIA = "CASE WHEN id LIKE '%a' THEN 'MessageMediaPhoto' ELSE '' END"
_TITLE = f"CASE WHEN {_BODY} = '' THEN CASE WHEN {_MEDIA} <> '' THEN '[telegram media post] ' || {_MEDIA} ELSE '' END WHEN split_part({_BODY}, '. ', 1) <> '' THEN split_part({_BODY}, '. ', 1) ELSE left({_BODY}, 160) END"
_FULL = f"CASE WHEN {_BODY} = '' AND {_MEDIA} <> '' THEN '[telegram media post without caption] ' || {_MEDIA} ELSE {_BODY} END"


@query(
    "SELECT id, title, body_text, concat_ws(',', CASE WHEN title = '' THEN 'title' END, CASE WHEN body_text = '' THEN 'body_text' END) AS missing_fields, "
    "concat_ws(',', CASE WHEN title = '' THEN 'title_missing' END, CASE WHEN body_text = '' THEN 'body_missing' END, CASE WHEN no_caption THEN 'media_without_caption' END) AS quality_flags, "
    "CASE WHEN title = '' AND body_text = '' THEN 'raw_only' WHEN title = '' OR body_text = '' THEN 'partial_success' ELSE 'success' END AS parse_status, sha256(title || chr(10) || body_text) AS content_hash "
    f"FROM (SELECT id, {_TITLE} AS title, {_FULL} AS body_text, {_MEDIA} <> '' AND {_BODY} = '' AS no_caption FROM news WHERE record_kind = 'news')"
)
def normalized_messages(spark: SparkSession, d: str) -> DataFrame:
    """Messages as records; those whose id ends in ``a`` stand for posts with a photo."""
    n = table(spark, d, "news").where("record_kind = 'news'")
    media = F.when(F.col("id").endswith("a"), "MessageMediaPhoto").otherwise("")
    return merge.normalized_payload(n, "body_text", media, F.lit("")).select("id", "title", "body_text", "missing_fields", "quality_flags", "parse_status", "content_hash")


@query("SELECT n.id, n.source_key FROM news n JOIN news s ON s.record_kind = 'source' AND s.source_key = n.source_key AND s.desired_state = 'running' WHERE n.record_kind = 'news' AND try_cast(n.source_item_id AS BIGINT) > s.last_message_id")
def gated_messages(spark: SparkSession, d: str) -> DataFrame:
    """Messages of running sources beyond their checkpoint."""
    n = table(spark, d, "news")
    s = n.where("record_kind = 'source' and desired_state = 'running'").select("source_key", "last_message_id")
    m = n.where("record_kind = 'news'").select("id", "source_key", F.col("source_item_id").try_cast("bigint").alias("item"))
    return m.join(s, "source_key").where("item > last_message_id").select("id", "source_key")


@query("SELECT r.raw_id, r.source_name, r.source_item_id, coalesce(max(n.last_message_id), 0) AS last_message_id, count(n.id) AS n_stored FROM raw_ingest r LEFT JOIN news n ON n.source_key = r.source_name AND n.source_item_id = r.source_item_id GROUP BY ALL")
def raw_with_stored(spark: SparkSession, d: str) -> DataFrame:
    """Raw payloads and what the store has of them; the store is reduced by key before the join."""
    r = table(spark, d, "raw_ingest").select("raw_id", "source_name", "source_item_id")
    n = table(spark, d, "news").groupBy(F.col("source_key").alias("source_name"), "source_item_id").agg(F.max("last_message_id").alias("m"), F.count(F.lit(1)).alias("c"))
    return r.join(n, ["source_name", "source_item_id"], "left").select("raw_id", "source_name", "source_item_id", F.coalesce("m", F.lit(0)).alias("last_message_id"), F.coalesce("c", F.lit(0)).alias("n_stored"))


@query("SELECT raw_id, regexp_extract(raw_html, '(?is)<meta\\s[^>]*property=\"og:title\"\\s+content=\"([^\"]*)\"', 1) AS og_title, len(regexp_extract_all(raw_html, '(?i)<p[\\s>]')) AS n_p FROM raw_ingest WHERE raw_html IS NOT NULL")
def page_fields(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "raw_ingest").where("raw_html is not null")
    og = F.regexp_extract("raw_html", r"(?is)<meta\s[^>]*property=\"og:title\"\s+content=\"([^\"]*)\"", 1)
    return r.select("raw_id", og.alias("og_title"), F.size(F.regexp_extract_all("raw_html", F.lit(r"(?i)<p[\s>]"), F.lit(0))).cast("bigint").alias("n_p"))


@query("")
def parsed_pages(spark: SparkSession, d: str) -> DataFrame:
    """Generic page parser: title, first heading, canonical address, paragraphs."""
    r = table(spark, d, "raw_ingest").where("raw_html is not null and raw_html <> ''")
    h = F.col("raw_html")
    return r.select("raw_id", html.page_title(h).alias("title"), html.tag_text(h, "h1").alias("heading"), html.canonical_url(h, F.col("origin_url")).alias("url"), html.paragraphs(h).alias("paragraphs"))


@query("SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS start_us, event_type, count(*) AS n FROM events GROUP BY ALL")
def hourly_events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(us(F.col("w.start")).alias("start_us"), "event_type", "n")


_AZ = "|".join([*dates.AZ_MONTHS, dates.AUGUST])
_MONTHS = "MAP {" + ", ".join(f"'{n}': '{i:02d}'" for i, n in [*enumerate(dates.AZ_MONTHS, 1), (8, dates.AUGUST)]) + "}"
_DAY = r"(\d{1,2})\s+([A-Za-zəöüğçşıƏÖÜĞÇŞİ]+)(?:\s+(\d{4}))?"
_DPART = lambda k: f"regexp_extract(list_date_text, '{_DAY}', {k})"


@query(f"SELECT seq, coalesce(try_cast(CASE WHEN {_DPART(3)} = '' THEN '2026' ELSE {_DPART(3)} END || '-' || {_MONTHS}[replace(replace({_DPART(2)}, 'İ', 'i'), 'I', 'ı').lower()] || '-' || lpad({_DPART(1)}, 2, '0') AS DATE)::VARCHAR, '') AS list_date FROM candidates".replace("replace(replace(" + _DPART(2) + ", 'İ', 'i'), 'I', 'ı').lower()", "lower(replace(replace(" + _DPART(2) + ", 'İ', 'i'), 'I', 'ı'))"))
def listing_dates(spark: SparkSession, d: str) -> DataFrame:
    """Dates of listings; those without a year are of 2026, the year of the run."""
    return table(spark, d, "candidates").select("seq", dates.azerbaijani_date(F.col("list_date_text"), F.lit(2026)).alias("list_date"))


_IDENT = "substr(source_key, 10)"


@query(f"SELECT id, source_key, CASE WHEN coalesce(try_cast(source_item_id AS BIGINT), 0) <= 0 OR {_IDENT} = '' THEN '' WHEN starts_with({_IDENT}, 'peer:') THEN 'https://t.me/c/' || regexp_replace(regexp_extract({_IDENT}, '^peer:-?(\\d+)$', 1), '^100', '') || '/' || try_cast(source_item_id AS BIGINT) ELSE 'https://t.me/' || {_IDENT} || '/' || try_cast(source_item_id AS BIGINT) END AS permalink FROM news WHERE record_kind = 'news' AND source_key IS NOT NULL")
def message_permalinks(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "news").where("record_kind = 'news' and source_key is not null")
    item = F.coalesce(F.col("source_item_id").try_cast("bigint"), F.lit(0))
    return n.select("id", "source_key", urls.message_url(F.substr("source_key", F.lit(10)), item).alias("permalink"))


@query("SELECT r.raw_id, r.source_name, coalesce(n.published_at, '') AS published_at, coalesce(n.body_text, r.raw_text, '') AS body_text, coalesce(epoch_us(n.created_at), epoch_us(r.observed_at)) AS created_us FROM raw_ingest r LEFT JOIN (SELECT source_key, source_item_id, arg_min(coalesce(published_at, ''), id) AS published_at, arg_min(coalesce(body_text, ''), id) AS body_text, min(created_at) AS created_at FROM news WHERE record_kind = 'news' GROUP BY ALL) n ON n.source_key = r.source_name AND n.source_item_id = r.source_item_id")
def migrated_records(spark: SparkSession, d: str) -> DataFrame:
    """Raw records with what the older layout stored of them, missing fields from the payload."""
    n = table(spark, d, "news").where("record_kind = 'news'").groupBy(F.col("source_key").alias("source_name"), "source_item_id").agg(
        F.min_by(F.coalesce("published_at", F.lit("")), "id").alias("p"), F.min_by(F.coalesce("body_text", F.lit("")), "id").alias("b"), F.min("created_at").alias("c")
    )
    r = table(spark, d, "raw_ingest").select("raw_id", "source_name", "source_item_id", "raw_text", "observed_at").join(n, ["source_name", "source_item_id"], "left")
    return r.select("raw_id", "source_name", F.coalesce("p", F.lit("")).alias("published_at"), F.coalesce("b", "raw_text", F.lit("")).alias("body_text"), us(F.coalesce("c", "observed_at")).alias("created_us"))


@query("SELECT source_key, id FROM (SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY item DESC NULLS LAST, id) AS kept FROM (SELECT * FROM (SELECT source_key, id, body_text, try_cast(source_item_id AS BIGINT) AS item, row_number() OVER (PARTITION BY source_key ORDER BY try_cast(source_item_id AS BIGINT) DESC NULLS LAST, id) AS rn FROM news WHERE record_kind = 'news') WHERE rn <= 25 AND coalesce(body_text, '') <> '')) WHERE kept <= 5")
def audit_window(spark: SparkSession, d: str) -> DataFrame:
    """Of the 25 newest messages of a source, the 5 newest with a text: a limit before the filter and one after it."""
    n = table(spark, d, "news").where("record_kind = 'news'").withColumn("item", F.col("source_item_id").try_cast("bigint"))
    w = Window.partitionBy("source_key").orderBy(F.col("item").desc_nulls_last(), "id")
    scanned = n.withColumn("rn", F.row_number().over(w)).where("rn <= 25").where(F.coalesce("body_text", F.lit("")) != "")
    return scanned.withColumn("kept", F.row_number().over(w)).where("kept <= 5").select("source_key", "id")


@query("SELECT s.source_key, s.desired_state, coalesce(n.n_messages, 0) AS n_messages, coalesce(n.last_us, 0) AS last_us, CASE WHEN n.source_key IS NULL THEN 'idle' ELSE 'seen' END AS runtime FROM news s LEFT JOIN (SELECT source_key, count(*) AS n_messages, max(epoch_us(fetched_at)) AS last_us FROM news WHERE record_kind = 'news' GROUP BY source_key) n ON n.source_key = s.source_key WHERE s.record_kind = 'source'")
def annotated_sources(spark: SparkSession, d: str) -> DataFrame:
    """Sources with what is known of their runs, ``idle`` where nothing is."""
    n = table(spark, d, "news")
    seen = n.where("record_kind = 'news'").groupBy("source_key").agg(F.count(F.lit(1)).alias("n"), F.max(us(F.col("fetched_at"))).alias("u"))
    s = n.where("record_kind = 'source'").select("source_key", "desired_state").join(seen, "source_key", "left")
    return s.select("source_key", "desired_state", F.coalesce("n", F.lit(0)).alias("n_messages"), F.coalesce("u", F.lit(0)).alias("last_us"), F.when(F.col("n").isNull(), "idle").otherwise("seen").alias("runtime"))


@query("SELECT source_name, arg_max(id, length(coalesce(content_text, '')) * 1000000000 - id) AS id, max(length(coalesce(content_text, ''))) AS n_chars FROM articles GROUP BY source_name")
def longest_articles(spark: SparkSession, d: str) -> DataFrame:
    """The longest text of every source; the lower id wins a tie."""
    n = F.length(F.coalesce("content_text", F.lit("")))
    return table(spark, d, "articles").groupBy("source_name").agg(F.max_by("id", F.struct(n, -F.col("id"))).alias("id"), F.max(n).cast("bigint").alias("n_chars"))


@query("SELECT seq, lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host, regexp_extract(rtrim(CASE WHEN regexp_matches(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://') THEN regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) ELSE regexp_extract(trim(url), '^([^?#]*)', 1) END, '/'), '([^/]*)$', 1) AS slug FROM candidates WHERE url IS NOT NULL")
def address_parts(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "candidates").where("url is not null")
    return c.select("seq", urls.url_host(F.col("url")).alias("host"), urls.last_segment(F.col("url")).alias("slug"))


@query("SELECT source_name, count(*) AS n, count(*) FILTER (parse_status = 'ok') AS n_ok, count(*) FILTER (parse_status = 'failed') AS n_failed, count(*) FILTER (coalesce(parser_error, '') <> '') AS n_errors, count(DISTINCT content_hash) AS n_hashes FROM raw_ingest GROUP BY source_name")
def ingest_counters(spark: SparkSession, d: str) -> DataFrame:
    """Counters of a run by source, from its outcomes."""
    r = table(spark, d, "raw_ingest")
    return r.groupBy("source_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("parse_status") == "ok").alias("n_ok"), F.count_if(F.col("parse_status") == "failed").alias("n_failed"),
        F.count_if(F.coalesce("parser_error", F.lit("")) != "").alias("n_errors"), F.countDistinct("content_hash").alias("n_hashes"),
    )


@query("SELECT source_name, source_article_id, id, content_hash IS DISTINCT FROM lag(content_hash) OVER (PARTITION BY source_name, source_article_id ORDER BY id) AS changed FROM articles WHERE source_article_id IS NOT NULL")
def changed_versions(spark: SparkSession, d: str) -> DataFrame:
    """Whether a delivery differs from the one before it."""
    w = Window.partitionBy("source_name", "source_article_id").orderBy("id")
    a = table(spark, d, "articles").where("source_article_id is not null")
    return a.select("source_name", "source_article_id", "id", (~F.col("content_hash").eqNullSafe(F.lag("content_hash").over(w))).alias("changed"))
