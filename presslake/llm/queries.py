"""Queries of the text problems; registered only where this subpackage exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.llm import boilerplate, canonical, encoding, language, lines, mixing, neardup, tokenizer, truncation
from presslake.session import MAX_BROADCAST_ROWS, bounded_rows, checkpointed, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of articles that hold wrongly decoded text, with the md5 of the restored value ('' where it is lost)."""
    articles = table(spark, sf_dir, "articles")
    portals = table(spark, sf_dir, "portals").select("source_name", "main_lang")
    # One text of title and content, so that the words of headlines are in the dictionaries too.
    labelled = articles.select("id", "source_name", F.concat_ws("\n", "title", "content_text").alias("text")).join(portals, "source_name")
    dictionaries = encoding.train_dictionaries(labelled, "id", "main_lang", "text")
    field = lambda name: F.struct(F.lit(name).alias("field_name"), F.col(name).alias("value"))
    # ASCII has no second reading; it is dropped before Python sees it.
    values = articles.select("id", F.inline(F.array(field("title"), field("content_text")))).where(F.col("value").rlike(encoding.BEYOND_ASCII))
    done = encoding.repair_encoding(values, "value", dictionaries)
    return done.where("affected").select("id", "field_name", F.when(F.col("value").contains("�"), F.lit("")).otherwise(F.md5(F.col("restored").cast("binary"))).alias("restored_md5"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, text) of articles and of news messages."""
    articles = table(spark, sf_dir, "articles").select(
        F.concat(F.lit("a"), F.col("id")).alias("key"), F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("content_text", F.lit(""))).alias("text")
    )
    news = table(spark, sf_dir, "news").where("record_kind = 'news'").select(F.concat(F.lit("n"), F.col("id")).alias("key"), F.col("body_text").alias("text"))
    return articles.unionByName(news)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of records that share at least 0.8 of the longer text's words."""
    return neardup.similar_pairs(_records(spark, sf_dir))


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record with the class of its text, and the number of other texts it is similar to."""
    return neardup.classes_with_links(_records(spark, sf_dir))


def _portal_entries(spark: SparkSession, sf_dir: str) -> list:
    rows = bounded_rows(table(spark, sf_dir, "portals").select("portal_id", "source_name", "display_name"), canonical.MAX_ENTRIES, "portals")
    return [(r[0], (r[1], r[2])) for r in rows]


def _category_entries(spark: SparkSession, sf_dir: str) -> list:
    rows = bounded_rows(table(spark, sf_dir, "category_ref").select("category_id", "name_az", "name_ru", "name_en"), canonical.MAX_ENTRIES, "category_ref")
    return [(r[0], (r[1], r[2], r[3])) for r in rows]


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field_name, id, value, matches) of every value that isn't a canonical name, null, '' or ``uncategorized``."""
    articles = table(spark, sf_dir, "articles")
    portals, categories = _portal_entries(spark, sf_dir), _category_entries(spark, sf_dir)
    parts = []
    for field, entries in (("category", categories), ("source_name", portals)):
        rows = articles.select(F.lit(field).alias("field_name"), "id", F.col(field).alias("value"))
        rows = rows.where(F.col("value").isNotNull() & ~F.col("value").isin("", "uncategorized", *[names[0] for _, names in entries]))
        parts.append(canonical.with_matches(rows, "value", entries))
    return parts[0].unionByName(parts[1])


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference entry of each freely typed category and source name, 0 if none fits."""
    best = F.coalesce(F.try_element_at("matches", F.lit(1))["ref_id"], F.lit(0))
    return _typed(spark, sf_dir).select("field_name", "id", best.alias("ref_id"))


def p6_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values without an entry, and how many articles have them."""
    missed = _typed(spark, sf_dir).where(F.size("matches") == 0)
    return missed.groupBy("field_name", "value").agg(F.count(F.lit(1)).alias("n"))


def _articles_with_portal(spark: SparkSession, sf_dir: str, more: list[str] = []) -> DataFrame:  # noqa: B006
    """(id, portal_id, content_text, more...) of articles; the portal is that of p6, null if there is none."""
    entries = _portal_entries(spark, sf_dir)
    exact = F.create_map(*[F.lit(x) for i, names in entries for x in (names[0], i)]) if entries else F.lit(None)
    rows = table(spark, sf_dir, "articles").select("id", "content_text", "source_name", *more)
    rows = rows.withColumn("exact_id", exact[F.col("source_name")] if entries else F.lit(None).cast("int"))
    rows = canonical.with_matches(rows.withColumn("typed", F.when(F.col("exact_id").isNull(), F.col("source_name"))), "typed", entries)
    return rows.select("id", F.coalesce("exact_id", F.try_element_at("matches", F.lit(1))["ref_id"]).alias("portal_id"), "content_text", *more)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines repeated within their portal, by article and number of the line."""
    return lines.repeated_places(_articles_with_portal(spark, sf_dir), "id", "portal_id", "content_text").select("id", "line_no")


def p7_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All articles with the text left when repeated lines are removed."""
    return lines.without_repeated(_articles_with_portal(spark, sf_dir), "id", "portal_id", "content_text")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document by byte_bpe_50k."""
    return tokenizer.encode_texts(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids decoded again: documents by whether the text came back."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = tokenizer.decode_ids(p8_ids(spark, sf_dir), "ids")
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return decoded.join(documents, "doc_id").groupBy(same.alias("same")).agg(F.count(F.lit(1)).alias("n_docs"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.score_texts(table(spark, sf_dir, "documents"), "doc_id", "source", "text", "title")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text was cut off."""
    return truncation.cut_off(_scored(spark, sf_dir)).select("doc_id")


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source has cut texts."""
    return truncation.truncation_rates(_scored(spark, sf_dir), "source")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rec_kind, rec_id, n_words, stretches, label) of articles and news messages."""
    articles, news = table(spark, sf_dir, "articles"), table(spark, sf_dir, "news").where("record_kind = 'news'")
    a_langs = table(spark, sf_dir, "article_langs").select(F.col("id").cast("string").alias("rec_id"), language.language_of_label(F.col("declared_lang")).alias("label"), F.lit("articles").alias("rec_kind"))
    n_langs = table(spark, sf_dir, "news_langs").select(F.col("id").alias("rec_id"), language.language_of_label(F.col("declared_lang")).alias("label"), F.lit("news").alias("rec_kind"))
    labels = a_langs.unionByName(n_langs).groupBy("rec_kind", "rec_id").agg(F.max("label").alias("label"))
    # Taught by articles whose declared language is also that of their portal.
    portals = table(spark, sf_dir, "portals").select("source_name", "main_lang")
    agreed = articles.select("id", "source_name").join(portals, "source_name")
    agreed = agreed.join(a_langs.select(F.col("rec_id").cast("bigint").alias("id"), "label"), "id").where(F.col("label") == F.col("main_lang"))
    models = language.train_models(articles, "id", "label", "content_text", agreed.select("id", "label"))
    texts = articles.select(F.lit("articles").alias("rec_kind"), F.col("id").cast("string").alias("rec_id"), F.col("content_text").alias("text")).unionByName(
        news.select(F.lit("news").alias("rec_kind"), F.col("id").alias("rec_id"), F.col("body_text").alias("text"))
    )
    # Texts are judged where they are; only their stretches meet the labels.
    return language.label_stretches(texts, "text", models, ["rec_kind", "rec_id"]).join(labels, ["rec_kind", "rec_id"], "left")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stretches of records whose label is missing or wrong, or which mix languages."""
    first = F.try_element_at("stretches", F.lit(1))["lang"]
    wrong = F.col("label").isNull() | (F.col("label") != first) | (F.size("stretches") > 1)
    cases = _judged(spark, sf_dir).where((F.col("n_words") >= language.MIN_WORDS) & (F.size("stretches") > 0) & wrong)
    return cases.select("rec_kind", "rec_id", F.posexplode("stretches").alias("pos", "s")).select("rec_kind", "rec_id", (F.col("pos") + 1).alias("seg_no"), F.col("s.lang").alias("lang"))


def p5_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch of every record, with its confidence."""
    return _judged(spark, sf_dir).select("rec_kind", "rec_id", F.posexplode("stretches").alias("pos", "s")).select(
        "rec_kind", "rec_id", (F.col("pos") + 1).alias("seg_no"), F.col("s.lang").alias("lang"), F.col("s.confidence").alias("confidence")
    )


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    targets = table(spark, sf_dir, "mix_targets")
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text").join(targets.select("source"), "source", "left_semi")
    sized = tokenizer.encode_texts(documents, "doc_id", "text", keep=("source",)).select("doc_id", "source", F.size("ids").alias("n_tokens"))
    return mixing.mix_sources(sized, targets, "doc_id", "source", "n_tokens")


def p9_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uses of documents in the order of the mix."""
    return _mixed(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of all tokens, by source."""
    return _mixed(spark, sf_dir)[1]


def _stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rec_kind, rec_id, portal_id, line) of the story paragraphs of pages and of articles that carry boilerplate."""
    pages = table(spark, sf_dir, "raw_ingest").where("raw_html is not null and raw_html <> ''").select("raw_id", "source_name", "raw_html")
    read = checkpointed(boilerplate.read_pages(pages, "raw_html", ["raw_id", "source_name"]))  # read by the vote, the dictionary and the extraction
    stories = boilerplate.with_story(read, boilerplate.winning_paths(read, "source_name"), "source_name")
    known = checkpointed(boilerplate.boilerplate_texts(stories, "source_name"))  # read to be counted and to be joined
    some = known.limit(MAX_BROADCAST_ROWS + 1).collect()
    shapes = boilerplate.story_shapes(stories)
    entries = _portal_entries(spark, sf_dir)
    from_pages = canonical.with_matches(stories.select(F.lit("raw_ingest").alias("rec_kind"), F.col("raw_id").alias("rec_id"), "source_name", "story"), "source_name", entries)
    from_pages = from_pages.select("rec_kind", "rec_id", F.try_element_at("matches", F.lit(1))["ref_id"].alias("portal_id"), F.explode("story").alias("line"))
    texts = _articles_with_portal(spark, sf_dir, ["title"])
    if len(some) <= MAX_BROADCAST_ROWS:
        from_texts = boilerplate.story_of_texts(texts, "content_text", "title", [(r.kind, r.text) for r in some], shapes, ["id", "portal_id"])
    else:
        from_texts = boilerplate.story_by_join(texts, "content_text", "title", known, shapes, ["id", "portal_id"])
    from_texts = from_texts.select(F.lit("articles").alias("rec_kind"), F.col("id").alias("rec_id"), "portal_id", F.explode("story").alias("line"))
    return from_pages.unionByName(from_texts)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """md5 of each story paragraph of pages, and of articles that also carry what surrounds stories."""
    found = _stories(spark, sf_dir).withColumn("h", F.xxhash64(lines.normal_line(F.col("line"))))
    # Lines of problem 7 are no story paragraphs.
    repeated = lines.frequent_lines(_articles_with_portal(spark, sf_dir), "portal_id", "content_text").select(F.col("source").alias("portal_id"), "h")
    some = repeated.limit(MAX_BROADCAST_ROWS + 1).collect()
    on = ["portal_id", "h"]
    if len(some) <= MAX_BROADCAST_ROWS:
        repeated = F.broadcast(spark.createDataFrame(some, repeated.schema))
    else:  # as in ``lines``: a repeated line is a hot key, so its records are spread
        on = [*on, "salt"]
        found = found.withColumn("salt", F.pmod(F.xxhash64("rec_id"), F.lit(lines.SALT)).cast("int"))
        repeated = repeated.select("*", F.explode(F.sequence(F.lit(0), F.lit(lines.SALT - 1))).alias("salt"))
    kept = found.join(repeated, on, "left_anti")
    return kept.select("rec_kind", "rec_id", F.md5(F.col("line").cast("binary")).alias("line_md5")).distinct()


def p4_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container paths that won each host's vote."""
    pages = table(spark, sf_dir, "raw_ingest").where("raw_html is not null and raw_html <> ''").select("raw_id", "source_name", "raw_html")
    won = boilerplate.winning_paths(boilerplate.read_pages(pages, "raw_html", ["raw_id", "source_name"]), "source_name")
    return won.select(F.col("w_host").alias("source_name"), F.array_join("paths", " | ").alias("paths"))


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p2_classes, p4_found, p4_paths, p5_found, p5_languages, p6_found, p6_unmatched, p7_found, p7_clean, p8_ids, p8_round_trip, p9_selection, p9_shares, p10_found, p10_rates)}
SQL: dict[str, str] = {}
