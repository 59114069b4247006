"""Keyed merges of candidates, articles and messages: single aggregations with map-side combine, no row-wise Python."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslake.functions import text
from presslake.session import checkpointed, free_name


def _first_filled(col: str, order: Column) -> Column:
    """The earliest value that isn't null or '' ('' if there is none)."""
    filled = F.col(col).isNotNull() & (F.col(col) != "")
    return F.coalesce(F.min_by(F.when(filled, F.col(col)), F.when(filled, order)), F.lit("")).alias(col)


def merge_candidates(candidates: DataFrame, key: list[str], order: str, first: list[str], ids: list[str], last: list[str], sets: list[str]) -> DataFrame:
    """One row per key: earliest non-empty ``first``, earliest non-null ``ids``, latest non-empty ``last``, sorted union of ``sets``.

    ``min_by`` over the arrival number needs no sort and combines on the map side, so a hot key is reduced before the shuffle.
    """
    o = F.col(order)
    # A list by key may be long only by the number of its distinct labels.
    union = [F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in sets]
    return candidates.groupBy(*key).agg(
        *[_first_filled(c, o) for c in first],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), o)).alias(c) for c in ids],
        *[F.coalesce(F.max_by(F.when(F.col(c) != "", F.col(c)), F.when(F.col(c) != "", o)), F.lit("")).alias(c) for c in last],
        *union,
        F.count(F.lit(1)).alias("n_merged"),
    )


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of every key, as an aggregation of structs (partial before the shuffle, no window)."""
    return _keep(df, key, order, F.min_by)


def keep_last(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    return _keep(df, key, order, F.max_by)


def _keep(df: DataFrame, key: list[str], order: list[str], pick) -> DataFrame:
    return df.groupBy(*key).agg(pick(F.struct(*df.columns), F.struct(*order)).alias("r")).select("r.*")


def upsert(base: DataFrame, delta: DataFrame, key: list[str], order: list[str], keep_from_base: list[str] = []) -> DataFrame:  # noqa: B006
    """``base`` after ``delta``: the last row of a key in ``delta`` replaces the base row, except for ``keep_from_base``.

    ``action`` tells inserted, updated and unchanged keys. Columns of ``delta`` are those of ``base``.
    """
    new = keep_last(delta, key, order)
    # Null is a value of a key like any other; a mark of each side tells whether it is there.
    b, d = base.withColumn("there", F.lit(True)).alias("b"), new.withColumn("there", F.lit(True)).alias("d")
    both = b.join(d, reduce(lambda x, y: x & y, [F.col(f"b.{k}").eqNullSafe(F.col(f"d.{k}")) for k in key]), "full")
    in_b, in_d = (F.coalesce(F.col(f"{s}.there"), F.lit(False)) for s in "bd")
    value = lambda c: F.when(~in_d, F.col(f"b.{c}")).when(~in_b, F.col(f"d.{c}")).otherwise(F.coalesce(f"b.{c}", f"d.{c}") if c in keep_from_base else F.col(f"d.{c}"))
    action = F.when(~in_d, "unchanged").when(~in_b, "inserted").otherwise("updated")
    return both.select(*[value(c).alias(c) for c in base.columns], action.alias("action"))


def merge_versions(df: DataFrame, key: list[str], order: list[str], keep_first_of: list[str], keep_last_of: list[str]) -> DataFrame:
    """A whole history merged per key: some columns from the first version, the others from the last."""
    o = F.struct(*order)
    return df.groupBy(*key).agg(*[F.min_by(c, o).alias(c) for c in keep_first_of], *[F.max_by(c, o).alias(c) for c in keep_last_of], F.count(F.lit(1)).alias("n_versions"))


def insert_missing(base: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``new`` whose key ``base`` lacks."""
    return new.join(base.select(*key), key, "left_anti")


def carried(df: DataFrame, source: str, order: list[str], running: dict[str, Column]) -> DataFrame:
    """Add ``pos`` (place within the source, from 1) and running maxima in order of arrival, without gathering a source in one task.

    Rows are cut into ranges of (source, order); windows run within a range, and what the ranges before it add up to, one row
    for each range and source, is joined to it. Expressions of ``running`` may use ``pos``; a maximum of structs that begin
    with ``pos`` is the last value.
    """
    part, here = free_name(df, "range"), free_name(df, "here")
    cut = checkpointed(df.repartitionByRange(source, *order).withColumn(part, F.spark_partition_id()))
    local = Window.partitionBy(source, part).orderBy(*order)
    before_it = Window.partitionBy(here).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # over one row a range and source
    sizes = cut.groupBy(F.col(source).alias(here), part).agg(F.count(F.lit(1)).alias("n_before"))
    before = sizes.select(here, part, F.coalesce(F.sum("n_before").over(before_it), F.lit(0)).alias("n_before"))
    placed = cut.withColumn("pos", F.row_number().over(local).cast("bigint"))
    placed = placed.join(before, placed[source].eqNullSafe(before[here]) & (placed[part] == before[part]), "left").drop(before[part]).drop(here)
    placed = placed.withColumn("pos", F.col("pos") + F.col("n_before")).drop("n_before")
    if not running:
        return placed.drop(part)
    placed = placed.withColumns({f"of_{k}": v for k, v in running.items()})
    inside = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = placed.groupBy(F.col(source).alias(here), part).agg(*[F.max(f"of_{k}").alias(f"all_{k}") for k in running])
    last = last.select(here, part, *[F.max(f"all_{k}").over(before_it).alias(f"all_{k}") for k in running])
    both = placed.withColumns({f"in_{k}": F.max(f"of_{k}").over(inside) for k in running})
    both = both.join(last, both[source].eqNullSafe(last[here]) & (both[part] == last[part]), "left").drop(last[part]).drop(here)
    both = both.withColumns({k: F.when(F.col(f"in_{k}").isNull(), F.col(f"all_{k}")).when(F.col(f"all_{k}").isNull(), F.col(f"in_{k}")).otherwise(F.greatest(f"in_{k}", f"all_{k}")) for k in running})
    return both.drop(part, *[f"{x}_{k}" for x in ("of", "in", "all") for k in running])


def running_checkpoint(df: DataFrame, source: str, order: list[str], value: str) -> DataFrame:
    """The highest value so far, per source in order of arrival."""
    return carried(df, source, order, {"checkpoint": F.col(value)}).drop("pos")


def chunks(df: DataFrame, source: str, order: list[str], size: int) -> DataFrame:
    """Add ``chunk``: rows of a source in order, in chunks of so many."""
    return carried(df, source, order, {}).withColumn("chunk", F.floor((F.col("pos") - 1) / size)).drop("pos")


def empty_streaks(df: DataFrame, source: str, order: str, filled: Column) -> DataFrame:
    """Length of the run of empty rows that ends at each row, 0 on rows that aren't empty."""
    rows = carried(df.withColumn("filled", filled), source, [order], {"seen": F.when(F.col("filled"), F.col("pos"))})
    return rows.withColumn("streak", F.col("pos") - F.coalesce("seen", F.lit(0))).drop("filled", "seen", "pos")


def repeated_signatures(pages: DataFrame, source: str, page: str, signature: str) -> DataFrame:
    """Whether a page's signature equals that of the last page before it that has one."""
    has = F.coalesce(F.col(signature), F.lit("")) != ""
    # The page before: what it has been told up to it is joined to the next place.
    rows = carried(pages, source, [page], {"seen": F.when(has, F.struct("pos", F.col(signature).alias("s")))})
    told = rows.select(F.col(source).alias("told_source"), (F.col("pos") + 1).alias("told_pos"), F.col("seen.s").alias("before"))
    both = rows.join(told, rows[source].eqNullSafe(told["told_source"]) & (rows["pos"] == told["told_pos"]), "left")
    return both.withColumn("repeated", F.coalesce(has & (F.col(signature) == F.col("before")), F.lit(False))).drop("seen", "pos", "told_source", "told_pos", "before")


def normalized_payload(messages: DataFrame, body: str, media: Column, title: Column) -> DataFrame:
    """Add title, body, missing fields, flags, status and hash of messages; the body column is replaced by the normalized one."""
    x = messages.withColumns({"title": text.message_title(title, F.col(body), media), "no_caption": (text.normalize_whitespace(F.col(body)) == "") & (text.normalize_whitespace(media) != "")})
    x = x.withColumn("body_text", text.media_body(F.col(body), media))
    no_title, no_body = F.col("title") == "", F.col("body_text") == ""
    return x.withColumns({
        "missing_fields": F.concat_ws(",", F.when(no_title, "title"), F.when(no_body, "body_text")),
        "quality_flags": F.concat_ws(",", F.when(no_title, "title_missing"), F.when(no_body, "body_missing"), F.when(F.col("no_caption"), "media_without_caption")),
        "parse_status": F.when(no_title & no_body, "raw_only").when(no_title | no_body, "partial_success").otherwise("success"),
        "content_hash": text.message_hash(F.col("title"), F.col("body_text")),
    }).drop("no_caption")


def apply_normalized(store: DataFrame, payloads: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """The store with ``fields`` of the payload of the same key, where there is one; keys of payloads are unique."""
    p = payloads.select(*key, *[F.col(f).alias(f"new_{f}") for f in fields], F.lit(True).alias("applied"))
    x = store.join(p, key, "left")
    return x.withColumns({f: F.when(F.col("applied"), F.col(f"new_{f}")).otherwise(F.col(f)) for f in fields}).drop(*[f"new_{f}" for f in fields]).withColumn("applied", F.coalesce("applied", F.lit(False)))


def set_states(sources: DataFrame, changes: DataFrame, key: str, state: str) -> DataFrame:
    """The sources whose state is set, with the new one; unknown keys give no row."""
    return sources.drop(state).join(changes.select(key, state), key)


def reset_content(articles: DataFrame, records: DataFrame, kind: str, checkpoint: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(articles, records, counts) after a reset: no articles, no news, checkpoints at 0; the counts are those before."""
    n = articles.agg(F.count(F.lit(1)).alias("n")).select(F.lit("articles").alias("what"), "n").unionByName(
        records.groupBy(F.when(F.col(kind) == "source", "sources").otherwise("news").alias("what")).agg(F.count(F.lit(1)).alias("n"))
    )
    return articles.limit(0), records.where(F.col(kind) == "source").withColumn(checkpoint, F.lit(0)), n
