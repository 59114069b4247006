"""Lines that return in a great many documents of one source, and the documents without them.

Lines are normalised and hashed in the JVM. Each document contributes every hash once, so documents per (source, hash) are
plain counts with map-side partial aggregation: a hot source spreads over its lines, and a hot line is one row per task.
Frequent lines are few by proof (with a share of s, at most lines-per-document / s in each source), so they are broadcast
behind a check of their number, and joined by shuffle beyond it.

Defined results
    null or empty text, only blank lines ...... no lines; the text stays as it is
    null source ............................... left out of the counts and of the result
    a line twice in one document .............. counts once for the threshold; both places are reported and removed
    repeated documents (other id) ............. count as documents of their own
    extra columns of any name ................. not touched: only the named columns are read
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.session import MAX_BROADCAST_ROWS, checkpointed

MIN_DOCS, MIN_SHARE = 5, 0.05
#: Parts of a source or line where the frequent lines are too many to be broadcast.
SALT = 64


def normal_line(line: Column) -> Column:
    x = F.regexp_replace(line, "[ \\t\\u00a0]+", " ")
    return F.regexp_replace(F.trim(x), "[0-9]+", "0")


def numbered_lines(text: Column) -> Column:
    """Array of (hash, line) of the lines that aren't blank, in order."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t ", "")) > 0)
    return F.transform(lines, lambda x: F.struct(F.xxhash64(normal_line(x)).alias("h"), x.alias("line")))


def frequent_lines(docs: DataFrame, source: str, text: str, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
    """(source, h, n_docs, n_source) of the lines that at least ``min_docs`` documents and that share of them have."""
    rows = docs.where(F.col(source).isNotNull() & (F.length(text) > 0)).select(F.col(source).alias("source"), F.col(text).alias("t"))
    totals = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_source"))
    hashes = rows.select("source", F.explode(F.array_distinct(F.transform(numbered_lines(F.col("t")), lambda x: x["h"]))).alias("h"))
    counts = hashes.groupBy("source", "h").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= min_docs)
    return counts.join(totals, "source").where(F.col("n_docs") >= min_share * F.col("n_source"))


def repeated_places(docs: DataFrame, key: str, source: str, text: str, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
    """(key, line_no, line, n_docs) of every repeated line in its place; lines are numbered from 1 without blank ones."""
    frequent = frequent_lines(docs, source, text, min_docs, min_share)
    some = frequent.limit(MAX_BROADCAST_ROWS + 1).collect()
    on = ["source", "h"]
    lines = docs.where(F.col(source).isNotNull() & (F.length(text) > 0)).select(
        F.col(key).alias("key"), F.col(source).alias("source"), F.posexplode(numbered_lines(F.col(text))).alias("pos", "x")
    )
    lines = lines.select("key", "source", (F.col("pos") + 1).alias("line_no"), F.col("x.h").alias("h"), F.col("x.line").alias("line"))
    if len(some) <= MAX_BROADCAST_ROWS:
        frequent = F.broadcast(docs.sparkSession.createDataFrame(some, frequent.schema))
    else:  # a frequent line is a hot key by definition: its documents are spread, and the lines are sent to each part
        on = [*on, "salt"]
        lines = lines.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALT)).cast("int"))
        frequent = frequent.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    return lines.join(frequent, on).select(F.col("key").alias(key), "line_no", "line", "n_docs")


def without_repeated(docs: DataFrame, key: str, source: str, text: str, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
    """(key, clean_text, n_removed): texts without repeated lines; other lines and blank ones stay as they are."""
    frequent = checkpointed(frequent_lines(docs, source, text, min_docs, min_share))  # counted and joined
    per_source = frequent.groupBy("source").agg(F.collect_set("h").alias("hs"))  # bounded by lines per document / share
    base = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), F.col(text).alias("t"))
    if frequent.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        joined = base.join(F.broadcast(per_source), "source", "left")
    else:
        salted = per_source.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
        joined = base.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALT)).cast("int")).join(salted, ["source", "salt"], "left")
    hs = F.coalesce(F.col("hs"), F.array().cast("array<bigint>"))
    kept = F.filter(F.split("t", "\n"), lambda x: ~F.array_contains(hs, F.xxhash64(normal_line(x))) | (F.length(F.translate(x, " \t ", "")) == 0))
    n = F.size(F.split("t", "\n")) - F.size(kept)
    return joined.select(F.col("key").alias(key), F.array_join(kept, "\n").alias("clean_text"), F.coalesce(n, F.lit(0)).alias("n_removed"))
