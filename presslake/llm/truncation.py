"""Texts that stop before their end, found by hashed logistic regression on how they close.

Positives are made: intact texts of a bounded sample are cut, at a length limit of their source or anywhere, inside or after
a word, and some get a mark of omission. Negatives are the sampled texts as they are, without those whose length is a limit
of their source. Features are tokens of the closing characters, the last line, the words since the last full stop, open
brackets and quotes, and whether the length is a limit; tokens are hashed to ``BUCKETS`` weights. All features and scores
are JVM expressions; only sampled rows of hashed numbers reach the driver, where the weights are fitted.

Defined results
    null, empty or blank text ................. not cut (score null)
    no text to learn from ..................... nothing is found
    a null title .............................. the text is taken for more than its title
    a null source ............................. takes part; it is a source of its own without limits
    repeated rows ............................. judged one by one, alike
    very long texts ........................... lengths are of the whole text
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.session import MAX_BROADCAST_ROWS, bounded_rows, checkpointed

#: Documented bound of the training sample, number of weights, steps and strength of the regularisation of the fit.
SAMPLE_ROWS, BUCKETS, STEPS, L2 = 12_000, 1 << 14, 200, 1e-4
#: Negatives that weights fitted without their fold score above this are taken for real cuts and left out.
FOLDS, SURELY_CUT = 3, 2.0
#: A length is a limit of its source if so many texts have it, and so many times the number that its neighbours let expect.
LIMIT_DOCS, LIMIT_RATIO, LIMIT_BLOCK = 5, 8.0, 64

# Marks of omission that cut texts may carry.
MARKS = ["", "", "", "", "…", " …", "...", " ...", " […]", " [...]", " [&hellip;]", "�", " &#6", "&am"]
_MARK = r"\s*(…|\.\.\.|\[(…|\.\.\.|&hellip;)\]|&#?\w{0,7}|�+)$"
_CLOSERS = r"[”\"»’')\]]"


def source_limits(docs: DataFrame, source: str, text: str) -> DataFrame:
    """(source, kind, n) of the lengths, in characters and in bytes, at which a source's texts pile up."""
    sizes = docs.where(F.length(text) > 0).select(
        F.col(source).alias("source"),
        F.explode(F.array(F.struct(F.lit("chars").alias("kind"), F.length(text).alias("size")), F.struct(F.lit("bytes").alias("kind"), F.octet_length(text).alias("size")))).alias("x"),
    )
    sizes = sizes.groupBy("source", "x.kind", "x.size").agg(F.count(F.lit(1)).alias("n"))
    blocks = sizes.groupBy("source", "kind", F.floor(F.col("size") / LIMIT_BLOCK).alias("block")).agg(F.sum("n").alias("in_block"))
    both = sizes.withColumn("block", F.floor(F.col("size") / LIMIT_BLOCK)).join(blocks, ["source", "kind", "block"])
    expected = (F.col("in_block") - F.col("n")) / (LIMIT_BLOCK - 1)
    return both.where((F.col("n") >= LIMIT_DOCS) & (F.col("n") >= LIMIT_RATIO * (expected + 0.25))).select("source", "kind", "size")


def _class(c: Column) -> Column:
    return (
        F.when(c == "", "none").when(c.rlike(r"^\p{Ll}"), "lower").when(c.rlike(r"^\p{L}"), "upper").when(c.rlike(r"^\p{N}"), "digit")
        .when(c.rlike(r"^\s"), "space").when(c.rlike(r"^[.!?]"), "stop").when(c.rlike("^" + _CLOSERS), "closer").otherwise(c)
    )


def with_features(df: DataFrame, text: str, at_chars: Column, at_bytes: Column, is_title: Column, out: str = "x") -> DataFrame:
    """Add ``out``: hashed feature tokens of a text; ``at_chars`` and ``at_bytes`` say whether its length is a limit,
    ``is_title`` whether the text is nothing but its title.

    Parts of the text are columns of their own, stage by stage, so that each is computed once for all tokens.
    """
    shape_of = lambda x: F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"\p{Lu}[\p{L}’'-]*", "X"), r"\p{Ll}[\p{L}’'-]*", "x"), r"[0-9]+", "9")
    count = lambda s, c: F.length(s) - F.length(F.replace(s, F.lit(c), F.lit("")))
    size = lambda x: F.least(F.size(F.filter(F.split(x, r"\s+"), lambda w: w != "")), F.lit(9)).cast("string")
    c = F.col
    x = df.withColumns({"f_limit": F.concat(F.when(at_chars, "c").otherwise(""), F.when(at_bytes, "b").otherwise("")), "f_title": is_title.cast("string"), "f_last": F.substring_index(c(text), "\n", -1)})
    x = x.withColumns({"f_mark": F.regexp_extract("f_last", _MARK, 1), "f_line": F.regexp_replace("f_last", _MARK, ""), "f_before": F.right(F.substr(c(text), F.lit(1), F.length(text) - F.length("f_last")), F.lit(3))})
    x = x.withColumns({
        "f_sep": F.when(F.trim(F.replace(c("f_before"), F.lit("\n"), F.lit(" "))) == F.lit(""), F.when(c("f_before") == "", "none").otherwise("two")).when(c("f_before").endswith("\n\n"), "two").otherwise("one"),
        "f_end": _class(F.right("f_line", F.lit(1))), "f_raw": _class(F.right(c(text), F.lit(1))),
        "f_tail": F.element_at(F.split("f_line", r"(?<=[.!?])" + _CLOSERS + r"?\s+"), -1),
        "f_word": F.lower(F.regexp_extract(F.right("f_line", F.lit(60)), r"([\p{L}\p{N}]+)[^\p{L}\p{N}]*$", 1)),
        "f_words": size(c("f_line")),
        "f_shape": F.when(F.length("f_line") <= 120, F.left(shape_of(c("f_line")), F.lit(40))).otherwise("long"),
        "f_start": F.when(c("f_line").rlike(r"^\s*#"), "tag").when(c("f_line").rlike("^https?:"), "link").when(c("f_line").rlike(r"^\s*([0-9]+[.)]|[-•*])"), "item").otherwise(_class(F.left("f_line", F.lit(1)))),
        "f_open": (count(c("f_line"), "“") > count(c("f_line"), "”")) | (count(c("f_line"), "«") > count(c("f_line"), "»")) | (count(c("f_line"), "(") > count(c("f_line"), ")")),
        "f_short": F.when(F.length(text) <= 120, "short").otherwise("long"),
    })
    x = x.withColumns({
        "f_closed": F.when(c("f_tail").rlike(r"^\(.*\)$"), "group").when(c("f_end").isin("stop", "closer"), "ended").otherwise("open"),
        "f_tails": F.when(c("f_end").isin("stop"), "0").otherwise(size(c("f_tail"))),
        "f_tshape": F.when(F.length("f_tail") <= 60, shape_of(c("f_tail"))).otherwise("long"),
        "f_marked": (c("f_mark") != "").cast("string"),
    })
    tok = lambda name, *cols: F.concat_ws("|", F.lit(name), *[F.col(f"f_{y}").cast("string") for y in cols])
    tokens = [
        tok("bias"), tok("raw", "raw"), tok("end", "end"), tok("mark", "mark"), tok("mark-end", "marked", "end"), tok("sep", "sep"), tok("sep-words", "sep", "words"),
        tok("shape", "sep", "shape"), tok("start", "sep", "start"), tok("tail", "tails", "end"), tok("tail-shape", "tshape"), tok("closed", "closed", "end"), tok("opened", "open"),
        tok("last", "word"), tok("last-end", "word", "marked"), tok("limit", "limit"), tok("limit-end", "limit", "end"), tok("short", "short", "sep"), tok("short-end", "short", "sep", "end"),
        tok("sep-end", "sep", "start", "end"), tok("mark-tail", "marked", "tails", "word"), tok("title", "title"), tok("title-end", "title", "end"),
    ]
    return x.withColumn(out, F.array(*[F.pmod(F.xxhash64(t), F.lit(BUCKETS)).cast("int") for t in tokens])).select(*df.columns, out)


def _logistic(x: np.ndarray, y: np.ndarray, steps: int) -> np.ndarray:
    """Weights by full-batch Adam; both classes weigh the same, and the same rows give the same weights."""
    w, m, v = np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(BUCKETS)
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-w[x].sum(1)))
        g = np.bincount(x.ravel(), np.repeat((p - y) * share, x.shape[1]), BUCKETS) + L2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def fit_weights(rows: list[tuple[list[int], int]]) -> np.ndarray:
    """Weights of the hashed tokens. The negatives are texts as they are, so some of them are cut: those are found fold by fold."""
    if not rows:
        return np.zeros(BUCKETS)
    x = np.array([r[0] for r in rows], np.int64)
    y = np.array([r[1] for r in rows], float)
    keep, fold = np.ones(len(y), bool), np.arange(len(y)) % FOLDS  # rows come sorted, so that like rows are in all folds
    for k in range(FOLDS):
        other = fold != k
        if 0 < y[other].sum() < other.sum():
            keep[(fold == k) & (y == 0) & (_logistic(x[other], y[other], STEPS // 2)[x].sum(1) > SURELY_CUT)] = False
    return _logistic(x[keep], y[keep], STEPS)


def score_texts(df: DataFrame, key: str, source: str, text: str, title: str) -> DataFrame:
    """(key, source, score): positive where the text is taken for cut off; null for null and blank texts."""
    spark = df.sparkSession
    docs = df.select(F.col(key).alias("k"), F.col(source).alias("source"), F.when(F.col(text).rlike(r"[^\s\u00a0]"), F.col(text)).alias("t"), F.trim(title).alias("title"))
    # The limits of a source are a few lengths; they meet its texts in a join, broadcast only where there are few sources.
    sizes = lambda kind: F.collect_list(F.when(F.col("kind") == kind, F.col("size"))).alias(f"at_{kind}")
    limits = checkpointed(source_limits(docs, "source", "t").groupBy("source").agg(sizes("chars"), sizes("bytes")))
    few = len(limits.select("source").limit(MAX_BROADCAST_ROWS + 1).collect()) <= MAX_BROADCAST_ROWS
    docs = docs.join(F.broadcast(limits) if few else limits, "source", "left")
    at = lambda t, kind: F.coalesce(F.array_contains(F.col(f"at_{kind}"), F.length(t) if kind == "chars" else F.octet_length(t)), F.lit(False))
    features = lambda x, t: with_features(x, t, at(F.col(t), "chars"), at(F.col(t), "bytes"), F.coalesce(F.trim(t) == F.col("title"), F.lit(False)))

    # The sample: as many rows as the bound allows, by hash of the key.
    some = docs.where(F.col("t").isNotNull())
    n = some.count()
    draw = lambda seed, m: F.pmod(F.xxhash64(F.col("k"), F.lit(seed)), F.lit(m))
    if n > SAMPLE_ROWS:
        some = some.where(draw(1, 1_000_000) < int(1_000_000 * SAMPLE_ROWS / n))
    size = F.length("t")
    to_limit = F.array_min(F.filter("at_chars", lambda c: c < size))
    place = F.when((draw(2, 2) == 0) & to_limit.isNotNull(), to_limit).otherwise((size * (20 + draw(3, 75)) / 100).cast("int"))
    cut = F.substr("t", F.lit(1), F.greatest(place, F.lit(1)))
    cut = F.when(draw(4, 3) == 0, F.regexp_replace(cut, r"\s+\S*$", "")).otherwise(cut)
    cut = F.concat(cut, F.element_at(F.array(*[F.lit(m) for m in MARKS]), (draw(5, len(MARKS)) + 1).cast("int")))
    intact = F.col("t").rlike(r"[.!?]" + _CLOSERS + "?$") & ~F.col("t").rlike(_MARK) & (size >= 200)
    at_limit = at(F.col("t"), "chars") | at(F.col("t"), "bytes")
    # A cut that happens to close a sentence is nothing to learn from.
    made = some.where(intact & ~at_limit).withColumn("cut", cut).where(~F.regexp_replace("cut", _MARK, "").rlike(r"[.!?]" + _CLOSERS + r"?\s*$"))
    negative = features(some.where(~at_limit), "t").select("x", F.lit(0).alias("y"))
    positive = features(made, "cut").select("x", F.lit(1).alias("y"))
    rows = bounded_rows(negative.unionByName(positive), 3 * SAMPLE_ROWS, "training rows")
    weights = fit_weights(sorted((list(r.x), r.y) for r in rows))
    literal = F.from_json(F.lit(json.dumps([round(float(w), 6) for w in weights])), "array<double>")
    scored = features(docs.where(F.col("t").isNotNull()), "t")
    total = F.aggregate("x", F.lit(0.0), lambda a, i: a + F.element_at(literal, i + 1))
    blank = docs.where(F.col("t").isNull()).select(F.col("k").alias(key), F.col("source").alias(source), F.lit(None).cast("double").alias("score"))
    return scored.select(F.col("k").alias(key), F.col("source").alias(source), total.alias("score")).unionByName(blank)


def cut_off(scored: DataFrame) -> DataFrame:
    """The rows of a scored table that are taken for cut off.

    A plain filter would be pushed below the features and repeat them for every use; a generator stays where it is.
    """
    row = F.struct(*scored.columns)
    return scored.select(F.explode(F.filter(F.array(row), lambda r: r["score"] > 0)).alias("r")).select("r.*")


def truncation_rates(scored: DataFrame, source: str) -> DataFrame:
    """(source, n_texts, n_cut, share) of every source."""
    cut = F.count_if(F.col("score") > 0)
    n = F.count("score")
    return scored.groupBy(source).agg(n.alias("n_texts"), cut.alias("n_cut"), F.when(n > 0, F.round(cut / n, 6)).alias("share"))
