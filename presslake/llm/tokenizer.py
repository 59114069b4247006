"""Byte-level BPE of a public vocabulary, run inside the JVM on distinct words.

A text is split into words by the vocabulary's pattern. Words are counted, and each distinct word is encoded once by a fold
of ranked merges (higher-order functions over its bytes, written as one-byte characters). The ranks are one constant: an array
of hash buckets of small maps, so that a lookup does not depend on the size of the vocabulary.

Texts are then put together again on two ways that give the same ids. The ``COMMON_WORDS`` most frequent words, a fixed
number whatever the corpus, are a constant of the same form and need no shuffle. All other words are joined to the table of
encoded words by shuffle; none of them is hot, since each is rarer than every common word, and a document sends each only
once.

Defined results
    null or empty text ................. empty list
    blank text ......................... the ids of its white space
    special tokens written in a text ... ordinary text
    repeated rows ...................... each gets its ids; keys need not be unique where ``encode_texts`` adds a column
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.session import bounded_rows, checkpointed, free_name

TOKENIZER_DIR = "/opt/tokenizers"
RANK_BUCKETS = 16_384
#: Size of the literal of frequent words, and the longest word in it, which bound it together.
COMMON_WORDS, COMMON_BUCKETS, COMMON_LENGTH = 16_384, 8_192, 64

# Fixed value: the pattern of the vocabulary, white space written out because Java's \s knows only ASCII.
_SPACE = "\\t-\\r \\u0085\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


@lru_cache(maxsize=4)
def load_ranks(name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> dict[bytes, int]:
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _table(text: str, kind: str) -> Column:
    """A constant of JSON text; the optimizer reads it once."""
    return F.from_json(F.lit(text), kind)


def _with(constant: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a constant, which stands in the plan once however often the body uses it."""
    return F.element_at(F.transform(F.array(constant), body), 1)


def _rank_table(ranks: dict[bytes, int]) -> Column:
    """Array of ``RANK_BUCKETS`` maps from pieces to ranks; a piece is in the map that its CRC names."""
    maps: list[str] = ["{}"] * RANK_BUCKETS
    for piece, rank in ranks.items():
        key = piece.decode("latin-1")
        slot = zlib.crc32(key.encode()) % RANK_BUCKETS
        entry = f"{json.dumps(key)}:{rank}"
        maps[slot] = "{" + entry + "}" if maps[slot] == "{}" else maps[slot][:-1] + "," + entry + "}"
    return _table("[" + ",".join(maps) + "]", "array<map<string,int>>")


def words_of(text: Column) -> Column:
    """The words that merges never cross, in order; their concatenation is the text."""
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def encode_word(word: Column, ranks: Column) -> Column:
    """Token ids of one word: a fold that merges the neighbours of least rank, leftmost first, until none has a rank."""
    return _with(ranks, lambda table: _fold(word, table))


def _fold(word: Column, table: Column) -> Column:
    rank = lambda piece: F.try_element_at(F.element_at(table, (F.crc32(F.encode(piece, "UTF-8")) % RANK_BUCKETS + 1).cast("int")), piece)
    raw = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")

    def merge(pieces: Column, _: Column) -> Column:
        # The pairs' ranks are bound once per step, as the single element of an array that transform() runs over.
        pairs = F.transform(F.sequence(F.lit(1), F.size(pieces) - 1), lambda i: rank(F.concat(F.element_at(pieces, i), F.element_at(pieces, i + 1))))
        step = F.transform(F.array(pairs), lambda r: F.transform(F.array(F.coalesce(F.array_position(r, F.array_min(r)), F.lit(0)).cast("int")), lambda j: F.when(
            j > 0,
            F.concat(F.slice(pieces, F.lit(1), j - 1), F.array(F.concat(F.element_at(pieces, F.greatest(j, F.lit(1))), F.element_at(pieces, F.greatest(j, F.lit(1)) + 1))), F.slice(pieces, j + 2, F.size(pieces))),
        ))[0])[0]
        # A null step ends the merging: the state is kept, with an empty piece at its end as the mark of it.
        done = F.element_at(pieces, -1) == ""
        return F.when(done | (F.size(pieces) < 2), pieces).otherwise(F.coalesce(step, F.concat(pieces, F.array(F.lit("")))))

    start = F.split(raw, "")
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(raw) - 1, F.lit(1))), start, merge, lambda p: F.transform(F.filter(p, lambda x: x != ""), rank))


def vocabulary(texts: DataFrame, text: str, ranks: dict[bytes, int]) -> DataFrame:
    """(word, n, ids) of every distinct word of the corpus, written to the checkpoint folder because it is used twice."""
    words = texts.where(F.length(text) > 0).select(F.explode(words_of(F.col(text))).alias("word"))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return checkpointed(counted.select("word", "n", encode_word(F.col("word"), _rank_table(ranks)).alias("ids")))


def _short_plans(df: DataFrame) -> None:
    """Let descriptions of plans end where they get long, unless the session says how long: the constants make them many MB,
    of which the driver keeps one for every job."""
    conf = df.sparkSession.conf
    said = conf.get("spark.sql.maxPlanStringLength").lower()
    if said.rstrip("b").isdigit() and int(said.rstrip("b")) > 1 << 30:
        conf.set("spark.sql.maxPlanStringLength", str(1 << 17))


def encode_texts(df: DataFrame, key: str, text: str, out: str = "ids", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, keep..., out) with the token ids of ``text``; ``key`` must be unique, ``keep`` must not be named k, t or m."""
    _short_plans(df)
    ranks = load_ranks(tokenizer, folder)
    docs = df.select(F.col(key).alias("k"), F.col(text).alias("t"), *keep)
    vocab = vocabulary(docs, "t", ranks)
    # Buckets of common words go by Spark's own hash of the word, which needs no copy of its bytes.
    slot = lambda w: F.pmod(F.hash(w), F.lit(COMMON_BUCKETS))
    top = vocab.where(F.length("word") <= COMMON_LENGTH).orderBy(F.desc("n"), "word").limit(COMMON_WORDS)
    # The buckets are written as JSON by Spark: the driver holds one string for each, not the words and their ids.
    texts = top.groupBy(slot(F.col("word")).alias("slot")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("word", "ids")))).alias("j"))
    maps = ["{}"] * COMMON_BUCKETS
    for r in bounded_rows(texts, COMMON_WORDS, "common words"):
        maps[r.slot] = r.j
    common = _table("[" + ",".join(maps) + "]", "array<map<string,array<int>>>")
    known = lambda t, w: F.try_element_at(F.element_at(t, slot(w) + 1), w)
    unknown = _with(common, lambda t: F.filter(words_of(F.col("t")), lambda w: known(t, w).isNull()))
    rare = docs.where(F.length("t") > 0).select("k", F.explode(F.array_distinct(unknown)).alias("word"))
    joined = rare.join(vocab.select("word", "ids"), "word").groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("word", "ids"))).alias("m"))
    # The text is what the join moves, not its ids, which take several times its bytes.
    done = docs.join(joined, "k", "left")
    ids = _with(common, lambda t: F.flatten(F.transform(words_of(F.coalesce("t", F.lit(""))), lambda w: F.coalesce(known(t, w), F.try_element_at(F.col("m"), w)))))
    return done.select(F.col("k").alias(key), *keep, F.coalesce(ids, F.array().cast("array<int>")).alias(out))


def decode_ids(df: DataFrame, ids: str, out: str = "decoded", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> DataFrame:
    """Add ``out``: the text of a list of ids, by concatenation of their binary pieces; null ids give null."""
    ranks = load_ranks(tokenizer, folder)
    pieces = [""] * (max(ranks.values()) + 1)
    for piece, i in ranks.items():
        pieces[i] = piece.hex()
    table = _table(json.dumps(pieces), "array<string>")
    name = free_name(df, "hex")
    hexed = df.withColumn(name, _with(table, lambda t: F.array_join(F.transform(ids, lambda i: F.element_at(t, i + 1)), "")))
    return hexed.withColumn(out, F.decode(F.unhex(F.col(name)), "UTF-8")).drop(name)
