"""Records that share nearly all their words, found by bands of minhashes and a bit-sliced comparison.

1. Each text is reduced to a class (the digest of its multiset of words), an odd sketch and minhashes of its multiset of words.
   Copies of one class are represented once from here on; each task passes on a class's sketch once, however often it meets it.
2. ``ROWS`` minhashes and a class of length make the key of a band. Buckets of one class are dropped. A bucket of more than
   ``BLOCK`` classes is cut into blocks of like length, and pairs of blocks whose lengths can reach the threshold are tasks of
   their own, so that no bucket has to fit into one task. Buckets that a sample shows to be hot are cut before they are
   gathered; the sample decides on the layout only, never on the result.
3. Within a task all sketches are compared at once: bit planes are stored vertically, one lane per record, shifted against
   themselves, and the differing bits are counted by carry-save adders. Blocks of lanes that all exceed their radius are
   abandoned between chunks of planes. The filter loses nothing: a differing word flips at most one bit of a sketch, so the
   distance of a true pair is at most the number of words that its texts do not share.
4. Pairs that are left are checked exactly on their words.

Similarity is the number of shared words, counted with repetition, over the word count of the longer text.

Defined results
    null text ................................ empty; under ``MIN_WORDS`` words, so no link
    under ``MIN_WORDS`` words, or U+FFFD ..... no link; in ``classes_with_links`` a class of exact copies of the text
    null or empty text there ................. a class of its own
    null key ................................. left out
    copies under other keys .................. linked like any pair; equal keys are not linked with themselves
    no records ............................... no links
    texts whose words are the same in another order ... one class
Only the bands can miss a pair, wherever its edits lie. A true pair with lengths in ratio q has a Jaccard similarity of the
multisets of at least 0.8 / (0.2 + q), and its lengths fall into one class with a chance of at least 1 - ln q / ln 0.8 /
``LENGTH_STEPS``; together the chance to miss it is greatest at q = 1 and similarity 0.8: (1 - (2/3)^ROWS)^BANDS = 0.0004. At a
similarity of 0.85 it is 0.000001.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslake.session import MAX_BROADCAST_ROWS, checkpointed, ship

THRESHOLD, MIN_WORDS = 0.8, 30
BANDS, ROWS = 56, 5
#: Width of a class of lengths, in steps of the threshold; every band has its own offset.
LENGTH_STEPS = 1.5
BITS, CHUNK, LANE_BLOCK = 512, 128, 64  # planes of a sketch, planes of a chunk, bytes of lanes that are abandoned together
BLOCK = 512
#: A bucket is hot if the sample, one class in ``SAMPLE``, has so many of it.
SAMPLE, HOT_IN_SAMPLE = 64, 512
#: Copies of one class are expanded in parts of so many.
PART = 1000
_WORDS = re.compile(r"[^ \t\n]+")
_OFFSETS = np.arange(BANDS) * 0.6180339887 % 1
_SEEDS = np.random.default_rng(20260101).integers(1, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def sketch(hashes: np.ndarray) -> tuple[bytes, bytes, np.ndarray]:
    """(digest of the multiset, odd sketch, band keys) of the word hashes of a text, in order. A band key has its number in front."""
    with np.errstate(over="ignore"):
        ordered = np.sort(hashes)
        first = np.r_[True, ordered[1:] != ordered[:-1]]
        place = np.arange(len(ordered)) - np.maximum.accumulate(np.where(first, np.arange(len(ordered)), 0))
        words = _mix(ordered + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        bits = (words >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)
        odd = np.packbits((np.bincount(bits, minlength=BITS) & 1).astype(np.uint8))
        least = ((words >> np.uint64(16)).astype(np.uint32)[None, :] * _SEEDS[:, None]).min(1).astype(np.uint64)
        keys = np.floor(np.log(len(words)) / -np.log(THRESHOLD) / LENGTH_STEPS + _OFFSETS).astype(np.uint64)
        for r in range(ROWS):
            keys = _mix(keys * np.uint64(0xC4CEB9FE1A85EC53) + least[r::ROWS])
    return hashlib.md5(ordered.tobytes()).digest(), odd.tobytes(), (keys >> np.uint64(32)).astype(np.uint32).view(np.int32)


class _Hashes(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known = _Hashes()
    told: set[bytes] = set()
    for pdf in batches:
        out = []
        for key, text in zip(pdf["key"], pdf["text"]):
            words = _WORDS.findall(text)
            if len(words) < MIN_WORDS:
                continue
            if len(known) > 500_000:  # keeps a worker's memory bounded
                known.clear()
            if len(told) > 500_000:
                told.clear()
            digest, odd, keys = sketch(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
            out.append((key, digest, len(words), *((None, None) if digest in told else (odd, keys))))
            told.add(digest)
        yield pd.DataFrame(out, columns=["key", "cls", "n", "odd", "bands"])


class Planes:
    """Bit planes of sketches, one lane per sketch, and their copies shifted by one to seven lanes."""

    def __init__(self, planes: np.ndarray):
        self.width = -(-planes.shape[1] // LANE_BLOCK) * LANE_BLOCK
        self.shifted = [np.zeros((len(planes), 2 * self.width + LANE_BLOCK), np.uint8)]
        self.shifted[0][:, : planes.shape[1]] = planes

    def _from(self, shift: int, blocks: int) -> np.ndarray:
        """(planes, blocks, bytes) of the lanes from ``shift`` on."""
        q, r = divmod(shift, 8)
        while len(self.shifted) <= r:
            last = self.shifted[-1]
            after = last << 1
            after[:, :-1] |= last[:, 1:] >> 7
            self.shifted.append(after)
        x = self.shifted[r][:, q:]
        return np.lib.stride_tricks.as_strided(x, (len(x), blocks, LANE_BLOCK), (x.strides[0], LANE_BLOCK, 1), writeable=False)

    def distances(self, shift: int, lanes: int, radius: np.ndarray) -> np.ndarray:
        """Bit distances of the first ``lanes`` lanes to those ``shift`` later; BITS + 1 where a block was abandoned."""
        blocks = -(-lanes // (LANE_BLOCK * 8))
        left, right = self._from(0, blocks), self._from(shift, blocks)
        limit = np.full(blocks * LANE_BLOCK * 8, -1, np.int16)
        limit[:lanes] = np.minimum(radius, BITS)
        limit = limit.reshape(blocks, -1)
        alive = np.flatnonzero((limit >= 0).any(1))
        total = np.full(limit.shape, BITS + 1, np.int16)
        total[alive] = 0
        for at in range(0, BITS, CHUNK):
            if not len(alive):
                break
            some = alive if len(alive) < blocks else slice(None)
            total[some] += _ones(left[at : at + CHUNK, some] ^ right[at : at + CHUNK, some])
            dead = ~(total[alive] <= limit[alive]).any(1)
            total[alive[dead]] = BITS + 1
            alive = alive[~dead]
        return total.ravel()[:lanes]


def _ones(level: np.ndarray) -> np.ndarray:
    """How many of at most 255 planes have each lane's bit, by carry-save adders; the planes are used up."""
    count, weight, n = np.zeros((level.shape[1], level.shape[2] * 8), np.uint8), 0, len(level)
    while n:
        carry, used = np.empty((n // 2, *level.shape[1:]), np.uint8), 0
        while n >= 3:  # full adders on whole planes: three of one weight give one, and a carry of twice the weight
            k = n // 3
            a, b, c, more = level[:k], level[k : 2 * k], level[2 * k : 3 * k], carry[used : used + k]
            ab = a ^ b
            np.bitwise_and(a, b, out=more)
            np.bitwise_and(ab, c, out=a)
            more |= a
            np.bitwise_xor(ab, c, out=a)
            level[k : k + n - 3 * k] = level[3 * k : n]
            used, n = used + k, k + n - 3 * k
        if n == 2:
            np.bitwise_and(level[0], level[1], out=carry[used])
            level[0] ^= level[1]
            used += 1
        count += np.unpackbits(level[0], axis=1) << weight
        level, n, weight = carry, used, weight + 1
    return count


def distances(planes: np.ndarray, shift: int, lanes: int, radius: np.ndarray) -> np.ndarray:
    return Planes(planes).distances(shift, lanes, radius)


def close_pairs(group: np.ndarray, odd: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within equal consecutive ``group`` values whose sketches are within their radius."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    order = np.argsort(-sizes, kind="stable")  # the larger groups first, so that active lanes are always a beginning
    size_of = np.repeat(sizes[order], sizes[order])
    place = np.arange(len(group)) - np.repeat(np.cumsum(sizes[order]) - sizes[order], sizes[order])
    lanes = np.repeat(starts[order], sizes[order]) + place
    left_over = (size_of - place).astype(np.int32)  # lanes to the end of the group
    length = n[lanes].astype(np.int32)
    need = np.ceil(THRESHOLD * length - 1e-9).astype(np.int32)  # words that a text of this length must share with a shorter one
    columns = np.ascontiguousarray(odd[lanes].T)
    planes = Planes(np.stack([np.packbits((columns >> (7 - k)) & 1, axis=1) for k in range(8)], axis=1).reshape(BITS, -1))
    left, right = [], []
    for shift in range(1, int(sizes.max())):
        active = int(np.searchsorted(-size_of, -shift, side="left"))  # lanes of groups with more than ``shift`` members
        m = min(active, len(lanes) - shift)
        if m <= 0:
            break
        a, b, share = length[:m], length[shift : shift + m], np.maximum(need[:m], need[shift : shift + m])
        radius = a + b - 2 * share
        radius[(left_over[:m] <= shift) | (np.minimum(a, b) < share)] = -1
        hit = np.flatnonzero(planes.distances(shift, m, radius) <= radius)
        left.append(lanes[hit])
        right.append(lanes[hit + shift])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.empty(0, int), np.empty(0, int))


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stream of rows sorted by task: pairs of classes within reach. A task that is open at a batch's end is carried on."""
    rest = None

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        odd = np.frombuffer(b"".join(pdf["odd"]), np.uint8).reshape(len(pdf), BITS // 8)
        i, j = close_pairs(pd.factorize(pdf["task"])[0], odd, pdf["n"].to_numpy())
        key, side = pdf["id"].to_numpy(), pdf["side"].to_numpy()
        # Pairs of one side of two blocks are found in a task of that block alone.
        cross = (key[i] != key[j]) & ((side[i] == 0) | (side[i] != side[j]))
        i, j = i[cross], j[cross]
        swap = key[i] > key[j]
        return pd.DataFrame({"id_a": key[np.where(swap, j, i)], "id_b": key[np.where(swap, i, j)]}).drop_duplicates()

    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        if pdf.empty:
            continue
        open_ = pdf["task"] == pdf["task"].iloc[-1]
        rest, ready = pdf[open_], pdf[~open_]
        if len(ready):
            yield pairs(ready.reset_index(drop=True))
    if rest is not None and len(rest) > 1:
        yield pairs(rest.reset_index(drop=True))


def shared_words(a: str, b: str) -> float:
    """Similarity of two texts by definition."""
    x, y = Counter(_WORDS.findall(a)), Counter(_WORDS.findall(b))
    return sum((x & y).values()) / max(x.total(), y.total(), 1)


def _exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        keep = [shared_words(a, b) >= THRESHOLD - 1e-12 for a, b in zip(pdf["text_a"], pdf["text_b"])]
        yield pdf.loc[keep, ["rep_a", "rep_b"]]


def _buckets(rows: DataFrame) -> DataFrame:
    """(bucket, id, size) of the buckets that hold several classes. A hot one keeps its estimated size and is never gathered."""
    hot = rows.where(F.pmod("id", F.lit(SAMPLE)) == 0).groupBy("bucket").agg((F.count(F.lit(1)) * SAMPLE).alias("size")).where(F.col("size") >= HOT_IN_SAMPLE * SAMPLE)
    hot = checkpointed(hot)
    few = len(hot.limit(MAX_BROADCAST_ROWS + 1).collect())
    cold = rows
    if few:
        hot = F.broadcast(hot) if few <= MAX_BROADCAST_ROWS else hot
        cold = rows.join(hot, "bucket", "left_anti")
    whole = Window.partitionBy("bucket")
    cold = cold.select("bucket", "id", F.count(F.lit(1)).over(whole).alias("size"), (F.min("id").over(whole) != F.max("id").over(whole)).alias("several")).where("several").drop("several")
    return cold.unionByName(rows.join(hot, "bucket").select(*cold.columns)) if few else cold


def _id(cls: str) -> Column:
    """A short name of a class. Two classes under one name only add candidates."""
    return F.xxhash64(cls).bitwiseAND(F.lit((1 << 48) - 1)).alias("id")


def _tasks(members: DataFrame) -> DataFrame:
    """(task, side, id, n, odd) of (bucket, size, id, n, odd): a bucket is one task, or pairs of blocks of like length."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("id", "bucket"), blocks).cast("int")
    step = F.floor(F.log(F.col("n").cast("double")) / float(-np.log(THRESHOLD))).cast("int")  # lengths within reach are at most one step apart
    task = lambda *of: F.xxhash64("bucket", *of)
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    of = lambda kind, lower, side: F.struct(task(F.lit(kind), *lower).alias("task"), side.cast("tinyint").alias("side"))
    zero = F.lit(0)
    within = F.transform(others, lambda o: of(0, (F.col("step"), F.least("block", o), F.greatest("block", o)), F.when(o == F.col("block"), 0).when(F.col("block") < o, 1).otherwise(2)))
    above = F.transform(others, lambda o: of(1, (F.col("step"), F.col("block"), o), F.lit(1)))
    below = F.transform(others, lambda o: of(1, (F.col("step") - 1, o, F.col("block")), F.lit(2)))
    x = members.select("bucket", "id", "n", "odd", blocks.alias("blocks"), block.alias("block"), step.alias("step"))
    whole = F.array(F.struct(F.xxhash64("bucket").alias("task"), zero.cast("tinyint").alias("side")))
    return x.select("id", "n", "odd", F.explode(F.when(F.col("blocks") == 1, whole).otherwise(F.concat(within, above, below))).alias("t")).select("t.task", "t.side", "id", "n", "odd")


def similar_classes(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For records (key, text): classes (cls, rep, n_copies), members (key, cls) and the links (rep_a, rep_b) between classes, rep_a < rep_b."""
    ship(records.sparkSession)
    base = records.select("key", "text").where(F.col("key").isNotNull() & (F.length("text") >= 2 * MIN_WORDS - 1) & ~F.col("text").contains("�"))
    sketches = checkpointed(base.mapInPandas(_sketches, "key string, cls binary, n int, odd binary, bands array<int>"))
    sketches = sketches.withColumn("id", _id("cls"))
    told = sketches.where("odd is not null")
    classes = sketches.groupBy("cls").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("n_copies"))

    bands = told.select("id", F.posexplode("bands").alias("band", "h"))
    bucket = F.shiftleft(F.col("band").cast("bigint"), 32).bitwiseOR(F.col("h").cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)))
    kept = _buckets(bands.select(bucket.alias("bucket"), "id"))
    reps = told.select("id", "cls", "n", "odd").repartition("id").groupBy("id", "cls").agg(F.first("n").alias("n"), F.first("odd").alias("odd"))
    placed = _tasks(kept.join(reps, "id")).repartition("task").sortWithinPartitions("task", "n")
    near = checkpointed(placed.mapInPandas(_compare, "id_a bigint, id_b bigint").distinct())

    involved = near.select(F.col("id_a").alias("id")).union(near.select("id_b")).distinct()
    small = involved.count() <= MAX_BROADCAST_ROWS
    wanted = classes.select(_id("cls"), "rep").join(F.broadcast(involved) if small else involved, "id", "left_semi")
    texts = base.join(F.broadcast(wanted) if small else wanted, base["key"] == wanted["rep"]).select("id", "rep", "text")
    both = near.join(texts.select(F.col("id").alias("id_a"), F.col("rep").alias("rep_a"), F.col("text").alias("text_a")), "id_a")
    both = both.join(texts.select(F.col("id").alias("id_b"), F.col("rep").alias("rep_b"), F.col("text").alias("text_b")), "id_b")
    return classes, sketches.select("key", "cls"), both.select("rep_a", "rep_b", "text_a", "text_b").mapInPandas(_exact, "rep_a string, rep_b string")


def similar_pairs(records: DataFrame) -> DataFrame:
    """(key_a, key_b) of all similar records, key_a < key_b: links between classes and copies within a class, expanded."""
    classes, members, links = similar_classes(records)
    several = classes.where("n_copies > 1")
    copies = members.join(several, "cls").select("rep", "key", F.ceil(F.col("n_copies") / PART).cast("int").alias("parts"))
    for end in ("a", "b"):
        links = links.join(copies.select(F.col("rep").alias(f"rep_{end}"), F.col("key").alias(f"key_{end}")), f"rep_{end}", "left").withColumn(f"key_{end}", F.coalesce(f"key_{end}", f"rep_{end}"))
    # A class of many copies is cut into parts, and every two of them meet in a group of their own.
    left = copies.withColumn("part", F.pmod(F.xxhash64("key"), "parts"))
    right = copies.select("rep", F.col("key").alias("other"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    within = left.join(right, ["rep", "part"]).where("key < other").select(F.col("key").alias("key_a"), F.col("other").alias("key_b"))
    return links.select("key_a", "key_b").unionByName(within).select(F.least("key_a", "key_b").alias("key_a"), F.greatest("key_a", "key_b").alias("key_b"))


def classes_with_links(records: DataFrame) -> DataFrame:
    """One row per record: (key, class_key, n_copies, n_links), links counted between different texts."""
    classes, members, links = similar_classes(records)
    ends = links.select(F.explode(F.array("rep_a", "rep_b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
    linked = members.join(classes.join(ends, "rep", "left"), "cls").select("key", F.col("rep").alias("class_key"), "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    # Texts that take no part: only their digests move. Without text there is nothing to be a copy of.
    rest = records.select("key", F.when(F.length("text") > 0, F.md5(F.col("text").cast("binary"))).alias("same")).join(members.select("key"), "key", "left_anti")
    rest = rest.withColumn("same", F.coalesce("same", F.concat(F.lit("key "), F.coalesce("key", F.lit("")))))
    alone = rest.groupBy("same").agg(F.min("key").alias("class_key"), F.count(F.lit(1)).alias("n_copies"))
    alone = rest.join(alone, "same").select("key", "class_key", "n_copies", F.lit(0).alias("n_links"))
    return linked.unionByName(alone)
