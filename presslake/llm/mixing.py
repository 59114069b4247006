"""One selection of documents in which every source has its target share of all tokens, interleaved by Pfair scheduling.

The total is the largest at which every source can give its share within its repeats. Each source's documents are laid out
in hash order, pass after pass, until its quota is filled; the last document is taken if more than half of it fits.
The order of the selection is a Pfair schedule: the total is cut into ``SLOTS`` blocks, block j of a source of weight w is
released at slot floor(j / w) and due at ceil((j + 1) / w), and in every slot the released block with the earliest deadline
goes next. So at any slot each source is less than one block away from its share.

Only sums per source (and per source and hash bucket) are gathered; the schedule has a fixed number of slots, whatever the
corpus, and documents find their slot by a join with it.

Defined results
    null, empty texts (size 0 or null) ....... take no part
    sources without a target ................. take no part
    targets without documents, share 0 or null, or without repeats ... get nothing; the other shares are scaled to add up to 1
    no documents or no targets ............... an empty selection
    ties in hash order ....................... by key
"""

from __future__ import annotations

from fractions import Fraction
from heapq import heappop, heappush

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presslake.session import bounded_rows, checkpointed

#: Bound of the list of targets; a source needs a slot, so more than ``SLOTS`` could not be served.
MAX_SOURCES = 1000
SLOTS = 10_000
HASH_BUCKETS = 4096


def pfair_schedule(weights: dict[str, float], slots: int = SLOTS) -> list[tuple[int, str, int]]:
    """(slot, source, block) in order of slots: earliest deadline first among released blocks."""
    total = sum(Fraction(w).limit_denominator(10**6) for w in weights.values() if w > 0)
    share = {s: Fraction(w).limit_denominator(10**6) / total for s, w in weights.items() if w > 0}
    waiting, ready, out = [], [], []
    for s, w in sorted(share.items()):
        heappush(waiting, (0, s, 0))
    for slot in range(slots):
        while waiting and waiting[0][0] <= slot:
            _, s, j = heappop(waiting)
            due = -(-(j + 1) * share[s].denominator // share[s].numerator)
            # Of blocks due together, one whose next block's window overlaps goes first.
            overlap = ((j + 1) * share[s].denominator) % share[s].numerator == 0
            heappush(ready, (due, overlap, -share[s], s, j))
        if not ready:
            continue
        _, _, _, s, j = heappop(ready)
        out.append((slot, s, j))
        heappush(waiting, ((j + 1) * share[s].denominator // share[s].numerator, s, j + 1))
    return out


def mix_sources(docs: DataFrame, targets: DataFrame, key: str, source: str, size: str, target: str = "target_share", repeats: str = "max_repeats", slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """(selection, shares).

    selection: (slot, place, source, key, copy_no, size), one row per use of a document, to be read in order of slot and
    place. shares: (source, target_share, n_docs, n_uses, n_size, actual_share), one row per target.
    """
    spark = docs.sparkSession
    rows = bounded_rows(targets.select(F.col(source).alias("s"), F.col(target).alias("w"), F.col(repeats).alias("r")), MAX_SOURCES, "targets")
    want = {r.s: (float(r.w), int(r.r)) for r in rows if r.s is not None and r.w and r.w > 0 and r.r and r.r > 0}
    sized = docs.select(F.col(key).alias("k"), F.col(source).alias("s"), F.col(size).cast("bigint").alias("n")).where((F.col("n") > 0) & F.col("s").isin(list(want) or [""]))
    sized = checkpointed(sized.withColumn("h", F.xxhash64(F.col("k").cast("string"))).withColumn("b", F.pmod(F.shiftright("h", 40), F.lit(HASH_BUCKETS))))
    sums = sized.groupBy("s", "b").agg(F.sum("n").alias("n"))
    total = {r.s: r.n for r in bounded_rows(sums.groupBy("s").agg(F.sum("n").alias("n")), MAX_SOURCES, "source totals")}
    alive = {s: want[s][0] for s in total}
    scale = sum(alive.values())
    whole = min((total[s] * want[s][1] * scale / alive[s] for s in alive), default=0.0)
    quota = spark.createDataFrame([(s, int(alive[s] / scale * whole), total[s], want[s][1]) for s in sorted(alive)], "s string, quota bigint, total bigint, r int")

    # Where each hash bucket begins in its source, then where each document begins in its bucket: no window spans a source.
    begins = sums.withColumn("begin", F.sum("n").over(Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)))
    begins = begins.select("s", "b", F.coalesce("begin", F.lit(0)).alias("begin"))
    inner = Window.partitionBy("s", "b").orderBy("h", "k").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("inside", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(begins, ["s", "b"]).join(F.broadcast(quota), "s")
    # How many passes reach a document follows from its place; only uses that count are made.
    placed = placed.withColumn("at", F.col("begin") + F.col("inside"))
    uses = F.least(F.floor((F.col("quota") - F.col("n") / 2 - F.col("at")) / F.col("total")) + 1, F.col("r").cast("bigint")).cast("int")
    used = placed.withColumn("uses", uses).where("uses > 0").select("s", "k", "n", "total", "at", F.explode(F.sequence(F.lit(0), F.col("uses") - 1)).alias("copy"))
    used = used.withColumn("at", F.col("at") + F.col("copy") * F.col("total"))

    block = max(whole / slots, 1e-9)
    schedule = spark.createDataFrame(pfair_schedule(alive, slots) or [(0, "", 0)], "slot int, s string, j int")
    last = schedule.groupBy("s").agg(F.max("j").alias("last"))
    # The rounding of the last quota can pass the last block by less than one document: it stays in that block.
    used = used.join(F.broadcast(last), "s").withColumn("j", F.least(F.floor(F.col("at") / block).cast("int"), F.col("last")))
    selection = used.join(F.broadcast(schedule), ["s", "j"]).select("slot", (F.col("at") % F.lit(max(int(block), 1))).cast("bigint").alias("place"), F.col("s").alias(source), F.col("k").alias(key), (F.col("copy") + 1).alias("copy_no"), F.col("n").alias("size"))

    taken = selection.groupBy(source).agg(F.countDistinct(key).alias("n_docs"), F.count(F.lit(1)).alias("n_uses"), F.sum("size").alias("n_size"))
    sum_all = F.sum("n_size").over(Window.partitionBy())  # over one row per target
    shares = targets.select(source, F.col(target).alias("target_share")).join(F.broadcast(taken), source, "left").fillna(0, ["n_docs", "n_uses", "n_size"])
    return selection, shares.withColumn("actual_share", F.when(sum_all > 0, F.round(F.col("n_size") / sum_all, 6)).otherwise(0.0))
