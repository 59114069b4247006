"""Live ingestion: gated micro-batches merged into a keyed table, exactly once in effect, with state for each source."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from presslake.operators.merge import upsert
from presslake.session import bounded_rows

PARTS = 64
#: Bound of the table of sources that is read again with each micro-batch.
MAX_SOURCES = 100_000


def gate(messages: DataFrame, sources: DataFrame) -> DataFrame:
    """Messages of known sources that are running (sources are few; Spark broadcasts them below its threshold)."""
    running = sources.where("desired_state = 'running'").select("source_key")
    return messages.join(running, "source_key", "left_semi")


class KeyedTable:
    """A parquet table in parts by hash of the key, on any Hadoop file system.

    A batch writes new files for the parts it touches, then a pointer that names the current file of every part; parts without
    new rows are not written again. A batch that was applied is not applied again, so that a restarted stream repeats nothing.
    Files of parts that are no longer current are removed once the pointer has moved.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str, key: list[str], parts: int = PARTS):
        self.spark, self.folder, self.schema, self.key, self.parts = spark, folder.rstrip("/"), schema, key, parts
        jvm = spark.sparkContext._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{p}")
        self.fs = self._path("CURRENT").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _state(self) -> dict:
        for name in ("CURRENT", "CURRENT.new"):  # the second, if a writer was lost between removal and renaming
            if self.fs.exists(self._path(name)):
                text = self.spark.read.option("wholetext", "true").text(f"{self.folder}/{name}").first()
                if text is not None:
                    return json.loads(text.value)
        return {"version": -1, "batch": -1, "files": {}}

    def _point(self, state: dict) -> None:
        out = self.fs.create(self._path("CURRENT.new"), True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        self.fs.delete(self._path("CURRENT"), False)
        self.fs.rename(self._path("CURRENT.new"), self._path("CURRENT"))

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.parts)).cast("int")

    def _read(self, files: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/{f}" for f in files]) if files else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        return self._read(sorted(self._state()["files"].values()))

    def merge(self, batch: DataFrame, batch_id: int, order: list[str], keep: list[str]) -> None:
        state = self._state()
        if batch_id <= state["batch"]:
            return
        names = self._read([]).columns
        touched = {str(r[0]) for r in bounded_rows(batch.select(self._part()).distinct(), self.parts, "parts")}
        old = {p: f for p, f in state["files"].items() if p in touched}
        merged = upsert(self._read(sorted(old.values())), batch.select(*names), self.key, order, keep).drop("action")
        version = state["version"] + 1
        merged.withColumn("part", self._part()).repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{self.folder}/v{version}")
        new = {p: f"v{version}/part={p}" for p in touched}
        self._point({"version": version, "batch": batch_id, "files": {**state["files"], **new}})
        for f in old.values():
            self.fs.delete(self._path(f), True)


def each_source(batch: DataFrame, sources: DataFrame, apply: Callable[[DataFrame, str], None]) -> dict[str, str]:
    """Run ``apply`` for the messages of each running source in a batch; what fails is told by source, and stops no other.

    The sources are read anew with every batch, so that a change of their state holds from the next batch on.
    """
    running = {r[0] for r in bounded_rows(sources.where("desired_state = 'running'").select("source_key"), MAX_SOURCES, "sources")}
    here = sorted(r[0] for r in bounded_rows(batch.select("source_key").where("source_key is not null").distinct(), MAX_SOURCES, "sources of a batch") if r[0] in running)
    errors = {}
    for key in here:
        try:
            apply(batch.where(F.col("source_key") == key), key)
        except Exception as e:  # noqa: BLE001 - any failure of one source must leave the others alone
            errors[key] = f"{type(e).__name__}: {e}".split("\n")[0][:500]
    return errors


def run_live(messages: DataFrame, sources: Callable[[], DataFrame], target: KeyedTable, order: list[str], keep: list[str], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Drain what is available batch by batch, or with ``every`` go on at that interval; ``sources`` reads their present state."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        target.merge(gate(batch, sources()), batch_id, order, keep)

    out = messages.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (out.trigger(processingTime=every) if every else out.trigger(availableNow=True)).start()


def handoff(messages: DataFrame, sources: Callable[[], DataFrame], target: KeyedTable, order: list[str], keep: list[str], checkpoint: str, every: str) -> StreamingQuery:
    """The whole history first, then what comes: one drain and one running query over the same checkpoint, so that nothing lies between."""
    run_live(messages, sources, target, order, keep, checkpoint).awaitTermination()
    return run_live(messages, sources, target, order, keep, checkpoint, every)


def pages_to_scan(cycle: int, pages: int = 5, deeper: int = 10, every: int = 10) -> int:
    """Listing pages of a polling cycle, counted from 1: each tenth cycle goes deeper."""
    return deeper if cycle % every == 0 else pages


def checkpoints_of(messages: DataFrame, source: str, item: str) -> DataFrame:
    """(source, checkpoint) after each micro-batch, from keyed state: the highest id of a source, whatever order ids come in."""
    import pandas as pd

    def advance(key: tuple, batches, state):  # noqa: ANN001, ANN202
        highest = state.get[0] if state.exists else 0
        for pdf in batches:
            highest = max(highest, int(pdf[item].max()))
        state.update((highest,))
        yield pd.DataFrame({source: [key[0]], "checkpoint": [highest]})

    return messages.where(F.col(item).isNotNull()).groupBy(source).applyInPandasWithState(advance, f"{source} string, checkpoint bigint", "highest bigint", "update", "NoTimeout")


def windowed_counts(events: DataFrame, time: str, kind: str, width: str, late: str) -> DataFrame:
    """Events per window and kind; a watermark bounds the state."""
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, width), kind).agg(F.count(F.lit(1)).alias("n"))


def deduplicated(messages: DataFrame, key: list[str], time: str, late: str) -> DataFrame:
    """Each key once within the watermark."""
    return messages.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark(key)
