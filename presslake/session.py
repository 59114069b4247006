"""Session, table and checkpoint helpers shared by every operator."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Broadcasts are made only behind a row check against this bound.
MAX_BROADCAST_ROWS = 100_000


def build_session(app: str = "presslake", cpus: str | int = "*", driver_memory: str = "8g") -> SparkSession:
    """Local session for tests and benchmarks; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application (executors need no installation)."""
    sc = spark.sparkContext
    if getattr(sc, "_presslake_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="presslake")  # read by the driver's file server only
    archive = os.path.join(folder, "presslake_src.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    sc.addPyFile(archive)
    sc._presslake_shipped = True


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the cluster's shared folder.

    ``spark.checkpoint.dir`` is read from the session. Only where it is unset and there is no cluster (tests) is a local one made.
    """
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not (sc.master or "").startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="presslake-ckpt")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def free_name(df: DataFrame, base: str) -> str:
    """A column name near ``base`` that ``df`` does not have in any case."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Collect a reference table after checking its size; raises instead of pulling an unbounded table."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} rows; it is not a small reference table")
    return rows


def struct_of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])
