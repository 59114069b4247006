"""Live items against stored ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def audit(live: DataFrame, stored: DataFrame, key: list[str]) -> DataFrame:
    """(key..., finding): ``missing_in_db`` or ``extra_in_db`` of every item that only one side has; rows are made distinct."""
    missing = live.select(*key).distinct().join(stored.select(*key), key, "left_anti").withColumn("finding", F.lit("missing_in_db"))
    extra = stored.select(*key).distinct().join(live.select(*key), key, "left_anti").withColumn("finding", F.lit("extra_in_db"))
    return missing.unionByName(extra)


def audit_status(findings: DataFrame, sources: DataFrame, source: str) -> DataFrame:
    """(source, n_missing, n_extra, status) of every source: fail if something is missing, else warning if something is extra."""
    count = lambda k: F.count_if(F.col("finding") == k)
    found = findings.groupBy(source).agg(count("missing_in_db").alias("n_missing"), count("extra_in_db").alias("n_extra"))
    all_ = sources.select(source).distinct().join(found, source, "left").fillna(0, ["n_missing", "n_extra"])
    return all_.withColumn("status", F.when(F.col("n_missing") > 0, "fail").when(F.col("n_extra") > 0, "warning").otherwise("pass"))
