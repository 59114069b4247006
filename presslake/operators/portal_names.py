"""The portal behind a source name, for zone and date-order lookups in the core."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.session import MAX_BROADCAST_ROWS, bounded_rows, checkpointed, free_name

MAX_PORTALS = 1000
#: Longest folded name that is compared; portals' names must be shorter.
MAX_NAME = 200
#: Parts into which the rows of a name are spread where the found names are too many to be broadcast.
SALT = 64


def folded(name: Column, ending: str = "") -> Column:
    """Lower-case letters and digits of a name, without address parts, labels and diacritics, and without the portals' common address ending."""
    x = F.lower(F.translate(name, "İIıƏəÖöÜüĞğŞşÇç", "iiieeoouuggsscc"))
    x = F.regexp_replace(x, r"^\s*m\p{L}nb\p{L}:\s*|^\s*(https?://)?(www\.|m\.)?|/+\s*$|\s*\(rss\)\s*$", "")
    return F.regexp_replace(x, (rf"[._]{ending}\b|" if ending else "") + r"[^\p{L}\p{N}]", "")


def common_ending(names: list[str]) -> str:
    """What follows the last full stop of most of the names, '' if there is nothing of the kind."""
    endings = Counter(m[1] for n in names if (m := re.search(r"\.([a-z]+)$", n or "")))
    return next((e for e, n in endings.most_common(1) if 2 * n > len(names)), "")


def with_portal(df: DataFrame, portals: DataFrame, name: str, fields: list[str]) -> DataFrame:
    """Add ``fields`` of the nearest portal (edit distance at most 2 of the folded names, ties to the lower id); null if none.

    Only distinct names are compared, each with the literal array of the portals' two names; the reference table is
    checked to have at most ``MAX_PORTALS`` rows. Null and empty names, and those of more than ``MAX_NAME`` letters, get nulls.
    """
    spark = df.sparkSession
    ending = common_ending([r[0] for r in bounded_rows(portals.select("source_name"), MAX_PORTALS, "portals")])
    rows = bounded_rows(
        portals.select("portal_id", *fields, folded(F.col("source_name"), ending).alias("__a"), folded(F.col("display_name"), ending).alias("__b")).orderBy("portal_id"), MAX_PORTALS, "portals"
    )
    ref = spark.createDataFrame([tuple(r[c] for c in ["portal_id", *fields]) for r in rows], portals.select("portal_id", *fields).schema)
    listed = F.array(*[F.struct(F.lit(r.portal_id).alias("i"), F.lit(v).alias("f")) for r in rows for v in (r["__a"], r["__b"])])
    scored = F.transform(listed, lambda e: F.struct(F.levenshtein(F.col("f"), e["f"], 2).alias("d"), e["i"].alias("i")))
    key = "__portal_key"
    # max() of the key is the key; filters on it stay above the aggregate, so each distinct name is scored once.
    names = df.select(F.col(name).alias(key)).where(F.col(key).isNotNull()).groupBy(key).agg(F.max(key).alias("n"))
    found = checkpointed(
        names.select(key, folded(F.col("n"), ending).alias("f")).where(F.length("f").between(3, MAX_NAME))
        .select(key, F.array_min(F.filter(scored, lambda e: e["d"] >= 0))["i"].alias("portal_id"))
        .join(F.broadcast(ref), "portal_id").select(key, *fields)
    )
    # A portal's name is a hot key: where the names are few they go to the rows, else the rows of a name are spread.
    if len(found.select(key).limit(MAX_BROADCAST_ROWS + 1).collect()) <= MAX_BROADCAST_ROWS:
        return df.join(F.broadcast(found), F.col(name) == F.col(key), "left").drop(key)
    salt = free_name(df, "salt")
    spread = df.withColumn(salt, F.floor(F.rand(7) * SALT).cast("int"))
    salted = found.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("__salt"))
    return spread.join(salted, (F.col(name) == F.col(key)) & (F.col(salt) == F.col("__salt")), "left").drop(key, salt, "__salt")
