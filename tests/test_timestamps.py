from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from presslake.operators import timestamps as ts
from presslake.operators.portal_names import with_portal

CASES = [
    ("2025-03-01T08:15:00Z", "UTC", False, "2025-03-01T08:15:00Z"), ("20250301T081500Z", "UTC", False, "2025-03-01T08:15:00Z"), ("2025-03-01T08:15:00.987654+04:00", "UTC", False, "2025-03-01T04:15:00Z"),
    ("2025-03-01 08:15:00 -0500", "UTC", False, "2025-03-01T13:15:00Z"), ("2025-03-01T08:15:00+03", "UTC", False, "2025-03-01T05:15:00Z"), ("1740816900", "UTC", False, "2025-03-01T08:15:00Z"), ("1740816900123", "UTC", False, "2025-03-01T08:15:00Z"),
    ("Sat, 01 Mar 2025 08:15:00 +0100", "UTC", False, "2025-03-01T07:15:00Z"), ("Sat Mar 01 2025 08:15:00 GMT+0400 (Azerbaijan Standard Time)", "UTC", False, "2025-03-01T04:15:00Z"),
    ("01 mart 2025, 08:15", "Asia/Baku", False, "2025-03-01T04:15:00Z"), ("01 Марта 2025  08:15", "Europe/Moscow", False, "2025-03-01T05:15:00Z"), ("01 mart 2025 08:15 (UTC +04:00)", "UTC", False, "2025-03-01T04:15:00Z"),
    (" Tarix: 01.03.2025 08:15 ", "+04:00", False, "2025-03-01T04:15:00Z"), ("01.03.2025 [08:15]", "UTC", False, "2025-03-01T08:15:00Z"), ("01-03-2025 / 08:15", "UTC", False, "2025-03-01T08:15:00Z"), ("2025.03.01 / 08:15", "UTC", False, "2025-03-01T08:15:00Z"),
    ("1/3/2025 8:15:00 AM9", "UTC", False, "2025-03-01T08:15:00Z"), ("3/1/2025 12:15:00 PM", "UTC", True, "2025-03-01T12:15:00Z"), ("23/1/2025 12:15:00 AM", "UTC", True, "2025-01-23T00:15:00Z"), ("March 1, 2025 8:15 PM", "UTC", False, "2025-03-01T20:15:00Z"),
    # A time that occurs twice is the first, one that was skipped moves forward by the gap.
    ("2025-11-02 01:30:00", "America/New_York", False, "2025-11-02T05:30:00Z"), ("2025-03-09 02:30:00", "America/New_York", False, "2025-03-09T07:30:00Z"), ("2025-03-30 02:30:00", "Europe/Berlin", False, "2025-03-30T01:30:00Z"),
    ("2025-03-01", "UTC", False, None), ("31.02.2025 [14:20]", "UTC", False, None), ("2025-13-08 10:00:00", "UTC", False, None), ("1970-01-01T00:00:00+00:00", "UTC", False, None), ("bugün, 12:40", "UTC", False, None),
    ("", "UTC", False, None), (None, "UTC", False, None), ("2025-03-01 08:15:00", None, False, None), ("2025-03-01 08:15:00", "No/Where", False, None), ("x" * 5000, "UTC", False, None), ("2025-03-01 08:15:00", "UTC", None, "2025-03-01T08:15:00Z"),
]


def test_cases(spark):
    df = spark.createDataFrame([(i, *c[:3], "kept") for i, c in enumerate(CASES)], "i int, v string, z string, m boolean, utc string").repartition(3)
    done = ts.normalize_timestamps(df, "v", F.col("z"), F.col("m"), ["UTC", "+04:00", "Asia/Baku", "Europe/Moscow", "Europe/Berlin", "America/New_York"])
    got = {r.i: r.t for r in done.select("i", ts.utc_text(F.col("utc_us")).alias("t")).collect()}
    assert [got[i] for i in range(len(CASES))] == [c[3] for c in CASES]
    assert {r.utc for r in done.select("utc").collect()} == {"kept"}


def test_empty_table(spark):
    df = spark.createDataFrame([], "v string")
    assert ts.normalize_timestamps(df, "v", F.lit("UTC"), F.lit(False), ["UTC"]).count() == 0


def test_zone_tables_have_a_version(spark):
    done = ts.normalize_timestamps(spark.createDataFrame([("2025-03-01 08:15:00" + " " * 500,)], "v string"), "v", F.lit("Asia/Baku"), F.lit(False), ["Asia/Baku"], version="tz").first()
    assert done.utc_us == 1740802500000000 and done.tz == ts.tz_version() != ""


def test_names_beyond_the_broadcast(spark, monkeypatch):
    from presslake.operators import portal_names

    portals = spark.createDataFrame([(1, "gundemxett.example", "Gündəm Xətti", "Asia/Baku"), (7, "novybereg.example", "Новый Берег", "Europe/Moscow")], "portal_id int, source_name string, display_name string, tz_name string")
    df = spark.createDataFrame([("gundemxett.example", i, i) for i in range(50)] + [(None, 50, 0), ("x" * 5000, 51, 0)], "n string, salt int, f int")
    want = sorted(map(str, portal_names.with_portal(df, portals, "n", ["tz_name"]).collect()))
    monkeypatch.setattr(portal_names, "MAX_BROADCAST_ROWS", 0)
    assert sorted(map(str, portal_names.with_portal(df, portals, "n", ["tz_name"]).collect())) == want


@settings(max_examples=300, deadline=None)
@given(st.datetimes(datetime(1950, 1, 1), datetime(2090, 1, 1)), st.sampled_from(["Europe/London", "America/New_York", "Europe/Istanbul", "Asia/Baku"]))
def test_zone_tables_follow_the_first_of_two(wall, zone):
    walls, offsets = ts.zone_tables(("America/New_York", "Asia/Baku", "Europe/Istanbul", "Europe/London"))[zone]
    wall = wall.replace(microsecond=0)
    seconds = int((wall - datetime(1970, 1, 1)) / timedelta(seconds=1))
    import numpy as np

    mine = seconds - offsets[np.searchsorted(walls, seconds, side="right")]
    assert mine == int(wall.replace(tzinfo=ZoneInfo(zone), fold=0).timestamp())


@pytest.mark.parametrize(("name", "tz"), [("WWW.gundemxett.example", "Asia/Baku"), ("Gündəm Xətti", "Asia/Baku"), ("gundmexett.example", "Asia/Baku"), ("novybereg_example", "Europe/Moscow"), ("Mənbə: Новый Берег", "Europe/Moscow"), ("forumlar", None), (None, None), ("", None)])
def test_portal_of_name(spark, name, tz):
    portals = spark.createDataFrame([(1, "gundemxett.example", "Gündəm Xətti", "Asia/Baku"), (7, "novybereg.example", "Новый Берег", "Europe/Moscow")], "portal_id int, source_name string, display_name string, tz_name string")
    df = spark.createDataFrame([(name, 1)], "n string, f int")
    assert [r.tz_name for r in with_portal(df, portals, "n", ["tz_name"]).collect()] == [tz]
