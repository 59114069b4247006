import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

from presslake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", 4, "4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def one(spark, expr, **values):
    """The value of one expression over literals."""
    from pyspark.sql import functions as F

    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(expr.alias("x")).collect()[0].x
