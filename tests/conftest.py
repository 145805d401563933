import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from acervo.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", 8, **{"spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Value of a column expression over one string."""

    def run(build, *texts):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
        got = [r["v"] for r in df.select("i", build(F.col("t")).alias("v")).orderBy("i").collect()]
        return got if len(texts) > 1 else got[0]

    return run
