"""Session helpers: table access, partition spreading, checked broadcasts and lineage cuts.

Nothing here changes results; every helper looks at the session or the plan and picks a physical form.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest estimated size of a side that is broadcast on purpose; beyond it the join shuffles.
BROADCAST_LIMIT = 16 * 1024 * 1024


def build_session(app: str = "acervo", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "6g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Reads ``{sf_dir}/{name}.parquet``; with ``columns`` only these are scanned."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Gives a CPU-heavy stage one partition per core when the scan yields fewer.

    A scan of many files already has enough partitions, so at scale this adds no shuffle; it only helps
    tables of one small file. Partition counts come from the plan, no job runs.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, *[F.col(k) for k in keys]) if keys else df.repartition(want)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``broadcast(df)`` if its estimated size is within ``limit``, else ``df`` as it is (a shuffled join)."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in ``spark.checkpoint.dir``; set here only where it is unset."""
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir", None)
    if where is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        where = os.path.join(tempfile.gettempdir(), "acervo-checkpoint")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(where)
    return where


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def dealt(left: DataFrame, right: DataFrame, keys: list[str], hot: int = 100_000) -> tuple[DataFrame, DataFrame, list[str]]:
    """Two sides of a join on ``keys`` with hot keys split, and the keys to join on.

    Rows of ``left`` whose key has more than ``hot`` rows are dealt over as many copies of that key's rows of ``right``; a row of ``left`` keeps all its
    partners, so the join gives the same rows. The hot keys (at most one in ``hot`` rows) are counted first: without any the sides stay as they are, and
    they are broadcast only if they are few.
    """
    counted = left.groupBy(*keys).count().where(F.col("count") > hot).select(*keys, F.ceil(F.col("count") / hot).cast("int").alias("_copias"))
    if counted.isEmpty():
        return left, right, keys
    counted = cut(counted)
    heavy = F.broadcast(counted) if counted.count() <= hot else counted
    copies = F.coalesce("_copias", F.lit(1))
    place = F.pmod(F.xxhash64(*left.columns), copies).cast("int")
    split = left.join(heavy, keys, "left").select(*left.columns, place.alias("_sal"))
    copied = right.join(heavy, keys, "left").select(*right.columns, F.explode(F.sequence(F.lit(0), copies - 1)).alias("_sal"))
    return split, copied, [*keys, "_sal"]


def squeeze(c: Column) -> Column:
    """Each run of Unicode whitespace becomes one blank; both ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)[\s​﻿]+", " "))
