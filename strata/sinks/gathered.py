"""A frame's rows, brought together by key in passing files.

Work on groups needs the rows of a key in one task.  A shuffle moves them as
Spark's rows, three times as wide as the same columns in Parquet, and partial
sums of many small groups save nothing.  :meth:`Stages.gather` writes the
columns that are wanted once, as a bucketed table, whose readers find each
key's rows in one bucket: grouping or ranking them by the keys shuffles no row.

A key with very many rows would fill a task by itself.  Such keys are found
beforehand (a frequent-items sketch of the keys' hashes, of bounded size), and
their rows are handed back as they came, for a plan that spreads a key over
tasks.  Which keys these are decides where rows go, never what comes out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import tables

#: A key is left out of the buckets if it has more than a share of
#: 1 / HOT_KEYS of the rows and more than ROWS_A_KEY of them: at most HOT_KEYS
#: keys, whose hashes reach the driver.
HOT_KEYS, ROWS_A_KEY = 400, 100_000
#: Rows of a bucket on average, and of one that is not worth a task.
ROWS_A_BUCKET, FEW_ROWS = 1_000_000, 50_000

DB = "strata_stages"
#: gather(rows, keys) -> (rows in buckets, rows of keys with very many or None)
Gather = Callable[[DataFrame, Sequence[str]], tuple[DataFrame, DataFrame | None]]


def hot_hashes(rows: DataFrame, keys: Sequence[str]) -> tuple[int, list[int]]:
    """The number of rows, and the hashes of the keys that have very many."""
    seen = rows.select(F.xxhash64(*keys).alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {HOT_KEYS}, {10 * HOT_KEYS})").alias("top")).first()
    least = max(seen.n // HOT_KEYS, ROWS_A_KEY)
    return seen.n, [r["item"] for r in seen.top or () if r["count"] > least]


def buckets_for(n: int, tasks: int) -> int:
    return max(1, -(-n // ROWS_A_BUCKET), min(tasks, -(-n // FEW_ROWS)))


class Stages:
    """The passing tables of a step; they go when it ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self._made = spark, []

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *_) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for name, path in self._made:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)
        self._made.clear()

    def gather(self, rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
        """``rows`` in two parts: those in buckets by ``keys``, and those of
        keys that have very many (None if there is no such key).  ``rows`` is
        read twice, the first time its keys alone."""
        spark = self.spark
        n, hot = hot_hashes(rows, keys)
        spread = F.xxhash64(*keys).isin(hot)
        tables._ensure_db(spark, f"{DB}.x")
        name, path = f"{DB}.by_{uuid.uuid4().hex[:12]}", scratch_path(spark, "gathered")
        self._made.append((name, path))
        near = rows.filter(~spread) if hot else rows
        (near.write.format("parquet").option("compression", tables.COMPRESSION).option("path", path)
             .bucketBy(buckets_for(n, spark.sparkContext.defaultParallelism), *keys).saveAsTable(name))
        return spark.table(name), rows.filter(spread) if hot else None
