"""What the corpus operators share: table reads, row keys, staged tables.

Row keys.  The operators address a document by ``_key``, a unique long that
orders documents as ``doc_id`` does.  When the ids of a table are unique and
not null the key *is* the id.  Otherwise :func:`keyed` numbers the distinct
(doc_id, text) pairs in ascending order, null ids first and equal ids by the
SHA-256 of their text: rows that repeat both id and text are one document
(and share its result), rows that repeat only the id are different documents.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: Bytes and rows that Spark puts in one Arrow batch for a Python task.
BATCH_BYTES = 16 << 20
BATCH_ROWS = 5000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of Python stages by bytes, so that a run of
    very long rows can't fill a worker; and let workers on this machine find
    the package where the driver did (a cluster gets it by ``--py-files``)."""
    env, root = spark.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stage(df: DataFrame, purpose: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: later plans
    start from files that outlive any executor.  ``options`` are the writer's."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.option("compression", "zstd").options(**options or {}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def wrap(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, _rest): all other columns, whatever their names, as one."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    return docs.select(id_col, text_col, F.struct(*rest or [F.lit(0).alias("_")]).alias("_rest"))


def unwrap(df: DataFrame, columns: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns that :func:`wrap` was given, in their order."""
    return df.select(*[F.col(c) if c in (id_col, text_col) else F.col("_rest").getField(c).alias(c) for c in columns])


def keyed(docs: DataFrame, *columns: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_key, id, text, *columns): see the module's docstring.  Only the id
    column is read to find out whether the ids are unique."""
    spark = docs.sparkSession
    bound_batches(spark)
    cols = [F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col)]
    cols += [F.col(c) for c in columns]
    d = docs.select(*cols)
    n, valid, distinct = docs.select(F.col(id_col).cast("long").alias("i")).agg(
        F.count("*"), F.count("i"), F.countDistinct("i")).first()
    if n == valid == distinct:
        return d.withColumn("_key", F.col(id_col))
    sha = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    pairs = d.select(id_col, sha.alias("_sha")).distinct()
    order = [F.asc_nulls_first(id_col), F.asc("_sha")]
    dealt = pairs.repartitionByRange(partitions(spark), *order).withColumn("_p", F.spark_partition_id())
    dealt = stage(dealt, "keys")
    # number within each range, then add the sizes of the ranges before it
    sizes = dealt.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"))
    numbered = dealt.withColumn("_rn", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    keys = numbered.join(before, "_p").select(
        F.col(id_col).alias("_id"), "_sha", (F.col("_before") + F.col("_rn") - 1).cast("long").alias("_key"))
    keys = stage(keys, "keys")
    d = d.withColumn("_sha", sha)
    return d.join(keys.withColumnRenamed("_sha", "_sha2"),
                  (F.col("_sha") == F.col("_sha2")) & F.col(id_col).eqNullSafe(F.col("_id"))) \
            .drop("_sha", "_sha2", "_id")
