"""Tables bucketed by their merge keys, merged without shuffling them.

A bucketed table keeps each key's rows in the file of its hash.  A merge
shuffles the batch alone, into as many partitions as the table has buckets,
and joins it bucket by bucket; the result leaves in the same layout, so the
next merge finds it again.  What moves over the network follows the batch,
not the table (the table itself is read and written once, as by any
snapshot).

A NULL key matches nothing, and all NULL keys would hash to one bucket.  Such
rows are kept beside, in ``<name>__keyless``, with a partition for each batch
that had some; a replayed batch replaces its own.  :func:`read` gives both.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import _all_keys_present, assert_unique_keys
from . import tables

#: The partition column of the keyless rows.
BATCH = "_merge_batch"
#: Rows that a bucket holds when its table is made: a merge sorts a bucket
#: and its part of the batch in one task, and the table grows.
ROWS_A_BUCKET = 400_000


def _beside(name: str) -> str:
    return f"{name}__keyless"


def _publish(df: DataFrame, name: str, keys: Sequence[str], buckets: int, tag: str) -> str:
    """``df`` (no NULL keys, dealt to ``buckets`` partitions by the keys) as
    the table's new snapshot: one sorted file a bucket."""
    spark = df.sparkSession
    path = tables.new_snapshot_path(spark, name, tag)
    # Spark writes buckets only for a table of the catalog: a passing one,
    # whose files stay when it is dropped.
    passing = f"{name}__{uuid.uuid4().hex[:10]}"
    df.write.format("parquet").option("compression", tables.COMPRESSION).bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(passing)
    if tables.exists(spark, name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.sql(f"REFRESH TABLE {name}")
    else:
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE {name} ({tables._columns_sql(df.schema.fields)}) USING parquet "
                  f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.sql(f"DROP TABLE {passing}")
    return path


def buckets_of(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    """The table's number of buckets and its bucket columns."""
    said = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if "Num Buckets" not in said:
        raise ValueError(f"{name} is not bucketed")
    return int(said["Num Buckets"]), [c.strip(" `") for c in said["Bucket Columns"].strip("[]").split(",")]


def enough_buckets(df: DataFrame, least: int = 1, rows_a_bucket: int | None = None) -> int:
    """The number of buckets for a table made of ``df`` (staged: its rows are
    counted)."""
    return max(least, -(-df.count() // (rows_a_bucket or ROWS_A_BUCKET)))


def create(df: DataFrame, name: str, keys: Sequence[str], buckets: int, batch: str = "initial") -> None:
    """A new table of ``df``, whose keys must be unique.  ``buckets`` stays
    for good: choose it so that a bucket fits a task when the table is at its
    largest (:func:`enough_buckets`)."""
    tables._ensure_db(df.sparkSession, name)
    assert_unique_keys(df, keys)
    keyed = _all_keys_present(keys)
    _publish(df.filter(keyed).repartition(buckets, *keys), name, keys, buckets, "initial")
    _set_beside(df.filter(~keyed), name, batch)


def _set_beside(keyless: DataFrame, name: str, batch: str) -> None:
    spark, beside = keyless.sparkSession, _beside(name)
    rows = keyless.withColumn(BATCH, F.lit(batch))
    tables.create_empty(spark, beside, rows.schema, [BATCH])
    path = tables.write_batch(rows, beside, {BATCH: batch})
    tables.add_partition(spark, beside, {BATCH: batch}, path)


def merged(source: DataFrame, name: str) -> DataFrame:
    """The keyed rows of the table after a merge of ``source`` (update all,
    insert all): a full outer join to which the table comes as it lies."""
    spark = source.sparkSession
    n, keys = buckets_of(spark, name)
    keyed = _all_keys_present(keys)
    target = spark.table(name)
    s = source.filter(keyed).repartition(n, *keys).withColumn("__new", F.lit(True)).alias("s")
    t = target.alias("t")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    new = F.col("s.__new").isNotNull()
    have = set(source.columns)

    def pick(c):
        given = F.col(f"s.{c}") if c in have else F.lit(None)
        return F.when(new, given).otherwise(F.col(f"t.{c}")).cast(target.schema[c].dataType).alias(c)
    return t.join(s.hint("merge"), on, "full_outer").select(*[pick(c) for c in target.columns])


def merge(source: DataFrame, name: str, batch: str) -> None:
    """MERGE (update all, insert all) of ``source``, which has the table's
    columns or fewer.  ``batch`` names the batch, also when it is replayed."""
    spark = source.sparkSession
    n, keys = buckets_of(spark, name)
    extra = [c for c in source.columns if c not in spark.table(name).columns]
    if extra:
        raise ValueError(f"{name} lacks the columns {extra}")
    assert_unique_keys(source, keys)
    _publish(merged(source, name), name, keys, n, "merge")
    _set_beside(source.filter(~_all_keys_present(keys)), name, batch)


def read(spark: SparkSession, name: str) -> DataFrame:
    keyless = tables.read(spark, _beside(name)).drop(BATCH)
    return tables.read(spark, name).unionByName(keyless, allowMissingColumns=True)
