"""Catalog tables backed by Parquet snapshot folders in the shared storage.

A write never overwrites the folder it may be reading from: every publish
writes a new snapshot folder and then repoints the catalog table at it
(``ALTER TABLE .. SET LOCATION``), so a reader sees the old or the new
snapshot, never a half-written one, and a failed job leaves the table as it
was.  Appends add files to the current snapshot; new columns are added to
the table first, missing ones read as NULL.

Snapshot folders are written by Spark tasks in parallel; nothing passes
through the driver.  They lie under ``spark.strata.tables.dir`` where the
session sets it, else under the shared folder.

A table keeps its partition columns through every overwrite, truncation and
merge, and the marks that its writers have left (:func:`record_commit`).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import shared_root


#: Of what is written here.  Against Spark's default (snappy) it takes about a
#: fifth off the files of the retail tables.
COMPRESSION = "zstd"


def _root(spark: SparkSession) -> str:
    own = spark.conf.get("spark.strata.tables.dir", "")
    return own.rstrip("/") or f"{shared_root(spark)}/strata/tables"


def _ensure_db(spark: SparkSession, name: str) -> None:
    if "." in name:
        db = name.split(".")[0]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(F.col("col_name") == "Location").collect()
    return rows[0]["data_type"]


def _partition_columns(spark: SparkSession, name: str) -> list:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def new_snapshot_path(spark: SparkSession, name: str, tag: str = "") -> str:
    return f"{_root(spark)}/{name.replace('.', '/')}/snap-{tag or 'x'}-{uuid.uuid4().hex[:10]}"


def _shape(schema: StructType) -> list:
    """Names and types; nullability is no difference between snapshots."""
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _columns_sql(fields) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def publish(df: DataFrame, name: str, tag: str = "", partition_by: list[str] | None = None,
            cluster_by: Sequence[str] = (), watch=None) -> str:
    """Overwrite ``name`` with ``df`` as a new snapshot (create if absent).
    An existing table's partition columns stay unless others are given.

    ``cluster_by`` deals the rows to files by ranges of these columns and
    sorts each file by them, so that a filter on them skips files and row
    groups.  A table that keeps its columns (or gains some) is repointed and
    never absent; one that loses columns, changes types or its partitioning
    is dropped and made again."""
    spark = df.sparkSession
    present = exists(spark, name)
    if partition_by is None:
        partition_by = _partition_columns(spark, name) if present else []
        missing = [c for c in partition_by if c not in df.columns]
        if missing:
            raise ValueError(f"{name} is partitioned by {missing}, which the new rows lack")
    path, _ = write_snapshot(df, name, tag, partition_by, cluster_by, watch)
    if watch:
        watch.check(spark.read.schema(df.schema).parquet(path))
    show_snapshot(spark, name, path, df.schema, partition_by)
    return path


def write_snapshot(df: DataFrame, name: str, tag: str = "", partition_by: Sequence[str] = (),
                   cluster_by: Sequence[str] = (), watch=None, stamp: Callable[[DataFrame], DataFrame] | None = None) -> tuple[str, StructType]:
    """Write ``df`` to a new snapshot folder of ``name`` that no reader sees
    before :func:`show_snapshot`.  ``stamp`` gives the rows their last columns
    once they are dealt to partitions, so that these are not shuffled.  Returns
    the folder and the rows' schema."""
    spark = df.sparkSession
    path = new_snapshot_path(spark, name, tag)
    rows = df
    if cluster_by:
        rows = rows.repartitionByRange(*partition_by, *cluster_by).sortWithinPartitions(*partition_by, *cluster_by)
    elif partition_by:
        # Rebalance by the partition columns: AQE keeps a partition's rows
        # together (few files per partition) and splits a hot partition
        # over several tasks instead of giving it to one.
        rows = rows.hint("rebalance", *partition_by)
    rows = stamp(rows) if stamp else rows
    w = (watch.on(rows) if watch else rows).write.mode("errorifexists").format("parquet").option("compression", COMPRESSION)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path, rows.schema


def show_snapshot(spark: SparkSession, name: str, path: str, schema: StructType, partition_by: Sequence[str] = ()) -> None:
    """Make the snapshot in ``path`` the table's (create it if absent)."""
    _ensure_db(spark, name)
    partition_by = list(partition_by)
    marks = {}
    if exists(spark, name):
        old = dict(_shape(spark.table(name).schema))
        new = dict(_shape(schema))
        if partition_by == _partition_columns(spark, name) and all(new.get(c) == t for c, t in old.items()):
            added = [f for f in schema.fields if f.name not in old]
            if added:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_columns_sql(added)})")
            # One metadata update repoints readers to the new snapshot (no
            # moment without a table); partitions are repointed one by one.
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            if partition_by:
                _repoint(spark, name, spark.read.schema(schema).parquet(path), partition_by)
            spark.sql(f"REFRESH TABLE {name}")
            return
        marks = _marks(spark, name)
        spark.sql(f"DROP TABLE {name}")
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({_columns_sql(schema.fields)}) USING parquet{part} LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    for writer, mark in marks.items():
        record_commit(spark, name, writer, mark)


def _quoted(value) -> str:
    return str(value).replace("\\", "\\\\").replace("'", "\\'")


# ------------------------------------------------------------ partitions --

def _spec(values: Mapping) -> str:
    return "PARTITION (" + ", ".join(f"`{c}` = '{_quoted(v)}'" for c, v in values.items()) + ")"


def partitions(spark: SparkSession, name: str) -> DataFrame:
    """The catalog's partitions of ``name``: their values as text, a column
    for each partition column."""
    def value(c):
        raw = F.regexp_extract("partition", f"(?:^|/){c}=([^/]*)", 1)
        return F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))).alias(c)
    return spark.sql(f"SHOW PARTITIONS {name}").select(*[value(c) for c in _partition_columns(spark, name)])


def add_partition(spark: SparkSession, name: str, values: Mapping, path: str) -> None:
    """Show the files in ``path`` as a partition: one catalog call, before
    which no reader sees them.  Nothing happens if it is there already."""
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {_spec(values)} LOCATION '{_quoted(path)}'")
    spark.sql(f"REFRESH TABLE {name}")


def batch_path(spark: SparkSession, name: str, values: Mapping) -> str:
    """The folder of a batch, known from its partition values alone."""
    return "/".join([location(spark, name).rstrip("/"), *(f"{c}={quote(str(v), safe='')}" for c, v in values.items())])


def write_batch(df: DataFrame, name: str, values: Mapping) -> str:
    """Write ``df`` to the folder of the partition ``values`` without telling
    the catalog: nothing reads the files before :func:`add_partition`.
    Leftovers of a write that was never committed are replaced."""
    path = batch_path(df.sparkSession, name, values)
    _aligned(df, name).drop(*values).write.mode("overwrite").parquet(path, compression=COMPRESSION)
    return path


def _repoint(spark: SparkSession, name: str, written: DataFrame, partition_by: Sequence[str], touched: Sequence | None = None) -> None:
    """Point the catalog's partitions at the files of ``written``, which was
    just written by these columns, and drop those that it lacks (of
    ``touched`` alone, if given: values of a single partition column).  The
    partitions' values reach the driver, which makes the catalog calls."""
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    named = [F.col(c).cast("string").alias(c) for c in partition_by]
    present = {tuple(r)[:-1]: unquote(r[-1]) for r in written.select(*named, folder).distinct().collect()}
    known = {tuple(r) for r in partitions(spark, name).select(*partition_by).collect()}
    new = [(k, p) for k, p in present.items() if k not in known]
    gone = [k for k in known - present.keys() if touched is None or k[0] in {str(t) for t in touched}]
    spec = lambda k: _spec(dict(zip(partition_by, k)))
    for k, p in present.items():
        if k in known:
            spark.sql(f"ALTER TABLE {name} {spec(k)} SET LOCATION '{_quoted(p)}'")
    if new:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"{spec(k)} LOCATION '{_quoted(p)}'" for k, p in new))
    if gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(map(spec, gone)))
    spark.sql(f"REFRESH TABLE {name}")


def _rewrite(name: str, rows: DataFrame, partition_col: str, touched: Sequence, tag: str) -> None:
    """Replace the partitions ``touched`` by ``rows``, which are written once
    to a new folder.  Other partitions keep their files."""
    spark = rows.sparkSession
    path = new_snapshot_path(spark, name, tag)
    rows.hint("rebalance", partition_col).write.mode("errorifexists").partitionBy(partition_col).parquet(path, compression=COMPRESSION)
    _repoint(spark, name, spark.read.schema(rows.schema).parquet(path), [partition_col], touched)


def _partitioned_by(spark: SparkSession, name: str, partition_col: str) -> None:
    if _partition_columns(spark, name) != [partition_col]:
        raise ValueError(f"{name} is partitioned by {_partition_columns(spark, name)}, not by {partition_col}")


def _values(*frames: DataFrame) -> list:
    """The distinct values of one-column frames: partitions, so few."""
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return [r[0] for r in out.distinct().collect()]


def _merge_touched(source: DataFrame, name: str, partition_col: str, found: Callable, merged: Callable) -> list:
    spark = source.sparkSession
    _partitioned_by(spark, name, partition_col)
    target = read(spark, name)
    touched = _values(*(f.select(partition_col) for f in found(target)))
    if touched:
        affected = target.filter(F.col(partition_col).isin(touched))
        _rewrite(name, merged(affected).select(*target.columns), partition_col, touched, "merge")
    return touched


def merge_partitioned(source: DataFrame, name: str, keys: list[str], partition_col: str,
                      check_unique: bool = True, replayed: Column | None = None) -> list:
    """MERGE (update all / insert all) into a table partitioned by
    ``partition_col``, rewriting only the partitions the batch touches.

    Touched = partitions of the batch's rows plus partitions where the table
    already holds one of the batch's keys (a left-semi join that reads only
    the key and partition columns of the table).  Their current rows are read
    with partition pruning, merged, and written once to a new folder, at which
    the catalog's partitions are then pointed; a touched partition left
    without rows (all its rows moved) is dropped.  Readers see a partition's
    old rows or its new ones.  What is written grows with the batch and the
    partitions it touches, not with the table.  The partition column must be
    the table's own (ValueError otherwise) and non-NULL.  ``replayed``: see
    ``upsert.merge_update_all``.  Returns the touched partition values (one
    row per partition reaches the driver)."""
    from ..operators.upsert import _all_keys_present, assert_unique_keys, merge_update_all
    spark = source.sparkSession
    if not exists(spark, name):
        publish(source, name, tag="initial", partition_by=[partition_col])
        return _values(spark.table(name).select(partition_col))
    _partitioned_by(spark, name, partition_col)
    if check_unique:
        assert_unique_keys(source, keys)
    keyed = _all_keys_present(keys)

    def found(target):
        yield target.join(source.filter(keyed).select(*keys).distinct(), list(keys), "left_semi")
        yield source
        if replayed is not None:
            yield target.filter(~keyed & replayed)
    return _merge_touched(source, name, partition_col, found,
                          lambda t: merge_update_all(t, source, keys, check_unique=False, replayed=replayed))


def merge_columns_partitioned(source: DataFrame, name: str, keys: list[str], partition_col: str,
                              update_columns: Sequence[str], replayed: Column | None = None) -> list:
    """MERGE with an update list (``upsert.merge_update_columns``) that
    rewrites only partitions that hold a key of the batch or get new rows.  A
    matched row stays in its partition unless ``update_columns`` names the
    partition column.  Returns the touched partition values."""
    from ..operators.upsert import _all_keys_present, assert_unique_keys, merge_update_columns
    assert_unique_keys(source, keys)
    keyed = _all_keys_present(keys)

    def found(target):
        yield target.join(source.filter(keyed).select(*keys), list(keys), "left_semi")
        if partition_col in update_columns:
            yield source
        else:
            yield source.filter(keyed).join(target.filter(keyed).select(*keys).distinct(), list(keys), "left_anti")
            yield source.filter(~keyed)
        if replayed is not None:
            yield target.filter(~keyed & replayed)
    return _merge_touched(source, name, partition_col, found,
                          lambda t: merge_update_columns(t, source, keys, update_columns, check_unique=False, replayed=replayed))


def update_partitioned(spark: SparkSession, name: str, predicate: Column, assignments: Mapping) -> list:
    """UPDATE .. SET .. WHERE (``upsert.update_where``) that rewrites only the
    partitions in which the predicate holds for a row, and those that such
    rows move to.  The search reads the predicate's columns, and of the
    partitions only those that it doesn't rule out itself."""
    from ..operators.upsert import update_where
    (partition_col,) = _partition_columns(spark, name)
    target = read(spark, name)
    hit = target.filter(predicate)
    frames = [hit.select(partition_col)]
    if partition_col in assignments:
        frames.append(update_where(hit, predicate, assignments).select(partition_col))
    touched = _values(*frames)
    if touched:
        affected = update_where(target.filter(F.col(partition_col).isin(touched)), predicate, assignments)
        _rewrite(name, affected, partition_col, touched, "update")
    return touched


# ---------------------------------------------------------- commit marks --

_MARK = "strata.commit."


def _marks(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key").startswith(_MARK)).collect()
    return {r["key"].removeprefix(_MARK): r["value"] for r in rows}


def last_commit(spark: SparkSession, name: str, writer: str) -> str | None:
    """The mark that ``writer`` left last on the table, one a writer."""
    return _marks(spark, name).get(writer) if exists(spark, name) else None


def record_commit(spark: SparkSession, name: str, writer: str, mark) -> None:
    """Leave a mark on the table once a write is through, so that the same
    write, replayed, can be told and skipped."""
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_MARK}{_quoted(writer)}' = '{_quoted(mark)}')")


def overwrite_merge_schema(df: DataFrame, name: str, tag: str = "", cluster_by: Sequence[str] = (), watch=None) -> str:
    """Overwrite keeping the union of the old and new columns (old-only
    columns become NULL), i.e. overwrite with schema merging."""
    spark = df.sparkSession
    if exists(spark, name):
        old = spark.table(name).schema
        add = [f for f in old.fields if f.name not in df.columns]
        if add:
            df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in add})
    return publish(df, name, tag, cluster_by=cluster_by, watch=watch)


def create_empty(spark: SparkSession, name: str, schema: StructType,
                 partition_by: list[str] | None = None) -> None:
    """Create the table if it does not exist (from a StructType)."""
    if not exists(spark, name):
        publish(spark.createDataFrame([], schema), name, "init", partition_by)


def _aligned(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the table's columns by name: new columns are added to the
    table first, those that ``df`` lacks are NULL."""
    spark = df.sparkSession
    tschema = spark.table(name).schema
    have = {f.name for f in tschema.fields}
    new = [f for f in df.schema.fields if f.name not in have]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_columns_sql(new)})")
        tschema = spark.table(name).schema
    return df.select(*[F.col(f.name).cast(f.dataType) if f.name in df.columns
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in tschema.fields])


def append(df: DataFrame, name: str, tag: str = "") -> None:
    """Append by column name: new columns are added to the table first
    (``ALTER TABLE .. ADD COLUMNS``), table columns absent from ``df`` are
    written as NULL."""
    spark = df.sparkSession
    if not exists(spark, name):
        publish(df, name, tag)
        return
    aligned = _aligned(df, name)
    if _partition_columns(spark, name):
        # Partition folders and catalog partitions are maintained by insertInto.
        aligned.write.mode("append").insertInto(name)
    else:
        aligned.write.mode("append").format("parquet").option("compression", COMPRESSION).save(location(spark, name))
    spark.sql(f"REFRESH TABLE {name}")


def truncate(spark: SparkSession, name: str) -> None:
    """Empty the table by publishing an empty snapshot of its schema and
    partitioning."""
    publish(spark.createDataFrame([], spark.table(name).schema), name, "truncate")


def vacuum(spark: SparkSession, name: str, keep_hours: float = 168.0) -> list[str]:
    """Delete the snapshot folders of ``name`` that it no longer points at and
    that are older than ``keep_hours`` (readers of a former snapshot, and
    writes under way, need them until then).  Live folders are those of the
    table's location and of its files, of which no data is read.  Returns the
    deleted folders."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    root = Path(f"{_root(spark)}/{name.replace('.', '/')}")
    fs = root.getFileSystem(conf)
    snapshot = F.regexp_extract(F.col("_metadata.file_path"), "/(snap-[^/]*)/", 1)
    live = {unquote(r[0]) for r in read(spark, name).select(snapshot).distinct().collect()}
    live.add(location(spark, name).rstrip("/").rsplit("/", 1)[-1])
    before = time.time() * 1000 - keep_hours * 3_600_000
    gone = []
    for st in fs.listStatus(root):
        folder = st.getPath().getName()
        if st.isDirectory() and folder.startswith("snap-") and folder not in live and st.getModificationTime() < before:
            fs.delete(st.getPath(), True)
            gone.append(folder)
    return gone


def read(spark: SparkSession, name: str) -> DataFrame:
    """Current snapshot of ``name``.  The cached relation is refreshed
    first: another session (e.g. a stream's ``foreachBatch``) may have
    repointed the table to a new snapshot folder."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def materialize(df: DataFrame, purpose: str = "stage", watch=None) -> DataFrame:
    """Write ``df`` once to a new folder in the shared storage and read it
    back: cuts the lineage for frames with several consumers (each consumer
    would otherwise recompute the whole plan) and survives executor loss,
    unlike caching or a local checkpoint.  ``watch`` sees the rows on the way."""
    from ..session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    (watch.on(df) if watch else df).write.mode("errorifexists").parquet(path, compression=COMPRESSION)
    return spark.read.schema(df.schema).parquet(path)
