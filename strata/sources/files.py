"""Landed CSV files: discovery, typed scans, per-row file lineage.

Discovery lists the landing folder with the ``binaryFile`` source selecting
only ``path/length/modificationTime`` (file contents are not read), keeps
names that contain the entity keyword and end in the suffix, and removes
files already in the ledger with a ``left_anti`` join, so neither the
listing nor the ledger is collected.  Only the paths of the new files of
this run reach the driver, because a reader needs them.

A listing costs what lies in the folder.  :func:`archive` moves files out of
it once they are committed, so that it stays as long as a run's new files;
``modified_after`` leaves older files out where they can't be moved.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Text options that keep values as written (Spark trims on write by default).
CSV_WRITE = {"header": "true", "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
CSV_READ = {"header": "true", "mode": "PERMISSIVE", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}


#: Column of the raw line of a row that doesn't fit its schema.
CORRUPT = "_corrupt_record"


def list_files(spark: SparkSession, folder: str, modified_after: datetime | None = None) -> DataFrame:
    """(path, file_name, size, modified) of every file under ``folder``, or
    of those modified later (in the session's time zone)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if modified_after:
        r = r.option("modifiedAfter", modified_after.strftime("%Y-%m-%dT%H:%M:%S"))
    df = r.load(folder).select("path", "length", "modificationTime")
    return df.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"),
                     F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def match_entity(files: DataFrame, keyword: str, suffix: str | None = ".csv",
                 case_sensitive: bool = False, on: str = "file_name") -> DataFrame:
    """Files whose name contains ``keyword`` (case-insensitive by default)
    and ends with ``suffix`` (None: any)."""
    name = F.col(on)
    kw = keyword.replace("*.csv", "").replace("*", "")
    cond = name.contains(kw) if case_sensitive else F.lower(name).contains(kw.lower())
    if suffix:
        cond = cond & F.col("file_name").endswith(suffix)
    return files.filter(cond)


def new_files(files: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Files not yet in the ledger (anti join on the full path)."""
    if ledger is None:
        return files
    done = ledger.select(F.col("file_path").alias("path"))
    return files.join(done, "path", "left_anti")


def committed_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that the ledger has (semi join on the full path)."""
    return files.join(ledger.select(F.col("file_path").alias("path")), "path", "left_semi")


def archive(spark: SparkSession, paths: Sequence[str], folder: str) -> None:
    """Move files to ``folder``, some at a time: one rename each.  One that is
    gone already was moved by a run before; a name that the folder has gets a
    prefix."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(folder).getFileSystem(conf)
    fs.mkdirs(Path(folder))

    def move(path):
        source, name = Path(path), path.rsplit("/", 1)[-1]
        if not fs.exists(source):
            return
        goal = Path(folder, name)
        goal = Path(folder, f"{uuid.uuid4().hex[:8]}-{name}") if fs.exists(goal) else goal
        if not fs.rename(source, goal):
            raise OSError(f"{path} can't be moved to {goal.toString()}")

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(move, paths))


def read_csv(spark: SparkSession, paths: list[str], schema: StructType | None = None,
             infer: bool = False, corrupt: bool = False) -> DataFrame:
    """One scan over all paths.  With a schema, a value that does not fit its
    type becomes NULL (PERMISSIVE); the file of every row is kept in
    ``_source_path``.  ``corrupt`` adds the line of each row that has such a
    value, or too few or too many, as ``_corrupt_record``."""
    r = spark.read.options(**CSV_READ)
    if schema is not None:
        if corrupt:
            schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
            r = r.option("columnNameOfCorruptRecord", CORRUPT)
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", "true")
    df = r.csv(paths)
    return df.withColumn("_source_path", source_path())


def as_text(schema: StructType):
    """The values of a captured line as text: a struct of the schema's names,
    NULL for a row without fault."""
    return F.from_csv(CORRUPT, ", ".join(f"`{f.name}` string" for f in schema.fields), {k: v for k, v in CSV_READ.items() if k != "header"})


def source_path():
    """Per-row source file as the listing spells it.  ``_metadata.file_path``
    is a URI (``x%20copy.csv``); decode the escapes (a literal ``+`` is kept)
    so the ledger and the listing compare equal."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def stage_csv(df: DataFrame, folder: str, name_col: str, suffix: str = ".csv") -> None:
    """Write ``df`` as CSV files named ``<name>-<n><suffix>`` in a flat
    ``folder`` (one logical file per value of ``name_col``, possibly split in
    parts).  Spark writes the parts in parallel; the driver only renames
    them, one metadata call per file.  A suffix that ends in ``.gz`` asks for
    compressed files; each is read by one task, and as large as what one task
    wrote."""
    spark = df.sparkSession
    tmp = f"{folder.rstrip('/')}/_tmp-{uuid.uuid4().hex[:8]}"
    packed = {"compression": "gzip"} if suffix.endswith(".gz") else {}
    df.write.options(**CSV_WRITE, **packed).partitionBy(name_col).csv(tmp)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(tmp).getFileSystem(conf)
    parts = fs.globStatus(Path(f"{tmp}/{name_col}=*/part-*"))
    counters: dict[str, int] = {}
    for st in parts:
        p = st.getPath()
        logical = p.getParent().getName().split("=", 1)[1]
        i = counters.get(logical, 0)
        counters[logical] = i + 1
        fs.rename(p, Path(f"{folder.rstrip('/')}/{logical}-{i:05d}{suffix}"))
    # The emptied _tmp-* folder is hidden from Spark listings (leading "_").


def logical_name(path_col: str = "_source_path"):
    """``transactions_1996-00003.csv`` -> ``transactions_1996``."""
    return F.regexp_extract(F.element_at(F.split(F.col(path_col), "/"), -1), r"^(.*)-\d+\.csv$", 1)
