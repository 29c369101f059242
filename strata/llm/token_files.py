"""Token-id files: tokenize, order, entropy-code, read back.

``write`` lays three Parquet tables under one folder:

* ``tokens``: (range, _key, id, n_tokens, ids) - the ids, in no order; what
  the coder reads, and restarts from.
* ``frequencies``: (token, freq) - the shared table, from the counts of *all*
  ids; at most 65,536 rows.
* ``blocks``: (bucket, first_key, block, n_tokens, payload) - each payload is a
  self-contained block (see :func:`pack_block`) of whole documents,
  about BLOCK_TOKENS ids, with checkpoints and checksums.  Documents ascend
  by key over the part files in the order of their names, and within them.

Buckets are ranges of the key with about equally many ids, put together of
smaller ranges, and each is one part file.  Spark's writers commit the files, so lost tasks and
executors leave no torn block.

Cases: a null or empty text has just the end id; repeated rows and null ids
follow ``common.keyed`` (a repeated row is written once for each of its
rows); an empty table gives empty tables; a very long text makes one long
block; other columns are ignored."""

from __future__ import annotations

import struct
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import arrays, common, rans, tokens

BLOCK_TOKENS = 1 << 18
MAGIC = b"RTOK0001"
_HEAD = struct.Struct("<8sQQQQII")  # magic, documents, ids, words, checkpoints, crc of ids, crc of the rest


def pack_block(coder: rans.Coder, keys: np.ndarray, ids: list[int | None], sizes: np.ndarray, symbols: np.ndarray) -> bytes:
    """Header; keys, ids (with a null flag) and lengths of the documents;
    checkpoint places and states; the coded words.  Little-endian."""
    words, states, places = coder.encode(symbols)
    null = np.array([i is None for i in ids], np.uint8)
    own = np.array([0 if i is None else i for i in ids], "<i8")
    body = b"".join(x.tobytes() for x in (
        keys.astype("<i8"), own, null, sizes.astype("<i8"), places.astype("<i8"), states.astype("<u4"), words.astype("<u2")))
    head = _HEAD.pack(MAGIC, len(keys), len(symbols), len(words), len(places),
                      zlib.crc32(symbols.astype("<u2").tobytes()), zlib.crc32(body))
    return head + body


def unpack_block(coder: rans.Coder, payload: bytes, check: bool = True):
    """(keys, ids, sizes, symbols); raises if a checksum differs."""
    magic, docs, n, n_words, n_marks, crc_ids, crc_body = _HEAD.unpack_from(payload)
    body = memoryview(payload)[_HEAD.size:]
    if magic != MAGIC or check and zlib.crc32(body) != crc_body:
        raise ValueError("damaged block")
    at = 0

    def take(kind, count):
        nonlocal at
        out = np.frombuffer(body, kind, count, at)
        at += out.nbytes
        return out

    keys, own, null, sizes = take("<i8", docs), take("<i8", docs), take("u1", docs), take("<i8", docs)
    places, states = take("<i8", n_marks), take("<u4", n_marks * rans.LANES).reshape(-1, rans.LANES)
    symbols = coder.decode(n, take("<u2", n_words), states, places)
    if check and zlib.crc32(symbols.astype("<u2").tobytes()) != crc_ids:
        raise ValueError("damaged block: ids differ")
    return keys, [None if z else int(i) for i, z in zip(own, null)], sizes, symbols


def _tokenize(path: str, bounds: list[int], batches):
    """Arrow batches (_key, id, text) to (range, _key, id, n_tokens, ids)."""
    enc, bounds = tokens.encoder(path), np.asarray(bounds, np.int64)
    for batch in batches:
        for i, j in arrays.slices(batch.column(2), tokens.SLICE_BYTES):
            part = batch.slice(i, j - i)
            ids, off = enc.encode(part.column(2))
            n = len(part)
            at = off + np.arange(n + 1)  # with the end ids
            out = np.empty(at[-1], "<u2")
            ends = np.zeros(at[-1], bool)
            ends[at[1:] - 1] = True
            out[ends], out[~ends] = tokens.END_ID, ids
            binary = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), n, [None, pa.py_buffer((at * 2).astype(np.int64)), pa.py_buffer(out)]).cast(pa.binary())
            own = np.searchsorted(bounds, part.column(0).to_numpy(zero_copy_only=False), "right")
            yield pa.RecordBatch.from_arrays(
                [pa.array(own.astype(np.int32)), part.column(0), part.column(1), pa.array(np.diff(at)), binary],
                names=["range", "_key", "id", "n_tokens", "ids"])


def _symbols(column: pa.Array) -> np.ndarray:
    c = column.cast(pa.large_binary())
    off = np.frombuffer(c.buffers()[1], np.int64)[c.offset:c.offset + len(c) + 1]
    return np.frombuffer(c.buffers()[2], np.uint8)[off[0]:off[-1]].view("<u2")


def _count(batches):
    """Counts of ids, one row for each id that a task has seen."""
    counts = np.zeros(rans.SCALE, np.int64)
    for batch in batches:
        if len(batch):
            counts += np.bincount(_symbols(batch.column(0)), minlength=rans.SCALE)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(counts[seen])], names=["token", "n"])


def _encode(freq: list[tuple[int, int]], block_tokens: int, batches):
    """Sorted (bucket, _key, id, n_tokens, ids) to blocks of whole documents
    of one bucket."""
    coder = rans.Coder(_table(freq))
    bucket, keys, ids, sizes, parts, total = None, [], [], [], [], 0
    number = TaskContext.get().partitionId() << 32

    def block():
        payload = pack_block(coder, np.concatenate(keys), ids, np.concatenate(sizes), np.concatenate(parts))
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int32()), pa.array([int(keys[0][0])]), pa.array([number]), pa.array([total]), pa.array([payload], pa.binary())],
            names=["bucket", "first_key", "block", "n_tokens", "payload"])

    for batch in batches:
        if not len(batch):
            continue
        b = batch.column(0).to_numpy(zero_copy_only=False)
        k, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 3))
        own, syms = batch.column(2).to_pylist(), _symbols(batch.column(4))
        ends = np.cumsum(n)
        i = 0
        while i < len(b):
            if bucket is not None and b[i] != bucket or total >= block_tokens:
                yield block()
                keys, ids, sizes, parts, total = [], [], [], [], 0
                number += 1
            bucket = int(b[i])
            begin = int(ends[i] - n[i])
            same = i + int(np.searchsorted(b[i:], bucket, "right"))
            j = min(i + 1 + int(np.searchsorted(ends[i:], begin + block_tokens - total, "left")), same)
            keys.append(k[i:j])
            ids += own[i:j]
            sizes.append(n[i:j])
            parts.append(syms[begin:int(ends[j - 1])])
            total += int(ends[j - 1]) - begin
            i = j
    if keys:
        yield block()


def _decode(freq: list[tuple[int, int]], batches):
    """Blocks to documents: (block, at, id, n_tokens, ids)."""
    coder = rans.Coder(_table(freq))
    for batch in batches:
        for r in range(len(batch)):
            keys, own, sizes, syms = unpack_block(coder, batch.column(1)[r].as_py())
            n, at = len(keys), np.concatenate([[0], np.cumsum(sizes)])
            binary = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), n, [None, pa.py_buffer((at * 2).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(syms))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column(0)[r].as_py()] * n, pa.int64()), pa.array(at[:-1]), pa.array(own, pa.int64()),
                 pa.array(np.diff(at)), binary],
                names=["block", "at", "id", "n_tokens", "ids"])


def _crc(batches):
    """(.., ids) to (.., crc32 of the ids as little-endian unsigned 32-bit)."""
    for batch in batches:
        last = batch.num_columns - 1
        crc = [zlib.crc32(np.frombuffer(x.as_buffer(), "<u2").astype("<u4").tobytes()) for x in batch.column(last)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(crc, pa.int64())],
                                         names=[*batch.schema.names[:last], "ids_crc32"])


def _table(freq: list[tuple[int, int]]) -> np.ndarray:
    out = np.zeros(max([t for t, _ in freq], default=0) + 1, np.int64)
    for t, f in freq:
        out[t] = f
    return out


def bounds(keys: DataFrame, buckets: int) -> list[int]:
    """Keys that cut the table into about equal ranges, at most ``buckets``."""
    cuts = keys.approxQuantile("_key", [i / buckets for i in range(1, buckets)], 0.2 / buckets) if buckets > 1 else []
    return sorted({int(c) for c in cuts})


#: Ranges of keys that are weighed for each bucket.
FINE = 8


def merged(sizes: dict[int, int], ranges: int, parts: int) -> list[int]:
    """For each of ``ranges`` ranges, with their sizes, the part it goes to:
    ``parts`` runs of ranges of about equal size, in order."""
    before = np.cumsum([0] + [sizes.get(r, 0) for r in range(ranges)])
    middle = (before[1:] + before[:-1]) / 2
    return np.minimum(middle * parts / max(int(before[-1]), 1), parts - 1).astype(int).tolist()


def write(docs: DataFrame, path: str, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text",
          buckets: int | None = None, block_tokens: int = BLOCK_TOKENS) -> None:
    """Write the token files of ``docs`` under ``path`` (a new folder)."""
    spark = docs.sparkSession
    tokenizer = tokenizer or tokens.default_path()
    d = common.keyed(docs, id_col=id_col, text_col=text_col).select("_key", F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    parts = buckets or 2 * common.partitions(spark)
    cuts = bounds(d.select(F.col("_key").cast("double").alias("_key")), FINE * parts)
    d.mapInArrow(partial(_tokenize, tokenizer, cuts), "range int, _key long, id long, n_tokens long, ids binary") \
        .write.option("compression", "zstd").parquet(f"{path}/tokens")
    ids = spark.read.parquet(f"{path}/tokens")
    counts = ids.select("ids").mapInArrow(_count, "token int, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(max([r.token for r in counts], default=0) + 1, np.int64)
    for r in counts:  # at most 65,536 rows
        n[r.token] = r.n
    freq = [(int(t), int(f)) for t, f in enumerate(rans.frequencies(n)) if f]
    spark.createDataFrame(freq, "token int, freq int").coalesce(1).write.parquet(f"{path}/frequencies")
    sizes = {r.range: r.n for r in ids.groupBy("range").agg(F.sum("n_tokens").alias("n")).collect()}  # a row a range
    bucket = F.split(F.lit(",".join(map(str, merged(sizes, len(cuts) + 1, parts)))), ",")[F.col("range")].cast("int")
    ids.select(bucket.alias("bucket"), "_key", "id", "n_tokens", "ids") \
        .repartitionById(parts, F.col("bucket")).sortWithinPartitions("_key") \
        .mapInArrow(partial(_encode, freq, block_tokens), "bucket int, first_key long, block long, n_tokens long, payload binary") \
        .write.option("compression", "none").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids): every document of the files, with its
    ids (unsigned 16-bit, little-endian) and the count of ids before it."""
    return _starts(spark, path, _decoded(spark, path))


def _decoded(spark: SparkSession, path: str) -> DataFrame:
    common.bound_batches(spark)
    freq = [(r.token, r.freq) for r in spark.read.parquet(f"{path}/frequencies").collect()]
    return spark.read.parquet(f"{path}/blocks").select("block", "payload").mapInArrow(
        partial(_decode, freq), "block long, at long, id long, n_tokens long, ids binary")


def _starts(spark: SparkSession, path: str, docs: DataFrame) -> DataFrame:
    """Replace (block, at) by start.  Only block heads are summed
    up: within a bucket by a window, over the buckets on one small table."""
    heads = spark.read.parquet(f"{path}/blocks").select("bucket", "first_key", "block", "n_tokens")
    sizes = heads.groupBy("bucket").agg(F.sum("n_tokens").alias("_n"))
    before = sizes.select("bucket", (F.sum("_n").over(Window.orderBy("bucket")) - F.col("_n")).alias("_before"))
    within = heads.select("bucket", "block", (F.sum("n_tokens").over(
        Window.partitionBy("bucket").orderBy("first_key", "block")
        .rowsBetween(Window.unboundedPreceding, -1))).alias("_within"))
    places = within.join(before, "bucket").select(
        "block", (F.col("_before") + F.coalesce("_within", F.lit(0))).alias("_at"))
    return docs.join(places, "block").select(
        "id", (F.col("_at") + F.col("at")).alias("start"),
        *[c for c in docs.columns if c not in ("block", "at", "id")])


def round_trip(docs: DataFrame, path: str, tokenizer: str | None = None) -> DataFrame:
    """Write the files, read them back: (doc_id, start, n_tokens, ids_crc32)."""
    spark = docs.sparkSession
    write(docs, path, tokenizer)
    crc = _decoded(spark, path).mapInArrow(_crc, "block long, at long, id long, n_tokens long, ids_crc32 long")
    return _starts(spark, path, crc).withColumnRenamed("id", "doc_id")
