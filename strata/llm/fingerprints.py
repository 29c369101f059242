"""Document fingerprints by one-permutation MinHash.

A document's set is its runs of SHINGLE words (lower-cased A-Z, words parted
by white space; fewer words are one run).  Each run is hashed once; the high
bits choose one of BINS bins, which keeps its least hash.  An empty bin
borrows from the first filled bin in an order of its own, the same for every
document (optimal densification), and of each bin BITS low bits are stored,
packed.  Two fingerprints' likeness is the share of equal bins, corrected for
bins that agree by chance.

Cases: a text without words (null, empty, white space) has the empty
fingerprint, which is like another empty one (1.0) and unlike all else (0.0);
repeated rows and null ids follow ``common.keyed`` (a repeated row is one
document: the next document is the next different one); a table of one
document is its own next; an empty table gives no rows; other columns are
ignored."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, common
from .token_files import bounds

SHINGLE = 5
BINS = 512
BITS = 4
#: Borrowing goes through this many bins for all rows at once, then row by row.
_ROUNDS = 24
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)

_ORDER = _RANK = None


def _orders() -> tuple[np.ndarray, np.ndarray]:
    """For each bin, the order in which it asks the others, and its inverse."""
    global _ORDER, _RANK
    if _ORDER is None:
        cell = np.arange(BINS * BINS, dtype=np.uint64).reshape(BINS, BINS)
        _ORDER = np.argsort(arrays.mix(cell * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)), axis=1).astype(np.int16)
        _RANK = np.argsort(_ORDER, axis=1).astype(np.int16)
    return _ORDER, _RANK


def bins(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows x BINS least hashes, densified; which rows have words)."""
    raw, off = arrays.utf8(column)
    data = arrays.lower(raw)
    start, stop, before = arrays.word_spans(data, off, arrays.NOT_SPACE)
    h, ahead = arrays.shingle_hashes(arrays.Spans(data).hash(start, stop), before, SHINGLE)
    n = len(column)
    least = np.full(n * BINS, _EMPTY)
    shift = np.uint64(64 - (BINS - 1).bit_length())
    np.minimum.at(least, arrays.rows_of(ahead) * BINS + (h >> shift).astype(np.int64), h)
    least = least.reshape(n, BINS)
    filled = least != _EMPTY
    some = filled.any(axis=1)
    order, rank = _orders()
    out = least.copy()
    row, slot = np.nonzero(~filled & some[:, None])
    for t in range(_ROUNDS):
        if not len(row):
            break
        ask = order[slot, t]
        got = filled[row, ask]
        out[row[got], slot[got]] = least[row[got], ask[got]]
        row, slot = row[~got], slot[~got]
    for r in np.unique(row):
        own, have = slot[row == r], np.flatnonzero(filled[r])
        out[r, own] = least[r, have[rank[own][:, have].argmin(axis=1)]]
    return out, some


def codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows x BINS codes of BITS bits, which rows have words).  The bin's
    number goes into its code: a hash that several bins share through
    borrowing agrees by chance in each of them anew."""
    least, some = bins(column)
    own = np.arange(BINS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (arrays.mix(least + own) & np.uint64((1 << BITS) - 1)).astype(np.uint8), some


def packed(code: np.ndarray, some: np.ndarray) -> list[str]:
    bits = np.unpackbits(code[:, :, None], axis=2, count=BITS, bitorder="little").reshape(len(code), -1)
    rows = np.packbits(bits, axis=1, bitorder="little")
    return [r.tobytes().hex() if s else "" for r, s in zip(rows, some)]


def unpacked(fingerprint: str) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(bytes.fromhex(fingerprint), np.uint8), bitorder="little").reshape(BINS, BITS)
    return np.packbits(bits, axis=1, bitorder="little").ravel()


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Row by row, between codes as :func:`codes` gives them."""
    chance = 2.0 ** -BITS
    j = ((a[0] == b[0]).mean(axis=1) - chance) / (1 - chance)
    return np.where(a[1] & b[1], np.clip(j, 0, 1), np.where(a[1] | b[1], 0.0, 1.0))


def _fingerprints(batches):
    for batch in batches:
        for i, j in arrays.slices(batch.column(1)):
            part = batch.slice(i, j - i)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed(*codes(part.column(1))), pa.string())],
                                             names=["id", "fingerprint"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fingerprint) of every row; no shuffle."""
    common.bound_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")) \
        .mapInArrow(_fingerprints, "id long, fingerprint string").withColumnRenamed("id", id_col)


def _compared(batches):
    """Rows (bucket, guest, _key, id, text), sorted, to the report's rows.
    Each row is followed by its next document; a bucket's last by its guest,
    which begins the bucket that comes after."""
    schema = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def report(rows, after, copies):
        """rows: [(id, text)], the last one the next of the one before it;
        after: for each but that the place of its next text; copies: how often
        each occurs."""
        texts = [t for _, t in rows]
        edited = [t[:len(t) - len(t) // 2] + texts[a][:len(t) // 2] for t, a in zip(texts, after)]
        own, new = (codes(pa.array(x, pa.large_string())) for x in (texts, edited))
        n = len(edited)
        mine = own[0][:n], own[1][:n]
        columns = [[i for i, _ in rows[:n]], [len(t) for t in texts[:n]],
                   [hashlib.sha256(t.encode()).hexdigest() for t in edited], packed(*mine), packed(*new),
                   likeness(mine, new), likeness(mine, (own[0][after], own[1][after]))]
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema)
        yield batch
        for r, more in enumerate(copies):
            for a in range(1, more, common.BATCH_ROWS):
                yield batch.take(pa.array(np.full(min(common.BATCH_ROWS, more - a), r)))

    waiting, key, times = None, None, 0  # the row whose next document hasn't come yet, and how often it came
    rows, after, copies, size = [], [], [], 0
    for batch in batches:
        for bucket, guest, k, i, text in zip(*(batch.column(c).to_pylist() for c in range(5))):
            here = (bucket, guest, k)
            if waiting and here != key:
                rows.append(waiting)
                after.append(len(rows))
                copies.append(times)
                size += len(waiting[1])
                waiting, times = None, 0
                if size >= arrays.SLICE_BYTES or guest:
                    yield from report(rows + [(i, text or "")], after, copies)
                    rows, after, copies, size = [], [], [], 0
            key = here
            if not guest:  # rows of one key are equal
                waiting, times = (i, text or ""), times + 1


def _firsts(cuts):
    def firsts(batches):
        least: dict[int, int] = {}
        for batch in batches:
            keys = np.sort(batch.column(0).to_numpy(zero_copy_only=False))
            own, at = np.unique(np.searchsorted(cuts.value, keys, "right"), return_index=True)
            for b, k in zip(own.tolist(), keys[at].tolist()):
                least[b] = min(k, least.get(b, k))
        yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.int32()), pa.array(list(least.values()), pa.int64())], names=["bucket", "_key"])
    return firsts


def _dealt(cuts, guests):
    """(_key, id, text) with the bucket, and once more as a guest."""
    def dealt(batches):
        heads, hosts = guests.value

        def rows(part, bucket, guest):
            return pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(np.full(len(part), guest)), *part.columns],
                                              names=["bucket", "guest", "_key", "id", "text"])
        for batch in batches:
            for i, j in arrays.slices(batch.column(2)):
                part = batch.slice(i, j - i)
                keys = part.column(0).to_numpy(zero_copy_only=False)
                yield rows(part, np.searchsorted(cuts.value, keys, "right"), False)
                at = np.minimum(np.searchsorted(heads, keys), len(heads) - 1)
                head = np.flatnonzero(heads[at] == keys)
                if len(head):
                    yield rows(part.take(pa.array(head)), hosts[at[head]], True)
    return dealt


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text (its last half
    replaced by the beginning of the next document's), and how like they are.

    Texts are dealt once into buckets of neighbouring keys.  Each bucket also
    gets the first document of the bucket after it, so every row meets its
    next; only the first key of each bucket goes through the driver."""
    spark = docs.sparkSession
    n = common.partitions(spark)
    d = common.keyed(docs, id_col=id_col, text_col=text_col)
    cuts = spark.sparkContext.broadcast(np.array(bounds(d.select(F.col("_key").cast("double").alias("_key")), 4 * n), np.int64))
    first = d.select("_key").mapInArrow(_firsts(cuts), "bucket int, _key long").groupBy("bucket").agg(F.min("_key").alias("_key"))
    heads = sorted((r.bucket, r["_key"]) for r in first.collect())  # a row a bucket
    # the first document of a bucket is a guest of the bucket before; the very first one of the last
    hosts = np.array([heads[i - 1][0] for i in range(len(heads))], np.int32)
    guests = spark.sparkContext.broadcast((np.array([k for _, k in heads], np.int64), hosts))
    dealt = d.select("_key", F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .mapInArrow(_dealt(cuts, guests), "bucket int, guest boolean, _key long, id long, text string") \
        .repartitionById(n, F.pmod("bucket", F.lit(n)).cast("int")).sortWithinPartitions("bucket", "guest", "_key")
    return dealt.mapInArrow(_compared, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                            "edited_fingerprint string, near_edited double, near_next double")
