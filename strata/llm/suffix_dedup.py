"""Exact removal of repeated byte strings, by a sparse suffix array.

A byte is removed if a string of WINDOW bytes that covers it also starts
earlier (in a document with a smaller key, or earlier in its own).

*Anchors.*  Of the grams (GRAM bytes) of each window, the one with the least
hash, the leftmost of equals, is the window's anchor.  It depends on the
window's bytes alone, so equal windows have equal grams at equal places, and
only anchors (about one in 40 bytes) need sorting.  Neighbouring windows with
one anchor form a segment.

*Collapse.*  Segments with equal bytes are equal window by window: all but
the first are removed, first among those a task reads, then among all.  So
of each different segment one copy goes on, however many there are.

*Sort.*  Different segments with one gram can still share windows.  Their
texts are fetched and the suffixes from the anchor on, and the reversed
texts before it, sorted by :mod:`suffix_sort`.  A window with ``o`` bytes
before the anchor equals another if the suffixes share WINDOW - o bytes and
the reversed texts ``o``: classes are read off the two arrays of common
prefixes, and all but the earliest of a class are removed.

*Popular grams.*  A gram with a large share of all anchors (more than a
quarter of a reducer's mean; at most four a reducer can be) is found from the
tasks' own counts.  Its windows are keyed by their whole text instead, which
collapses in each task, so no gram's segments pile up in one place.

Cases: a null or empty text has no bytes and no spans; texts shorter than
WINDOW lose nothing; repeated rows and null ids follow ``common.keyed`` (a
repeated row is one document, which is no earlier than itself); an empty
table gives no rows; a text of any length is read whole, in overlapping
pieces; other columns are ignored."""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, common, suffix_sort

WINDOW = 100
GRAM = 24
_GRAMS = WINDOW - GRAM + 1  # of a window
#: Bytes that one vectorised step takes; longer texts are read in pieces.
PIECE = 1 << 20
#: Anchors that a task collapses together.
COLLAPSE = 1 << 20
#: Segments that are sorted together, whole groups each.
SORTED = 100_000

_U = np.uint64
_PLACE = _U(0xFFFFFF)


class _Anchors:
    """The segments of some rows: arrays gram, digest, key, at, lo, hi; lo
    and hi are the first and last window's start, at the gram's."""

    def __init__(self, keys: np.ndarray, column: pa.Array):
        data, off = arrays.utf8(column)
        pieces = []  # (first byte, last byte + 1, first byte of the row, key)
        for r in np.flatnonzero(np.diff(off) >= WINDOW).tolist():
            s, e = int(off[r]), int(off[r + 1])
            while True:
                stop = min(s + PIECE, e)
                pieces.append((s, stop, int(off[r]), int(keys[r])))
                if stop == e:
                    break
                s = stop - WINDOW + 1
        self.data, self.parts = data, []
        i = 0
        while i < len(pieces):  # neighbouring pieces of about PIECE bytes
            j = i + 1
            while j < len(pieces) and pieces[j][1] - pieces[i][0] <= PIECE:
                j += 1
            self.parts.append(self._part(pieces[i:j]))
            i = j

    def _part(self, pieces):
        first, stop, row, key = np.array(pieces, np.int64).T
        base = int(first[0])
        data = self.data[base:int(stop[-1])]
        spans = arrays.Spans(data)
        n = len(data)
        all_at = np.arange(n - GRAM + 1)
        gram = spans.raw(all_at, all_at + GRAM)
        v = ((gram * _U(0x9FB21C651E98DF25)) & ~_PLACE) | all_at.astype(_U)
        least = arrays.sliding_min(v, _GRAMS)
        size = stop - first - WINDOW + 1  # windows of each piece
        piece = np.repeat(np.arange(len(first)), size)
        p = np.arange(len(piece)) - np.repeat(np.cumsum(size) - size, size) + (first - base)[piece]
        a = (least[p] & _PLACE).astype(np.int64)
        head = np.ones(len(p), bool)
        head[1:] = (a[1:] != a[:-1]) | (piece[1:] != piece[:-1])
        begin = np.flatnonzero(head)
        lo, hi, a, piece = p[begin], p[np.append(begin[1:], len(p)) - 1], a[begin], piece[begin]
        digest = arrays.mix(spans.hash(lo, hi + WINDOW) + (a - lo).astype(_U) * _U(0xD6E8FEB86659FD93))
        shift = base - row[piece]
        return {"gram": arrays.mix(gram[a]), "digest": digest, "key": key[piece], "at": a + shift, "lo": lo + shift, "hi": hi + shift,
                "spans": spans, "raw": gram, "shift": shift}


def _popular(share: float, batches):
    """(gram, n) of the grams that have ``share`` of a task's anchors (eight
    at least), and a row (null, anchors) for all of them."""
    grams, total, rows = [], 0, []

    def flush():
        if grams:
            g, n = np.unique(np.concatenate(grams), return_counts=True)
            often = n >= max(8, share * n.sum())
            rows.append((g[often].view(np.int64), n[often]))
            grams.clear()

    held = 0
    for batch in batches:
        for i, j in arrays.slices(batch.column(1)):
            part = batch.slice(i, j - i)
            for x in _Anchors(part.column(0).to_numpy(zero_copy_only=False), part.column(1)).parts:
                grams.append(x["gram"])
                held += len(x["gram"])
                total += len(x["gram"])
        if held > 4 * COLLAPSE:
            flush()
            held = 0
    flush()
    for g, n in rows:
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(n, pa.int64())], names=["gram", "n"])
    yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total], pa.int64())], names=["gram", "n"])


_ROW = ["k", "digest", "key", "at", "lo", "hi"]
_ROW_SCHEMA = "k long, digest long, key long, at long, lo long, hi long"
#: ``lo`` of a row that is a removed range: key's bytes at..hi.
_GONE = -1


def _merged(key: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Overlapping or touching ranges of one key as one."""
    o = np.lexsort((start, key))
    key, start, stop = key[o], start[o], stop[o]
    if not len(key):
        return key, start, stop
    head = np.ones(len(key), bool)
    head[1:] = key[1:] != key[:-1]
    # running maximum of stop within a key: lift each key above all before it
    lift = np.cumsum(head) * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + lift)
    head[1:] |= (start + lift)[1:] > reach[:-1]
    begin = np.flatnonzero(head)
    return key[begin], start[begin], (reach - lift)[np.append(begin[1:], len(key)) - 1]


def _segments(popular, batches):
    """Documents to rows of segments, each different one once a task, and of
    removed ranges."""
    popular = np.array(sorted(popular.value), np.int64).view(_U)
    popular.sort()
    held, n = [], 0

    def flush():
        k, digest, key, at, lo, hi = (np.concatenate(x) for x in zip(*held))
        both = arrays.mix(k ^ arrays.mix(digest))
        o = np.lexsort((at, key, both))
        same = np.zeros(len(o), bool)
        same[1:] = (both[o][1:] == both[o][:-1]) & (k[o][1:] == k[o][:-1]) & (digest[o][1:] == digest[o][:-1])
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(o))))
        first = o[head]
        itself = (key[o] == key[first]) & (at[o] == at[first])
        gone, kept = o[same & ~itself], o[~same]
        gk, gs, ge = _merged(key[gone], lo[gone], hi[gone] + WINDOW)
        cols = [(k[kept], digest[kept], key[kept], at[kept], lo[kept], hi[kept]),
                (arrays.mix(gk.view(_U)), np.zeros(len(gk), _U), gk, gs, np.full(len(gk), _GONE), ge)]
        for c in cols:
            for s in range(0, len(c[0]), 1 << 16):
                part = [x[s:s + (1 << 16)] for x in c]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view(np.int64) if x.dtype == _U else x, pa.int64()) for x in part], names=_ROW)

    for batch in batches:
        for i, j in arrays.slices(batch.column(1)):
            part = batch.slice(i, j - i)
            for x in _Anchors(part.column(0).to_numpy(zero_copy_only=False), part.column(1)).parts:
                rows = [x[c] for c in ("gram", "digest", "key", "at", "lo", "hi")]
                if len(popular):
                    f = np.searchsorted(popular, x["gram"])
                    f[f == len(popular)] = 0
                    hot = popular[f] == x["gram"]
                    if hot.any():
                        h = np.flatnonzero(hot)
                        size = (x["hi"] - x["lo"] + 1)[h]
                        w = np.repeat(h, size)
                        p = np.arange(len(w)) - np.repeat(np.cumsum(size) - size, size) + x["lo"][w]
                        here = p - x["shift"][w]
                        digest = arrays.mix(x["raw"][here] + _U(3) * x["raw"][here + _GRAMS // 2] + _U(7) * x["raw"][here + _GRAMS - 1])
                        held.append([x["spans"].hash(here, here + WINDOW), digest, x["key"][w], p, p, p])
                        n += len(w)
                        rows = [c[~hot] for c in rows]
                held.append(rows)
                n += len(rows[0])
        if n > COLLAPSE:
            yield from flush()
            held.clear()
            n = 0
    if held:
        yield from flush()


def _collapse(batches):
    """Rows sorted by (k, digest, key, at) to removed ranges (lo = _GONE) and
    the first copy of each segment whose k has others.  One row waits."""
    last = None  # (k, digest, key, at) of the current segment's first copy
    waiting = None  # the first copy of a k that has had one digest so far
    for batch in batches:
        if not len(batch):
            continue
        k, digest, key, at, lo, hi = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        gone = lo == _GONE
        pk, pd = (np.concatenate([[last[c] if last else 0], x[:-1]]) for c, x in ((0, k), (1, digest)))
        new_k = k != pk
        if last is None:
            new_k[0] = True
        new = new_k | (digest != pd)
        seg = ~gone
        # the first copy's place for each row
        heads = np.where(new, np.arange(len(k)), -1)
        head = np.maximum.accumulate(heads)
        fkey = np.where(head >= 0, key[np.maximum(head, 0)], last[2] if last else 0)
        fat = np.where(head >= 0, at[np.maximum(head, 0)], last[3] if last else 0)
        copy = seg & ~new & ~((key == fkey) & (at == fat))
        out = [(k[gone], digest[gone], key[gone], at[gone], lo[gone], hi[gone]),
               (k[copy], digest[copy], key[copy], lo[copy], np.full(copy.sum(), _GONE), hi[copy] + WINDOW)]
        # first copies: all of a k but its first, and that one if another follows
        firsts = np.flatnonzero(new & seg)
        follows = np.zeros(len(firsts), bool)  # the next first copy has the same k
        if len(firsts):
            follows[:-1] = k[firsts[1:]] == k[firsts[:-1]]
            emit = ~new_k[firsts] | follows
            if waiting is not None and not new_k[firsts[0]]:
                out.append(tuple(np.array([v]) for v in waiting))
                waiting = None
            e = firsts[emit]
            out.append((k[e], digest[e], key[e], at[e], lo[e], hi[e]))
            f = firsts[-1]
            waiting = tuple(int(c[f]) for c in (k, digest, key, at, lo, hi)) if not emit[-1] else None
        i = len(k) - 1
        last = (k[i], digest[i], fkey[i], fat[i])
        cols = [np.concatenate(c) for c in zip(*out)]
        if len(cols[0]):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=_ROW)


def _shrunk(batches):
    z = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array([z.compress(t.as_buffer()) if t.is_valid else None for t in batch.column(batch.num_columns - 1)], pa.binary())],
            names=[*batch.schema.names[:-1], "z"])


def _whole(z) -> bytes:
    return zstandard.ZstdDecompressor().decompress(z) if z is not None else b""


def _contexts(batches):
    """(z, rows of segments) to (k, key, at, lo, hi, context): the text of
    all windows of each segment."""
    for batch in batches:
        out = []
        for z, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = _whole(z)
            out += [(r["k"], r["key"], r["at"], r["lo"], r["hi"], text[r["lo"]:r["hi"] + WINDOW]) for r in rows]
        kinds = [pa.int64()] * 5 + [pa.binary()]
        cols = zip(*out) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["k", "key", "at", "lo", "hi", "context"])


def earlier(group: np.ndarray, key: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, contexts: list[bytes]):
    """Removed ranges (key, start, stop) among segments; ``group`` ascending."""
    n = len(group)
    size = np.fromiter(map(len, contexts), np.int64, n)
    begin = np.cumsum(size) - size
    text = b"".join(contexts)
    data = np.frombuffer(text + bytes(8), np.uint8)
    back = np.frombuffer(text[::-1] + bytes(8), np.uint8)
    before = at - lo  # bytes before the anchor; the most of any window
    right = begin + before, size - before
    left = len(text) - (begin + before), before
    classes = []
    for buf, (start, length) in ((data, right), (back, left)):
        perm = suffix_sort.order(buf, start, length, group)
        classes.append((perm, suffix_sort.neighbours(buf, start, length, perm, group)))
    rank = np.empty(n, np.int64)
    place = np.lexsort((at, key))
    rank[place] = np.cumsum(np.concatenate([[0], (key[place][1:] != key[place][:-1]) | (at[place][1:] != at[place][:-1])])) if n else 0
    least, most = at - hi, before
    gone = np.zeros((n, _GRAMS + 2), np.int8)
    own = np.empty((2, n), np.int64)
    for o in range(int(least.min()) if n else 0, int(most.max()) + 1 if n else 0):
        for c, ((perm, lcp), need) in enumerate(zip(classes, (WINDOW - o, o))):
            own[c, perm] = np.cumsum(lcp < need)
        on = np.flatnonzero((least <= o) & (o <= most))
        both = own[0, on] * (n + 1) + own[1, on]
        by = np.lexsort((rank[on], both))
        same = np.zeros(len(by), bool)
        same[1:] = both[by][1:] == both[by][:-1]
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))
        late = same & (rank[on][by] > rank[on][by[head]])
        gone[on[by[late]], o + 1] = 1
    turn = np.diff(gone, axis=1)
    r, first = np.nonzero(turn == 1)  # runs of removed windows, o = first..last-1
    _, last = np.nonzero(turn == -1)
    return key[r], at[r] - (last - 1), at[r] - first + WINDOW


def _sorted_groups(batches):
    """Contexts sorted by k to removed ranges, some whole groups at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def solve(parts):
        t = pa.Table.from_batches(parts).combine_chunks()
        cols = [t.column(c).to_numpy() for c in ("k", "key", "at", "lo", "hi")]
        group = np.cumsum(np.diff(cols[0], prepend=cols[0][0] - 1) != 0) if len(t) else cols[0]
        k, s, e = _merged(*earlier(group, *cols[1:], t.column("context").to_pylist()))
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (k, s, e)], names=["key", "start", "stop"])

    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        rows += len(batch)
        if rows >= SORTED:
            k = batch.column(0).to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(k, k[-1], "left"))  # the last group may go on
            if cut:
                yield solve([*held[:-1], batch.slice(0, cut)])
                held, rows = [batch.slice(cut)], len(batch) - cut
    if held:
        yield solve(held)


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents as (_key, id, z): texts packed by zstandard; removed ranges
    as (key, start, stop), which may overlap)."""
    spark = docs.sparkSession
    n = common.partitions(spark)
    d = common.keyed(docs, id_col=id_col, text_col=text_col)
    text = d.select("_key", text_col)
    share = 1 / (4 * n)
    counts = text.mapInArrow(partial(_popular, share), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = common.stage(counts, "grams")
    total = counts.filter("gram is null").select(F.sum("n")).first()[0] or 0
    # at most 1 / share grams can have a share of all anchors
    popular = [r.gram for r in counts.filter(F.col("gram").isNotNull() & (F.col("n") >= share * total)).select("gram").collect()]
    rows = text.mapInArrow(partial(_segments, spark.sparkContext.broadcast(popular)), _ROW_SCHEMA)
    rows = rows.repartition(n, "k").sortWithinPartitions("k", "digest", "key", "at").mapInArrow(_collapse, _ROW_SCHEMA)
    rows = common.stage(rows, "segments")
    packed = d.select("_key", F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_shrunk, "_key long, id long, z binary")
    # a document has fewer segments than bytes, so its list is bounded by its text
    wanted = rows.filter(F.col("lo") != _GONE).groupBy("key").agg(F.collect_list(F.struct(*[c for c in _ROW if c != "digest"])).alias("rows"))
    late = packed.join(wanted, F.col("_key") == F.col("key")).select("z", "rows") \
        .mapInArrow(_contexts, "k long, key long, at long, lo long, hi long, context binary") \
        .repartition(n, "k").sortWithinPartitions("k").mapInArrow(_sorted_groups, "key long, start long, stop long")
    ranges = rows.filter(F.col("lo") == _GONE).select("key", F.col("at").alias("start"), F.col("hi").alias("stop"))
    return packed, ranges.unionByName(late)


def _kept(with_text: bool, batches):
    """(id, z, starts and stops) to the report, or to what is left."""
    for batch in batches:
        out = []
        for i, z, rows in zip(*(batch.column(c).to_pylist() for c in range(3))):
            text = _whole(z)
            spans = sorted((r["start"], r["stop"]) for r in rows or ())
            runs: list[list[int]] = []
            for s, e in spans:
                if runs and s <= runs[-1][1]:
                    runs[-1][1] = max(e, runs[-1][1])
                else:
                    runs.append([s, e])
            edges = [0, *(x for run in runs for x in run), len(text)]
            left = b"".join(text[edges[j]:edges[j + 1]] for j in range(0, len(edges), 2))
            row = (i, len(text), len(text) - len(left), len(runs), hashlib.sha256(left).hexdigest())
            out.append(row + ([{"start": s, "stop": e} for s, e in runs], left) if with_text else row)
        kinds = [pa.int64()] * 4 + [pa.string()]
        if with_text:
            kinds += [pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.binary()]
        cols = zip(*out) if out else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"][:len(kinds)])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row a document: (doc_id, n_bytes, n_removed, n_spans, kept_sha256);
    with ``with_text`` also the removed spans and the bytes that are left."""
    packed, ranges = removed(docs, id_col, text_col)
    spans = ranges.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("rows"))
    return packed.join(spans, F.col("_key") == F.col("key"), "left").select("id", "z", "rows").mapInArrow(
        partial(_kept, with_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (
            ", spans array<struct<start:long,stop:long>>, kept binary" if with_text else ""))
