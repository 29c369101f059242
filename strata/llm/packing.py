"""Hierarchical multi-length packing of documents into training sequences.

Documents are tokenized where Spark reads them and packed task by task, so
no token is shuffled.  A document gives as many full windows of the longest
tier as it holds; its remainder is routed to the smallest tier (TIERS) that
holds it.  Tiers are packed from the longest to the shortest: a remainder
opens a window of its tier, and the window's gap is filled from shorter
tiers, best fit first, cutting a piece where none fits.  Every tier is a
power of two, so its full windows need no padding; what a task has left at
its end (less than one window) is cut into powers of two.  Sequences of a
tier are then dealt to step groups with balanced attention cost.

Cases: a null or empty text has just the end id; each repeated row is packed
as a row of its own; null ids stay null; an empty table gives no rows; a
very long text gives many full windows; other columns are ignored."""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, common, tokens

#: Context sizes, longest first; each a power of two.
TIERS = (2048, 1024, 512, 256)
#: Ids of remainders that a task packs together.
POOL_TOKENS = 4 << 20
#: Sequences of a step group.
GROUP = 64

Piece = tuple[int, int, int]  # length, item, start in the item


def pack(pieces: list[Piece], tiers: tuple[int, ...] = TIERS) -> tuple[list[tuple[int, list[Piece]]], list[Piece]]:
    """(full windows as (size, pieces), the pieces of a last window that was
    not filled).  No piece may be longer than the first tier."""
    pool, windows = sorted(pieces), []
    for size in tiers:
        while pool and (pool[-1][0] > size // 2 or size == tiers[-1]):
            window = [pool.pop()]
            gap = size - window[0][0]
            while gap and pool:
                k = bisect_right(pool, gap, key=lambda p: p[0])
                if k:
                    window.append(pool.pop(k - 1))
                else:
                    n, item, start = pool.pop(0)
                    window.append((gap, item, start))
                    insort(pool, (n - gap, item, start + gap))
                gap -= window[-1][0]
            if gap:
                return windows, window
            windows.append((size, window))
    return windows, []


def powers(pieces: list[Piece]) -> list[tuple[int, list[Piece]]]:
    """Cut the pieces, end to end, into windows whose sizes are falling
    powers of two: the binary digits of their total."""
    left, windows = sum(p[0] for p in pieces), []
    queue = list(pieces)[::-1]
    while left:
        size = 1 << (left.bit_length() - 1)
        gap, window = size, []
        while gap:
            n, item, start = queue.pop()
            take = min(n, gap)
            window.append((take, item, start))
            if take < n:
                queue.append((n - take, item, start + take))
            gap -= take
        windows.append((size, window))
        left -= size
    return windows


def step_groups(windows: list[tuple[int, list[Piece]]], group: int = GROUP) -> list[int]:
    """A group number for each window: windows of one size, ``group`` to a
    step at most, dealt back and forth by falling attention cost."""
    out, first = [0] * len(windows), 0
    for size in sorted({s for s, _ in windows}, reverse=True):
        own = [i for i, (s, _) in enumerate(windows) if s == size]
        own.sort(key=lambda i: -sum(p[0] ** 2 for p in windows[i][1]))
        n = -(-len(own) // group)
        for rank, i in enumerate(own):
            turn, at = divmod(rank, n)
            out[i] = first + (at if turn % 2 == 0 else n - 1 - at)
        first += n
    return out


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group", "ids"]
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "tier int, step_group long")


class _Task:
    """The packing state of one task: remainders that wait, and counters."""

    def __init__(self, with_ids: bool):
        self.next_sequence = self.next_group = TaskContext.get().partitionId() << 32
        self.with_ids = with_ids
        self.rows: list[tuple] = []
        self._clear([])

    def _clear(self, kept: list[tuple]) -> None:
        self.items = kept  # (doc_id, start in the document, ids, doc_tokens)
        self.pool: list[Piece] = [(len(x[2]), i, 0) for i, x in enumerate(kept)]
        self.waiting = sum(p[0] for p in self.pool)

    def add(self, doc_id, ids: np.ndarray) -> None:
        full = len(ids) - len(ids) % TIERS[0]
        for at in range(0, full, TIERS[0]):
            self._piece(doc_id, at, ids[at:at + TIERS[0]], len(ids), self.next_sequence, 0, TIERS[0], self.next_group)
            self.next_sequence += 1
            if (self.next_sequence & (GROUP - 1)) == 0:
                self.next_group += 1
        if full < len(ids):
            self.pool.append((len(ids) - full, len(self.items), 0))
            self.items.append((doc_id, full, ids[full:].copy(), len(ids)))
            self.waiting += len(ids) - full

    def _piece(self, doc_id, start, ids, total, sequence, offset, tier, group) -> None:
        raw = ids.astype("<u4").tobytes()
        row = (doc_id, start, len(ids), zlib.crc32(raw), total, sequence, offset, tier, group)
        self.rows.append(row + (ids.tolist(),) if self.with_ids else row)

    def flush(self, last: bool) -> None:
        windows, rest = pack(self.pool)
        if last:
            windows += powers(rest)
            rest = []
        groups = step_groups(windows)
        self.next_group += 1
        for (size, window), group in zip(windows, groups):
            offset = 0
            for n, item, start in window:
                doc_id, begin, ids, total = self.items[item]
                self._piece(doc_id, begin + start, ids[start:start + n], total, self.next_sequence, offset, size,
                            self.next_group + group)
                offset += n
            self.next_sequence += 1
        self.next_group += max(groups, default=0) + 1
        kept = []
        for n, item, start in rest:
            doc_id, begin, ids, total = self.items[item]
            kept.append((doc_id, begin + start, ids[start:start + n], total))
        self._clear(kept)

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()] + ([pa.list_(pa.int32())] if self.with_ids else [])
        columns = zip(*rows) if rows else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_NAMES[:len(kinds)])


def _pack(path: str, with_ids: bool, batches):
    enc, task = tokens.encoder(path), _Task(with_ids)
    for batch in batches:
        for i, j in arrays.slices(batch.column(1), tokens.SLICE_BYTES):
            part = batch.slice(i, j - i)
            ids, off = enc.encode(part.column(1))
            for r, doc_id in enumerate(part.column(0).to_pylist()):
                task.add(doc_id, np.append(ids[off[r]:off[r + 1]], np.uint16(tokens.END_ID)))
            if task.waiting >= POOL_TOKENS:
                task.flush(last=False)
            yield task.take()
    task.flush(last=True)
    yield task.take()


def pack_documents(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = False) -> DataFrame:
    """One row a piece: see SCHEMA; with ``with_ids`` also its ids."""
    common.bound_batches(docs.sparkSession)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(partial(_pack, tokenizer or tokens.default_path(), with_ids),
                        SCHEMA + (", ids array<int>" if with_ids else ""))
