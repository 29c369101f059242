"""Fuzzy line deduplication by SimHash.

A line's normal form is its words (digits, ASCII letters in lower case,
anything beyond ASCII).  Digits stay as they are: lines of other numbers,
dates or sums are other lines.  Lines are alike when the edit
similarity of their word sequences is SIMILAR or more; equal normal forms are
alike without further ado.  Of each connected group only the first line
stays (least document key, then line).

Equal normal forms collapse first, within each task and then among all, so a
popular line reaches the join once.

A line's SimHash has BLOCKS blocks of 32 bits; its features are its words,
the second, third .. occurrence of a word being features of their own.  Each
block is a bucket, for lines of like length: lengths are cut into classes at
steps of STEP, in each block at other places.  Lines are candidates if they
share a bucket: always, if they have as many words and fewer than BLOCKS bits
differ (pigeonhole), and mostly if few words do.  README has the measured
shares by edit similarity.  Candidates are kept by a bound that no like lines exceed (an edit changes two of 256
parities of a line's words at most), and confirmed by the edit distance of
their words, along :mod:`linking`.  So lines are linked if, and only if, they
share a bucket and are alike, and no such link is lost.

Buckets of more than two lines, and the keys of lines whose words are wanted,
are broadcast while they are at most BROADCAST_ROWS rows, and else joined by a
shuffle; the result is the same.

Cases: a line without words is never a duplicate; a null or empty text has no
lines; repeated rows and null ids follow ``common.keyed`` (a repeated row is
one document); a document that loses all its lines with words
gets what is left, or goes (:func:`drop_repeated`); an empty table gives no rows; texts of any
length are read whole; other columns are ignored by :func:`report` and kept
by :func:`drop_repeated`."""

from __future__ import annotations

import math
import re
from functools import partial, reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, common
from .linking import Bound, link
from .suffix_dedup import _shrunk, _whole

BLOCKS = 16
STEP = 1.25
SIMILAR = 0.75
#: Lines that a task collapses together.
COLLAPSE = 1 << 19
#: Rows (of 24 bytes or so) that may be broadcast.
BROADCAST_ROWS = 100_000

#: Lines whose buckets a task groups together.
BANDED = 1 << 16
#: Parts, of which a task groups one at a time, for each shuffle partition.
PARTS = 4

#: Longs of the parities of a line's words.
PARITIES = ("p0", "p1", "p2", "p3")
#: Longs of its SimHash, two blocks each, the lower half first.  Longs cost
#: Spark much less than an array a row.
SKETCH = tuple(f"s{i}" for i in range(BLOCKS // 2))

_U = np.uint64

_NORMAL = np.arange(256, dtype=np.uint8)
_NORMAL[65:91] += 32

#: Words that are counted together, in eight binary digits.
RUN = 255
#: Words (of 64 bytes) that one step of the count holds.
COUNTED = 1 << 16
#: Words that are mixed at once, so that the steps stay in a core's cache.
MIXED = 1 << 11
#: Lines whose words' parities are counted at once.
PARTED = 1 << 11


def _digits(rows: list[np.ndarray]) -> list[np.ndarray]:
    """How many of ``rows`` have each bit set, as binary digits: bit arrays,
    the lowest first.  Three rows of a digit add up to one row of it and one
    of the next."""
    digits = []
    while rows:
        carried = []
        while len(rows) > 1:
            a, b = rows.pop(), rows.pop()
            both = a & b
            a = a ^ b
            if rows:
                c = rows.pop()
                both |= a & c
                a ^= c
            rows.append(a)
            carried.append(both)
        digits.append(rows[0])
        rows = carried
    return digits


def _above(digits: list[np.ndarray], bound: np.ndarray) -> np.ndarray:
    """The bits whose counts are above their row's bound, which has no more digits."""
    above, level = np.zeros_like(digits[0]), ~np.zeros_like(digits[0])
    for d in range(len(digits) - 1, -1, -1):
        own = (np.zeros(1, _U) - ((bound >> d) & 1).astype(_U))[:, None]  # all bits or none
        above |= level & digits[d] & ~own
        level &= ~(digits[d] ^ own)
    return above


class _Lines:
    """The lines of some rows: row and number of each, and its words."""

    def __init__(self, column: pa.Array):
        raw, off = arrays.utf8(column)
        data = _NORMAL[raw]
        start, stop, _ = arrays.word_spans(data, off, arrays.ALNUM)
        rows = np.flatnonzero(np.diff(off))
        begin = np.sort(np.concatenate([off[rows], np.flatnonzero(raw == 10) + 1]))
        end_of_row = np.searchsorted(off, begin, "right") - 1  # a row may end with a newline
        cut = np.isin(begin, off[rows])
        # a line that begins where the next row does is the row's last, empty one
        twice = np.zeros(len(begin), bool)
        twice[:-1] = begin[1:] == begin[:-1]
        self.row = end_of_row.copy()
        ends_text = twice | (begin == len(raw))
        if ends_text.any():
            self.row[ends_text] = np.searchsorted(off, begin[ends_text] - 1, "right") - 1
            cut = cut & ~ends_text
        first = np.maximum.accumulate(np.where(np.diff(self.row, prepend=-1) != 0, np.arange(len(begin)), 0)) if len(begin) else begin
        self.number = np.arange(len(begin)) - first
        self.before = np.append(np.searchsorted(start, begin), len(start))
        # words of an empty last line: none
        self.hash = arrays.Spans(data).hash(start, stop)

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        s, e = self.before[:-1], self.before[1:]
        return (arrays.Spans(arrays.mix(self.hash)).hash(s, e),
                arrays.Spans(arrays.mix(self.hash ^ _U(0x5851F42D4C957F2D))).hash(s, e))

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """A hash of each word of each line and of how often the line had it
        before, and how many precede each line."""
        line = arrays.rows_of(self.before).astype(_U)
        if len(self.before) <= 1 << 20:
            both = np.sort((line << _U(44)) | (self.hash >> _U(20)))
            line, word = both >> _U(44), both & _U((1 << 44) - 1)
        else:
            word = self.hash >> _U(20)
            o = np.lexsort((word, line))
            line, word = line[o], word[o]
        new = np.ones(len(word), bool)
        new[1:] = (line[1:] != line[:-1]) | (word[1:] != word[:-1])
        at = np.arange(len(word))
        again = at - np.maximum.accumulate(np.where(new, at, 0))
        return arrays.mix(word + again.astype(_U) * _U(0x9E3779B97F4A7C15)), self.before

    def simhash(self) -> np.ndarray:
        """lines x BLOCKS blocks of 32 bits."""
        hashes, before = self.features()
        n = np.diff(before)
        out = np.zeros((len(n), BLOCKS // 2), _U)
        some = np.flatnonzero(n)
        if not len(some):
            return out.view(np.uint32)
        # an even number of words counts the first of them twice: no ties
        odd, first = n[some] | 1, before[some]
        own = np.zeros((len(hashes) + 1, BLOCKS // 2), _U)  # the last row: no word
        seeds = np.array([(k + 1) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF for k in range(BLOCKS // 2)], _U)
        for s in range(0, len(hashes), MIXED):
            own[s:min(s + MIXED, len(hashes))] = arrays.mix(hashes[s:s + MIXED, None] + seeds)
        per = -(-odd // RUN)
        line = np.repeat(np.arange(len(some)), per)
        begin = RUN * (np.arange(len(line)) - (np.cumsum(per) - per)[line])
        size = np.minimum(odd[line] - begin, RUN)
        alone, order = per[line] == 1, np.lexsort((size, per[line] > 1))
        votes = np.zeros((len(some) if len(line) > len(some) else 0, out.shape[1] * 64), np.int64)
        i = 0
        while i < len(order):  # runs of like length, bits of all at once
            j = min(len(order), i + max(1, COUNTED // int(size[order[min(len(order), i + COUNTED // int(size[order[i]])) - 1]])))
            x = order[i:j]
            if alone[x[0]] != alone[x[-1]]:
                x = x[alone[x]]
            i += len(x)
            own_line, stop = line[x], begin[x] + size[x]
            at = begin[x] + np.arange(int(size[x].max()))[:, None]
            at = np.where(at < stop, np.where(at < n[some[own_line]], first[own_line] + at, first[own_line]), len(hashes))
            digits = _digits(list(own.take(at, axis=0)))
            if alone[x[0]]:
                out[some[own_line]] = _above(digits, odd[own_line] // 2)
            else:
                counts = sum(np.unpackbits(d.view(np.uint8), axis=1, bitorder="little").astype(np.int32) << e for e, d in enumerate(digits))
                o = np.argsort(own_line, kind="stable")
                heads = np.flatnonzero(np.diff(own_line[o], prepend=-1))
                votes[own_line[o][heads]] += np.add.reduceat(counts[o], heads, axis=0)
        long = np.flatnonzero(per > 1)
        if len(long):
            out[some[long]] = np.packbits(2 * votes[long] > odd[long][:, None], axis=1, bitorder="little").view(_U)
        return out.view(np.uint32)

    def parities(self) -> np.ndarray:
        """Of each line, which of 256 classes have an odd number of its words."""
        lines = len(self.before) - 1
        out = np.zeros((lines, 4), _U)
        at = (self.hash & _U(255)).astype(np.int64)
        for i in range(0, lines, PARTED):
            j = min(i + PARTED, lines)
            own = self.before[i:j + 1]
            counts = np.bincount((arrays.rows_of(own) << 8) + at[own[0]:own[-1]], minlength=(j - i) << 8)
            out[i:j] = np.packbits((counts & 1).astype(np.uint8).reshape(-1, 256), axis=1, bitorder="little").view(_U)
        return out


_ROW = "a long, b long, key long, line int, words int, gone boolean, length double, " + ", ".join(f"{c} long" for c in PARITIES + SKETCH)
_NUMBERED = _ROW + ", cid long"


def _batch(a, b, key, line, words, gone, parities, blocks):
    longs = [pa.array(np.ascontiguousarray(x)) for x in (*parities.view(np.int64).T, *np.ascontiguousarray(blocks).view(np.int64).T)]
    return pa.RecordBatch.from_arrays(
        [pa.array(x.view(np.int64), pa.int64()) for x in (a, b)] +
        [pa.array(key, pa.int64()), pa.array(line.astype(np.int32)), pa.array(words.astype(np.int32)), pa.array(gone, pa.bool_()),
         pa.array(np.log(words) / math.log(STEP)), *longs],
        names=["a", "b", "key", "line", "words", "gone", "length", *PARITIES, *SKETCH])


def _local(batches):
    """Documents (_key, text) to their lines with words: the first of each
    normal form that the task reads, and the others as gone."""
    held, n = [], 0

    def flush():
        a, b, key, line, words, parities, blocks = (np.concatenate(x) for x in zip(*held))
        o = np.lexsort((line, key, b, a))
        same = np.zeros(len(o), bool)
        same[1:] = (a[o][1:] == a[o][:-1]) & (b[o][1:] == b[o][:-1])
        first = o[np.maximum.accumulate(np.where(same, 0, np.arange(len(o))))]
        itself = (key[o] == key[first]) & (line[o] == line[first])
        kept, gone = o[~same], o[same & ~itself]
        for at, flag in ((kept, False), (gone, True)):
            for s in range(0, len(at), 1 << 16):
                x = at[s:s + (1 << 16)]
                yield _batch(arrays.mix(key[x].view(_U)) if flag else a[x], b[x], key[x], line[x], words[x], np.full(len(x), flag),
                             parities[x], np.zeros((len(x), BLOCKS), np.uint32) if flag else blocks[x])

    for batch in batches:
        for i, j in arrays.slices(batch.column(1)):
            part = batch.slice(i, j - i)
            x = _Lines(part.column(1))
            words = np.diff(x.before)
            some = words > 0
            a, b = x.digests()
            keys = part.column(0).to_numpy(zero_copy_only=False)
            held.append((a[some], b[some], keys[x.row[some]], x.number[some], words[some], x.parities()[some], x.simhash()[some]))
            n += int(some.sum())
        if n > COLLAPSE:
            yield from flush()
            held.clear()
            n = 0
    if held:
        yield from flush()


def _global(batches):
    """Rows sorted by (a, b, key, line), numbered: the first of each form
    stays."""
    last, number = None, TaskContext.get().partitionId() << 33
    for batch in batches:
        if not len(batch):
            continue
        a, b, key, line = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(4))
        gone = batch.column(5).to_numpy(zero_copy_only=False)
        pa_, pb = (np.concatenate([[last[c] if last else 0], x[:-1]]) for c, x in ((0, a), (1, b)))
        new = (a != pa_) | (b != pb)
        if last is None:
            new[0] = True
        head = np.maximum.accumulate(np.where(new, np.arange(len(a)), -1))
        fkey = np.where(head >= 0, key[np.maximum(head, 0)], last[2] if last else 0)
        fline = np.where(head >= 0, line[np.maximum(head, 0)], last[3] if last else 0)
        copy = ~gone & ~new & ~((key == fkey) & (line == fline))
        repeat = ~gone & ~new & ~copy
        last = (a[-1], b[-1], fkey[-1], fline[-1])
        numbers = np.arange(number, number + len(a))
        number += len(a)
        out = pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(gone | copy, pa.bool_()), *batch.columns[6:], pa.array(numbers)],
                                         names=[*batch.schema.names, "cid"])
        yield out.filter(pa.array(~repeat))


def _bands(bits, batches):
    """(cid, length, sketch) to the buckets of a task's lines, by the part
    (the first ``bits`` bits of its hash) that a bucket is in: (bucket, cid)
    of those with one line, (bucket, least cid, greatest cid, lines) of the
    others, as longs."""
    held, n = [], 0
    blocks = np.arange(BLOCKS)

    def packed(part, columns):
        off = np.searchsorted(part, np.arange((1 << bits) + 1)) * 8 * len(columns)
        data = np.ascontiguousarray(np.stack(columns, axis=1))
        return pa.Array.from_buffers(pa.binary(), 1 << bits, [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(data)])

    def flush():
        bucket, cid = (np.concatenate(x) for x in zip(*held))
        h = arrays.mix(bucket.view(_U))
        o = np.argsort(h)
        h, bucket, cid = h[o], bucket[o], cid[o]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        head = np.flatnonzero(new)
        count, part = np.diff(np.append(head, len(h))), (h[head] >> _U(64 - bits)).astype(np.int64)
        one, more = count == 1, count > 1
        x = head[one]
        alone = packed(part[one], [bucket[x], cid[x]])
        several = packed(part[more], [bucket[head[more]], np.minimum.reduceat(cid, head)[more], np.maximum.reduceat(cid, head)[more], count[more]])
        out = pa.RecordBatch.from_arrays([pa.array(np.arange(1 << bits, dtype=np.int32)), alone, several], names=["part", "alone", "several"])
        yield out.filter(pa.array(np.bincount(part, minlength=1 << bits) > 0))

    for batch in batches:
        if not len(batch):
            continue
        cid, length = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(2))
        sketch = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(2, batch.num_columns)], axis=1)
        kind = np.floor(length[:, None] + blocks / float(BLOCKS)).astype(np.int64)
        bucket = (blocks << 48) + (kind << 32) + np.ascontiguousarray(sketch).view(np.int32)
        held.append((bucket.ravel(), np.repeat(cid, BLOCKS)))
        n += len(batch)
        if n >= BANDED:
            yield from flush()
            held.clear()
            n = 0
    if held:
        yield from flush()


def _heads(batches):
    """The parts of all tasks, sorted, to (bucket, hub, far, n) of the buckets
    with more than one line."""
    part, alone, several = None, [], []

    def flush():
        one, more = (np.frombuffer(b"".join(x), np.int64).reshape(-1, k) for x, k in ((alone, 2), (several, 4)))
        bucket = np.concatenate([one[:, 0], more[:, 0]])
        o = np.argsort(bucket)
        bucket = bucket[o]
        new = np.ones(len(o), bool)
        new[1:] = bucket[1:] != bucket[:-1]
        head = np.flatnonzero(new)
        n = np.add.reduceat(np.concatenate([np.ones(len(one), np.int64), more[:, 3]])[o], head)
        hub = np.minimum.reduceat(np.concatenate([one[:, 1], more[:, 1]])[o], head)
        far = np.maximum.reduceat(np.concatenate([one[:, 1], more[:, 2]])[o], head)
        x = n > 1
        return pa.RecordBatch.from_arrays([pa.array(c[x]) for c in (bucket[head], hub, far, n)], names=["bucket", "hub", "far", "n"])

    for batch in batches:
        for p, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            if p != part and part is not None:
                yield flush()
                alone.clear()
                several.clear()
            part = p
            alone.append(a.as_py())
            several.append(b.as_py())
    if part is not None:
        yield flush()


def edit_distance(a: list, b: list, limit: int) -> int | None:
    """Edit distance of two sequences if at most ``limit``.  What they begin
    and end with in common is cut off; of the rest, a column of the table of
    distances is two numbers whose bits are its steps up and down."""
    if abs(len(a) - len(b)) > limit:
        return None
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    a, b = a[i:], b[i:]
    i = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b))) if x != y), len(a))
    a, b = a[:len(a) - i], b[:len(b) - i]
    if not a:
        return len(b)
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    every, last = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, d = every, 0, len(a)
    for done, y in enumerate(b, 1):
        same = where.get(y, 0)
        zero = ((((same & up) + up) ^ up) | same | down) & every
        higher, lower = (down | ~(zero | up)) & every, up & zero
        d += bool(higher & last) - bool(lower & last)
        if d - (len(b) - done) > limit:
            return None
        higher, lower = (higher << 1 | 1) & every, lower << 1 & every
        up, down = (lower | ~(zero | higher)) & every, higher & zero
    return d if d <= limit else None


def _alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the edit distance of two lines' words is within the limit.
    Most that are need only words replaced, and put in at one place; others
    take :func:`edit_distance`."""
    if len(a) > len(b):
        a, b = b, a
    gap, limit = len(b) - len(a), int(len(b) * (1 - SIMILAR))
    if gap > limit:
        return False
    if len(a):
        left, right = a != b[:len(a)], a != b[gap:]
        least = np.cumsum(left.view(np.int8) - right.view(np.int8), dtype=np.int64).min()
        if gap + np.count_nonzero(right) + min(least, 0) <= limit:
            return True
    return edit_distance(a.tolist(), b.tolist(), limit) is not None


def _confirm(batches):
    hub_key, hub = None, None
    for batch in batches:
        links = []
        own, _, guest, key = (batch.column(c).to_pylist() for c in range(4))
        off, words = batch.column(4).offsets.to_numpy(), batch.column(4).values.to_numpy(zero_copy_only=False)
        for r in range(len(own)):
            mine = words[off[r]:off[r + 1]]
            if not guest[r]:
                hub_key, hub = own[r], mine
            elif own[r] == hub_key and _alike(hub, mine):
                links.append((own[r], key[r]))
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())],
                                         names=["a", "b"])


def _parts(column: pa.Array):
    """(start, texts) of a column of texts or z, bounded by bytes."""
    if not pa.types.is_binary(column.type):
        for i, j in arrays.slices(column):
            yield i, column.slice(i, j - i)
        return
    start, held, size = 0, [], 0
    for i, z in enumerate(column):
        text = _whole(z.as_py())
        if held and size + len(text) > arrays.SLICE_BYTES:
            yield start, pa.array(held, pa.binary()).cast(pa.string())
            start, held, size = i, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield start, pa.array(held, pa.binary()).cast(pa.string())


def _words(batches):
    """(text or z, [(cid, line)]) to (_key, text): the hashes of a line's
    words."""
    for batch in batches:
        lists = batch.column(1)
        off = lists.offsets.to_numpy(zero_copy_only=False)
        cid, line = (x.to_numpy(zero_copy_only=False) for x in lists.values.flatten())
        for i, texts in _parts(batch.column(0)):
            x = _Lines(texts)
            own = off[i:i + len(texts) + 1]
            at = np.searchsorted(x.row, arrays.rows_of(own - own[0])) + line[own[0]:own[-1]]
            n = x.before[at + 1] - x.before[at]
            ahead = np.concatenate([[0], np.cumsum(n)])
            hashes = x.hash[np.repeat(x.before[at] - ahead[:-1], n) + np.arange(ahead[-1])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cid[own[0]:own[-1]], pa.int64()), pa.ListArray.from_arrays(pa.array(ahead, pa.int32()), pa.array(hashes.view(np.int64)))],
                names=["_key", "text"])


def _repeated(docs: DataFrame, packed: DataFrame) -> DataFrame:
    """(key, line) of every line to drop.  ``packed``: (_key, .., z)."""
    spark = docs.sparkSession
    n = common.partitions(spark)
    rows = docs.mapInArrow(_local, _ROW).repartition(n, "a").sortWithinPartitions("a", "b", "key", "line").mapInArrow(_global, _NUMBERED)
    rows = common.stage(rows.drop("a", "b"), "lines", {f"parquet.enable.dictionary#{c}": "false" for c in PARITIES + SKETCH})
    forms = rows.filter("not gone")
    # a bucket is a block's number, the class of the line's length and 32 bits
    def bucket(block, bits):
        return F.shiftleft(block.cast("long"), 48) + F.shiftleft(F.floor(F.col("length") + block / F.lit(float(BLOCKS))).cast("long"), 32) + bits

    banded = forms.select("cid", "length", F.posexplode(F.array(*SKETCH)).alias("pair", "bits")).select("cid", F.explode(F.array(
        bucket(F.col("pair") * 2, F.shiftright(F.shiftleft("bits", 32), 32)),
        bucket(F.col("pair") * 2 + 1, F.shiftright("bits", 32)))).alias("bucket"))
    # nearly all buckets have one line: a task's are shuffled as a row a part
    bits = (PARTS * n - 1).bit_length()
    heads = forms.select("cid", "length", *SKETCH).mapInArrow(partial(_bands, bits), "part int, alone binary, several binary")
    heads = common.stage(heads.repartition(n, "part").sortWithinPartitions("part").mapInArrow(_heads, "bucket long, hub long, far long, n long"),
                         "buckets")
    two = heads.filter("n = 2").select("bucket", F.explode(F.array("hub", "far")).alias("_key"), "hub")
    more = heads.filter("n > 2").select("bucket", "hub")
    more = F.broadcast(more) if more.count() <= BROADCAST_ROWS else more
    shared = common.stage(two.union(banded.join(more, "bucket").select("bucket", F.col("cid").alias("_key"), "hub")), "buckets")
    values = forms.select(F.col("cid").alias("_key"), "words", *PARITIES)
    values = common.stage(values.join(shared.select("_key").distinct(), "_key", "left_semi"), "values")
    # the edit distance is at least the difference of the numbers of words,
    # and half the number of parities that differ
    bound = Bound(("words", *PARITIES), lambda a, b: (F.least(a[0], b[0]) >= F.greatest(a[0], b[0]) * SIMILAR) & (
        reduce(add, [F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(a[1:], b[1:])])
        <= 2 * F.floor(F.greatest(a[0], b[0]) * (1 - SIMILAR))))

    def texts(keys):
        # a document's list is bounded by its lines
        few = keys.count() <= BROADCAST_ROWS
        keys = F.broadcast(keys) if few else keys
        wanted = forms.join(keys, F.col("cid") == F.col("_key")).groupBy("key").agg(F.collect_list(F.struct("cid", "line")).alias("rows"))
        if few:  # documents without such a line are left where they are
            found = docs.join(F.broadcast(wanted), F.col("_key") == F.col("key")).select("_text", "rows")
        else:
            found = packed.join(wanted, F.col("_key") == F.col("key")).select("z", "rows")
        return found.mapInArrow(_words, "_key long, text array<long>").dropDuplicates(["_key"])

    found = link(shared.withColumn("score", F.lit(0)), values, bound, texts, _confirm)
    grouped = forms.join(found, F.col("cid") == F.col("node")).select("component", "key", "line")
    least = grouped.groupBy("component").agg(F.min(F.struct("key", "line")).alias("first"))
    late = grouped.join(least, "component").filter(F.struct("key", "line") != F.col("first")).select("key", "line")
    return rows.filter("gone").select("key", "line").union(late)


_worded = re.compile(b"[0-9A-Za-z\x80-\xff]").search


def _kept(batches):
    """(.., z, dropped line numbers) to (.., n_lines, n_dropped, whether no
    line with words is left of some, text)."""
    for batch in batches:
        m = batch.num_columns - 2
        lines, dropped, hollow, texts = [], [], [], []
        for z, gone in zip(batch.column(m).to_pylist(), batch.column(m + 1).to_pylist()):
            text = _whole(z)
            own = text.split(b"\n") if text else []
            out = set(gone or ())
            left = [x for i, x in enumerate(own) if i not in out]
            lines.append(len(own))
            dropped.append(len(out))
            hollow.append(bool(out) and not any(map(_worded, left)))
            texts.append(None if z is None else b"\n".join(left))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:m], pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(hollow, pa.bool_()), pa.array(texts, pa.binary()).cast(pa.string())],
            names=[*batch.schema.names[:m], "_lines", "_dropped", "_hollow", "_text"])


def _deduped(docs: DataFrame, columns: list[str], id_col: str, text_col: str) -> DataFrame:
    d = common.keyed(docs, *columns, id_col=id_col, text_col=text_col)
    renamed = {c: f"_c{i}" for i, c in enumerate([id_col, *columns])}
    d = d.select("_key", *[F.col(c).alias(r) for c, r in renamed.items()], F.col(text_col).alias("_text"))
    packed_schema = d.drop("_text").schema.add("z", "binary")
    packed = d.mapInArrow(_shrunk, packed_schema)
    slim = d.select("_key", "_text").mapInArrow(_shrunk, "_key long, z binary")
    gone = _repeated(d.select("_key", "_text"), slim).groupBy("key").agg(F.collect_list("line").alias("_gone"))
    joined = packed.join(gone, F.col("_key") == F.col("key"), "left").select(*renamed.values(), "z", "_gone")
    out = joined.drop("z", "_gone").schema.add("_lines", "long").add("_dropped", "long").add("_hollow", "boolean").add("_text", "string")
    kept = joined.mapInArrow(_kept, out)
    return kept.select(*[F.col(r).alias(c) for c, r in renamed.items()], "_lines", "_dropped", "_hollow", "_text")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: (doc_id, n_lines, n_dropped, kept_sha256)."""
    return _deduped(docs, [], id_col, text_col).select(
        id_col, F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("_text", F.lit("")), 256).alias("kept_sha256"))


def drop_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents (all their columns) with the lines that stay; one that
    loses all its lines with words goes."""
    kept = _deduped(common.wrap(docs, id_col, text_col), ["_rest"], id_col, text_col).filter("not _hollow")
    return common.unwrap(kept.select(id_col, "_rest", F.col("_text").alias(text_col)), docs.columns, id_col, text_col)
