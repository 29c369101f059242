"""Benchmark decontamination by winnowing.

Both sides are word sequences.  Every run of GRAM words is hashed; of each
SPAN - GRAM + 1 neighbouring hashes the least is kept as a fingerprint, so
two texts that share SPAN words in a row share a fingerprint inside that
span.  A document's fingerprints are joined to the benchmark's; each hit is
extended to all spans of SPAN words that contain it, which are looked up
among the items' spans and then compared word by word.  An item of fewer
than SPAN words is one span of its own length; documents are looked up for
each such length directly.

The benchmark's fingerprints are broadcast in blocks of at most BLOCK_WORDS
words (a stated query set against all rows): one pass over the documents a
block, whatever the benchmark's size.  The passes' hits are then merged.

Cases: a null or empty text has no words and is clean; an item without words
matches nothing; null or repeated item ids are counted once, a null id as
the empty string; repeated documents each get their row; empty tables give
no rows, or clean documents; texts of any length are read whole; other
columns are ignored."""

from __future__ import annotations

import hashlib
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, common

SPAN = 10
GRAM = 5
#: Words of benchmark text that one pass holds in a task's memory.
BLOCK_WORDS = 1 << 20


class _Text:
    """Rows of text as words: their spans in the lower-cased bytes, hashes."""

    def __init__(self, column: pa.Array):
        raw, off = arrays.utf8(column)
        self.data = arrays.lower(raw)
        self.start, self.stop, self.before = arrays.word_spans(self.data, off, arrays.ALNUM)
        self.hash = arrays.Spans(self.data).hash(self.start, self.stop)
        self.row = arrays.rows_of(self.before)
        self.last = self.before[1:][self.row] if len(self.row) else self.row  # where each word's row ends

    def runs(self, k: int, at: np.ndarray) -> np.ndarray:
        """Hash of the ``k`` words from each position on."""
        h = np.full(len(at), k, np.uint64)
        for j in range(k):
            h = arrays.mix(h * np.uint64(0x9FB21C651E98DF25) + self.hash[at + j])
        return h

    def words(self, at: int, k: int) -> tuple[bytes, ...]:
        return tuple(self.data[s:e].tobytes() for s, e in zip(self.start[at:at + k], self.stop[at:at + k]))

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of the winnowed grams; the leftmost of equal
        least hashes."""
        n = len(self.hash) - GRAM + 1
        if n < SPAN - GRAM + 1:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = self.runs(GRAM, np.arange(n))
        least = arrays.sliding_min(h, SPAN - GRAM + 1)
        first = np.arange(len(least))
        whole = first + SPAN <= self.last[first]
        first, least = first[whole], least[whole]
        at, found = np.full(len(first), -1), np.zeros(len(first), bool)
        for j in range(SPAN - GRAM + 1):
            here = ~found & (h[first + j] == least)
            at[here], found = first[here] + j, found | here
        at = np.unique(at)
        return at, h[at]


class Probe:
    """One block of benchmark items, ready to be looked up."""

    def __init__(self, items: list[tuple[str, str | None]]):
        ids = [i for i, _ in items]
        t = _Text(pa.array([x for _, x in items], pa.large_string()))
        _, grams = t.fingerprints()
        self.grams = np.unique(grams)
        n = np.diff(t.before)
        self.spans: dict[int, tuple[np.ndarray, list]] = {}  # by length: sorted hashes, [(words, items)] of each
        for size in sorted({int(min(x, SPAN)) for x in n if x}):
            rows = np.flatnonzero(n >= SPAN) if size == SPAN else np.flatnonzero(n == size)
            at = np.concatenate([np.arange(t.before[r], t.before[r + 1] - size + 1) for r in rows])
            known: dict[int, dict] = {}
            for p, h in zip(at.tolist(), t.runs(size, at).tolist()):
                known.setdefault(h, {}).setdefault(t.words(p, size), set()).add(ids[t.row[p]])
            keys = np.array(sorted(known), np.uint64)
            self.spans[size] = keys, [known[int(k)] for k in keys]

    def _confirmed(self, t: _Text, size: int, at: np.ndarray):
        """(position, items) of the spans that begin at ``at`` and are some
        item's, word by word."""
        keys, spans = self.spans[size]
        h = t.runs(size, at)
        i = np.searchsorted(keys, h)
        i[i == len(keys)] = 0
        hit = keys[i] == h
        for p, k in zip(at[hit].tolist(), i[hit].tolist()):
            items = spans[k].get(t.words(p, size))
            if items:
                yield p, items

    def find(self, column: pa.Array):
        """For each row: its count of words, [(first word, last word + 1)] of
        merged hits, and the items that occur."""
        t = _Text(column)
        hits: dict[int, list] = {}
        items: dict[int, set] = {}
        for size in self.spans:
            if size == SPAN:
                at, h = t.fingerprints()
                i = np.searchsorted(self.grams, h)
                i[i == len(self.grams)] = 0
                at = at[self.grams[i] == h]
                at = np.unique((at[:, None] + np.arange(GRAM - SPAN, 1)).ravel())  # every span that contains it
            else:
                at = np.arange(len(t.hash))
            at = at[at >= 0]
            at = at[at + size <= t.last[at]] if len(t.last) else at[:0]
            at = at[at + size <= len(t.hash)]
            for p, own in self._confirmed(t, size, at):
                r = int(t.row[p])
                hits.setdefault(r, []).append((p - int(t.before[r]), p - int(t.before[r]) + size))
                items.setdefault(r, set()).update(own)
        n = np.diff(t.before)
        for r in range(len(column)):
            yield int(n[r]), merge(hits.get(r, [])), sorted(items.get(r, ()))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _find(items, batches):
    """(text, *kept) to (kept, n_words, hits, items).  The probe is built
    once a task from the broadcast items."""
    probe = Probe(items.value)
    for batch in batches:
        for i, j in arrays.slices(batch.column(0)):
            part = batch.slice(i, j - i)
            n, hits, found = zip(*probe.find(part.column(0)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[1:], pa.array(n, pa.int64()),
                 pa.array([[{"start": s, "stop": e} for s, e in x] for x in hits],
                          pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                 pa.array(found, pa.list_(pa.string()))],
                names=[*part.schema.names[1:], "n_words", "hits", "items"])


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int):
    """The benchmark in lists of (id, text) of about ``block_words`` words."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.col(text_col).cast("string").alias("t"))
    block, words = [], 0
    for r in rows.toLocalIterator():
        block.append((r.i, r.t))
        words += len(r.t or "") // 2 + 1  # words at most
        if words >= block_words:
            yield block
            block, words = [], 0
    if block:
        yield block


def find_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id_col, n_words, hits, items) of every document: the merged word
    ranges that benchmark spans cover and the ids of items that occur."""
    spark = docs.sparkSession
    common.bound_batches(spark)
    d = docs.select(F.col(text_col).cast("string").alias("_text"), F.col(id_col).cast("long").alias(id_col))
    schema = f"`{id_col}` long, n_words long, hits array<struct<start:long,stop:long>>, items array<string>"
    blocks = _blocks(benchmark, id_col=item_col, text_col=item_text_col, block_words=block_words)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        return d.mapInArrow(partial(_find, spark.sparkContext.broadcast(first)), schema)
    keyed = common.keyed(docs, id_col=id_col, text_col=text_col).select(F.col(text_col).alias("_text"), "_key", id_col)
    every = None
    for block in chain([first, second], blocks):
        found = keyed.mapInArrow(partial(_find, spark.sparkContext.broadcast(block)), f"_key long, {schema}")
        found = common.stage(found, "hits")
        every = found if every is None else every.unionByName(found)
    # a row for each pass and document: gather at most as many as passes
    merged = every.groupBy("_key").agg(
        F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    return keyed.select("_key", id_col).join(merged, "_key").drop("_key")


def _digest(batches):
    for batch in batches:
        hits = [merge([(x["start"], x["stop"]) for x in h]) for h in batch.column(2).to_pylist()]
        items = [sorted(set(x)) for x in batch.column(3).to_pylist()]
        n_hit = [sum(e - s for s, e in h) for h in hits]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n_hit, pa.int64()), pa.array(list(map(len, items)), pa.int64()),
             pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
             pa.array([n > 0 for n in n_hit], pa.bool_())],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def report(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """One row a document: counts of words, hit words and items, the digest
    of the item ids, and whether it is contaminated."""
    return find_hits(docs, benchmark, **kw).mapInArrow(
        _digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The documents (all their columns) in which no benchmark span occurs."""
    d = common.keyed(common.wrap(docs), "_rest")
    hit = find_hits(d.select(F.col("_key").alias("doc_id"), "text"), benchmark, **kw).filter(F.size("hits") > 0)
    left = d.join(hit.select(F.col("doc_id").alias("_key")).distinct(), "_key", "left_anti")
    return common.unwrap(left, docs.columns)
