"""Near-duplicate documents by SuperMinHash.

A document's set is its distinct runs of SHINGLE words (lower-cased A-Z,
words parted by white space; fewer words are one run, none is the empty set).

*Signatures.*  Every element ranks the SLOTS slots by a permutation of its
own and offers slot number ``rank`` the value ``rank + a fraction``; a slot
keeps the least offer.  Ranks of one element never repeat, which is what
lowers the variance against independent hashes.  Offers are made rank by
rank for many documents at once, and a document stops as soon as each of its
slots has an offer, because no later one is less.

*Groups.*  Documents with equal sets are one class from the start.  BANDS
bands of ROWS slots put the classes into buckets: a pair at the threshold of
0.75 shares none with probability (1 - 0.75**ROWS)**BANDS, 5e-6.  That takes
slots for independent, which they aren't where a few elements fill them all;
so sets of TINY elements at most also go into a bucket for each subset that
they may share with a similar one, and no pair of such sets is missed.
Candidates are confirmed on their full sets, along :mod:`linking`.

*Bounds.*  Elements that only one class of all candidates has can't be in an
intersection, so what a class shares with any other is at most its other
elements, its core.  That rules out the many variants of one text that differ
too much from each other, before they are paired.  Where many are left, their
parities are compared: of each of some classes of elements, several for each
element, whether a set has an odd number.  Sets differ in at least as many
elements as parities.  The hub of a bucket is the class that meets the most
classes in all its buckets: the text that its variants are most like.

Cases: texts without words are linked with nothing; repeated rows and null
ids follow ``common.keyed``; an empty table gives no rows; texts of any
length are read whole; other columns are ignored by :func:`groups` and kept
by :func:`keep_first`."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, common
from .linking import Bound, link

SHINGLE = 5
SLOTS = 131  # a prime: rank * step + offset visits every slot
ROWS = 4
BANDS = 32
TINY = 8
#: Link when SIMILAR[0] * |intersection| >= SIMILAR[1] * |union|.
SIMILAR = (100, 75)

_U = np.uint64
_NONE = _U(0xFFFFFFFFFFFFFFFF)


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct element hashes of each row, sorted within the row, and how
    many precede each row."""
    raw, off = arrays.utf8(column)
    data = arrays.lower(raw)
    start, stop, before = arrays.word_spans(data, off, arrays.NOT_SPACE)
    h, ahead = arrays.shingle_hashes(arrays.Spans(data).hash(start, stop), before, SHINGLE)
    for a, b in zip(ahead[:-1].tolist(), ahead[1:].tolist()):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[ahead[:-1][ahead[:-1] < len(h)]] = True
    return h[new], np.concatenate([[0], np.cumsum(new)])[ahead]


def signatures(h: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    """rows x SLOTS least offers.  The high byte of an offer is its rank."""
    n = len(ahead) - 1
    sig = np.full(n * SLOTS, _NONE)
    row = arrays.rows_of(ahead)
    seed = arrays.mix(h + _U(0x2545F4914F6CDD1D))
    step = (seed % _U(SLOTS - 1)).astype(np.int64) + 1
    slot = ((seed >> _U(32)) % _U(SLOTS)).astype(np.int64)
    value = h
    for rank in range(SLOTS):
        if not len(row):
            break
        offer = (arrays.mix(value + _U((rank + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> _U(8)) | _U(rank << 56)
        np.minimum.at(sig, row * SLOTS + slot, offer)
        if rank + 1 == SLOTS:
            break
        waiting = np.zeros(n, bool)
        own = np.unique(row) if rank > 4 else np.arange(n)
        waiting[own] = (sig.reshape(n, SLOTS)[own] == _NONE).any(axis=1)
        on = waiting[row]
        row, step, value = row[on], step[on], value[on]
        slot = (slot[on] + step) % SLOTS
    return sig.reshape(n, SLOTS)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """rows x BANDS bucket keys; the band's number is part of its key."""
    key = np.broadcast_to(arrays.mix(np.arange(1, BANDS + 1, dtype=_U)), (len(sig), BANDS))
    for r in range(ROWS):
        key = arrays.mix(key * _U(0x9FB21C651E98DF25) + sig[:, r * BANDS:(r + 1) * BANDS])
    return key


def _sums(h: np.ndarray, ahead: np.ndarray, salt: int) -> np.ndarray:
    total = np.concatenate([np.zeros(1, _U), np.cumsum(arrays.mix(h ^ _U(salt)), dtype=_U)])
    return total[ahead[1:]] - total[ahead[:-1]]


def subset_keys(h: np.ndarray) -> list[int]:
    """Bucket keys of the subsets of a tiny set that it may share, whole, with
    a similar set: one of at least SIMILAR of its size."""
    n, own = len(h), arrays.mix(h ^ _U(0x6A09E667F3BCC908))
    least = -(-SIMILAR[1] * n // SIMILAR[0])
    return [int(arrays.mix(own[list(c)].sum(keepdims=True) + _U(k))[0]) for k in range(least, n + 1) for c in combinations(range(n), k)]


def _buckets(bands: np.ndarray, h: np.ndarray, ahead: np.ndarray) -> pa.Array:
    """Each row's bucket keys as a list."""
    n = np.diff(ahead)
    tiny = np.flatnonzero((n > 0) & (n <= TINY))
    more = [subset_keys(h[ahead[r]:ahead[r + 1]]) for r in tiny]
    size = np.full(len(n), BANDS)
    size[tiny] += np.array([len(x) for x in more], np.int64)
    ends = np.concatenate([[0], np.cumsum(size)])
    keys = np.empty(ends[-1], _U)
    keys[(ends[:-1, None] + np.arange(BANDS)).ravel()] = bands.ravel()
    for r, x in zip(tiny, more):
        keys[ends[r] + BANDS:ends[r + 1]] = x
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(keys.view(np.int64)))


def _signed(batches):
    """(_key, id, text) to (_key, id, n_shingles, set_a, set_b, bands); the
    two sums tell equal sets apart from all others (128 bits)."""
    for batch in batches:
        for i, j in arrays.slices(batch.column(2)):
            part = batch.slice(i, j - i)
            h, ahead = shingle_sets(part.column(2))
            bands = band_keys(signatures(h, ahead))
            n, lists = np.diff(ahead), _buckets(bands, h, ahead)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(n), pa.array(_sums(h, ahead, 0x5851F42D4C957F2D).view(np.int64)),
                 pa.array(_sums(h, ahead, 0x14057B7EF767814F).view(np.int64)), lists],
                names=["_key", "id", "n_shingles", "set_a", "set_b", "bands"])


def _confirm(batches):
    """Sorted (hub, copy, guest, _key, text) to the links (a, b).  The hub's
    own row comes before its guests."""
    hub_key, hub = None, None
    for batch in batches:
        links = []
        for i, j in arrays.slices(batch.column(4)):
            part = batch.slice(i, j - i)
            h, ahead = shingle_sets(part.column(4))
            for r, (own, guest, key) in enumerate(zip(*(part.column(c).to_pylist() for c in (0, 2, 3)))):
                mine = h[ahead[r]:ahead[r + 1]]
                if not guest:
                    hub_key, hub = own, mine.copy()
                elif own == hub_key:
                    at = np.searchsorted(hub, mine)
                    at[at == len(hub)] = 0
                    common_ = int((hub[at] == mine).sum())
                    if SIMILAR[0] * common_ >= SIMILAR[1] * (len(hub) + len(mine) - common_):
                        links.append((own, key))
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())],
                                         names=["a", "b"])


def _elements(batches):
    """(_key, text) to (element, _key)."""
    for batch in batches:
        for i, j in arrays.slices(batch.column(1)):
            part = batch.slice(i, j - i)
            h, ahead = shingle_sets(part.column(1))
            key = part.column(0).to_numpy(zero_copy_only=False)[arrays.rows_of(ahead)]
            for a in range(0, len(h), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(h[a:a + (1 << 17)].view(np.int64)), pa.array(key[a:a + (1 << 17)])],
                                                 names=["h", "_key"])


def parities(h: np.ndarray) -> np.ndarray:
    """The parities of a set in longs: four classes or more for an element,
    a power of two, so that two halves put together are those of fewer."""
    words = 1 << max(0, int(len(h) - 1).bit_length() - 4)
    own = arrays.mix(h ^ _U(0x3C6EF372FE94F82B))
    out = np.zeros(words, _U)
    np.bitwise_xor.at(out, ((own >> _U(6)) & _U(words - 1)).astype(np.int64), _U(1) << (own & _U(63)))
    return out


def _parities(batches):
    """(_key, text) to (_key, parity)."""
    for batch in batches:
        for i, j in arrays.slices(batch.column(1)):
            part = batch.slice(i, j - i)
            h, ahead = shingle_sets(part.column(1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([parities(h[a:b]).view(np.int64) for a, b in zip(ahead, ahead[1:])], pa.list_(pa.int64()))],
                names=["_key", "parity"])


def _differences(a: str, b: str):
    """In how many parities two sets differ.  Similar sets have as many
    parities, or one has twice as many, which are folded."""
    def folded(x, other):
        n = F.size(other)
        halves = F.zip_with(F.slice(x, F.lit(1), n), F.slice(x, n + 1, n), lambda u, v: u.bitwiseXOR(v))
        return F.when(F.size(x) > n, halves).otherwise(F.col(x))
    both = F.zip_with(folded(a, b), folded(b, a), lambda u, v: F.bit_count(u.bitwiseXOR(v)))
    return F.aggregate(both, F.lit(0), lambda total, x: total + x)


def _finer(a, b):
    shared = F.floor((F.col(a[0]) + F.col(b[0]) - _differences(a[2], b[2])) / 2)
    return _likely(a[0], shared, F.col(b[0]))


def _likely(n: str, core, least_n):
    """Whether sets of n and least_n elements at least may be similar when
    they share ``core`` at most."""
    return SIMILAR[0] * core >= SIMILAR[1] * (F.col(n) + least_n - core)


def _bound(texts: DataFrame) -> Bound:
    """Of columns n (elements) and core (those that other classes have, too),
    and parity."""
    return Bound(("n", "core"),
                 pair=lambda a, b: _likely(a[0], F.least(a[1], b[1]), F.col(b[0])),
                 alone=lambda a, low: _likely(a[0], F.col(a[1]), F.greatest(F.col(low[0]), F.lit(1))),
                 finer=(texts.mapInArrow(_parities, "_key long, parity array<long>"), _finer))


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_key, id, n_shingles, component) of every row; component is a key."""
    d = common.keyed(docs, id_col=id_col, text_col=text_col).select("_key", F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    signed = common.stage(d.mapInArrow(
        _signed, "_key long, id long, n_shingles long, set_a long, set_b long, bands array<long>"), "signatures")
    some = signed.filter("n_shingles > 0")
    # written first: the join may then split the rows of a popular set
    classes = common.stage(some.groupBy("set_a", "set_b").agg(F.min("_key").alias("class")), "sets")
    member = common.stage(some.select("_key", "set_a", "set_b").join(classes, ["set_a", "set_b"]).select("_key", "class").distinct(), "classes")
    heads = member.filter("_key = class").select("_key")
    bucketed = some.dropDuplicates(["_key"]).join(heads, "_key", "left_semi").select("_key", F.explode("bands").alias("bucket"))
    several = bucketed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket", F.col("n").alias("size"))
    shared = common.stage(bucketed.join(several, "bucket"), "buckets")  # classes that share a bucket
    wanted = shared.select("_key").distinct()
    texts = common.stage(d.select("_key", "text").join(wanted, "_key", "left_semi").dropDuplicates(["_key"]), "texts")
    lone = texts.mapInArrow(_elements, "h long, _key long").groupBy("h").agg(F.count("*").alias("n"), F.min("_key").alias("_key")) \
        .filter("n = 1").groupBy("_key").agg(F.count("*").alias("lone"))
    values = some.select("_key", F.col("n_shingles").alias("n")).join(wanted, "_key", "left_semi").distinct().join(lone, "_key", "left")
    values = common.stage(values.select("_key", "n", (F.col("n") - F.coalesce("lone", F.lit(0))).alias("core")), "cores")
    met = shared.groupBy("_key").agg(F.sum("size").alias("met"))
    hubs = shared.join(met, "_key").groupBy("bucket").agg(F.max(F.struct("met", -F.col("_key"))).alias("best")) \
        .select("bucket", (-F.col("best.col2")).alias("hub"), F.col("best.met").alias("score"))
    shared = shared.drop("size")
    found = link(shared.join(hubs, "bucket"), values, _bound(texts), lambda _: texts, _confirm)
    classes = member.join(found, F.col("class") == F.col("node"), "left") \
        .select("_key", F.coalesce("component", "class").alias("component"))
    return signed.select("_key", "id", "n_shingles").join(classes, "_key", "left") \
        .withColumn("component", F.coalesce("component", "_key"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: (doc_id, n_shingles, component_id, kept)."""
    g = _grouped(docs, id_col, text_col)
    heads = g.filter("_key = component").select(F.col("_key").alias("component"), F.col("id").alias("component_id")).distinct()
    return g.join(heads, "component").select(
        F.col("id").alias(id_col), "n_shingles", "component_id", (F.col("_key") == F.col("component")).alias("kept"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents (all their columns) that come first in their group; of
    rows that repeat id and text, one stays."""
    d = common.keyed(common.wrap(docs, id_col, text_col), "_rest", id_col=id_col, text_col=text_col)
    kept = _grouped(docs, id_col, text_col).filter("_key = component").select("_key").distinct()
    return common.unwrap(d.dropDuplicates(["_key"]).join(kept, "_key", "left_semi"), docs.columns, id_col, text_col)
