"""Ranked lexical search by pipelined term partitioning.

The terms of all items are dealt to OWNERS owners, the rarest to the first,
so that each owner has about as many postings.  Items travel in bundles of
ITEMS at most; a bundle meets the documents in blocks of about DOCS.  For a
bundle and a block, the bundle's items carry the terms that are still to be
seen and a sparse accumulator (documents and their scores so far).  They
pass the owners one after the other: each stage cogroups the bundles with
its owner's postings by (block, bundle), adds weight times frequency part as
64-bit integers, and sends on what is left of the terms and the accumulators
that are not 0.  As the commonest terms come last, little is carried.  The
last stage gives the best K documents of each item and block, and the best K
of those are the result; no document is left out before.

No list of postings is held by one task: a popular term's documents are
spread over all blocks.  Terms are compared by 64-bit hashes.  Documents are
sieved by SIEVE_BITS bits of the items' terms (a broadcast of fixed size);
the join with the owners' terms then decides.

Cases: null or empty texts have no terms, so such a document is never found
and such an item has no rows; equal scores are ordered by ascending document;
repeated rows and null ids follow ``common.keyed``, for items too (a repeated
row is one document or item); empty tables give no rows; texts of any length
are read whole; other columns are ignored."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import arrays, common

K = 10
OWNERS = 4
#: Documents of a block, about, and items of a bundle at most, about.
DOCS = 512
ITEMS = 256
SIEVE_BITS = 20

_COUNTED = "_key long, n long, terms array<long>, tfs array<long>"
_BUNDLES = "block int, bundle int, item long, owners array<int>, terms array<long>, weights array<long>, docs array<long>, scores array<long>"
_BEST = "item long, doc long, score long"


def _counter(sieve=None):
    """A function from (_key, text) to each row's number of terms and, of
    those that pass the sieve, the distinct ones with their numbers."""
    def counted(batches):
        for batch in batches:
            for i, j in arrays.slices(batch.column(1)):
                part = batch.slice(i, j - i)
                raw, off = arrays.utf8(part.column(1))
                data = arrays.lower(raw)
                start, stop, before = arrays.word_spans(data, off, arrays.ALNUM)
                h, row = arrays.Spans(data).hash(start, stop), arrays.rows_of(before)
                if sieve is not None:
                    on = sieve.value[h >> np.uint64(64 - SIEVE_BITS)]
                    h, row = h[on], row[on]
                o = np.lexsort((h, row))
                h, row = h[o], row[o]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                at = np.flatnonzero(new)
                ends = pa.array(np.searchsorted(row[at], np.arange(len(part) + 1)).astype(np.int32))
                tfs = np.diff(np.append(at, len(h)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(before)), pa.ListArray.from_arrays(ends, pa.array(h[at].view(np.int64))),
                     pa.ListArray.from_arrays(ends, pa.array(tfs))], names=["_key", "n", "terms", "tfs"])
    return counted


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """A list column's values and, for each, its row."""
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(c.offsets.to_numpy())
    return c.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(c)), size)


def _lists(values: np.ndarray, row: np.ndarray, n: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32)), pa.array(values))


def _owner(number: int, k: int):
    """The cogroup of one owner: a bundle's items in a block with the owner's
    postings (term, doc, part) there.  The last owner gives the ``k`` best."""
    last = number == OWNERS - 1

    def visit(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        n = len(bundle)
        doc, doc_item = _flat(bundle["docs"])
        posted = postings["doc"].to_numpy()
        docs, place = np.unique(np.concatenate([doc, posted]), return_inverse=True)
        score = np.zeros((n, len(docs)), np.int64)  # this block's scratch; only what isn't 0 is carried
        score[doc_item, place[:len(doc)]] = _flat(bundle["scores"])[0]
        owner, item = _flat(bundle["owners"])
        (term, _), (weight, _) = _flat(bundle["terms"]), _flat(bundle["weights"])
        here = owner == number
        o = np.argsort(term[here], kind="stable")
        own, own_item, own_weight = term[here][o], item[here][o], weight[here][o]
        theirs = postings["term"].to_numpy()
        o = np.argsort(theirs, kind="stable")
        theirs, at, part = theirs[o], place[len(doc):][o], postings["part"].to_numpy()[o]
        for t in np.intersect1d(own, theirs):
            a, b = np.searchsorted(own, t), np.searchsorted(own, t, "right")
            c, d = np.searchsorted(theirs, t), np.searchsorted(theirs, t, "right")
            score[np.ix_(own_item[a:b], at[c:d])] += own_weight[a:b, None] * part[None, c:d]
        row, col = np.nonzero(score)
        value = score[row, col]
        keys = bundle["item"].combine_chunks()
        if last:
            o = np.lexsort((docs[col], -value, row))
            o = o[np.arange(len(o)) - np.searchsorted(row, row) < k]  # row is sorted, and stays so
            return pa.Table.from_arrays([keys.take(pa.array(row[o])), pa.array(docs[col[o]]), pa.array(value[o])], names=["item", "doc", "score"])
        rest = ~here
        return pa.Table.from_arrays(
            [bundle["block"], bundle["bundle"], keys, _lists(owner[rest].astype(np.int32), item[rest], n), _lists(term[rest], item[rest], n),
             _lists(weight[rest], item[rest], n), _lists(docs[col], row, n), _lists(value, row, n)],
            names=[f.split()[0] for f in _BUNDLES.split(", ")])

    return visit


def _owners(terms: DataFrame) -> DataFrame:
    """``terms`` (h, df, ..) with an owner: by classes of like frequency (some
    hundred at most), so that owners have about as many postings."""
    kind = F.floor(F.log2("df") * 4)
    sizes = sorted(terms.groupBy(kind.alias("kind")).agg(F.sum("df").alias("n")).collect())
    total, seen, first = sum(r.n for r in sizes), 0, []
    for r in sizes:
        first += [r.kind] * max(0, min(OWNERS - 1, seen * OWNERS // total) - len(first))
        seen += r.n
    owner = sum([F.when(kind >= x, 1).otherwise(0) for x in first], F.lit(0))
    return terms.withColumn("owner", owner.cast("int"))


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item, rank, doc, score): the ``k`` documents of the highest score above
    0 of each item, under the names of the id columns."""
    spark = docs.sparkSession
    d = common.keyed(docs, id_col=id_col, text_col=text_col)
    q = common.keyed(items, id_col=item_col, text_col=item_text_col)

    wanted = q.dropDuplicates(["_key"]).select("_key", item_text_col).mapInArrow(_counter(), _COUNTED)
    wanted = common.stage(wanted.select(F.col("_key").alias("item"), F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
                          .select("item", F.col("t.terms").alias("h"), F.col("t.tfs").alias("repeats")), "items")
    sieve = np.zeros(1 << SIEVE_BITS, bool)
    kept = F.shiftrightunsigned("h", 64 - SIEVE_BITS).alias("bits")
    sieve[wanted.select(kept).distinct().toArrow()["bits"].to_numpy()] = True  # 2**SIEVE_BITS values at most
    sieve = spark.sparkContext.broadcast(sieve)
    text = d.select("_key", text_col)
    n, distinct = d.agg(F.count("*"), F.countDistinct("_key")).first()
    text = text if n == distinct else text.dropDuplicates(["_key"])
    counted = common.stage(text.mapInArrow(_counter(sieve), _COUNTED).filter("n > 0"), "postings")
    n_docs, n_terms = counted.agg(F.count("*"), F.sum("n")).first()
    if not n_docs or wanted.isEmpty():
        return _named(spark.createDataFrame([], "item long, doc long, score long, rank int"), d, q, id_col, item_col)

    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    found = counted.select(F.explode("terms").alias("h")).groupBy("h").agg(F.count("*").alias("df")) \
        .join(wanted.select("h").distinct(), "h", "left_semi").withColumn("w", weight)
    found = common.stage(_owners(common.stage(found, "terms")), "terms")
    bundles = math.ceil(wanted.agg(F.countDistinct("item")).first()[0] / ITEMS)
    blocks = math.ceil(n_docs / DOCS)
    bundle = F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int").alias("bundle")
    carried = common.stage(wanted.join(found, "h").select("item", bundle, "owner", F.col("h").alias("term"), (F.col("w") * F.col("repeats")).alias("weight")), "bundles")
    none = F.array().cast("array<long>")
    state = carried.groupBy("bundle", "item").agg(F.collect_list(F.struct("owner", "term", "weight")).alias("t")) \
        .select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "bundle", "item", F.col("t.owner").alias("owners"),
                F.col("t.term").alias("terms"), F.col("t.weight").alias("weights"), none.alias("docs"), none.alias("scores"))
    asked = common.stage(carried.select("owner", "term", "bundle").distinct(), "owners")
    m = F.lit(25) + F.expr(f"(75L * n * {n_docs}L) div {n_terms}L")
    # the terms of an owner come to the bundles that have them, block by block
    shown = counted.select(F.col("_key").alias("doc"), m.alias("m"), F.explode(F.arrays_zip("terms", "tfs")).alias("t")) \
        .select("doc", F.col("t.terms").alias("term"), F.expr("(1000000000L * t.tfs) div (1000L * t.tfs + 8L * m)").alias("part"))
    block = F.pmod(F.xxhash64("doc"), F.lit(blocks)).cast("int").alias("block")
    for number in range(OWNERS):
        postings = shown.join(asked.filter(F.col("owner") == number).select("term", "bundle"), "term") \
            .select(block, "bundle", "term", "doc", "part")
        state = state.groupBy("block", "bundle").cogroup(postings.groupBy("block", "bundle")) \
            .applyInArrow(_owner(number, k), _BEST if number == OWNERS - 1 else _BUNDLES)
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
    best = common.stage(state.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), "best")
    return _named(best, d, q, id_col, item_col)


def _named(best: DataFrame, d: DataFrame, q: DataFrame, id_col: str, item_col: str) -> DataFrame:
    of = d.select(F.col("_key").alias("doc"), F.col(id_col).alias("_doc")).join(best.select("doc").distinct(), "doc", "left_semi").distinct()
    by = q.select(F.col("_key").alias("item"), F.col(item_col).alias("_item")).distinct()
    return best.join(of, "doc").join(by, "item").select(
        F.col("_item").alias(item_col), "rank", F.col("_doc").alias(id_col), "score")
