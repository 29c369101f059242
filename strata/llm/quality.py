"""Quality classifier: random-indexing word vectors pooled per document, a
two-layer network on top, temperature-calibrated.

*Elements.*  A word is white-space-parted text.  Its elements are the word in
lower case, its shape (runs of capitals, small letters, digits; marks as they
are) and its last marks.  Every element has a random sparse index vector,
fixed by its hash: DIM numbers, a few of them +1 or -1.

*Word vectors.*  A word's vector is the sum of its elements' index vectors
plus its context vector: the sum of the index vectors of the words beside it
over the fitting sample, scaled to length one.  Context vectors are kept in
CONTEXTS hash buckets, so the model's size is bounded whatever the
vocabulary.

*Documents.*  The mean of all words' vectors, the lengths of these means
(a text that repeats few words has long ones), how often a word has the
vector of the word before it, and the logarithm of the word count.  A two-layer numpy network turns them into a logit, which a
temperature fitted on rows that the weights haven't seen makes a probability.

Fitting takes at most SAMPLE labelled rows, the first by hash of their id;
scoring reads every whole text.  Labels, languages, sources and ids are never
inputs of a score.

Cases: a text without words (null, empty) has the zero vector and still a
score; a null label or id is not fitted on; repeated label rows count once
(the greater label); repeated documents each get their row; without labels of
both classes every score is the known share of label 1 (0.5 without labels);
an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays, common

DIM = 64
NONZERO = 6
CONTEXTS = 1 << 14
#: Labelled rows that the model is fitted on, at most.
SAMPLE = 12_000
#: Rows of the sample that only calibrate the temperature: one in so many.
CALIBRATE = 5
HIDDEN = 48
THRESHOLD = 0.3
FEATURES = 2 * DIM + 4
#: Text that one vectorised step works on, and words that are looked up at once.
SLICE = 1 << 20
PART = 1 << 15

_U = np.uint64


def _bins(h: np.ndarray) -> np.ndarray:
    """The sparse +-1 vector of each hash: NONZERO rows of 2 * dimension, and
    one more for +1."""
    out = np.empty((NONZERO, len(h)), np.uint8)
    for j in range(NONZERO):
        x = arrays.mix(h + _U((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        out[j] = (x >> _U(7)) & _U(2 * DIM - 2) | x & _U(1)  # DIM is a power of two
    return out


def _columns(bins: np.ndarray) -> np.ndarray:
    """The vectors of ``bins`` as columns, DIM numbers each."""
    out = np.zeros((DIM, bins.shape[1]), np.float32)
    at = np.arange(bins.shape[1])
    for b in bins:
        out[b >> 1, at] += np.where(b & 1, np.float32(1), np.float32(-1))
    return out


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the place of one of each of the different hashes, the number of each
    hash among them).  Hashes are told apart by their low bits, where those
    do, and by sorting the others."""
    slots = 1 << 15
    slot = (h & _U(slots - 1)).astype(np.int64)
    at = np.full(slots, -1)
    at[slot] = np.arange(len(h))
    other = np.flatnonzero(h[at[slot]] != h)
    used = np.flatnonzero(at >= 0)
    number = np.zeros(slots, np.int64)
    number[used] = np.arange(len(used))
    code, first = number[slot], at[used]
    if len(other):
        _, more, own = np.unique(h[other], return_index=True, return_inverse=True)
        code[other] = len(used) + own
        first = np.append(first, other[more])
    return first, code


# Shape classes of bytes: a small letter or any byte beyond ASCII, a capital,
# a digit; marks stand for themselves.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = _SHAPE[0x80:] = 1
_SHAPE[65:91] = 2
_SHAPE[48:58] = 3


class _Words:
    """The words of some rows: hashes of each word's elements, and how many
    words precede each row."""

    def __init__(self, column: pa.Array):
        raw, off = arrays.utf8(column)
        s, e, self.before = arrays.word_spans(raw, off, arrays.NOT_SPACE)
        shape = _SHAPE[raw]
        mark = shape > 3
        run = np.ones(len(shape), bool)
        run[1:] = (shape[1:] != shape[:-1]) | mark[1:]
        run[s] = True
        place = np.int32 if len(raw) < 1 << 31 else np.int64
        # hash the shape with runs collapsed: the buffer of run heads
        ahead = np.zeros(len(run) + 1, place)
        np.cumsum(run, out=ahead[1:])
        self.shape = arrays.Spans(shape[run]).hash(ahead[s].astype(np.int64), ahead[e].astype(np.int64))
        del ahead, run, shape
        last = np.where(mark, place(-1), np.arange(len(mark), dtype=place))
        np.maximum.accumulate(last, out=last)
        tail = np.maximum(last[e - 1].astype(np.int64) + 1, s)
        del last, mark
        spans = arrays.Spans(arrays.lower(raw))
        self.bare = spans.hash(s, e)
        self.marks = spans.hash(tail, e)  # marks have no lower case

    def form(self, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        """(bins of the different forms, the number of each word's form
        among them) of the words from ``i`` up to ``j``."""
        shape, marks = self.shape[i:j] ^ _U(0x5851F42D4C957F2D), self.marks[i:j] ^ _U(0x14057B7EF767814F)
        first, code = _distinct(arrays.mix(shape) + marks)
        return np.vstack([_bins(shape[first]), _bins(marks[first])]), code

    def buckets(self, i: int, j: int) -> np.ndarray:
        return (arrays.mix(self.bare[i:j]) % _U(CONTEXTS)).astype(np.int64)

    def parts(self):
        """(first row, last row + 1) of rows with about PART words; rows
        without words are left out at either end."""
        some = np.flatnonzero(np.diff(self.before))
        a = 0
        while a < len(some):
            b = max(int(np.searchsorted(self.before[some + 1], self.before[some[a]] + PART, "right")), a + 1)
            yield some[a:b]
            a = b


def features(column: pa.Array, context: np.ndarray) -> np.ndarray:
    return _features(column, np.ascontiguousarray(context.T))


def _features(column: pa.Array, columns: np.ndarray) -> np.ndarray:
    """``columns``: the context vectors, as columns: one number of all words
    at a time is looked up in a core's cache, and added up in order."""
    w = _Words(column)
    n = np.diff(w.before)[:, None]
    pooled = np.zeros((len(n), 2 * DIM))
    for rows in w.parts():
        i, j = int(w.before[rows[0]]), int(w.before[rows[-1] + 1])
        begin = w.before[rows] - i
        to = 2 * DIM * np.repeat(np.arange(len(rows)), n[rows, 0])
        votes = sum(np.bincount(to + b, minlength=2 * DIM * len(rows)) for b in _bins(w.bare[i:j])).reshape(-1, DIM, 2)
        pooled[rows, :DIM] = votes[:, :, 1] - votes[:, :, 0]
        bins, code = w.form(i, j)
        forms, bucket = _columns(bins), w.buckets(i, j)
        for d in range(DIM):
            pooled[rows, DIM + d] = np.add.reduceat(forms[d].take(code, mode="clip") + columns[d].take(bucket, mode="clip"), begin)
    pooled /= np.maximum(n, 1)
    mean_own, mean_form = pooled[:, :DIM], pooled[:, DIM:]
    length = lambda x: np.sqrt((x ** 2).sum(axis=1, keepdims=True))
    again = np.zeros(len(w.bare) + 1, np.int64)
    again[2:] = np.cumsum(w.bare[1:] == w.bare[:-1])  # pairs that end before each word
    pairs = again[w.before[1:]] - again[np.minimum(w.before[:-1] + 1, w.before[1:])]
    share = pairs[:, None] / np.maximum(n - 1, 1)
    return np.hstack([pooled, length(mean_own), length(mean_form), share, np.log1p(n) / 5]).astype(np.float32)


def _contexts(batches):
    """Sums of neighbours' index vectors by bucket, over a task's rows."""
    votes = np.zeros(CONTEXTS * 2 * DIM, np.int32)
    for batch in batches:
        for i, j in arrays.slices(batch.column(0), SLICE):
            w = _Words(batch.column(0).slice(i, j - i))
            beside = np.ones(len(w.bare), bool)  # the word before is of the same row
            beside[w.before[:-1][w.before[:-1] < len(beside)]] = False
            for a in range(0, len(w.bare), PART):
                lo, hi = max(a - 1, 0), min(a + PART, len(w.bare))
                y = np.flatnonzero(beside[lo + 1:hi]) + 1
                if not len(y):
                    continue
                form, code = w.form(lo, hi)
                bins = np.vstack([_bins(w.bare[lo:hi]), form.take(code, axis=1, mode="clip")]).T.copy()
                x, other = np.concatenate([y - 1, y]), np.concatenate([y, y - 1])
                order = np.argsort(w.buckets(lo, hi)[x], kind="stable")  # a bucket's votes are counted in a core's cache
                to = 2 * DIM * w.buckets(lo, hi)[x[order]]
                votes += np.bincount((to[:, None] + bins[other[order]]).ravel(), minlength=len(votes)).astype(np.int32)
    votes = votes.reshape(CONTEXTS, DIM, 2)
    table = (votes[:, :, 1] - votes[:, :, 0]).astype(np.float32)
    used = np.flatnonzero(table.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array([r.tobytes() for r in table[used]], pa.binary())], names=["bucket", "sums"])


def _add_up(batches):
    """Sum the rows of each bucket: the input is sorted by bucket."""
    bucket, total = None, None
    out = []
    for batch in batches:
        for b, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if b != bucket:
                if bucket is not None:
                    out.append((bucket, total.tobytes()))
                bucket, total = b, np.zeros(DIM, np.float32)
            total = total + np.frombuffer(s, np.float32)
    if bucket is not None:
        out.append((bucket, total.tobytes()))
    yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()), pa.array([s for _, s in out], pa.binary())],
                                     names=["bucket", "sums"])


def _pooled(columns, batches):
    for batch in batches:
        for i, j in arrays.slices(batch.column(2), SLICE):
            part = batch.slice(i, j - i)
            x = _features(part.column(2), columns.value)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([r.tobytes() for r in x], pa.binary())],
                                             names=["id", "label", "x"])


@dataclass
class Network:
    """Two layers: logit = tanh(x A + a) b + c, divided by a temperature."""
    mean: np.ndarray
    scale: np.ndarray
    A: np.ndarray
    a: np.ndarray
    b: np.ndarray
    c: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh(((x - self.mean) / self.scale) @ self.A + self.a)
        return h @ self.b + self.c

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))


def fit_network(x: np.ndarray, y: np.ndarray, epochs: int = 40, batch: int = 128, rate: float = 0.004, decay: float = 1e-4,
                seed: int = 7) -> Network:
    """Adam on the mean log loss."""
    rng = np.random.default_rng(seed)
    x, y = x.astype(np.float64), y.astype(np.float64)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - mean) / scale
    p = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
    m, v, t = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(len(z))
        for k in range(0, len(z), batch):
            at = order[k:k + batch]
            h = np.tanh(z[at] @ p[0] + p[1])
            d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -40, 40))) - y[at]) / len(at)
            back = np.outer(d, p[2]) * (1 - h * h)
            grads = [z[at].T @ back + decay * p[0], back.sum(axis=0), h.T @ d + decay * p[2], np.array([d.sum()])]
            t += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - step * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    return Network(mean, scale, p[0], p[1], p[2], float(p[3][0]))


def calibrate(net: Network, x: np.ndarray, y: np.ndarray) -> Network:
    """The temperature of least log loss on rows the weights haven't seen."""
    if len(y) and 0 < y.mean() < 1:
        logit = net.logit(x.astype(np.float64))
        losses = [(np.logaddexp(0, -logit / t * np.where(y > 0, 1, -1)).mean(), t) for t in np.geomspace(0.5, 8, 60)]
        net.temperature = float(min(losses)[1])
    return net


@dataclass
class Model:
    columns: np.ndarray  # the context vectors
    network: Network | None
    prior: float

    def score(self, column: pa.Array) -> np.ndarray:
        if self.network is None:
            return np.full(len(column), self.prior)
        return self.network.probability(_features(column, self.columns).astype(np.float64))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label_col: str = "quality") -> Model:
    """Fit on at most ``sample`` rows of ``labels`` that have a document.
    Only counts, the bounded context table and the pooled vectors of the
    sample (FEATURES floats each) come to the driver."""
    spark = docs.sparkSession
    common.bound_batches(spark)
    own = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label_col).cast("int").alias("label")) \
        .dropna().groupBy("_id").agg(F.max("label").alias("label"))
    chosen = own.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = [(r[0], r[1]) for r in chosen.collect()]  # at most ``sample`` pairs
    given = spark.sparkContext.broadcast(dict(rows))
    text = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
    picked = common.stage(text.mapInArrow(partial(_picked, given), "_id long, label int, text string").repartition(8, "_id"), "quality-sample")
    sums = picked.select("text").mapInArrow(_contexts, "bucket int, sums binary").repartition(8, "bucket") \
        .sortWithinPartitions("bucket").mapInArrow(_add_up, "bucket int, sums binary").collect()
    context = np.zeros((CONTEXTS, DIM), np.float32)
    for r in sums:  # at most CONTEXTS rows
        context[r.bucket] = np.frombuffer(r.sums, np.float32)
    context /= np.maximum(np.sqrt((context ** 2).sum(axis=1, keepdims=True)), 1e-6)
    columns = np.ascontiguousarray(context.T)
    shared = spark.sparkContext.broadcast(columns)
    pooled = picked.select("_id", "label", "text").mapInArrow(partial(_pooled, shared), "id long, label int, x binary").collect()
    pooled.sort(key=lambda r: (r.id, r.x))
    y = np.array([r.label > 0 for r in pooled], float)
    if not len(y) or y.min() == y.max():
        return Model(columns, None, float(y.mean()) if len(y) else 0.5)
    x = np.array([np.frombuffer(r.x, np.float32) for r in pooled])
    held = np.arange(len(y)) % CALIBRATE == 0
    if len(y) < 10 * CALIBRATE:
        held[:] = False
    return Model(columns, calibrate(fit_network(x[~held], y[~held]), x[held], y[held]), float(y.mean()))


def _picked(given, batches):
    for batch in batches:
        label = [given.value.get(i) for i in batch.column(0).to_pylist()]
        keep = pa.array([v is not None for v in label])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(label, pa.int32()), batch.column(1)],
                                         names=["_id", "label", "text"]).filter(keep)


def _scored(model, batches):
    """(.., text) to (.., text, score)."""
    for batch in batches:
        text = batch.num_columns - 1
        for i, j in arrays.slices(batch.column(text), SLICE):
            part = batch.slice(i, j - i)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.value.score(part.column(text)), pa.float64())],
                                             names=[*part.schema.names, "_score"])


def score(docs: DataFrame, model: Model, *columns: str, text_col: str = "text") -> DataFrame:
    """The chosen columns of every row, its text and ``_score`` (0 to 1)."""
    spark = docs.sparkSession
    common.bound_batches(spark)
    d = docs.select(*columns, F.col(text_col).cast("string").alias(text_col))
    schema = T.StructType([*d.schema.fields, T.StructField("_score", T.DoubleType())])
    return d.mapInArrow(partial(_scored, spark.sparkContext.broadcast(model)), schema)


def held_out(id_col: str = "doc_id"):
    """True for the rows that labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5, F.lit(0)) == 0


def predict(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; the model is
    fitted on labels of rows that aren't held out."""
    model = fit(docs, labels.filter(~held_out()), sample)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return score(d, model, "doc_id").select(
        "doc_id", held_out().alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents (all their columns) that the classifier doesn't reject."""
    model = fit(docs, labels.filter(~held_out()), sample)
    kept = score(common.wrap(docs), model, "doc_id", "_rest").filter(F.col("_score") >= THRESHOLD)
    return common.unwrap(kept, docs.columns)
