"""Spelling variants by dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced code point turns one
into the other: what they have in common at their beginning and at their end
then comes to the longer one's length less one, and no other pair's does.

*Groups.*  Let the shorter word have m code points.  The place of the edit
lies in one of PARTS parts of 0..m, and all before and behind that part is
the same in both words.  So a word goes, as the shorter (or one of two equally
long) and as the longer of a pair, into a group for each part, keyed by what
lies around it: near words meet in the part of their first difference, and
are counted there only.

*Splits.*  A group of more than TILE words is not compared: its part is cut
into PARTS again, and its words are dealt anew, until groups are small or the
part is a single place (then a group has at most one shorter word for each
letter).  So no beginning or ending is too popular for a task, and no pair is
lost.

*Tiles.*  Tasks read whole groups in order and hold their words as two padded
matrices of code points, from the front and from the back.  Blocks of pairs
of rows are compared at once; the first column that differs gives the common
prefix in one matrix and the common suffix in the other.

Cases: null or empty texts have no words; a null id counts as the empty
string; each repeated row counts; of near words of one number the least in
code-point order is the form; empty tables give no rows; texts of any length
are read whole, piece by piece; other columns are ignored."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, common

#: Shortest word, fewest occurrences, and how many times more its form has.
LENGTH = 5
COUNT = 3
TIMES = 2
PARTS = 4
#: Words of a group that are compared without a further split.
TILE = 256
#: Code points that one step compares.
CELLS = 1 << 22
#: Words that a task counts before it gives them away; characters of text
#: that it takes apart at once.
HELD = 1 << 19
PIECE = 1 << 20

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_BREAK = re.compile("[^A-Za-zÀ-ÿ]")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _pieces(text: str):
    """The text cut outside of words."""
    at = 0
    while len(text) - at > PIECE:
        end = _BREAK.search(text, at + PIECE)
        if not end:
            break
        yield text[at:end.start()]
        at = end.start()
    yield text[at:] if at else text


def _counter(shortest: int, damage: int | None):
    def counted(batches):
        total: Counter = Counter()

        def given():
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = zlib.crc32(f"{'' if i is None else i}:".encode())
                for piece in _pieces(text) if text else ():
                    for run, n in Counter(_RUN.findall(piece.translate(_LOWER))).items():
                        if damage:
                            h = zlib.crc32(run.encode(), own)
                            if h % damage == 0:
                                h %= len(run)
                                run = run[:h] + run[h + 1:]
                        if len(run) >= shortest:
                            total[run] += n
                    if len(total) > HELD:
                        yield from given()
        yield from given()
    return counted


def word_counts(docs: DataFrame, damage: int | None = None, shortest: int = LENGTH, fewest: int = COUNT,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): lower-cased runs of Latin letters and how often they occur.
    With ``damage`` N, about one of N (document, run) pairs loses a code point,
    both chosen by a checksum: misspellings to find again."""
    common.bound_batches(docs.sparkSession)
    runs = docs.select(id_col, F.col(text_col).cast("string").alias("text")).mapInArrow(_counter(shortest, damage), "word string, n long")
    return runs.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= fewest)


def _parted(rows: DataFrame, low, high) -> DataFrame:
    """Each row for each part of the places from ``low`` to ``high``."""
    cut = [F.expr(f"{low} + ({j} * ({high} - {low})) div {PARTS}").cast("int") for j in range(PARTS + 1)]
    parts = F.filter(F.array(*[F.struct(a.alias("lo"), b.alias("hi")) for a, b in zip(cut, cut[1:])]), lambda x: x["lo"] < x["hi"])
    rows = rows.select("word", "n", "m", F.explode(parts).alias("p")).select("word", "n", "m", F.col("p.lo").alias("lo"), F.col("p.hi").alias("hi"))
    return rows.withColumn("around", F.xxhash64(F.expr("left(word, lo)"), F.expr("right(word, m - hi)")))


_GROUP = ["m", "lo", "hi", "around"]


def _groups(words: DataFrame) -> DataFrame:
    """(word, n, m, lo, hi, around) of groups that may hold near words: those
    with a word of m code points and another."""
    m = F.explode(F.array(F.char_length("word"), F.char_length("word") - 1)).alias("m")
    rows = _parted(words.select("word", "n", m).filter("m > 0"), "0", "m")
    ready = None
    while True:
        rows = common.stage(rows, "parts")
        sizes = rows.groupBy(*_GROUP).agg(F.count("*").alias("words"), F.count_if(F.char_length("word") == F.col("m")).alias("short")) \
            .filter("words > 1 and short > 0")
        large = (F.col("words") > TILE) & (F.col("hi") - F.col("lo") > 1)
        rows = common.stage(rows.join(sizes.select(*_GROUP, large.alias("large")), _GROUP), "groups")
        small = rows.filter("not large").drop("large")
        ready = small if ready is None else ready.unionByName(small)
        rows = rows.filter("large")
        if rows.isEmpty():
            return ready
        rows = _parted(rows, "lo", "hi")


def _matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points (plus 1) of the words from the front and from the back,
    padded with 0, and the words' lengths."""
    size = np.array([len(w) for w in words])
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32) + np.uint32(1)
    ends = np.cumsum(size)
    column = np.arange(width)
    inside = column < size[:, None]
    front, back = np.zeros((2, len(words), width), np.uint32)
    front[inside] = points[((ends - size)[:, None] + column)[inside]]
    back[inside] = points[(ends[:, None] - 1 - column)[inside]]
    return front, back, size


def near_pairs(words: list[str], group: np.ndarray, m: int, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of near words of one group, i of ``m`` code points, whose
    first difference lies in ``low`` .. ``high``.  The rows come by group, in
    each those of ``m`` code points first."""
    front, back, size = _matrices(words, m + 1)
    end = np.searchsorted(group, group, "right")
    short = np.flatnonzero(size == m)
    partners = end[short] - 1 - short  # each short word with all rows of its group behind it
    tiles = np.cumsum(partners * (m + 1)) // CELLS
    found = [(np.zeros(0, np.int64),) * 2]
    for a, b in zip(*(np.searchsorted(tiles, np.unique(tiles), side) for side in ("left", "right"))):
        n = partners[a:b]
        i = np.repeat(short[a:b], n)
        j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + i + 1
        prefix = np.argmin(front[i] == front[j], axis=1)
        suffix = np.argmin(back[i] == back[j], axis=1)
        place = np.minimum(prefix, m - 1)
        near = (prefix + suffix >= np.maximum(m, size[j]) - 1) & (low[i] <= place) & (place < high[i])
        found.append((i[near], j[near]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _tiles(batches):
    """Rows of groups, in order, to near words (word, near, near_n), each pair
    both ways."""
    held = None

    def compared(rows: pa.Table, m: int):
        words = rows["word"].to_pylist()
        low, high = rows["lo"].to_numpy(), rows["hi"].to_numpy()
        i, j = near_pairs(words, _numbers(rows), m, low, high)
        n = rows["n"].to_numpy()
        both, other = np.concatenate([i, j]), np.concatenate([j, i])
        word = rows["word"].combine_chunks()
        for a in range(0, len(both), 1 << 16):
            x, y = both[a:a + (1 << 16)], other[a:a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([word.take(pa.array(x)), word.take(pa.array(y)), pa.array(n[y])], names=["word", "near", "near_n"])

    def by_length(rows: pa.Table):
        m = rows["m"].to_numpy()
        cut = np.flatnonzero(np.diff(m, prepend=-1, append=-1))
        for a, b in zip(cut, cut[1:]):
            yield from compared(rows.slice(a, b - a), int(m[a]))

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        if not len(rows):
            continue
        numbers = _numbers(rows)
        whole = int(np.searchsorted(numbers, numbers[-1]))  # the last group may go on in the next batch
        yield from by_length(rows.slice(0, whole)) if whole else ()
        held = rows.slice(whole)
    if held is not None:
        yield from by_length(held)
    pa.default_memory_pool().release_unused()


def _numbers(rows: pa.Table) -> np.ndarray:
    """The number of each row's group."""
    new = np.zeros(len(rows), bool)
    for c in _GROUP:
        v = rows[c].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.cumsum(new)


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n) of all near words among ``words`` (word, n)."""
    n = common.partitions(words.sparkSession)
    columns = ["word", "n", *_GROUP]
    return _groups(words).select(*columns).repartition(n, *_GROUP) \
        .sortWithinPartitions(*_GROUP, F.char_length("word")).mapInArrow(_tiles, "word string, near string, near_n long")


def group_variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``words`` (word, n): the form
    is the near word that occurs most, if it does ``times`` as often at least;
    the root is where a word's forms lead."""
    words = common.stage(words.select("word", F.col("n").cast("long").alias("n")), "words")
    best = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    most = -F.col("best.n")
    formed = common.stage(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(most >= times * F.col("n"), F.col("best.near")).alias("form"), F.when(most >= times * F.col("n"), most).alias("form_n")), "forms")
    # each round doubles the steps that a word has gone; numbers grow with
    # each step, so there are no circles and few rounds
    roots = formed.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        roots = common.stage(roots, "roots")
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        gone = roots.join(on, "root", "left")
        if gone.filter("next is not null").isEmpty():
            break
        roots = gone.select("word", F.coalesce("next", "root").alias("root"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
