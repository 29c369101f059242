"""Links between rows that share buckets, without all pairs of a bucket.

Given (bucket, _key, hub, score) - the rows of buckets that have more than
one, a member of each bucket as its hub, and how good a hub it is -
:func:`link` finds components:

1. each row is confirmed against the best hub it may be like;
2. in every bucket, the rows outside the component of the bucket's hub are
   confirmed against one of them, in a few rounds;
3. those still outside are confirmed against all rows of the bucket that are
   in another component and that they may be like, by the bound and by a finer
   one that is worth its columns only here.

A link that these steps leave out joins two rows of one component, so the
components are those of all links, and a bucket of n rows like their hub
costs n confirmations, not n**2.  "May be like" is a bound that holds for
every link (:class:`Bound`), so it loses none."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

#: Rounds in which a stray of each bucket is tried as a hub of the others.
ROUNDS = 2
#: Rows that share a copy of the text they are confirmed against.
GUESTS = 64


def confirmed(pairs: DataFrame, texts: DataFrame, confirm) -> DataFrame:
    """The pairs (hub, _key) that ``confirm`` accepts, as (a, b).

    ``confirm`` gets Arrow batches (hub, copy, guest, _key, text) in which a
    hub's own row comes before its guests.  A hub's text is copied for every
    GUESTS of them, so no hub is too popular for a task."""
    n = common.partitions(pairs.sparkSession)
    hubs = pairs.groupBy("hub").agg(F.ceil(F.count("*") / GUESTS).cast("int").alias("copies"))
    guests = pairs.join(hubs, "hub").select(
        "_key", "hub", F.pmod(F.xxhash64("_key"), F.col("copies")).cast("int").alias("copy"), F.lit(1).alias("guest"))
    hosts = hubs.select(F.col("hub").alias("_key"), "hub", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"),
                        F.lit(0).alias("guest"))
    rows = guests.unionByName(hosts).join(texts, "_key").select("hub", "copy", "guest", "_key", "text")
    return rows.repartition(n, "hub", "copy").sortWithinPartitions("hub", "copy", "guest", "_key") \
        .mapInArrow(confirm, "a long, b long")


@dataclass(frozen=True)
class Bound:
    """What a link implies for columns of its two rows.

    ``pair`` takes the names of two rows' columns and tells whether the rows
    may be linked.  ``alone``, if given, takes the names of one row's columns
    and of the least values of the columns in its bucket, and tells whether
    the row may be linked with any row of the bucket.  ``finer`` is of step 3:
    a frame of further columns by _key, and ``pair`` with these."""
    columns: tuple[str, ...]
    pair: Callable[[tuple[str, ...], tuple[str, ...]], Column]
    alone: Callable[[tuple[str, ...], tuple[str, ...]], Column] | None = None
    finer: tuple[DataFrame, Callable[[tuple[str, ...], tuple[str, ...]], Column]] | None = None


def _named(prefix: str, columns: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(f"{prefix}{c}" for c in columns)


def _near(pairs: DataFrame, values: DataFrame, bound: Bound) -> DataFrame:
    """The pairs (hub, _key) that may be links."""
    def of(key, prefix):
        return values.select(F.col("_key").alias(key), *[F.col(c).alias(f"{prefix}{c}") for c in bound.columns])
    both = pairs.join(of("hub", "_a_"), "hub").join(of("_key", "_b_"), "_key")
    return both.filter(bound.pair(_named("_a_", bound.columns), _named("_b_", bound.columns))).select("hub", "_key")


def link(shared: DataFrame, values: DataFrame, bound: Bound, texts: Callable[[DataFrame], DataFrame], confirm) -> DataFrame:
    """(node, component) of the rows that have links.  ``values`` has the
    bound's columns by _key; ``texts`` gives the (_key, text) of the keys in
    a frame of (_key)."""
    scores = shared.select("hub", "score").distinct()
    first = _near(shared.filter("_key != hub").select("hub", "_key").distinct(), values, bound).join(scores, "hub") \
        .groupBy("_key").agg(F.max(F.struct("score", -F.col("hub"))).alias("best")).select("_key", (-F.col("best.col2")).alias("hub"))
    first = common.stage(first, "pairs")
    links = common.stage(confirmed(first, texts(_ends(first)), confirm), "links")
    found = components(links)
    for _ in range(ROUNDS):
        placed, strays = _strays(shared, found, values, bound)
        if strays.isEmpty():
            return found
        # one of a bucket's strays as a hub of the others
        lead = strays.groupBy("bucket").agg(F.min("s").alias("hub"))
        pairs = strays.join(lead, "bucket").filter("s != hub").select("hub", F.col("s").alias("_key")).distinct()
        pairs = common.stage(_near(pairs, values, bound).groupBy("_key").agg(F.min("hub").alias("hub")), "pairs")
        more = common.stage(confirmed(pairs, texts(_ends(pairs)), confirm), "links")
        if more.isEmpty():
            break
        links = links.union(more)
        found = components(links)
        placed = None
    if placed is None:
        placed, strays = _strays(shared, found, values, bound)
    if strays.isEmpty():
        return found
    members = placed.join(strays.select("bucket").distinct(), "bucket", "left_semi")
    columns, likely = bound.columns, bound.pair
    if bound.finer:
        more, finer = bound.finer
        added = tuple(c for c in more.columns if c != "_key")
        members = members.join(more, "_key")
        strays = strays.join(more.select(F.col("_key").alias("s"), *[F.col(c).alias(n) for c, n in zip(added, _named("_s_", added))]), "s")
        columns, likely = columns + added, lambda a, b: bound.pair(a, b) & finer(a, b)
    pairs = strays.join(members, "bucket") \
        .filter((F.col("cs") != F.col("c")) & ((F.col("c") == F.col("main")) | (F.col("s") < F.col("_key")))
                & likely(_named("_s_", columns), columns)) \
        .select(F.least("s", "_key").alias("hub"), F.greatest("s", "_key").alias("_key")).distinct()
    pairs = common.stage(pairs, "pairs")
    if pairs.isEmpty():
        return found
    more = common.stage(confirmed(pairs, texts(_ends(pairs)), confirm), "links")
    return found if more.isEmpty() else components(links.union(more))


def _strays(shared: DataFrame, found: DataFrame, values: DataFrame, bound: Bound) -> tuple[DataFrame, DataFrame]:
    """(the buckets' rows with their components; those outside the component
    of their bucket's hub that may still be linked)."""
    named = found.select(F.col("node").alias("_key"), F.col("component").alias("c"))
    placed = shared.drop("score").join(named, "_key", "left").withColumn("c", F.coalesce("c", "_key"))
    mains = named.select(F.col("_key").alias("hub"), F.col("c").alias("main"))
    placed = placed.join(mains, "hub", "left").withColumn("main", F.coalesce("main", "hub"))
    placed = common.stage(placed.join(values, "_key"), "buckets")
    own, low = _named("_s_", bound.columns), _named("_l_", bound.columns)
    strays = placed.filter("c != main").select("bucket", F.col("_key").alias("s"), F.col("c").alias("cs"),
                                               *[F.col(c).alias(n) for c, n in zip(bound.columns, own)])
    if bound.alone:
        least = placed.groupBy("bucket").agg(*[F.min(c).alias(n) for c, n in zip(bound.columns, low)])
        strays = strays.join(least, "bucket").filter(bound.alone(own, low)).drop(*low)
    return placed, common.stage(strays, "strays")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select("_key").union(pairs.select("hub")).distinct()
