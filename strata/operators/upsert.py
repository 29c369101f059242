"""Upserts without a row-level-DML table format.

A MERGE is computed as a new snapshot of the target:

    new = (target rows whose key is not in the source) UNION ALL source

which is exactly ``WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *`` for a
source with unique keys.  Rows with a NULL in any key column can never
match (``=`` is never true on NULL), so they are inserted and bypass the join
entirely: they would otherwise all hash to one shuffle partition, and a NULL
key holding a third of the table would land in one task.

A batch that is replayed after a failure would insert its NULL-key rows once
more.  ``replayed`` tells the target's rows that an earlier, uncommitted
attempt of the same batch has left (by batch id, or by an ingestion time
beyond the committed watermark); of these, the ones with a NULL key are
replaced.  Rows are never compared by value: equal rows of two loads are two
rows.

The anti join's strategy is AQE's: broadcast when the source batch is
measured under the broadcast threshold (the usual incremental case), else
sort-merge with skew splitting.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class MergeKeyError(ValueError):
    """The source has several rows for one merge key (ambiguous MERGE)."""


def _all_keys_present(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-NULL merge keys that occur more than once in the source."""
    return (source.filter(_all_keys_present(keys)).groupBy(*keys)
                  .agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1))


def assert_unique_keys(source: DataFrame, keys: Sequence[str]) -> None:
    """One bounded action: at most one offending key reaches the driver."""
    dup = duplicate_keys(source, keys).limit(1).collect()
    if dup:
        raise MergeKeyError(f"source has {dup[0]['copies']} rows for merge key "
                            f"{ {k: dup[0][k] for k in keys} }")


def _align(df: DataFrame, columns: Sequence[str], types: Mapping[str, str]) -> DataFrame:
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast(types[c]).alias(c)
                       for c in columns])


def _without_replayed(rows: DataFrame, replayed: Column | None) -> DataFrame:
    return rows if replayed is None else rows.filter(~F.coalesce(replayed, F.lit(False)))


def merge_update_all(target: DataFrame, source: DataFrame, keys: Sequence[str],
                     check_unique: bool = True, replayed: Column | None = None) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE SET * WHEN NOT MATCHED INSERT *.

    Columns are aligned by name; a column only in the source is added
    (NULL in untouched target rows), a column only in the target is NULL in
    inserted/updated rows."""
    if check_unique:
        assert_unique_keys(source, keys)
    types = {f.name: f.dataType.simpleString() for f in target.schema.fields}
    types.update({f.name: f.dataType.simpleString() for f in source.schema.fields})
    cols = list(target.columns) + [c for c in source.columns if c not in target.columns]
    keyed = _all_keys_present(keys)
    src_keys = source.filter(keyed).select(*keys)
    kept = target.filter(keyed).join(src_keys, list(keys), "left_anti")
    parts = [kept, _without_replayed(target.filter(~keyed), replayed), source]
    out = _align(parts[0], cols, types)
    for p in parts[1:]:
        out = out.unionByName(_align(p, cols, types))
    return out


def merge_update_columns(target: DataFrame, source: DataFrame, keys: Sequence[str],
                         update_columns: Sequence[str] | None = None,
                         check_unique: bool = True, replayed: Column | None = None) -> DataFrame:
    """MERGE with an explicit update list: matched rows take only
    ``update_columns`` (default: every non-key source column) from the
    source; unmatched source rows are inserted whole.  One full outer join
    on the keys (NULL-key rows bypass it as in ``merge_update_all``)."""
    if check_unique:
        assert_unique_keys(source, keys)
    upd = list(update_columns) if update_columns else [c for c in source.columns if c not in keys]
    cols = list(target.columns) + [c for c in source.columns if c not in target.columns]
    keyed = _all_keys_present(keys)
    t = target.filter(keyed).withColumn("__in_t", F.lit(True))
    s = source.filter(keyed).withColumn("__in_s", F.lit(True))
    t = t.select(*[F.col(c).alias(f"t__{c}") for c in t.columns])
    s = s.select(*[F.col(c).alias(f"s__{c}") for c in s.columns])
    cond = None
    for k in keys:
        e = F.col(f"t__{k}") == F.col(f"s__{k}")
        cond = e if cond is None else cond & e
    j = t.join(s, cond, "full_outer")
    in_t, in_s = F.col("t____in_t").isNotNull(), F.col("s____in_s").isNotNull()
    tcols, scols = set(target.columns), set(source.columns)

    def pick(c: str) -> Column:
        tv = F.col(f"t__{c}") if c in tcols else F.lit(None)
        sv = F.col(f"s__{c}") if c in scols else F.lit(None)
        if c in keys:
            return F.when(in_t, tv).otherwise(sv)
        if c in upd:
            return F.when(in_s, sv).otherwise(tv)
        return F.when(in_t, tv).otherwise(sv)

    types = {f.name: f.dataType for f in target.schema.fields}
    types.update({f.name: f.dataType for f in source.schema.fields if f.name not in types})
    merged = j.select(*[pick(c).cast(types[c]).alias(c) for c in cols])
    tnull = _without_replayed(target.filter(~keyed), replayed)
    snull = source.filter(~keyed)
    tstr = {c: types[c].simpleString() for c in cols}
    return (merged.unionByName(_align(tnull, cols, tstr))
                  .unionByName(_align(snull, cols, tstr)))


def update_where(df: DataFrame, predicate: Column, assignments: Mapping[str, Column | object]) -> DataFrame:
    """``UPDATE t SET c = v WHERE predicate`` as a projection (one pass, no
    shuffle).  A NULL predicate leaves the row unchanged, as in SQL."""
    cols = {}
    for c, v in assignments.items():
        val = v if isinstance(v, Column) else F.lit(v)
        cols[c] = F.when(F.coalesce(predicate, F.lit(False)), val).otherwise(F.col(c))
    return df.withColumns(cols)
