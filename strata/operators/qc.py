"""Data-quality checks whose results are a DataFrame.

A check spec (``row_count`` / ``nulls`` / ``duplicates`` / ``value_ranges``
/ ``valid_values``) is compiled into

* ONE global aggregate holding every row-level metric (row count, NULL
  counts, range and domain violations): a single scan of only the checked
  columns, partial aggregation in every task, no shuffle of rows; and
* ONE grouped aggregate for the duplicate check: group counts per key with
  map-side partial aggregation (a hot key costs one row per map task), then
  a global aggregate of the group counts.

Each check becomes one *metric row* (kind, row count, violation count,
limit, literal message fragments) via ``inline(array(named_struct ..))``
over the one-row aggregates, and one fixed projection (``_FINAL``) turns
metric rows into results: status, message, thresholds.  The expressions are
SQL text handed to ``selectExpr``: a suite of any size costs a handful of
driver-to-JVM calls and a plan whose size does not grow per check.  Nothing
is computed on the driver; only ``gate`` collects, one row per check.

Result semantics follow the data contract: PASS / FAIL / WARNING; missing
columns FAIL; ratios are 0 on an empty frame; NULL never violates a range or
domain; NaN violates a maximum.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.text import pct_text, py_pct
from ..schemas import QC_RESULT

DEFAULT_MIN_ROWS = 1
DEFAULT_MAX_NULL_PCT = 0.1
DEFAULT_MAX_DUP_PCT = 0.05


class QCFailure(Exception):
    """Raised by ``gate`` with every failed check of the results."""

    def __init__(self, failures):
        self.failures = failures
        lines = [f"{f['table_name']}.{f['check_name']}: {f['message']}" for f in failures]
        super().__init__(f"{len(failures)} QC check(s) failed:\n  " + "\n  ".join(lines))


# ------------------------------------------------------------ SQL text ----

def _q(s) -> str:
    """SQL string literal (or NULL)."""
    if s is None:
        return "CAST(NULL AS STRING)"
    return "'" + str(s).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _id(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _num(v) -> str:
    if v is None:
        return "CAST(NULL AS DOUBLE)"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v)
    return f"CAST('{float(v)!r}' AS DOUBLE)"


# ------------------------------------------------------------ metric rows --
#
# kind       meaning of the fields
# static     fail_status = the status, a = the message (no numbers)
# row_count  lim = minimum rows, aux = expected rows (or NULL); a/b = their text
# pct        k = offending rows; FAIL when k/n > lim; a / b = fail / pass tail
# dup        k = rows in duplicated keys, g = duplicated keys; lim = max share
# count      k = offending rows; fail_status when k > 0; a = fail tail, b = pass text

def _mrow(seq: int, table: str, check: str, kind: str, n="NULL", k="NULL", g="NULL", lim=None,
          aux=None, fail_status=None, a=None, b=None, exprs: bool = False) -> str:
    """One metric row as a ``named_struct`` SQL expression.  n/k/g are SQL
    expressions over the aggregate's columns; ``exprs`` marks fail_status
    and a as SQL expressions instead of literals."""
    fs = fail_status if exprs else _q(fail_status or "FAIL")
    at = a if exprs else _q(a)
    return (f"named_struct('seq', CAST({seq} AS INT), 'table_name', {_q(table)}, "
            f"'check_name', {_q(check)}, 'kind', {_q(kind)}, "
            f"'n', CAST({n} AS BIGINT), 'k', CAST({k} AS BIGINT), 'g', CAST({g} AS BIGINT), "
            f"'lim', CAST({_num(lim)} AS DOUBLE), 'aux', CAST({_num(aux)} AS DOUBLE), "
            f"'fail_status', CAST({fs} AS STRING), 'a', CAST({at} AS STRING), "
            f"'b', CAST({_q(b)} AS STRING))")


_R = "(CASE WHEN n > 0 THEN CAST(k AS DOUBLE) / CAST(n AS DOUBLE) ELSE 0.0D END)"
_H = "(CASE WHEN n > 0 THEN (k * 20000 + n) div (2 * n) ELSE 0L END)"
_PCT = f"concat(CAST({_H} div 100 AS STRING), '.', lpad(CAST({_H} % 100 AS STRING), 2, '0'), '%')"
_BELOW, _WARN = "(n < lim)", "(aux IS NOT NULL AND n <> aux)"
_OVER, _HAS, _BAD = f"({_R} > lim)", "(g > 0)", "(k > 0)"

# The one projection from metric rows to results (fixed size).
_FINAL = [
    "seq", "table_name", "check_name",
    f"""CASE kind
          WHEN 'static' THEN fail_status
          WHEN 'row_count' THEN CASE WHEN {_BELOW} THEN 'FAIL' WHEN {_WARN} THEN 'WARNING' ELSE 'PASS' END
          WHEN 'pct' THEN CASE WHEN {_OVER} THEN 'FAIL' ELSE 'PASS' END
          WHEN 'dup' THEN CASE WHEN {_HAS} AND {_OVER} THEN 'FAIL' WHEN {_HAS} THEN 'WARNING' ELSE 'PASS' END
          ELSE CASE WHEN {_BAD} THEN fail_status ELSE 'PASS' END END AS status""",
    f"""CASE kind
          WHEN 'static' THEN a
          WHEN 'row_count' THEN CASE
              WHEN {_BELOW} THEN concat('Row count ', CAST(n AS STRING), ' is below minimum threshold ', a)
              WHEN {_WARN} THEN concat('Row count ', CAST(n AS STRING), ' does not match expected ', b)
              ELSE concat('Row count ', CAST(n AS STRING), ' is valid') END
          WHEN 'pct' THEN concat('Null percentage ', {_PCT}, CASE WHEN {_OVER} THEN a ELSE b END)
          WHEN 'dup' THEN CASE
              WHEN {_HAS} AND {_OVER} THEN concat('Duplicate percentage ', {_PCT}, a)
              WHEN {_HAS} THEN concat('Found ', CAST(g AS STRING), ' duplicate key combinations')
              ELSE 'No duplicates found' END
          ELSE CASE WHEN {_BAD} THEN concat('Found ', CAST(k AS STRING), a) ELSE b END END AS message""",
    "CAST(CASE WHEN kind <> 'static' THEN n END AS BIGINT) AS row_count",
    f"""CAST(CASE kind WHEN 'pct' THEN k WHEN 'dup' THEN CASE WHEN {_HAS} THEN k END
          WHEN 'count' THEN CASE WHEN {_BAD} THEN k END END AS BIGINT) AS failed_rows""",
    f"""CAST(CASE kind WHEN 'row_count' THEN CASE WHEN {_BELOW} THEN lim WHEN {_WARN} THEN aux END
          WHEN 'pct' THEN lim WHEN 'dup' THEN CASE WHEN {_HAS} THEN lim END END AS DOUBLE) AS threshold""",
    f"""CAST(CASE kind WHEN 'pct' THEN {_R} WHEN 'dup' THEN CASE WHEN {_HAS} THEN {_R} END
          WHEN 'count' THEN CASE WHEN {_BAD} THEN {_R} END END AS DOUBLE) AS actual_value""",
]


def _finalize(m: DataFrame) -> DataFrame:
    return m.selectExpr(*_FINAL)


def _metric_frame(one_row: DataFrame, rows: list[str]) -> DataFrame:
    return one_row.selectExpr(f"inline(array({', '.join(rows)}))")


def _static_frame(spark, rows: list[str]) -> DataFrame:
    return _metric_frame(spark.range(1), rows)


def _empty_results(spark) -> DataFrame:
    return spark.createDataFrame([], QC_RESULT)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# --------------------------------------------------------- compiled spec --

@dataclass
class _Compiled:
    table: str
    metrics: list = field(default_factory=lambda: ["count(1) AS __n"])   # aggregate SQL
    rows: list = field(default_factory=list)                               # metric-row SQL
    seq: int = 0

    def next_seq(self) -> int:
        self.seq += 1
        return self.seq

    def metric(self, predicate_sql: str) -> str:
        name = f"__m{len(self.metrics)}"
        self.metrics.append(f"count_if({predicate_sql}) AS {name}")
        return name

    def static(self, check: str, status: str, message: str):
        self.rows.append(_mrow(self.next_seq(), self.table, check, "static",
                               fail_status=status, a=message))

    def count_row(self, check: str, k: str, fail_tail: str, pass_text: str, fail_status="FAIL"):
        self.rows.append(_mrow(self.next_seq(), self.table, check, "count", "__n", k,
                               fail_status=fail_status, a=fail_tail, b=pass_text))

    def frame(self, df: DataFrame) -> DataFrame:
        return _metric_frame(df.selectExpr(*self.metrics), self.rows)


def _row_count(c: _Compiled, min_rows=DEFAULT_MIN_ROWS, expected_rows=None):
    c.rows.append(_mrow(c.next_seq(), c.table, "row_count", "row_count", "__n",
                        lim=float(min_rows), aux=float(expected_rows) if expected_rows else None,
                        a=str(min_rows), b=str(expected_rows)))


def _nulls(c: _Compiled, df: DataFrame, columns: Sequence[str], max_pct=DEFAULT_MAX_NULL_PCT):
    for col in columns:
        if col not in df.columns:
            c.static(f"null_check_{col}", "FAIL", f"Column {col} not found in DataFrame")
            continue
        k = c.metric(f"{_id(col)} IS NULL")
        c.rows.append(_mrow(c.next_seq(), c.table, f"null_check_{col}", "pct", "__n", k,
                            lim=float(max_pct), a=f" exceeds threshold {py_pct(max_pct)}",
                            b=" is within threshold"))


def _range_text(lo, hi) -> str:
    return f"[{lo if lo is not None else '-∞'}, {hi if hi is not None else '∞'}]"


def _value_range(c: _Compiled, df: DataFrame, col: str, min_value=None, max_value=None):
    check = f"value_range_{col}"
    if col not in df.columns:
        c.static(check, "FAIL", f"Column {col} not found")
        return
    if min_value is None and max_value is None:
        c.static(check, "PASS", "No range constraints specified")
        return
    conds = []
    if min_value is not None:
        conds.append(f"{_id(col)} < {_num(min_value)}")
    if max_value is not None:
        conds.append(f"{_id(col)} > {_num(max_value)}")
    k = c.metric(f"coalesce({' OR '.join(conds)}, false)")
    rng = _range_text(min_value, max_value)
    c.count_row(check, k, f" rows with values outside range {rng}", f"All values are within range {rng}")


def _valid_values(c: _Compiled, df: DataFrame, col: str, values: Sequence):
    check = f"valid_values_{col}"
    if col not in df.columns:
        c.static(check, "FAIL", f"Column {col} not found")
        return
    vals = list(values)
    inlist = ", ".join(_q(v) if isinstance(v, str) else _num(v) for v in vals)
    k = c.metric(f"{_id(col)} IS NOT NULL AND NOT {_id(col)} IN ({inlist})")
    c.count_row(check, k, f" rows with invalid values. Valid values: {vals}",
                f"All values are valid. Valid values: {vals}")


def _duplicate_metrics(df: DataFrame, table: str, key_columns: Sequence[str], max_pct, seq) -> DataFrame:
    missing = [k for k in key_columns if k not in df.columns]
    if missing:
        return _static_frame(df.sparkSession, [_mrow(seq, table, "duplicate_check", "static",
                                                     fail_status="FAIL",
                                                     a=f"Column(s) {missing} not found")])
    g = df.groupBy(*key_columns).agg(F.count(F.lit(1)).alias("__c"))
    a = g.selectExpr("CAST(coalesce(sum(__c), 0) AS BIGINT) AS __n", "count_if(__c > 1) AS __g",
                     "CAST(coalesce(sum(CASE WHEN __c > 1 THEN __c END), 0) AS BIGINT) AS __d")
    return _metric_frame(a, [_mrow(seq, table, "duplicate_check", "dup", "__n", "__d", "__g",
                                   lim=float(max_pct), a=f" exceeds threshold {py_pct(max_pct)}")])


def duplicate_frame(df: DataFrame, table: str, key_columns: Sequence[str],
                    max_pct=DEFAULT_MAX_DUP_PCT, seq: int = 1) -> DataFrame:
    """Duplicate check: failed_rows counts every row of a duplicated key
    (not only the surplus copies); NULL keys group together; an empty key
    list is one global group."""
    return _finalize(_duplicate_metrics(df, table, key_columns, max_pct, seq))


def _compile(df: DataFrame, table_name: str, checks: Mapping, seq_start: int = 0) -> tuple[_Compiled, tuple | None]:
    """The row-level metrics of a check spec, and what the duplicate check
    is called with (it needs the rows grouped)."""
    c = _Compiled(table_name, seq=seq_start)
    if "row_count" in checks:
        rc = checks["row_count"] or {}
        _row_count(c, rc.get("min_rows", DEFAULT_MIN_ROWS), rc.get("expected_rows"))
    if "nulls" in checks:
        nc = checks["nulls"]
        _nulls(c, df, nc.get("columns", []), nc.get("max_null_percentage", DEFAULT_MAX_NULL_PCT))
    dup = None
    if "duplicates" in checks:
        dc = checks["duplicates"]
        dup = (table_name, dc.get("key_columns", []), dc.get("max_duplicate_percentage", DEFAULT_MAX_DUP_PCT), c.next_seq())
    for col, rc in (checks.get("value_ranges") or {}).items():
        _value_range(c, df, col, rc.get("min_value"), rc.get("max_value"))
    for col, vals in (checks.get("valid_values") or {}).items():
        _valid_values(c, df, col, vals)
    return c, dup


def _results(df: DataFrame, metrics: list, dup: tuple | None) -> DataFrame:
    parts = metrics + ([_duplicate_metrics(df, *dup)] if dup else [])
    return _finalize(union_all(parts)) if parts else _empty_results(df.sparkSession)


def evaluate(df: DataFrame, table_name: str, checks: Mapping, seq_start: int = 0) -> DataFrame:
    """Run a check spec over ``df``; returns a lazy DataFrame of results in
    the fixed order row_count, nulls, duplicates, value_ranges, valid_values
    (column ``seq``)."""
    c, dup = _compile(df, table_name, checks, seq_start)
    return _results(df, [c.frame(df)] if c.rows else [], dup)


class Watch:
    """A check spec that the write it guards evaluates on the way: ``on``
    gives the rows to write, ``results`` the results once they are written,
    ``check`` raises with the failed ones.

    The row-level metrics are observed by the tasks that write, in the last
    stage of the job, whose tasks count once however often they are tried;
    nothing reads the rows again but the duplicate check, which takes the key
    columns of what was written."""

    def __init__(self, table_name: str, checks: Mapping, gate: bool = True):
        self.table_name, self.checks, self.gate = table_name, checks, gate

    def on(self, df: DataFrame) -> DataFrame:
        self._compiled, self._dup = _compile(df, self.table_name, self.checks)
        self._seen = Observation()
        return df.observe(self._seen, *[F.expr(m) for m in self._compiled.metrics])

    def results(self, written: DataFrame) -> DataFrame:
        seen = self._seen.get
        row = written.sparkSession.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in seen.items()])
        return _results(written, [_metric_frame(row, self._compiled.rows)] if self._compiled.rows else [], self._dup)

    def check(self, written: DataFrame) -> None:
        if self.gate:
            raise_failures(self.results(written).collect())


# ---------------------------------------------------- single-check API ----

def check_row_count(df, table_name, min_rows=DEFAULT_MIN_ROWS, expected_rows=None):
    return evaluate(df, table_name, {"row_count": {"min_rows": min_rows, "expected_rows": expected_rows}})


def row_count_result(spark, n: int, table_name: str, min_rows=DEFAULT_MIN_ROWS, expected_rows=None) -> DataFrame:
    """The row-count check of a number that is known already."""
    c = _Compiled(table_name)
    _row_count(c, min_rows, expected_rows)
    return _finalize(_metric_frame(spark.range(1).select(F.lit(n).cast("long").alias("__n")), c.rows))


def check_nulls(df, table_name, columns, max_null_percentage=DEFAULT_MAX_NULL_PCT):
    return evaluate(df, table_name, {"nulls": {"columns": list(columns),
                                               "max_null_percentage": max_null_percentage}})


def check_duplicates(df, table_name, key_columns, max_duplicate_percentage=DEFAULT_MAX_DUP_PCT):
    return duplicate_frame(df, table_name, list(key_columns), max_duplicate_percentage)


def check_value_range(df, table_name, column, min_value=None, max_value=None):
    return evaluate(df, table_name, {"value_ranges": {column: {"min_value": min_value,
                                                                "max_value": max_value}}})


def check_valid_values(df, table_name, column, valid_values):
    return evaluate(df, table_name, {"valid_values": {column: list(valid_values)}})


def _fk_metrics(df: DataFrame, table_name: str, foreign_key_column: str, reference: DataFrame,
                reference_key_column: str, seq: int) -> DataFrame:
    # Fact side: (key, rows) with map-side partial aggregation; reference
    # side: its distinct keys.  A left join of the two sees each key once on
    # each side (no hot key can reach one task, and it is broadcast when AQE
    # measures either side small), and one pass yields both the row count
    # and the orphan count.  An outer join is not pushed below the
    # aggregate, so the fact table is read once.
    g = df.groupBy(F.col(foreign_key_column).alias("__fk")).agg(F.count(F.lit(1)).alias("__c"))
    ref_keys = (reference.select(F.col(reference_key_column).alias("__rk"))
                         .filter(F.col("__rk").isNotNull()).distinct())
    j = g.join(ref_keys, F.col("__fk") == F.col("__rk"), "left")
    a = j.selectExpr(
        "CAST(coalesce(sum(__c), 0) AS BIGINT) AS __n",
        "CAST(coalesce(sum(CASE WHEN __fk IS NOT NULL AND __rk IS NULL THEN __c END), 0) AS BIGINT) AS __k")
    return _metric_frame(a, [_mrow(seq, table_name, f"referential_integrity_{foreign_key_column}",
                                   "count", "__n", "__k", fail_status="FAIL",
                                   a=" rows with invalid foreign keys", b="All foreign keys are valid")])


def check_referential_integrity(df: DataFrame, table_name: str, foreign_key_column: str,
                                reference: DataFrame, reference_key_column: str,
                                seq: int = 1) -> DataFrame:
    """Orphans = non-NULL foreign keys without a match; row_count counts the
    frame passed in.

    The fact side is first reduced to (key, count) with map-side partial
    aggregation and left-joined to the distinct reference keys, so the join
    sees each key once: its size is bounded by the key domain, not by the
    fact table, and a key holding a third of the rows is one row.
    """
    return _finalize(_fk_metrics(df, table_name, foreign_key_column, reference,
                                 reference_key_column, seq))


def check_schema(df: DataFrame, table_name: str, expected: StructType, seq: int = 1) -> DataFrame:
    """Names differ -> FAIL; same names but type differences -> WARNING.
    Metadata only: evaluated from ``df.schema`` without reading data."""
    exp = {f.name: f.dataType for f in expected.fields}
    act = {f.name: f.dataType for f in df.schema.fields}
    missing = sorted(set(exp) - set(act))
    extra = sorted(set(act) - set(exp))
    if missing or extra:
        parts = []
        if missing:
            parts.append(f"Missing columns: {missing}")
        if extra:
            parts.append(f"Extra columns: {extra}")
        status, msg = "FAIL", "; ".join(parts)
    else:
        mism = [f"{n}: expected {exp[n].simpleString()}, got {act[n].simpleString()}"
                for n in exp if exp[n] != act[n]]
        status, msg = ("WARNING", "Type mismatches: " + ", ".join(mism)) if mism else \
            ("PASS", "Schema matches expected schema")
    return _finalize(_static_frame(df.sparkSession, [
        _mrow(seq, table_name, "schema_check", "static", fail_status=status, a=msg)]))


def _conformance_rows(c: _Compiled, df: DataFrame, columns: Sequence[str], type_name: str,
                      check_prefix: str, fail_tail, pass_text, fail_status: str):
    for col in columns:
        check = f"{check_prefix}_{col}"
        if col not in df.columns:
            c.static(check, "FAIL", f"Column {col} not found")
            continue
        k = c.metric(f"{_id(col)} IS NOT NULL AND try_cast({_id(col)} AS {type_name}) IS NULL")
        c.count_row(check, k, fail_tail(col), pass_text(col), fail_status)


def check_type_conformance(text_df: DataFrame, table_name: str, schema: StructType,
                           seq_start: int = 0) -> DataFrame:
    """For a frame read as text, count per typed column the non-NULL values
    a typed scan would silently turn into NULL (one aggregate)."""
    c = _Compiled(table_name, seq=seq_start)
    for f in schema.fields:
        if isinstance(f.dataType, StringType):
            continue
        t = f.dataType.simpleString()
        _conformance_rows(c, text_df, [f.name], t, "type_conformance",
                          lambda col, t=t: f" values that are not valid {t}",
                          lambda col, t=t: f"All values convert to {t}", "WARNING")
    return _finalize(c.frame(text_df))


def check_captured(df: DataFrame, table_name: str, schema: StructType, text: Column, seq_start: int = 0) -> DataFrame:
    """The results of :func:`check_type_conformance` from the typed scan
    itself: ``text`` holds the values, as text, of a row with a fault (NULL
    for others), and a value was lost where it has one and the typed column
    has none.  One scan, and only faulty lines are taken apart again."""
    c = _Compiled(table_name, seq=seq_start)
    for f in schema.fields:
        if not isinstance(f.dataType, StringType):
            t = f.dataType.simpleString()
            k = c.metric(f"__text.{_id(f.name)} IS NOT NULL AND {_id(f.name)} IS NULL")
            c.count_row(f"type_conformance_{f.name}", k, f" values that are not valid {t}", f"All values convert to {t}", "WARNING")
    return _finalize(c.frame(df.withColumn("__text", text)))


def business_rule_positive_total(df: DataFrame, table_name: str, column: str = "total_sales",
                                 check_name: str = "business_rule_total_sales",
                                 seq: int = 1) -> DataFrame:
    """Sum of a money column must be positive; an empty table FAILs."""
    a = df.selectExpr(f"sum(CAST({_id(column)} AS DECIMAL(20,2))) AS __t")
    label = column.replace("_", " ").capitalize()
    ok = "coalesce(__t > 0, false)"
    status = f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END"
    message = (f"concat({_q(label + ' ')}, coalesce(CAST(__t AS STRING), 'NULL'), "
               f"CASE WHEN {ok} THEN ' is positive' ELSE ' is not positive' END)")
    return _finalize(_metric_frame(a, [_mrow(seq, table_name, check_name, "static",
                                             fail_status=status, a=message, exprs=True)]))


# --------------------------------------------------------- gate, summary --

def raise_failures(rows, raise_on=("FAIL",)) -> None:
    """Raise with every failed check among already collected result rows."""
    failures = [{k: r[k] for k in ("table_name", "check_name", "message")}
                for r in rows if r["status"] in raise_on]
    if failures:
        raise QCFailure(failures)


def gate(results: DataFrame, raise_on=("FAIL",)) -> list:
    """Collect the failed checks (at most one row per check) and raise with
    all of them; returns the (empty) failure list otherwise."""
    failed = (results.filter(F.col("status").isin(list(raise_on)))
                     .select("table_name", "check_name", "message").collect())
    failures = [r.asDict() for r in failed]
    if failures:
        raise QCFailure(failures)
    return failures


def summary(results: DataFrame) -> DataFrame:
    """Checks and tables per status with the share of all checks (the
    window runs over at most three rows, one per status)."""
    g = results.groupBy("status").agg(F.count(F.lit(1)).alias("check_count"),
                                      F.count_distinct("table_name").alias("table_count"))
    total = F.sum("check_count").over(Window.partitionBy())
    return g.select("status", "check_count", "table_count",
                    pct_text(F.col("check_count"), total).alias("share"))


def orphan_rows(df: DataFrame, foreign_key_column: str, reference: DataFrame, reference_key_column: str) -> DataFrame:
    """The rows whose foreign key (not NULL) has no reference row: what a
    failed referential-integrity check counts."""
    keys = reference.select(F.col(reference_key_column).alias(foreign_key_column)).dropna().distinct()
    return df.filter(F.col(foreign_key_column).isNotNull()).join(keys, foreign_key_column, "left_anti").select(*df.columns)


# ------------------------------------------------------ rule dictionary --

def evaluate_rules(df: DataFrame, table_name: str, rules: Mapping,
                   references: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Compile a declarative rule entry (required / not_null / unique /
    date / numeric columns, min_values, foreign_keys ``col -> entity.col``)
    into the fused checks.  Row order: required, not-null, unique, minimum
    values, date columns, numeric columns, foreign keys.  A foreign key
    without a reference frame is a FAIL; no rules give no rows."""
    c = _Compiled(table_name)
    req = list(rules.get("required_columns", []))
    if req:
        missing = [x for x in req if x not in df.columns]
        c.static("required_columns", "FAIL" if missing else "PASS",
                 f"Missing required columns: {missing}" if missing else "All required columns present")
    if rules.get("not_null_columns"):
        _nulls(c, df, rules["not_null_columns"], 0.0)
    dup = None
    if rules.get("unique_columns"):
        dup = _duplicate_metrics(df, table_name, list(rules["unique_columns"]), 0.0, c.next_seq())
    for col, lo in (rules.get("min_values") or {}).items():
        _value_range(c, df, col, lo, None)
    for cols, t, prefix in ((rules.get("date_columns", []), "date", "date_format"),
                            (rules.get("numeric_columns", []), "double", "numeric")):
        _conformance_rows(c, df, cols, t, prefix,
                          lambda col, t=t: f" values in {col} that are not a valid {t}",
                          lambda col, t=t: f"All values in {col} are valid {t}", "FAIL")
    parts = [c.frame(df)] if c.rows else []
    if dup is not None:
        parts.append(dup)
    seq = c.seq
    for fk_col, target in (rules.get("foreign_keys") or {}).items():
        seq += 1
        entity, key = target.split(".", 1)
        ref = (references or {}).get(entity)
        if ref is None:
            missing = _Compiled(table_name)
            missing.seq = seq - 1
            missing.static(f"referential_integrity_{fk_col}", "FAIL", f"No reference data for {fk_col} -> {target}")
            parts.append(missing.frame(df))
            continue
        parts.append(_fk_metrics(df, table_name, fk_col, ref, key, seq))
    return _finalize(union_all(parts)) if parts else _empty_results(df.sparkSession)
