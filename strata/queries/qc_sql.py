"""SQL statement of the quality checks (DuckDB dialect), written from the
check contract: one aggregate CTE per checked relation, one SELECT per
result row, glued with UNION ALL."""

from __future__ import annotations

from ..functions.text import py_pct
from .oracle import pct_text, ratio

COLS = "seq, table_name, check_name, status, message, row_count, failed_rows, threshold, actual_value"
NB, ND, NS = "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS VARCHAR)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def dbl(v) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def row(seq, table, check, status, message, row_count=NB, failed=NB, threshold=ND, actual=ND,
        src: str | None = None) -> str:
    frm = f" FROM {src}" if src else ""
    return (f"SELECT CAST({seq} AS INTEGER) AS seq, {q(table)} AS table_name, {q(check)} AS check_name, "
            f"{status} AS status, {message} AS message, CAST({row_count} AS BIGINT) AS row_count, "
            f"CAST({failed} AS BIGINT) AS failed_rows, CAST({threshold} AS DOUBLE) AS threshold, "
            f"CAST({actual} AS DOUBLE) AS actual_value{frm}")


def _range_text(lo, hi) -> str:
    return f"[{lo if lo is not None else '-∞'}, {hi if hi is not None else '∞'}]"


def _num(v) -> str:
    return repr(v) if isinstance(v, float) else str(v)


def evaluate(src: str, table: str, checks: dict, columns: list[str], seq_start: int = 0,
             tag: str = "a") -> tuple[list[str], list[str]]:
    """Returns (ctes, selects) for the check spec over relation ``src``."""
    metrics = ["count(*) AS n"]
    sel: list[str] = []
    seq = seq_start
    agg = f"qc_{tag}"
    ctes: list[str] = []

    def m(expr: str) -> str:
        name = f"m{len(metrics)}"
        metrics.append(f"count(*) FILTER (WHERE {expr}) AS {name}")
        return name

    if "row_count" in checks:
        rc = checks["row_count"] or {}
        mn, ex = rc.get("min_rows", 1), rc.get("expected_rows")
        seq += 1
        below = f"n < {mn}"
        warn = f"n <> {ex}" if ex else "FALSE"
        status = f"CASE WHEN {below} THEN 'FAIL' WHEN {warn} THEN 'WARNING' ELSE 'PASS' END"
        msg = (f"CASE WHEN {below} THEN 'Row count ' || CAST(n AS VARCHAR) || {q(f' is below minimum threshold {mn}')} "
               f"WHEN {warn} THEN 'Row count ' || CAST(n AS VARCHAR) || {q(f' does not match expected {ex}')} "
               f"ELSE 'Row count ' || CAST(n AS VARCHAR) || ' is valid' END")
        thr = f"CASE WHEN {below} THEN {dbl(mn)} WHEN {warn} THEN {dbl(ex) if ex else ND} END"
        sel.append(row(seq, table, "row_count", status, msg, "n", NB, thr, ND, agg))
    if "nulls" in checks:
        nc = checks["nulls"]
        mx = nc.get("max_null_percentage", 0.1)
        for c in nc.get("columns", []):
            seq += 1
            if c not in columns:
                sel.append(row(seq, table, f"null_check_{c}", "'FAIL'", q(f"Column {c} not found in DataFrame"), src=agg))
                continue
            k = m(f"{c} IS NULL")
            r = ratio(k, "n")
            bad = f"{r} > {dbl(mx)}"
            status = f"CASE WHEN {bad} THEN 'FAIL' ELSE 'PASS' END"
            msg = (f"CASE WHEN {bad} THEN 'Null percentage ' || {pct_text(k, 'n')} || {q(f' exceeds threshold {py_pct(mx)}')} "
                   f"ELSE 'Null percentage ' || {pct_text(k, 'n')} || ' is within threshold' END")
            sel.append(row(seq, table, f"null_check_{c}", status, msg, "n", k, dbl(mx), r, agg))
    if "duplicates" in checks:
        dc = checks["duplicates"]
        keys, mx = dc.get("key_columns", []), dc.get("max_duplicate_percentage", 0.05)
        seq += 1
        missing = [k for k in keys if k not in columns]
        if missing:
            sel.append(row(seq, table, "duplicate_check", "'FAIL'", q(f"Column(s) {missing} not found")))
        else:
            gby = f" GROUP BY {', '.join(keys)}" if keys else ""
            g = f"dupg_{tag}"
            d = f"dup_{tag}"
            ctes.append(f"{g} AS (SELECT count(*) AS c FROM {src}{gby})")
            ctes.append(f"{d} AS (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS n, "
                        f"count(*) FILTER (WHERE c > 1) AS grp, "
                        f"CAST(coalesce(sum(CASE WHEN c > 1 THEN c END), 0) AS BIGINT) AS dr FROM {g})")
            r = ratio("dr", "n")
            has, over = "grp > 0", f"{r} > {dbl(mx)}"
            status = f"CASE WHEN {has} AND {over} THEN 'FAIL' WHEN {has} THEN 'WARNING' ELSE 'PASS' END"
            msg = (f"CASE WHEN {has} AND {over} THEN 'Duplicate percentage ' || {pct_text('dr', 'n')} || "
                   f"{q(f' exceeds threshold {py_pct(mx)}')} "
                   f"WHEN {has} THEN 'Found ' || CAST(grp AS VARCHAR) || ' duplicate key combinations' "
                   f"ELSE 'No duplicates found' END")
            sel.append(row(seq, table, "duplicate_check", status, msg, "n",
                           f"CASE WHEN {has} THEN dr END", f"CASE WHEN {has} THEN {dbl(mx)} END",
                           f"CASE WHEN {has} THEN {r} END", d))
    for c, rc in (checks.get("value_ranges") or {}).items():
        seq += 1
        lo, hi = rc.get("min_value"), rc.get("max_value")
        chk = f"value_range_{c}"
        if c not in columns:
            sel.append(row(seq, table, chk, "'FAIL'", q(f"Column {c} not found"), src=agg))
            continue
        if lo is None and hi is None:
            sel.append(row(seq, table, chk, "'PASS'", q("No range constraints specified"), src=agg))
            continue
        conds = []
        if lo is not None:
            conds.append(f"{c} < {_num(lo)}")
        if hi is not None:
            conds.append(f"{c} > {_num(hi)}")
        k = m("coalesce(" + " OR ".join(conds) + ", FALSE)")
        rng = _range_text(lo, hi)
        status = f"CASE WHEN {k} > 0 THEN 'FAIL' ELSE 'PASS' END"
        msg = (f"CASE WHEN {k} > 0 THEN 'Found ' || CAST({k} AS VARCHAR) || {q(f' rows with values outside range {rng}')} "
               f"ELSE {q(f'All values are within range {rng}')} END")
        sel.append(row(seq, table, chk, status, msg, "n", f"CASE WHEN {k} > 0 THEN {k} END", ND,
                       f"CASE WHEN {k} > 0 THEN {ratio(k, 'n')} END", agg))
    for c, vals in (checks.get("valid_values") or {}).items():
        seq += 1
        chk = f"valid_values_{c}"
        if c not in columns:
            sel.append(row(seq, table, chk, "'FAIL'", q(f"Column {c} not found"), src=agg))
            continue
        vl = ", ".join(q(v) for v in vals)
        k = m(f"{c} IS NOT NULL AND {c} NOT IN ({vl})")
        status = f"CASE WHEN {k} > 0 THEN 'FAIL' ELSE 'PASS' END"
        msg = (f"CASE WHEN {k} > 0 THEN 'Found ' || CAST({k} AS VARCHAR) || "
               f"{q(f' rows with invalid values. Valid values: {list(vals)}')} "
               f"ELSE {q(f'All values are valid. Valid values: {list(vals)}')} END")
        sel.append(row(seq, table, chk, status, msg, "n", f"CASE WHEN {k} > 0 THEN {k} END", ND,
                       f"CASE WHEN {k} > 0 THEN {ratio(k, 'n')} END", agg))
    ctes.insert(0, f"{agg} AS (SELECT {', '.join(metrics)} FROM {src})")
    return ctes, sel


def fk(src: str, table: str, fk_col: str, ref: str, ref_key: str, seq: int, tag: str,
       prefilter: bool) -> tuple[list[str], list[str]]:
    where = f" WHERE {fk_col} IS NOT NULL" if prefilter else ""
    a = f"fk_{tag}"
    cte = (f"{a} AS (SELECT count(*) AS n, count(*) FILTER (WHERE {fk_col} IS NOT NULL AND NOT EXISTS "
           f"(SELECT 1 FROM {ref} r WHERE r.{ref_key} = s.{fk_col})) AS k FROM (SELECT * FROM {src}{where}) s)")
    status = "CASE WHEN k > 0 THEN 'FAIL' ELSE 'PASS' END"
    msg = ("CASE WHEN k > 0 THEN 'Found ' || CAST(k AS VARCHAR) || ' rows with invalid foreign keys' "
           "ELSE 'All foreign keys are valid' END")
    return [cte], [row(seq, table, f"referential_integrity_{fk_col}", status, msg, "n",
                       "CASE WHEN k > 0 THEN k END", ND, f"CASE WHEN k > 0 THEN {ratio('k', 'n')} END", a)]


def positive_total(src: str, table: str, column: str, check: str, seq: int, tag: str):
    a = f"bt_{tag}"
    label = column.replace("_", " ").capitalize()
    cte = f"{a} AS (SELECT sum(CAST({column} AS DECIMAL(20,2))) AS t FROM {src})"
    ok = "coalesce(t > 0, FALSE)"
    tt = "coalesce(CAST(t AS VARCHAR), 'NULL')"
    status = f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END"
    msg = (f"CASE WHEN {ok} THEN {q(label + ' ')} || {tt} || ' is positive' "
           f"ELSE {q(label + ' ')} || {tt} || ' is not positive' END")
    return [cte], [row(seq, table, check, status, msg, src=a)]


def type_conformance(src: str, table: str, typed: list[tuple[str, str, str]], seq_start: int,
                     tag: str):
    """typed: (column, duckdb type, type label)."""
    a = f"tc_{tag}"
    metrics = ["count(*) AS n"]
    sel = []
    seq = seq_start
    for i, (c, t, label) in enumerate(typed):
        seq += 1
        k = f"m{i}"
        metrics.append(f"count(*) FILTER (WHERE {c} IS NOT NULL AND try_cast({c} AS {t}) IS NULL) AS {k}")
        status = f"CASE WHEN {k} > 0 THEN 'WARNING' ELSE 'PASS' END"
        msg = (f"CASE WHEN {k} > 0 THEN 'Found ' || CAST({k} AS VARCHAR) || {q(f' values that are not valid {label}')} "
               f"ELSE {q(f'All values convert to {label}')} END")
        sel.append(row(seq, table, f"type_conformance_{c}", status, msg, "n",
                       f"CASE WHEN {k} > 0 THEN {k} END", ND,
                       f"CASE WHEN {k} > 0 THEN {ratio(k, 'n')} END", a))
    return [f"{a} AS (SELECT {', '.join(metrics)} FROM {src})"], sel


def assemble(parts: list[tuple[list[str], list[str]]], final: str | None = None) -> str:
    """Combine (ctes, selects) parts into one statement: ``qc_rows`` holds
    the union; ``final`` (default: all rows) selects from it.  Data CTEs the
    checks read (silver_transactions, ...) are pulled in automatically."""
    from .oracle import with_ctes
    ctes, sels = [], []
    for c, s in parts:
        ctes += c
        sels += s
    body = "\nUNION ALL\n".join(sels)
    ctes.append(f"qc_rows AS ({body})")
    return with_ctes(final or f"SELECT {COLS} FROM qc_rows", ctes)
