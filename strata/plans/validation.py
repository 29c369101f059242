"""Cross-layer validation: the bronze, silver and gold suites as one
DataFrame of results (per table: one fused aggregate, one grouped aggregate
for duplicates, one pre-aggregated anti join per foreign key)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import qc
from ..specs import BRONZE_SUITE, ENTITIES, GOLD_SUITE, SILVER_SUITE, TABLES


def _suite_len(checks: Mapping) -> int:
    n = 1 if "row_count" in checks else 0
    n += len((checks.get("nulls") or {}).get("columns", []))
    n += 1 if "duplicates" in checks else 0
    n += len(checks.get("value_ranges") or {}) + len(checks.get("valid_values") or {})
    return n


def foreign_key_checks(tx: DataFrame, dims: Mapping[str, DataFrame], table: str,
                       seq_start: int = 0) -> list[DataFrame]:
    out = []
    seq = seq_start
    for fk_col, ref_entity, ref_key, prefilter in ENTITIES["transactions"].foreign_keys:
        seq += 1
        src = tx.filter(F.col(fk_col).isNotNull()) if prefilter else tx
        out.append(qc.check_referential_integrity(src, table, fk_col, dims[ref_entity], ref_key, seq=seq))
    return out


def bronze_layer(bronze: Mapping[str, DataFrame]) -> DataFrame:
    frames = [qc.evaluate(bronze[e], TABLES["bronze"][e], BRONZE_SUITE[e])
              for e in ("customers", "products", "stores", "transactions")]
    return qc.union_all(frames)


def silver_layer(silver: Mapping[str, DataFrame]) -> DataFrame:
    frames = []
    for e in ("customers", "products", "stores", "transactions"):
        frames.append(qc.evaluate(silver[e], TABLES["silver"][e], SILVER_SUITE[e]))
    t = TABLES["silver"]["transactions"]
    frames += foreign_key_checks(silver["transactions"], silver, t,
                                 seq_start=_suite_len(SILVER_SUITE["transactions"]))
    return qc.union_all(frames)


def gold_layer(gold: Mapping[str, DataFrame]) -> DataFrame:
    frames = [qc.evaluate(gold[m], TABLES["gold"][m], GOLD_SUITE[m])
              for m in ("customer_summary", "product_sales", "store_performance", "daily_sales")]
    cs = TABLES["gold"]["customer_summary"]
    frames.append(qc.business_rule_positive_total(
        gold["customer_summary"], cs, "total_sales", "business_rule_total_sales",
        seq=_suite_len(GOLD_SUITE["customer_summary"]) + 1))
    return qc.union_all(frames)


def all_layers(bronze, silver, gold) -> DataFrame:
    return qc.union_all([bronze_layer(bronze), silver_layer(silver), gold_layer(gold)])
