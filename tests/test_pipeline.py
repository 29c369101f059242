"""End-to-end: landing CSVs -> bronze -> silver -> gold -> validation, run
three times with 1000, +100 and +50 transaction lines (the incremental
golden), then a run with nothing new, then a lost-ledger replay."""

from datetime import datetime

from pyspark.sql import functions as F

from strata.context import RunContext
from strata.plans.bronze import ingest_csv_to_bronze
from strata.plans.run import run_layers, silver_step
from strata.sinks import tables
from strata.specs import TABLES


def _write(path, header, rows):
    with open(path, "w") as f:
        f.write(header + "\n")
        for r in rows:
            f.write(",".join(str(x) for x in r) + "\n")


def _tx_rows(start, n):
    out = []
    for i in range(start, start + n):
        out.append((f"T{i // 3}", i % 3 + 1, f"2024-01-{1 + i % 28:02d} 10:00:00", "POS" if i % 2 else "ecom",
                    f"S{i % 3}", f" c{i % 10} ", f"SKU-{i % 5}", 1 + i % 4, f"{10 + i % 7}.25", i % 20, "INR"))
    return out


TX_HEADER = ("transaction_id,transaction_line_id,transaction_ts,channel,store_id,customer_id,sku,"
             "quantity,unit_price,discount,currency")


def test_incremental_golden_and_replay(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    _write(land / "customers.csv", "customer_id,name,signup_date",
           [(f"C{i}", f"Name {i}", "05/03/2024" if i % 2 else "05/03/24") for i in range(10)])
    _write(land / "products.csv", "sku,product_key,category,list_price",
           [(f"sku-{i}", f"pk-{i}", "cat", 10.5 + i) for i in range(5)])
    _write(land / "stores copy.csv", "store_id,name,region", [(f"s{i}", f"Store {i}", "EAST") for i in range(3)])
    _write(land / "transactions_1.csv", TX_HEADER, _tx_rows(0, 1000))
    _write(land / "notes.txt", "x", [(1,)])

    def silver_tx():
        return tables.read(spark, TABLES["silver"]["transactions"]).count()

    r1 = run_layers(spark, RunContext(as_of=datetime(2024, 2, 1, 2), batch_id="b1"), str(land))
    assert r1.bronze == {"customers": 10, "products": 5, "stores": 3, "transactions": 1000}
    assert silver_tx() == 1000
    assert all(r["status"] != "FAIL" for r in r1.results) and len(r1.results) == 50

    _write(land / "transactions_2.csv", TX_HEADER, _tx_rows(1000, 100))
    r2 = run_layers(spark, RunContext(as_of=datetime(2024, 2, 2, 2), batch_id="b2"), str(land))
    assert r2.bronze["transactions"] == 100 and r2.bronze["customers"] == 0
    assert r2.silver_rows == {"customers": 0, "products": 0, "stores": 0, "transactions": 100}
    assert silver_tx() == 1100

    _write(land / "transactions_3.csv", TX_HEADER, _tx_rows(1100, 50))
    run_layers(spark, RunContext(as_of=datetime(2024, 2, 3, 2), batch_id="b3"), str(land))
    assert silver_tx() == 1150
    assert tables.read(spark, TABLES["bronze"]["transactions"]).count() == 1150

    # Nothing new: no bronze rows, no silver change, no new audit rows.
    audit_before = tables.read(spark, TABLES["load_audit"]).count()
    r4 = run_layers(spark, RunContext(as_of=datetime(2024, 2, 4, 2), batch_id="b4"), str(land),
                    validate=False)
    assert sum(r4.bronze.values()) == 0 and silver_tx() == 1150
    assert tables.read(spark, TABLES["load_audit"]).count() == audit_before

    # Ledger write lost after the data write: the file is ingested again,
    # bronze holds it twice, silver merges it and keeps one row per key.
    ctx5 = RunContext(as_of=datetime(2024, 2, 5, 2), batch_id="b5")
    again = ingest_csv_to_bronze(spark, ctx5, "transactions", str(land),
                                 ledger="ops.lost_ledger", audit="ops.lost_audit")
    assert again.rows == 1150
    silver_step(spark, ctx5, "transactions")
    assert silver_tx() == 1150

    g = tables.read(spark, TABLES["gold"]["customer_summary"])
    assert g.count() == 10
    assert g.agg(F.sum("total_transactions")).first()[0] == 1150
    names = {r.customer_id for r in g.select("customer_id").collect()}
    assert names == {f"C{i}" for i in range(10)}


def test_validation_failure_is_stored_then_raised(spark, tmp_path):
    import pytest
    from strata.operators.qc import QCFailure
    from strata.plans.run import Namespace
    land = tmp_path / "landing"
    land.mkdir()
    _write(land / "customers.csv", "customer_id,name,signup_date", [("C1", "One", "05/03/2024")])
    _write(land / "products.csv", "sku,product_key,category,list_price", [("sku-1", "pk-1", "cat", 10.0)])
    _write(land / "stores.csv", "store_id,name,region", [("s1", "Store", "EAST")])
    rows = _tx_rows(0, 3)
    rows[0] = rows[0][:5] + ("C404",) + rows[0][6:]      # orphan customer
    rows = [r[:4] + ("s1", r[5] if r[5] == "C404" else "C1", "sku-1") + r[7:] for r in rows]
    _write(land / "transactions_1.csv", TX_HEADER, rows)
    ns = Namespace("strata_t_fail")
    ctx = RunContext(as_of=datetime(2024, 3, 1, 2), batch_id="bf")
    with pytest.raises(QCFailure) as e:
        run_layers(spark, ctx, str(land), gate=False, raise_on_validation_fail=True, ns=ns)
    assert any(f["check_name"] == "referential_integrity_customer_id" for f in e.value.failures)
    stored = tables.read(spark, ns(TABLES["validation_results"])).filter("batch_id = 'bf'")
    assert stored.count() == 50
