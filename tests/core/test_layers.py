import datetime
import gzip

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import observe, rules, scans
from lakeloom.plans import kpi, medallion
from lakeloom.sources.store import TableStore, plan_layout
from lakeloom.streaming import ingest

HEADER = ["Row ID", "Order ID", "Order Date", "Customer ID", "Customer Name", "Segment", "Sub-Category", "Sales"]
NAMES = {"Sub-Category": "sub_category"}
ROWS = [
    ["1", "o1", "2024-01-02", "c1", "Ann", "Consumer", "Chairs", "10.5"],
    ["2", "o2", "2024-01-03", "c2", "Bo", "Corporate", "Chairs", "20"],
    ["3", "o3", "2024-01-03", "", "No Key", "Consumer", "Desks", "30"],
    ["4", "o4", "2024-01-04", "c4", "Di", "Premium", "Desks", "40"],
    ["5", "o1", "2024-01-05", "c1", "Ann B", "Consumer", "Desks", "not-a-number"],
]
CUSTOMERS = rules.EntityRules("customers", ("customer_id",), ("customer_id", "customer_name", "segment"), allowed={"segment": ["Consumer", "Corporate"]}, severity={"customer_name": rules.REPAIRABLE, "segment": rules.REPAIRABLE})
SALES = rules.EntityRules("sales", ("order_id",), ("order_id", "sales", "order_date"), patterns={"sales": r"^\d+(\.\d+)?$"}, casts={"sales": "decimal(10,2)"}, dates=("order_date",))


def write(path, header, rows, zipped=False):
    text = "\n".join(",".join(x) for x in [header, *rows]) + "\n"
    (gzip.open(path, "wt") if zipped else open(path, "w")).write(text)


def test_ingest_to_gold(spark, tmp_path):
    landing, table, check = (str(tmp_path / x) for x in ("landing", "raw", "check"))
    (tmp_path / "landing").mkdir()
    write(tmp_path / "landing" / "a.csv", HEADER, ROWS[:3])
    write(tmp_path / "landing" / "b.csv.gz", HEADER, ROWS[3:], zipped=True)
    (tmp_path / "landing" / "skip.txt").write_text("x")
    t1, t2 = datetime.datetime(2024, 2, 1), datetime.datetime(2024, 2, 2)
    assert ingest.is_initial(spark, check)
    assert ingest.ingest(spark, landing, table, check, NAMES, "r1", t1) == 1
    assert not ingest.is_initial(spark, check) and ingest.ingest(spark, landing, table, check, NAMES, "r1b", t1) == 0
    raw = ingest.raw_table(spark, table)
    assert raw.count() == 5 and raw.where("sub_category = 'Chairs'").count() == 2
    assert {r[0] for r in raw.select("source_file_name").distinct().collect()} == {"a.csv", "b.csv.gz"}
    # The next file has its columns in another order, one more, and a line that does not fit.
    order = ["Order ID", "Customer ID", "Segment", "Customer Name", "Order Date", "Sales", "Sub-Category", "Row ID", "Discount Reason"]
    write(tmp_path / "landing" / "c.csv", order, [["o9", "c1", "Corporate", "Ann B", "2024-01-09", "9", "Chairs", "9", "why"], ["o8", "c8", "Consumer", "Hal", "2024-01-08", "8", "Chairs", "8", "x", "one too many"]])
    assert ingest.ingest(spark, landing, table, check, NAMES, "r2", t2) == 1
    raw = ingest.raw_table(spark, table)
    assert raw.count() == 7 and raw.where("order_id = 'o9'").first()["discount_reason"] == "why"
    assert raw.where(F.col(ingest.RESCUED).isNotNull()).count() == 1
    assert observe.detect_drift(raw.columns, [c for c in raw.columns if c != "discount_reason"])["NEW"] == ["discount_reason"]
    with pytest.raises(ValueError):
        ingest.entity_rows(raw, ["nothing"])
    known = ingest.landed_files(spark, landing).where("file_name <> 'a.csv'")
    day = datetime.date.today()
    window = day - datetime.timedelta(2), day + datetime.timedelta(2)
    assert ingest.backfill(spark, landing, table + "_again", check, NAMES, "r3", *window, known, t2) == 1
    assert ingest.raw_table(spark, table + "_again").count() == 3
    # Under the run of an ingest, and again for the same window: nothing is written over.
    assert ingest.backfill(spark, landing, table, check + "2", NAMES, "r1", *window, known, t2) == 1 and ingest.raw_table(spark, table).count() == 10
    write(tmp_path / "landing" / "d.csv", HEADER, ROWS[:1])
    assert ingest.backfill(spark, landing, table, check + "2", NAMES, "r1", *window, known, t2) == 1 and ingest.raw_table(spark, table).count() == 11
    assert ingest.backfill(spark, landing, table, check + "2", NAMES, "r1", *window, known, t2) == 0
    raw = spark.createDataFrame(raw.where(F.col("master_run_id").isin("r1", "r2")).dropDuplicates(["row_id"]).collect(), raw.schema)
    assert ingest.checkpoint_for("c", datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)) == "c_backfill_20240101_20240102"

    store = TableStore(spark, str(tmp_path / "store"))
    meta = ["bronze_ingestion_ts", "master_run_id"]
    for spec in (CUSTOMERS, SALES):
        store.replace("bronze", spec.name, ingest.entity_rows(raw.replace("", None), spec.columns, meta).where("master_run_id = 'r1'"))
    run = scans.RunConfig.of({})
    done = medallion.attempt_all({s.name: lambda s=s: medallion.silver(store, s, run, "r1", t1) for s in (CUSTOMERS, SALES)})
    c, s = done["customers"], done["sales"]
    assert (c.read, c.inserted, c.quarantined, c.duplicates, c.load_type) == (5, 3, 1, 1, "INITIAL_LOAD")
    assert (s.read, s.inserted, s.quarantined) == (5, 4, 1)
    assert all(medallion.reconcile(store, x).first()["balanced"] for x in (CUSTOMERS, SALES))
    assert store.read("quarantine", "sales_dirty").first()["error_columns"] == ["sales", "cast_sales"]
    assert medallion.dimension(store, "customers", store.read("silver", "customers"), ["customer_id"], ["customer_name", "segment"], t1) == {"inserted": 3, "closed": 0}
    assert store.read("gold", "dim_customers").where("customer_id = 'c4'").first()["segment"] == "Unknown"
    assert medallion.fact(store, "sales", store.read("silver", "sales"), ["order_id"], ["order_id", "sales", "order_date"], t1) == {"inserted": 4, "updated": 0}

    # The second batch changes one customer; a rerun of it changes nothing.
    for spec in (CUSTOMERS, SALES):
        store.append("bronze", spec.name, ingest.entity_rows(raw, spec.columns, meta).where("master_run_id = 'r2'"))
    r = medallion.silver(store, CUSTOMERS, run, "r2", t2)
    assert (r.read, r.inserted, r.updated, r.load_type) == (2, 1, 1, "INCREMENTAL")
    assert medallion.silver(store, CUSTOMERS, run, "r2", t2).load_type == "NO_DATA"
    new = store.read("silver", "customers").where(F.col("silver_ingestion_ts") == F.lit(t2))
    assert medallion.dimension(store, "customers", new, ["customer_id"], ["customer_name", "segment"], t2) == {"inserted": 1, "closed": 1}
    assert medallion.dimension(store, "customers", new, ["customer_id"], ["customer_name", "segment"], t2) == {"inserted": 0, "closed": 0}
    row = medallion.reconcile(store, CUSTOMERS).first()
    assert row["balanced"] and row["superseded_rows"] == 1
    replay = scans.RunConfig.of({"run_mode": "replay", "start_date": "2024-02-01", "end_date": "2024-02-01"})
    before = store.read("quarantine", "customers_dirty").count(), store.read("audit", "customers_duplicates").count()
    assert medallion.silver(store, CUSTOMERS, replay, "r4", t2).load_type == "REPLAY"
    assert (store.read("quarantine", "customers_dirty").count(), store.read("audit", "customers_duplicates").count()) == before
    assert medallion.silver(store, CUSTOMERS, scans.RunConfig.of({"run_mode": "replay", "start_date": "2024-02-01", "end_date": "2024-02-02", "dry_run": "true"}), "r5", t2).inserted == 0

    medallion.record_checks(store, [observe.reconciliation_check("r2", "t", row.asDict(), t2), observe.placeholder_check("r2", "t", "dim", {"placeholder_pct": 1.0}, t2)])
    assert kpi.alert_reconciliation(store.read("metrics", "data_quality_checks")).first()[0] == 0
    snapshot = kpi.snapshot_row("t", "r2", "Manual", t2, {"revenue_total": 5, "orders_total": 2})
    schema = "master_run_id string, env string, trigger_type string, snapshot_at timestamp, run_started_at timestamp, raw_rows_ingested long, data_from date, data_through date, revenue_30d double, profit_30d double, revenue_total double, profit_total double, orders_total long, customers_total long"
    for _ in range(2):
        medallion.record_snapshot(store, snapshot, schema)
    assert spark.table("kpi_run_snapshot").count() == 1 and spark.table("kpi_run_snapshot").first()["trigger_type"] == "manual"
    metrics = store.read("metrics", "etl_run_metrics")
    assert {r["run_status"] for r in metrics.collect()} == {"SUCCESS", "SKIPPED"} and kpi.alert_freshness(metrics, datetime.datetime(2100, 1, 1)).first()[0] > 0
    assert store.vacuum("metrics", "kpi_run_snapshot") >= 1 and store.read("metrics", "kpi_run_snapshot").count() == 1


def test_store_and_layout(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    with pytest.raises(LookupError):
        store.read("gold", "none")
    with pytest.raises(ValueError):
        store.folder("nowhere", "x")
    store.replace("gold", "t", spark.range(10), cluster_by=("id",))
    held = store.read("gold", "t")
    store.replace("gold", "t", held.where("id < 3"))
    assert held.count() == 10 and store.read("gold", "t").count() == 3
    store.append("gold", "t", spark.createDataFrame([(9, "new")], "id long, extra string"))
    assert store.read("gold", "t").where("extra = 'new'").count() == 1
    assert [plan_layout(*x) for x in (((), ("a",), ("a",)), ((), (), ("a",)), (("p",), (), ("a",)))] == ["NOTHING", "ALTER_CLUSTER_BY", "CONVERT_PARTITIONED"]
    with pytest.raises(ValueError):
        plan_layout((), (), ("a", "a"))


def test_merges_touch_only_the_buckets_of_their_keys(spark, tmp_path):
    from lakeloom.operators import merge

    store = TableStore(spark, str(tmp_path), buckets=8)
    store.create("gold", "t", spark.createDataFrame([], "k long, v string").schema)
    rows = lambda ids, v: spark.createDataFrame([(i, v) for i in ids], "k long, v string")
    assert medallion.upsert(store, "gold", "t", rows(range(200), "a"), ["k"]) == {"inserted": 200, "updated": 0}
    before = {p["path"] for p in store.manifest("gold", "t")["parts"]}
    held = store.read("gold", "t")
    assert len(before) == 8
    assert medallion.upsert(store, "gold", "t", rows([7], "b"), ["k"]) == {"inserted": 0, "updated": 1}
    assert len(before & {p["path"] for p in store.manifest("gold", "t")["parts"]}) == 7
    assert medallion.upsert(store, "gold", "t", rows([1000], "c"), ["k"]) == {"inserted": 1, "updated": 0}
    got = {r["k"]: r["v"] for r in store.read("gold", "t").collect()}
    assert got == {i: "a" for i in range(200)} | {7: "b", 1000: "c"} and held.count() == 200
    assert store.vacuum("gold", "t") == 2 and store.read("gold", "t").count() == 201
    # An append lies in no bucket, and is taken into them by the next merge.
    store.append("gold", "t", rows([2000, 2001], "d"))
    assert medallion.upsert(store, "gold", "t", rows([2000], "e"), ["k"]) == {"inserted": 0, "updated": 1}
    assert store.read("gold", "t").count() == 203 and store.read("gold", "t").where("v = 'e'").count() == 1
    with pytest.raises(ValueError):
        store.rewrite("gold", "t", spark.createDataFrame([("x",)], "k string"), ["k"], lambda t, s: merge.merge(t, s, ["k"]), drop=[merge.ACTION])


def test_ranges_are_replaced_without_touching_others(spark, tmp_path):
    store, day = TableStore(spark, str(tmp_path)), datetime.datetime
    rows = lambda *days: spark.createDataFrame([(day(2024, 1, d), d) for d in days], "ts timestamp, d int")
    held = lambda: sorted(r["d"] for r in store.read("audit", "t").collect())
    assert store.replace_range("audit", "t", rows(1, 2, 3), "ts", None, None) == 3
    assert store.replace_range("audit", "t", rows(5, 6), "ts", day(2024, 1, 4), None) == 2 and held() == [1, 2, 3, 5, 6]
    first = store.manifest("audit", "t")["parts"][0]
    assert store.replace_range("audit", "t", rows(7), "ts", day(2024, 1, 4), None) == 1 and held() == [1, 2, 3, 7]
    assert store.manifest("audit", "t")["parts"][0] == first
    assert store.replace_range("audit", "t", rows(), "ts", day(2024, 1, 2), day(2024, 1, 3)) == 0 and held() == [1, 3, 7]
    assert store.replace_range("audit", "t", rows(9), "ts", None, None) == 1 and held() == [9]


def test_writers_that_meet_do_not_lose_rows(spark, tmp_path):
    from lakeloom.sources.store import WriteConflict

    one, two = TableStore(spark, str(tmp_path)), TableStore(spark, str(tmp_path))
    one.append("gold", "t", spark.range(3))
    before = one.manifest("gold", "t")
    two.append("gold", "t", spark.range(2))
    with pytest.raises(WriteConflict):
        one._commit("gold", "t", before, [], spark.range(1).schema)
    assert one.read("gold", "t").count() == 5


def test_jobs_are_all_tried_before_failing():
    seen = []
    with pytest.raises(RuntimeError, match="b: "):
        medallion.attempt_all({"a": lambda: seen.append(1), "b": lambda: 1 / 0, "c": lambda: seen.append(2)})
    assert seen == [1, 2]
