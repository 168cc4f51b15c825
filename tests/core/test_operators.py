import datetime

import pytest
from pyspark.sql import functions as F

from lakeloom.functions.dates import parse_date
from lakeloom.functions.hashing import content_hash, row_hash
from lakeloom.functions.text import clean_strings, conform_values, rename_columns, sanitize_column
from lakeloom.operators import dedup, merge, observe, rules, scans, scd2

DAY = datetime.datetime


@pytest.mark.parametrize(("name", "clean"), [("Order ID", "order_id"), ("Sub-Category", "subcategory"), ("2024 Sales", "col_2024_sales"), ("", "col_"), ("_x", "col__x"), ("Profit", "profit")])
def test_sanitize(name, clean):
    assert sanitize_column(name) == clean


def test_rename_map_wins(spark):
    df = spark.createDataFrame([(1, 2)], "`Sub-Category` int, `Row ID` int")
    assert rename_columns(df, {"Sub-Category": "sub_category"}).columns == ["sub_category", "row_id"]


def test_clean_and_conform(spark):
    df = spark.createDataFrame([('  "a b" ', datetime.date(2024, 1, 2), 5, "OFF"), ("", None, None, None)], "s string, d date, n int, c string")
    rows = conform_values(clean_strings(df, ["s", "d", "n"]), {"c": {"OFF": "Office"}, "no": {"a": "b"}}).collect()
    assert [tuple(r) for r in rows] == [("a b", datetime.date(2024, 1, 2), 5, "Office"), ("", None, None, None)]


def test_dates(spark):
    texts = ["2024-01-05", "5/1/2024", "05-01-2024", "5 Jan 2024", "5 January 2024", "31-02-2024", "x", None, "2024/01/05"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = datetime.date(2024, 1, 5)
    assert [r[0] for r in df.select(parse_date(F.col("t"))).collect()] == [want] * 5 + [None] * 4


def test_hashes_tell_fields_apart_and_take_any_type(spark):
    df = spark.createDataFrame([("a", "bc", None, datetime.date(2024, 1, 1)), ("ab", "c", None, None)], "k1 string, k2 string, n decimal(10,2), d date")
    rows = df.select(row_hash(["k1", "k2", "n", "d"]).alias("a"), content_hash(["k2", "k1", "n", "d"]).alias("b"), content_hash(["d", "n", "k1", "k2"]).alias("c")).collect()
    assert rows[0]["a"] != rows[1]["a"] and all(r["b"] == r["c"] for r in rows) and all(len(r["a"]) == 64 for r in rows)


SPEC = rules.EntityRules(
    "customers", ("customer_id",), ("customer_id", "segment", "postal_code"), allowed={"segment": ["Consumer", "Corporate"]}, patterns={"postal_code": r"^\d+$"}, severity={"segment": rules.REPAIRABLE, "postal_code": rules.REPAIRABLE}
)


def test_severity_tiers(spark):
    df = spark.createDataFrame([("1", "Consumer", "12"), (None, "Consumer", "12"), ("2", "Premium", None), ("3", "Corporate", "x")], "customer_id string, segment string, postal_code string")
    got = [(r["error_columns"], r["repaired_columns"], r["is_valid"]) for r in rules.assess(df, SPEC).collect()]
    assert got == [([], [], True), (["customer_id"], [], False), ([], ["postal_code", "segment"], True), ([], ["postal_code"], True)]


def test_casts_and_dates_are_quarantined_not_lost(spark):
    spec = rules.EntityRules("o", ("id",), ("id", "amount", "a", "b"), casts={"amount": "decimal(10,2)"}, dates=("a", "b"), not_before=(("b", "a"),))
    df = spark.createDataFrame([("1", "1.5", "2024-01-01", "2024-01-02"), ("2", "99999999999", "2024-01-01", "2024-01-02"), ("3", "1", "31-02-2024", "2024-01-02"), ("4", "1", "2024-01-03", "2024-01-02")], "id string, amount string, a string, b string")
    good, bad = rules.route(df, spec)
    assert [r["id"] for r in good.collect()] == ["1"] and dict(good.dtypes)["amount"] == "decimal(10,2)"
    assert {r["id"]: r["error_columns"] for r in bad.collect()} == {"2": ["cast_amount"], "3": ["unparseable_a"], "4": ["b_before_a"]}


def test_dedup_prefers_complete_then_late_then_hash(spark):
    rows = [("a", "full", DAY(2024, 1, 1), []), ("a", "late", DAY(2024, 1, 9), ["region"]), ("b", "x", DAY(2024, 1, 1), None), ("b", "y", DAY(2024, 1, 1), None), ("c", "only", None, [])]
    df = spark.createDataFrame(rows, "k string, v string, ts timestamp, repaired_columns array<string>")
    winners, losers = dedup.deduplicate(df, ["k"], "ts")
    got = {r["k"]: r["v"] for r in winners.collect()}
    assert got["a"] == "full" and got["c"] == "only" and len(got) == 3 and losers.count() == 2
    assert {r["k"]: r["v"] for r in dedup.deduplicate(df.repartition(3), ["k"], "ts")[0].collect()} == got
    assert {r["record_type"] for r in losers.collect()} == {"duplicate"}


def test_merge(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0)], "k int, v string, old double")
    source = spark.createDataFrame([(2, "B", True), (3, "c", True), (None, "m", False)], "k int, v string, new boolean")
    got = sorted((str(r["k"]), r["v"], r["old"], r["new"], r["_action"]) for r in merge.merge(target, source, ["k"]).collect())
    assert got == [("1", "a", 1.0, None, "kept"), ("2", "B", 2.0, True, "updated"), ("3", "c", None, True, "inserted"), ("None", "m", None, False, "inserted"), ("None", "n", 0.0, None, "kept")]
    assert merge.action_counts(merge.merge(target, source, ["k"], lambda t, s: t("v") == s("v"))) == {"inserted": 2, "updated": 0, "kept": 3}


def test_scd2(spark):
    schema = "k string, seg string, h string, effective_from timestamp, effective_to timestamp, is_current boolean"
    dim = spark.createDataFrame([("a", "x", "hx", DAY(2024, 1, 1), None, True), ("a", "w", "hw", DAY(2023, 1, 1), DAY(2023, 12, 31), False), ("b", "y", "hy", DAY(2024, 1, 1), None, True), ("c", "z", None, DAY(2024, 1, 1), None, True)], schema)
    source = spark.createDataFrame([("a", "x2", "hx2", DAY(2024, 5, 1)), ("b", "y", "hy", DAY(2024, 5, 1)), ("c", "z", None, DAY(2024, 5, 1)), ("d", "n", "hn", DAY(2024, 5, 1))], "k string, seg string, h string, effective_from timestamp")
    out = scd2.apply_scd2(dim, source, ["k"], "h")
    current = {r["k"]: r["seg"] for r in out.where("is_current").collect()}
    assert current == {"a": "x2", "b": "y", "c": "z", "d": "n"} and out.count() == 6
    assert out.where("seg = 'x'").first()["effective_to"] == DAY(2024, 4, 30, 23, 59, 59)
    assert scd2.apply_scd2(out, source, ["k"], "h").count() == 6
    gone = scd2.soft_delete(out, source.where("k <> 'd'"), ["k"], DAY(2024, 6, 1))
    assert gone.where("k = 'd'").first()["is_current"] is False and gone.where("is_current").count() == 3


def test_timeline(spark):
    df = spark.createDataFrame([("a", "1", DAY(2024, 1, 1)), ("a", "1", DAY(2024, 1, 2)), ("a", "2", DAY(2024, 1, 3))], "k string, h string, effective_from timestamp")
    rows = sorted(scd2.timeline(df, ["k"], "h").collect(), key=lambda r: r["effective_from"])
    assert [r["is_current"] for r in rows] == [False, False, True] and rows[0]["effective_to"] == DAY(2024, 1, 1, 23, 59, 59, 999999)
    assert scd2.collapse_unchanged(df, ["k"], "h").count() == 2


def test_timeline_of_versions_at_one_instant(spark):
    rows = [("a", "1", DAY(2024, 1, 1)), ("a", "3", DAY(2024, 1, 2)), ("a", "2", DAY(2024, 1, 2)), ("a", "2", DAY(2024, 1, 2)), ("b", "x", DAY(2024, 1, 1)), ("b", "y", DAY(2024, 1, 1))]
    df = spark.createDataFrame(rows, "k string, h string, effective_from timestamp")
    for some in (df, df.repartition(3)):
        got = scd2.timeline(some, ["k"], "h")
        assert sorted((r["k"], r["h"], r["is_current"]) for r in got.collect()) == [("a", "1", False), ("a", "3", True), ("b", "y", True)]
        assert scd2.overlaps(got, ["k"]).count() == 0


def test_overlaps(spark):
    rows = [("a", DAY(2024, 1, 1), DAY(2024, 1, 5)), ("a", DAY(2024, 1, 3), None), ("b", DAY(2024, 1, 1), DAY(2023, 1, 1)), ("c", DAY(2024, 1, 1), None), ("c", DAY(2024, 1, 2), None), ("d", DAY(2024, 1, 1), DAY(2024, 1, 2)), ("d", DAY(2024, 1, 3), None)]
    got = scd2.overlaps(spark.createDataFrame(rows, "k string, effective_from timestamp, effective_to timestamp"), ["k"])
    assert sorted((r["k"], r["fault"]) for r in got.collect()) == [("a", "overlaps"), ("b", "covers no time"), ("c", "overlaps")]


def test_acquisition(tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    for name in ("b.csv", "a.csv.gz", "c.txt"):
        (source / name).write_text(name)
    landing = str(tmp_path / "landing")
    assert scans.acquire(scans.LocalSource(str(source)), landing) == ["a.csv.gz", "b.csv"]
    assert scans.acquire(scans.LocalSource(str(source)), landing) == [] and (tmp_path / "landing" / "b.csv").read_text() == "b.csv"
    assert scans.acquire(scans.LocalSource(str(tmp_path / "nowhere")), landing) == []


def test_run_bounds():
    mark, of = DAY(2024, 1, 5), scans.RunConfig.of
    assert of({}).bounds(mark) == (DAY(2024, 1, 5, 0, 0, 0, 1), None) and of({}).bounds() == (None, None)
    assert of({"run_mode": "replay", "start_date": "2024-01-01", "end_date": "2024-01-02"}).bounds(mark) == (DAY(2024, 1, 1), DAY(2024, 1, 3))
    assert of({"run_mode": "full_refresh"}, allow_full_refresh=True).bounds(mark) == (None, None)


def test_run_config():
    of = scans.RunConfig.of
    assert of({}).mode == "incremental" and of({"run_mode": "Backfill", "start_date": "2024-01-01"}, today=datetime.date(2024, 2, 1)).end == datetime.date(2024, 2, 1)
    for bad in ({"run_mode": "x"}, {"run_mode": "replay"}, {"run_mode": "replay", "start_date": "2024-02-01", "end_date": "2024-01-01"}, {"run_mode": "replay", "start_date": "2020-01-01", "end_date": "2024-01-01"}, {"run_mode": "full_refresh"}):
        with pytest.raises(ValueError):
            of(bad)
    assert of({"run_mode": "full_refresh"}, allow_full_refresh=True).load_type(False, 3) == "FULL_REFRESH"
    assert of({}).load_type(True, 1) == "INITIAL_LOAD" and of({}).load_type(True, 0) == "NO_DATA" and of({}).scope("ts") is None


def test_scan_helpers(spark):
    assert scans.backfill_scope(0, 0) == "WINDOW_MATCHED_NOTHING" and scans.backfill_scope(3, 3) == "NOTHING_MISSING" and scans.backfill_scope(3, 1) == "HAS_WORK"
    assert [scans.source_state(*x) for x in ((1, 0), (0, 1), (0, 0))] == ["SOURCE_POPULATED", "SOURCE_DRAINED", "NO_DATA_ANYWHERE"]
    assert scans.plan_acquisition(["b.csv", "a.csv.gz", "x.txt", "c.csv"], ["c.csv"]) == ["a.csv.gz", "b.csv"]
    with pytest.raises(ValueError):
        scans.source_state(-1, 0)
    df = spark.createDataFrame([(DAY(2024, 1, 1, 23, 59),), (DAY(2024, 1, 2),), (DAY(2024, 1, 3),)], "ts timestamp")
    assert scans.in_window(df, "ts", datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)).count() == 2
    assert scans.since(df, "ts", None).count() == 3 and scans.since(df, "ts", DAY(2024, 1, 2)).count() == 1


def test_reconciliation_can_fail(spark):
    mk = lambda keys: spark.createDataFrame([(k,) for k in keys], "k string")
    bronze = mk(["a", "a", "b", None, "c", "c"])
    ok = observe.reconcile("e", bronze, mk(["a", "b", "c"]), mk([None]), mk(["a"]), ["k"]).first()
    assert ok["balanced"] and ok["superseded_rows"] == 1 and ok["accounted_rows"] == 6
    assert not observe.reconcile("e", bronze, mk(["a", "b"]), mk([None]), mk(["a"]), ["k"]).first()["balanced"]
    assert not observe.reconcile("e", bronze, mk(["a", "b", "c"]), mk([None]), mk(["a"] * 5), ["k"]).first()["balanced"]
    row = observe.reconciliation_check("r", "t", ok.asDict(), None)
    assert row[2:7] == ("reconciliation", "e", 6.0, 6.0, True)


def test_placeholders_drift_and_metrics(spark):
    df = spark.createDataFrame([("1", None, "North", ["region"], True), ("2", "Home", "East", None, True), ("3", "Home", "West", [], False)], "id string, segment string, region string, repaired_columns array<string>, is_current boolean")
    fixed = observe.substitute_untrusted(df, ["segment", "region", "absent"])
    assert [(r["segment"], r["region"]) for r in fixed.collect()] == [("Unknown", "Unknown"), ("Home", "East"), ("Home", "West")]
    e = observe.placeholder_exposure(fixed, ["segment", "region"]).first()
    assert tuple(e) == (2, 1, 50.0) and observe.placeholder_exposure(fixed.limit(0), ["region"]).first()["placeholder_pct"] == 0
    with pytest.raises(ValueError):
        observe.placeholder_exposure(df, [])
    assert observe.detect_drift(["a", "n", "i"], ["a", "m"], ["i"]) == {"NEW": ["n"], "MISSING": ["m"], "IGNORED": ["i"]}
    assert observe.drift_summary({"NEW": ["n"], "MISSING": [], "IGNORED": ["i", "j"]}) == "1 new (n); 2 ignored (i, j)" and observe.drift_summary({}) == "no drift"
    assert observe.missing_columns_message("e", ["a"], ["b", "a"]) == "e lacks b" and observe.missing_columns_message("e", ["a"], ["a"]) is None
    assert observe.run_metrics(10, 3, 4, 2.0)["unchanged_rows"] == 3 and observe.run_metrics(1, 5, 0, 0)["unchanged_rows"] == 0
    assert observe.partition_skew(spark.range(100).repartition(4)).first()["rows"] == 100


def test_places(spark):
    from lakeloom.plans import kpi

    values = [5.0, 5.0, None, -3.0, 0.0, 1e12, 7.25, 7.26, -0.5, None, 0.01]
    df = spark.createDataFrame([(g, v) for g in ("x", None) for v in values[: 8 if g else None]], "g string, v double")
    for by in ([], ["g"]):
        for down in (True, False):
            for r in kpi.with_place(df, "place", "v", by, down).collect():
                peers = [v for g in ("x", None) for v in values[: 8 if g else None] if not by or g == r["g"]]
                known = [v for v in peers if v is not None]
                if r["v"] is None:
                    want = len(known) + 1 if down else 1
                else:
                    want = sum(x > r["v"] for x in known) + 1 if down else sum(x < r["v"] for x in known) + 1 + len(peers) - len(known)
                assert r["place"] == want, (by, down, r)


def test_dates_of_odd_texts(spark):
    texts = ["29/2/2024", "29/2/2023", "1-13-2024", "31 Apr 2024", "5 MAY 2024", "5 Foo 2024", "5 Janu 2024", "2024-1-05", " 2024-01-05", "0000-00-00", "", "99/99/9999", "1/1/24"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [str(r[0]) for r in df.select(parse_date(F.col("t"))).collect()] == ["2024-02-29", "None", "None", "None", "2024-05-05", *["None"] * 8]
