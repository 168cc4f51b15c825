"""The layered pipeline: bronze entities to silver by rules, deduplication and merge, then to gold dimensions and facts.

A run derives the rows of a range of ingestion times: those after the high-water mark, of a window, or all. What it keeps aside, it
replaces in that range, and it moves the mark last, so a run that failed at any step can be run again. Marks come from the rows that a
run has read, so a batch that is wholly quarantined is not read twice. Every run leaves a row of metrics for each entity.

The source is read and assessed in one pass, which writes the assessed rows down and counts them on the way; the rest reads these. Merges
touch the buckets of their keys only.
"""

from __future__ import annotations

import datetime
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.hashing import content_hash, row_hash
from lakeloom.operators import dedup, merge, observe, rules, scans, scd2
from lakeloom.sources.store import TableStore

MARKS = T.StructType([T.StructField("entity", T.StringType()), T.StructField("mark", T.TimestampType()), T.StructField("master_run_id", T.StringType())])


@dataclass(frozen=True)
class SilverResult:
    entity: str
    read: int
    inserted: int
    updated: int
    quarantined: int
    duplicates: int
    load_type: str


def mark_of(store: TableStore, entity: str) -> datetime.datetime | None:
    """The entity's high-water mark."""
    if not store.exists("metrics", "high_water_marks"):
        return None
    return store.read("metrics", "high_water_marks").where(F.col("entity") == entity).agg(F.max("mark")).first()[0]


def move_mark(store: TableStore, entity: str, mark: datetime.datetime, run_id: str) -> None:
    store.append("metrics", "high_water_marks", store.spark.createDataFrame([(entity, mark, run_id)], MARKS))


def logged(store: TableStore, layer: str, entity: str, run: scans.RunConfig, run_id: str, work: Callable[[], dict], env: str = "dev") -> dict:
    """Do the work of one entity and append its metrics, of a failure too; what the work returned."""
    began = datetime.datetime.now(datetime.UTC).replace(tzinfo=None)
    clock = time.monotonic()

    def record(status: str, found: dict, notes: str | None) -> None:
        if not run.dry_run:
            row = observe.metrics_row(run_id, env, layer, entity, run.mode, status, began, time.monotonic() - clock, found, notes)
            store.append("metrics", "etl_run_metrics", store.spark.createDataFrame([row], observe.METRICS_SCHEMA))

    try:
        found = work()
    except Exception as e:
        record("FAILED", {}, f"{type(e).__name__}: {e}"[:500])
        raise
    record("SUCCESS" if found.get("read") else "SKIPPED", found, None if found.get("read") else "nothing to read")
    return found


def silver(store: TableStore, spec: rules.EntityRules, run: scans.RunConfig, run_id: str, now: datetime.datetime) -> SilverResult:
    """One entity from bronze: valid rows are deduplicated and merged, dirty rows and duplicates are kept aside."""
    found = logged(store, "SILVER", spec.name, run, run_id, lambda: _silver(store, spec, run, run_id, now))
    return SilverResult(spec.name, found["read"], found["inserted"], found["updated"], found["quarantined"], found["duplicates"], found["load_type"])


def _silver(store: TableStore, spec: rules.EntityRules, run: scans.RunConfig, run_id: str, now: datetime.datetime) -> dict:
    mark = mark_of(store, spec.name)
    rows = scans.read_for_run(store.read("bronze", spec.name), run, spec.order_by, mark)
    empty = not store.exists("silver", spec.name)
    assessed = rules.assess(rows, spec)
    counts = [F.count("*").alias("n"), F.count_if(~F.col("is_valid")).alias("bad"), F.max(spec.order_by).alias("mark")]
    if run.dry_run:
        seen = assessed.agg(*counts).first()
        return {"read": seen["n"], "inserted": 0, "updated": 0, "quarantined": 0, "duplicates": 0, "load_type": run.load_type(empty, seen["n"])}
    # The one pass over the source: written down for this run, and counted as it is written.
    stage, seen = f"{store.root}/_stage/{spec.name}-{uuid.uuid4().hex}", Observation()
    assessed.observe(seen, *counts).write.parquet(f"{stage}/assessed")
    seen = seen.get
    assessed = store.spark.read.schema(assessed.schema).parquet(f"{stage}/assessed")
    dirty = rules.untyped(assessed.where("NOT is_valid")).withColumn("master_run_id", F.lit(run_id))
    stamped = rules.typed(assessed.where("is_valid"), spec).withColumns({f"silver_{spec.name}_hash_id": content_hash(spec.columns), "silver_ingestion_ts": F.lit(now).cast("timestamp")})
    ranked = dedup.classify_duplicates(stamped, spec.keys, spec.order_by, spec.columns)
    ranked.write.parquet(f"{stage}/ranked")
    winners, losers = dedup.split(store.spark.read.schema(ranked.schema).parquet(f"{stage}/ranked"))
    for layer, name, kept in (("silver", spec.name, winners), ("quarantine", f"{spec.name}_dirty", dirty), ("audit", f"{spec.name}_duplicates", losers)):
        store.create(layer, name, kept.schema)
    done = {"read": seen["n"], "inserted": 0, "updated": 0, "quarantined": seen["bad"], "duplicates": 0, "load_type": run.load_type(empty, seen["n"])}
    if seen["n"]:
        low, high = run.bounds(mark)
        store.replace_range("quarantine", f"{spec.name}_dirty", dirty, spec.order_by, low, high)
        done["duplicates"] = store.replace_range("audit", f"{spec.name}_duplicates", losers, spec.order_by, low, high)
        done |= upsert(store, "silver", spec.name, winners, spec.keys)
        done["matched"] = done["updated"]
        done["skew_ratio"] = observe.partition_skew(assessed).first()["skew_ratio"]
        move_mark(store, spec.name, seen["mark"], run_id)
    store._path(stage)[0].delete(store._path(stage)[1], True)
    return done


def upsert(store: TableStore, layer: str, name: str, rows: DataFrame, keys: Sequence[str], hash_col: str | None = None) -> dict[str, int]:
    """Merge rows (unique keys) into a table, of matches those whose hash differs, or all; inserted and updated rows."""
    plan = (lambda t, s: merge.upsert_changed(t, s, keys, hash_col)) if hash_col else (lambda t, s: merge.merge(t, s, keys))
    measures = {a: F.count_if(F.col(merge.ACTION) == a) for a in ("inserted", "updated")}
    return store.rewrite(layer, name, rows, keys, plan, measures, [merge.ACTION])


def dimension(store: TableStore, name: str, source: DataFrame, keys: Sequence[str], attributes: Sequence[str], now: datetime.datetime, effective: str = "silver_ingestion_ts") -> dict[str, int]:
    """Apply silver rows to an SCD2 dimension; new versions (replacements excluded) and closed versions."""
    h = f"gold_{name}_hash_id"
    trusted = observe.substitute_untrusted(scd2.require_columns(source, [*keys, *attributes, effective]), [a for a in attributes if a not in keys])
    versions = scd2.prepare_versions(trusted, keys, attributes, h, effective).withColumns({"silver_ingestion_ts": F.col("effective_from"), "gold_ingestion_ts": F.lit(now).cast("timestamp")})
    table = f"dim_{name}"
    store.create("gold", table, versions.withColumns({"effective_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)}).schema)
    action = F.col(merge.ACTION)
    measures = {"inserted": F.count_if(action == "inserted"), "closed": F.count_if(action == "closed")}
    return store.rewrite("gold", table, versions, keys, lambda t, s: scd2.apply_scd2(t, s, keys, h, merge.ACTION), measures, [merge.ACTION])


def fact(store: TableStore, name: str, source: DataFrame, keys: Sequence[str], columns: Sequence[str], now: datetime.datetime) -> dict[str, int]:
    """Upsert silver rows into a fact table where their hash differs; inserted and updated rows."""
    h, table = f"gold_{name}_hash_id", f"facts_{name}"
    rows = scd2.require_columns(source, [*columns, "silver_ingestion_ts"]).select(*columns, row_hash(columns).alias(h), "silver_ingestion_ts", F.lit(now).cast("timestamp").alias("gold_ingestion_ts"))
    store.create("gold", table, rows.schema)
    return upsert(store, "gold", table, rows, keys, h)


def gold_source(store: TableStore, entity: str, table: str, run: scans.RunConfig, window_on: str = "bronze_ingestion_ts") -> tuple[DataFrame, DataFrame | None]:
    """What a gold table reads of its silver entity: rows silver has written since the table's mark, or whose bronze rows came in the run's window."""
    rows = store.read("silver", entity)
    if run.is_windowed:
        return scans.in_window(rows, window_on, run.start, run.end)
    return rows if run.mode == "full_refresh" else scans.since(rows, "silver_ingestion_ts", mark_of(store, f"gold.{table}"))


def load_gold(store: TableStore, entity: str, table: str, run: scans.RunConfig, run_id: str, apply: Callable[[DataFrame], dict[str, int]]) -> dict:
    """Scan silver for a gold table (`dim_...` or `facts_...`), apply the rows, move its mark and append its metrics.

    The mark moves last; applying the same rows again changes nothing.
    """

    def work() -> dict:
        if not store.exists("silver", entity):
            return {"read": 0, "load_type": "NO_DATA"}
        empty, rows = not store.exists("gold", table), gold_source(store, entity, table, run)
        seen = rows.agg(F.count("*").alias("n"), F.max("silver_ingestion_ts").alias("mark")).first()
        found = {"read": seen["n"], "load_type": run.load_type(empty, seen["n"])}
        if seen["n"] and not run.dry_run:
            found |= apply(rows)
            found["unchanged"] = max(0, seen["n"] - found.get("inserted", 0) - found.get("updated", 0))
            move_mark(store, f"gold.{table}", seen["mark"], run_id)
        return found

    return logged(store, "GOLD", table, run, run_id, work)


def load_dimension(store: TableStore, name: str, entity: str, keys: Sequence[str], attributes: Sequence[str], run: scans.RunConfig, run_id: str, now: datetime.datetime) -> dict:
    return load_gold(store, entity, f"dim_{name}", run, run_id, lambda rows: dimension(store, name, rows, keys, attributes, now))


def load_fact(store: TableStore, name: str, entity: str, keys: Sequence[str], columns: Sequence[str], run: scans.RunConfig, run_id: str, now: datetime.datetime) -> dict:
    return load_gold(store, entity, f"facts_{name}", run, run_id, lambda rows: fact(store, name, rows, keys, columns, now))


def record_features(store: TableStore, name: str, rows: DataFrame, keys: Sequence[str]) -> dict[str, int]:
    """Upsert feature rows by key and feature_date: another date is another row, the same date is replaced."""
    store.create("features", name, rows.schema)
    return upsert(store, "features", name, rows, [*keys, "feature_date"])


def reconcile(store: TableStore, spec: rules.EntityRules) -> DataFrame:
    """Reconciliation of one entity's tables."""
    return observe.reconcile(spec.name, store.read("bronze", spec.name), store.read("silver", spec.name), store.read("quarantine", f"{spec.name}_dirty"), store.read("audit", f"{spec.name}_duplicates"), spec.keys)


def run_reconciliation_checks(store: TableStore, specs: Sequence[rules.EntityRules], run_id: str, env: str, at: datetime.datetime) -> list[tuple]:
    """Reconcile all entities and append their check rows, which are returned."""
    rows = [observe.reconciliation_check(run_id, env, reconcile(store, s).first().asDict(), at) for s in specs]
    record_checks(store, rows)
    return rows


def record_checks(store: TableStore, rows: list[tuple]) -> None:
    """Append check rows to the log."""
    store.append("metrics", "data_quality_checks", store.spark.createDataFrame(rows, observe.CHECKS_SCHEMA))


def record_drift(store: TableStore, raw: DataFrame, declared: dict[str, Sequence[str]], ignored: Sequence[str], run_id: str, env: str, at: datetime.datetime, rescue: str | None = None, pipeline: Sequence[str] = ()) -> dict[str, list[str]]:
    """Compare the source's columns with those that the entities declare, append what differs, with the rows that did not fit their header; the drift."""
    drift = observe.detect_drift(observe.source_columns(raw.columns, [*pipeline, *([rescue] if rescue else [])]), observe.declared_columns(declared), ignored)
    rescued = (rescue, raw.where(F.col(rescue).isNotNull()).count()) if rescue and rescue in raw.columns else None
    rows = observe.drift_rows(run_id, env, drift, at, rescued)
    if rows:
        store.append("metrics", "schema_drift", store.spark.createDataFrame(rows, observe.DRIFT_SCHEMA))
    return drift


def record_snapshot(store: TableStore, row: dict, schema: str) -> None:
    """Upsert a run's snapshot by its id and show it as a view."""
    new = store.spark.createDataFrame([row], schema)
    store.create("metrics", "kpi_run_snapshot", new.schema)
    upsert(store, "metrics", "kpi_run_snapshot", new, ["master_run_id"])
    store.view("metrics", "kpi_run_snapshot", "kpi_run_snapshot")


def attempt_all(jobs: dict) -> dict:
    """Run every job, then fail if any has failed: {name: function} to {name: result}."""
    done, failed = {}, {}
    for name, job in jobs.items():
        try:
            done[name] = job()
        except Exception as e:
            failed[name] = e
    if failed:
        raise RuntimeError("failed: " + "; ".join(f"{n}: {e}" for n, e in failed.items())) from next(iter(failed.values()))
    return done
