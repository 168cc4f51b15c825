"""Reconciliation, orphans, placeholders, drift and run metrics."""

from __future__ import annotations

import datetime
import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.numbers import rounded

PLACEHOLDER = "Unknown"


def substitute_untrusted(df: DataFrame, attributes: Sequence[str], placeholder: str = PLACEHOLDER) -> DataFrame:
    """Put the placeholder where a string attribute is null or noted as repaired."""
    flagged = "repaired_columns" in df.columns
    kinds = {f.name: f.dataType for f in df.schema}

    def trusted(c: str) -> Column:
        bad = F.col(c).isNull()
        if flagged:
            bad = bad | F.coalesce(F.array_contains("repaired_columns", c), F.lit(False))
        return F.when(bad, F.lit(placeholder)).otherwise(F.col(c))

    changed = {c: trusted(c) for c in attributes if isinstance(kinds.get(c), T.StringType)}
    return df.withColumns(changed) if changed else df


def placeholder_exposure(dim: DataFrame, columns: Sequence[str], placeholder: str = PLACEHOLDER, current_only: bool = True) -> DataFrame:
    """total_rows, placeholder_rows (a row counts once) and their percentage."""
    if not columns:
        raise ValueError("no columns to look at")
    rows = dim.where("is_current") if current_only and "is_current" in dim.columns else dim
    hit = F.exists(F.array(*columns), lambda x: x.eqNullSafe(F.lit(placeholder)))
    n, k = F.count("*"), F.count_if(hit)
    return rows.agg(n.alias("total_rows"), k.alias("placeholder_rows"), F.coalesce(rounded(k * 100.0 / F.nullif(n, F.lit(0)), 4), F.lit(0.0)).cast("double").alias("placeholder_pct"))


def orphans(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no current dimension row."""
    known = (dim.where("is_current") if "is_current" in dim.columns else dim).select(key)
    return facts.join(known, key, "left_anti")


def reconcile(entity: str, bronze: DataFrame, silver: DataFrame, quarantine: DataFrame, audit: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row that accounts for every bronze row: in silver, quarantined, a duplicate of its batch, or superseded by a later batch.

    A key's arrivals are its bronze rows less its quarantined ones. Balanced also asks that no count is negative.
    """
    keyed = lambda df, n: df.select(*keys, F.lit(n).alias("n"), F.lit(1 if n > 0 else 0).alias("b"))
    # One shuffle counts both sides of a key: bronze adds one, quarantine takes one away.
    per_key = keyed(bronze, 1).unionByName(keyed(quarantine, -1)).dropna(subset=list(keys)).groupBy(*keys).agg(F.sum("n").alias("arrivals"), F.sum("b").alias("b"))
    extra = per_key.where("arrivals > 0 AND b > 0").agg(F.coalesce(F.sum(F.col("arrivals") - 1), F.lit(0)).cast("long").alias("extra"))
    for name, df in (("bronze_rows", bronze), ("silver_rows", silver), ("quarantine_rows", quarantine), ("audit_rows", audit)):
        extra = extra.crossJoin(F.broadcast(df.agg(F.count("*").alias(name))))  # one row each
    superseded = F.col("extra") - F.col("audit_rows")
    accounted = F.col("silver_rows") + F.col("quarantine_rows") + F.col("audit_rows") + superseded
    return extra.select(
        F.lit(entity).alias("entity"), "bronze_rows", "silver_rows", "quarantine_rows", "audit_rows", superseded.alias("superseded_rows"), accounted.alias("accounted_rows"),
        ((accounted == F.col("bronze_rows")) & (superseded >= 0)).alias("balanced"),
    )


CHECKS_SCHEMA = "master_run_id string, env string, check_name string, subject string, observed_value double, expected_value double, passed boolean, details string, checked_at timestamp"
DRIFT_SCHEMA = "master_run_id string, env string, column_name string, drift_status string, row_count long, detected_at timestamp"


def check_row(run_id: str, env: str, name: str, subject: str, observed, expected, passed: bool, details: Mapping, at) -> tuple:
    return (run_id, env, name, subject, None if observed is None else float(observed), None if expected is None else float(expected), bool(passed), json.dumps(details, sort_keys=True, default=str), at)


def reconciliation_check(run_id: str, env: str, row: Mapping, at) -> tuple:
    return check_row(run_id, env, "reconciliation", row["entity"], row["accounted_rows"], row["bronze_rows"], row["balanced"], dict(row), at)


def orphans_check(run_id: str, env: str, subject: str, n: int, at) -> tuple:
    return check_row(run_id, env, "orphaned_facts", subject, n, 0, n == 0, {"orphaned": n}, at)


def placeholder_check(run_id: str, env: str, subject: str, row: Mapping, at) -> tuple:
    return check_row(run_id, env, "placeholder_exposure", subject, row["placeholder_pct"], None, True, dict(row), at)


def detect_drift(observed: Iterable[str], declared: Iterable[str], ignored: Iterable[str] = ()) -> dict[str, list[str]]:
    """Columns that are NEW, MISSING or knowingly IGNORED, each sorted."""
    o, d, i = set(observed), set(declared), set(ignored)
    return {"NEW": sorted(o - d - i), "MISSING": sorted(d - o), "IGNORED": sorted(o & i)}


def declared_columns(entities: Mapping[str, Sequence[str]]) -> set[str]:
    """All columns that some entity declares."""
    return {c for columns in entities.values() for c in columns}


def source_columns(columns: Iterable[str], added: Iterable[str]) -> list[str]:
    """Columns that came with the source, without those that the ingest adds."""
    own = set(added)
    return [c for c in columns if c not in own]


def drift_summary(drift: Mapping[str, Sequence[str]]) -> str:
    """One line of text on a drift."""
    said = [f"{len(drift[s])} {s.lower()} ({', '.join(drift[s])})" for s in ("NEW", "MISSING", "IGNORED") if drift.get(s)]
    return "; ".join(said) or "no drift"


def missing_columns_message(entity: str, columns: Iterable[str], declared: Iterable[str]) -> str | None:
    """What to say if a declared column is not there; None if all are."""
    gone = sorted(set(declared) - set(columns))
    return f"{entity} lacks {', '.join(gone)}" if gone else None


def drift_rows(run_id: str, env: str, drift: Mapping[str, Sequence[str]], at, rescued: tuple[str, int] | None = None) -> list[tuple]:
    rows = [(run_id, env, c, status, None, at) for status in ("NEW", "MISSING", "IGNORED") for c in drift.get(status, ())]
    return rows + ([(run_id, env, rescued[0], "RESCUED", rescued[1], at)] if rescued else [])


def partition_skew(df: DataFrame) -> DataFrame:
    """Partitions with rows, rows, and the largest partition over the mean."""
    sizes = df.groupBy(F.spark_partition_id().alias("part")).count()
    return sizes.agg(F.count("*").alias("partitions"), F.coalesce(F.sum("count"), F.lit(0)).alias("rows"), F.coalesce(rounded(F.max("count") / F.avg("count"), 2), F.lit(0.0)).alias("skew_ratio"))


def validity_counts(df: DataFrame) -> DataFrame:
    """Valid and dirty rows in one pass."""
    return df.agg(F.count_if("is_valid").alias("valid_rows"), F.count_if(~F.col("is_valid")).alias("dirty_rows"))


def file_metrics(rows: DataFrame, seconds: float) -> DataFrame:
    """One row on the files of an ingest: files, bytes, times, largest over mean size, rows a second. rows: file_path, file_size, file_modification_time."""
    files = rows.groupBy("file_path").agg(F.max("file_size").alias("size"), F.max("file_modification_time").alias("at"), F.count("*").alias("n"))
    rate = F.lit(0.0) if not seconds else rounded(F.sum("n") / F.lit(float(seconds)), 2)
    return files.agg(
        F.count("*").alias("n_files"), F.coalesce(F.sum("size"), F.lit(0)).alias("total_bytes"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows_read"), F.min("at").alias("first_file_at"), F.max("at").alias("last_file_at"),
        rounded(F.max("size") / F.coalesce(F.nullif(F.avg("size"), F.lit(0.0)), F.lit(1.0)), 2).alias("file_skew_ratio"), rate.alias("throughput_rows_per_sec"),
    )


#: One row for each entity and run.
METRICS_SCHEMA = (
    "master_run_id string, env string, layer string, entity string, run_mode string, load_type string, run_status string, rows_read long, inserted_rows long, updated_rows long, "
    "matched_rows long, unchanged_rows long, closed_rows long, quarantined_rows long, duplicate_rows long, skew_ratio double, start_ts timestamp, end_ts timestamp, duration_secs double, throughput_rows_per_sec double, notes string"
)


def run_metrics(n_read: int, inserted: int, updated: int, seconds: float) -> dict[str, float]:
    """Derived counters of a run."""
    return {"read_rows": n_read, "inserted_rows": inserted, "updated_rows": updated, "matched_rows": updated, "unchanged_rows": max(n_read - inserted - updated, 0), "throughput_rows_per_sec": round(n_read / seconds, 2) if seconds else 0.0}


def metrics_row(run_id: str, env: str, layer: str, entity: str, mode: str, status: str, began, seconds: float, found: Mapping, notes: str | None) -> tuple:
    """A row of METRICS_SCHEMA from what a step has found."""
    n = lambda k: int(found.get(k) or 0)
    m = run_metrics(n("read"), n("inserted"), n("updated"), seconds)
    return (
        run_id, env, layer, entity, mode, found.get("load_type"), status, m["read_rows"], m["inserted_rows"], m["updated_rows"], m["matched_rows"], m["unchanged_rows"], n("closed"), n("quarantined"), n("duplicates"),
        float(found.get("skew_ratio") or 0.0), began, began + datetime.timedelta(seconds=seconds), round(seconds, 3), float(m["throughput_rows_per_sec"]), notes,
    )
