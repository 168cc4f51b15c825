"""What a run reads: high-water marks, date windows and run modes."""

from __future__ import annotations

import datetime
import os
import shutil
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODES = ("incremental", "backfill", "replay", "full_refresh")


@dataclass(frozen=True)
class RunConfig:
    """A validated run: `RunConfig.of` is the one way in."""

    mode: str = "incremental"
    start: datetime.date | None = None
    end: datetime.date | None = None
    dry_run: bool = False

    @classmethod
    def of(cls, spec: Mapping, *, today: datetime.date | None = None, allow_full_refresh: bool = False, max_days: int = 365) -> RunConfig:
        mode = str(spec.get("run_mode") or "incremental").strip().lower()
        if mode not in MODES:
            raise ValueError(f"unknown run mode: {mode}")
        if mode == "full_refresh" and not allow_full_refresh:
            raise ValueError("this environment does not permit rebuilding everything")
        day = lambda x: x if isinstance(x, datetime.date) else datetime.date.fromisoformat(x) if x else None
        start, end = day(spec.get("start_date")), day(spec.get("end_date"))
        if mode in ("backfill", "replay"):
            if start is None:
                raise ValueError(f"{mode} needs a start date")
            end = end or today or datetime.date.today()
            if start > end:
                raise ValueError("the start is after the end")
            if (end - start).days > max_days:
                raise ValueError(f"the window is longer than {max_days} days")
        else:
            start = end = None
        return cls(mode, start, end, str(spec.get("dry_run", "")).lower() in ("true", "1", "yes"))

    @property
    def is_windowed(self) -> bool:
        return self.mode in ("backfill", "replay")

    @property
    def reads_source(self) -> bool:
        return self.mode in ("incremental", "backfill")

    def scope(self, ingestion_col: str) -> Column | None:
        """Rows that this run derives again: none, a window, or all."""
        if self.is_windowed:
            return F.to_date(ingestion_col).between(F.lit(self.start), F.lit(self.end))
        return F.lit(True) if self.mode == "full_refresh" else None

    def bounds(self, mark: datetime.datetime | None = None) -> tuple[datetime.datetime | None, datetime.datetime | None]:
        """[low, high) of the ingestion times that this run reads, None for no bound: what it derives, it replaces there, so it can be run again."""
        if self.is_windowed:
            midnight = datetime.time()
            return datetime.datetime.combine(self.start, midnight), datetime.datetime.combine(self.end + datetime.timedelta(days=1), midnight)
        return (None if self.mode == "full_refresh" or mark is None else mark + datetime.timedelta(microseconds=1)), None

    def load_type(self, target_was_empty: bool, n_read: int) -> str:
        if not n_read:
            return "NO_DATA"
        return "INITIAL_LOAD" if target_was_empty else self.mode.upper()


def high_water_mark(df: DataFrame, column: str):
    """The largest value, or None."""
    return df.agg(F.max(column)).first()[0]


def since(df: DataFrame, column: str, mark) -> DataFrame:
    """Rows after the mark; all if there is none. The literal reaches the scan."""
    return df if mark is None else df.where(F.col(column) > F.lit(mark))


def in_window(df: DataFrame, column: str, start: datetime.date, end: datetime.date) -> DataFrame:
    """Rows of the days from start to end: bounds on the column itself, so that the scan can skip."""
    after = end + datetime.timedelta(days=1)
    return df.where((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(after)))


def read_for_run(df: DataFrame, run: RunConfig, column: str, mark=None) -> DataFrame:
    """The rows that a run of this mode reads."""
    if run.is_windowed:
        return in_window(df, column, run.start, run.end)
    return df if run.mode == "full_refresh" else since(df, column, mark)


def file_identity(name: str, modified: str) -> str:
    return f"{name}|{modified}"


def without_ingested(files: DataFrame, ingested: DataFrame) -> DataFrame:
    """Files (file_name, modified) not yet ingested, by anti join: no literal list, however many there are."""
    return files.join(ingested.select("file_name", "modified").distinct(), ["file_name", "modified"], "left_anti")


def backfill_scope(n_in_window: int, n_known: int) -> str:
    """HAS_WORK, NOTHING_MISSING or WINDOW_MATCHED_NOTHING."""
    if min(n_in_window, n_known) < 0:
        raise ValueError(f"a number of files below zero: {n_in_window}, {n_known}")
    return "WINDOW_MATCHED_NOTHING" if not n_in_window else "NOTHING_MISSING" if n_known >= n_in_window else "HAS_WORK"


def source_state(n_source: int, n_landed: int) -> str:
    """SOURCE_POPULATED, SOURCE_DRAINED or NO_DATA_ANYWHERE."""
    if min(n_source, n_landed) < 0:
        raise ValueError(f"a number of files below zero: {n_source}, {n_landed}")
    return "SOURCE_POPULATED" if n_source else "SOURCE_DRAINED" if n_landed else "NO_DATA_ANYWHERE"


class LocalSource:
    """A source of files in a folder of this machine; another source has the same two methods."""

    def __init__(self, folder: str):
        self.folder = folder

    def names(self) -> list[str]:
        return sorted(os.listdir(self.folder)) if os.path.isdir(self.folder) else []

    def fetch(self, name: str, to: str) -> None:
        shutil.copyfile(f"{self.folder}/{name}", to)


def acquire(source, landing: str) -> list[str]:
    """Fetch what the source has and the landing folder (of this machine) has not, by name; the names. A file appears there whole or not at all."""
    os.makedirs(landing, exist_ok=True)
    wanted = plan_acquisition(source.names(), os.listdir(landing))
    for name in wanted:
        source.fetch(name, f"{landing}/.{name}.part")
        os.replace(f"{landing}/.{name}.part", f"{landing}/{name}")
    return wanted


def plan_acquisition(listed: Iterable[str], landed: Iterable[str]) -> list[str]:
    """CSV files of the source that have not landed, by name."""
    return sorted({x for x in listed if x.endswith((".csv", ".csv.gz"))} - set(landed))


def impact(df: DataFrame, run: RunConfig, column: str) -> DataFrame:
    """What a dry run reports: rows and days that it would read."""
    return read_for_run(df, run, column).agg(F.count("*").alias("rows"), F.count_distinct(F.to_date(column)).alias("days"), F.min(F.to_date(column)).alias("first_day"), F.max(F.to_date(column)).alias("last_day"))
