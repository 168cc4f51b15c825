"""A session on this machine, for tests and the bench; a cluster brings its own."""

from __future__ import annotations

import os
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import SparkSession

#: What results depend on, and what keeps a run on one machine quiet.
SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
ROOT = str(Path(__file__).resolve().parents[1])


def on_path() -> None:
    """Let Python workers find this package."""
    known = os.environ.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, known) if x)


def local_session(cores: int | str, memory: str, more: Mapping[str, str] | None = None) -> SparkSession:
    on_path()
    settings = SETTINGS | {"spark.driver.memory": memory, "spark.sql.shuffle.partitions": str(cores)} | dict(more or {})
    session = SparkSession.builder.master(f"local[{cores}]").config(map=settings).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
