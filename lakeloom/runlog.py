"""Run identifiers and structured log lines (one JSON object each)."""

from __future__ import annotations

import datetime
import json
import logging
import uuid
from dataclasses import dataclass, field


@dataclass(frozen=True)
class RunContext:
    """Identifies a run of all layers and one layer's part of it."""

    env: str = "dev"
    master_run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    layer: str = ""
    layer_run_id: str = field(default_factory=lambda: str(uuid.uuid4()))

    def for_layer(self, layer: str) -> RunContext:
        return RunContext(self.env, self.master_run_id, layer)


class JsonFormatter(logging.Formatter):
    """Time, level, message and the record's `event` fields as sorted JSON."""

    def __init__(self, zone: datetime.tzinfo = datetime.UTC):
        super().__init__()
        self.zone = zone

    def format(self, record: logging.LogRecord) -> str:
        at = datetime.datetime.fromtimestamp(record.created, self.zone).isoformat(timespec="milliseconds")
        line = {"at": at, "level": record.levelname, "logger": record.name, "message": record.getMessage(), **getattr(record, "event", {})}
        if record.exc_info:
            line["error"] = self.formatException(record.exc_info)
        return json.dumps(line, sort_keys=True, default=str)


def log_event(logger: logging.Logger, level: int, message: str, run: RunContext | None = None, **fields) -> None:
    known = {"env": run.env, "master_run_id": run.master_run_id, "layer": run.layer, "layer_run_id": run.layer_run_id} if run else {}
    logger.log(level, message, extra={"event": known | fields})
