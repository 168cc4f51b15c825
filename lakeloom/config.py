"""Entities from configuration: JSON, or YAML where a parser is installed."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from lakeloom.operators.rules import EntityRules


@dataclass(frozen=True)
class DimensionSpec:
    name: str
    keys: tuple[str, ...]
    attributes: tuple[str, ...]
    cluster_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class FactSpec:
    name: str
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    cluster_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class Config:
    """What a layered pipeline runs: source column names, ignored columns, entities, dimensions and facts."""

    names: Mapping[str, str] = field(default_factory=dict)
    ignored: tuple[str, ...] = ()
    entities: Mapping[str, EntityRules] = field(default_factory=dict)
    dimensions: Mapping[str, DimensionSpec] = field(default_factory=dict)
    facts: Mapping[str, FactSpec] = field(default_factory=dict)

    @classmethod
    def of(cls, spec: Mapping) -> Config:
        tuples = lambda x: {k: tuple(v) if isinstance(v, list) else v for k, v in x.items()}
        return cls(
            names=spec.get("names", {}),
            ignored=tuple(spec.get("ignored", ())),
            entities={x["name"]: EntityRules.from_dict(x) for x in spec.get("entities", ())},
            dimensions={x["name"]: DimensionSpec(**tuples(x)) for x in spec.get("dimensions", ())},
            facts={x["name"]: FactSpec(**tuples(x)) for x in spec.get("facts", ())},
        )

    def declared(self) -> list[str]:
        """All columns that some entity declares."""
        return sorted({c for e in self.entities.values() for c in e.columns})


def load(path: str) -> Config:
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yml", ".yaml")):
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("reading YAML needs a YAML parser; JSON needs none") from e
        return Config.of(yaml.safe_load(text))
    return Config.of(json.loads(text))
