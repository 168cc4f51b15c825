"""Data-quality rules: every violation is named, fatal ones send a row to quarantine, repairable ones are noted on it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.dates import parse_date
from lakeloom.functions.text import clean_strings, conform_values

FATAL, REPAIRABLE = "fatal", "repairable"


@dataclass(frozen=True)
class EntityRules:
    """What one entity's rows must satisfy. A column without a severity is fatal."""

    name: str
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    patterns: Mapping[str, str] = field(default_factory=dict)
    allowed: Mapping[str, Sequence[str]] = field(default_factory=dict)
    severity: Mapping[str, str] = field(default_factory=dict)
    conform: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    dates: tuple[str, ...] = ()
    casts: Mapping[str, str] = field(default_factory=dict)
    #: (later, earlier) pairs of date columns.
    not_before: tuple[tuple[str, str], ...] = ()
    order_by: str = "bronze_ingestion_ts"

    @classmethod
    def from_dict(cls, spec: Mapping) -> EntityRules:
        """From a parsed configuration; unknown keys are an error."""
        known = {k: tuple(v) if k in ("keys", "columns", "dates") else tuple(map(tuple, v)) if k == "not_before" else v for k, v in spec.items()}
        return cls(**known)


#: A column of the typed values, made once and dropped by `typed` and `untyped`.
TYPED = "_typed"


def _names(flags: Sequence[tuple[Column, str]]) -> Column:
    """Array of the names whose condition holds, without repeats."""
    if not flags:
        return F.array().cast("array<string>")
    return F.array_distinct(F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in flags])))


def record_violations(df: DataFrame, rules: EntityRules) -> DataFrame:
    """Add error_columns (fatal) and repaired_columns (repairable): nulls first, then patterns, then allowed values; and the typed values."""
    if rules.dates or rules.casts:
        values = {c: parse_date(F.col(c).cast("string")) for c in rules.dates} | {c: F.col(c).try_cast(k) for c, k in rules.casts.items()}
        df = df.withColumn(TYPED, F.struct(*[v.alias(c) for c, v in values.items()]))
    date = lambda c: F.col(f"{TYPED}.{c}") if c in rules.dates else parse_date(F.col(c).cast("string"))
    checks = [(F.col(c).isNull(), c) for c in rules.columns]
    checks += [(~F.col(c).cast("string").rlike(p), c) for c, p in rules.patterns.items()]
    checks += [(F.col(c).isNotNull() & ~F.col(c).isin(*v), c) for c, v in rules.allowed.items()]
    tier = lambda c: rules.severity.get(c, FATAL)
    fatal = [x for x in checks if tier(x[1]) == FATAL]
    for c in rules.dates:  # a text that passes its pattern but is no date
        fatal.append((F.col(c).isNotNull() & date(c).isNull(), f"unparseable_{c}"))
    for c in rules.casts:
        fatal.append((F.col(c).isNotNull() & F.col(f"{TYPED}.{c}").isNull(), f"cast_{c}"))
    for later, earlier in rules.not_before:
        if later in rules.columns and earlier in rules.columns:
            fatal.append((date(later) < date(earlier), f"{later}_before_{earlier}"))
    return df.withColumns({"error_columns": _names(fatal), "repaired_columns": _names([x for x in checks if tier(x[1]) == REPAIRABLE])})


def add_is_valid(df: DataFrame, errors: str = "error_columns") -> DataFrame:
    """is_valid: no name in the array; never null."""
    return df.withColumn("is_valid", F.coalesce(F.size(F.filter(errors, lambda x: x.isNotNull())) == 0, F.lit(True)))


def assess(df: DataFrame, rules: EntityRules) -> DataFrame:
    """Clean, conform, and record violations."""
    return add_is_valid(record_violations(conform_values(clean_strings(df, rules.columns), rules.conform), rules))


def typed(df: DataFrame, rules: EntityRules) -> DataFrame:
    """Assessed rows with dates and numbers in their types."""
    changed = {c: F.col(f"{TYPED}.{c}") for c in [*rules.dates, *rules.casts]}
    return df.withColumns(changed).drop(TYPED) if changed else df


def untyped(df: DataFrame) -> DataFrame:
    """Assessed rows as they came."""
    return df.drop(TYPED)


def route(df: DataFrame, rules: EntityRules) -> tuple[DataFrame, DataFrame]:
    """(valid rows, typed; quarantined rows as they came)."""
    rows = assess(df, rules)
    return typed(rows.where("is_valid"), rules), untyped(rows.where("NOT is_valid"))
