"""Column names and string columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sanitize_column(name: str) -> str:
    """Lower-case snake name of letters, digits and underscores that starts with a letter."""
    clean = re.sub(r"[^a-z0-9_]", "", name.lower().replace(" ", "_"))
    return clean if re.match(r"[a-z]", clean) else f"col_{clean}"


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by the map where it has the column; sanitise the others."""
    return df.toDF(*[names.get(c, sanitize_column(c)) for c in df.columns])


def clean_string(c: Column) -> Column:
    """Trim, then drop double quotes (blanks inside quotes stay)."""
    return F.regexp_replace(F.trim(c), '"', "")


def clean_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Clean the string columns; dates and timestamps go through text and back; other types stay."""
    changed = {}
    for c in columns:
        kind = df.schema[c].dataType
        if isinstance(kind, T.StringType):
            changed[c] = clean_string(F.col(c))
        elif isinstance(kind, (T.DateType, T.TimestampType)):
            changed[c] = clean_string(F.col(c).cast("string")).cast(kind)
    return df.withColumns(changed) if changed else df


def conform_values(df: DataFrame, mappings: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Replace exact values by their canonical form; absent columns and unmapped values stay."""
    changed = {}
    for c, values in mappings.items():
        if c in df.columns and values:
            table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
            changed[c] = F.coalesce(F.element_at(table, F.col(c)), F.col(c))
    return df.withColumns(changed) if changed else df
