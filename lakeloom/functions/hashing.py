"""Row hashes over text forms, so that types and nulls never break them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Divides fields, so that ("a", "bc") and ("ab", "c") differ.
SEPARATOR = "||"


def row_hash(columns: Sequence[str], separator: str = SEPARATOR) -> Column:
    """SHA-256 of the columns in the given order; null counts as the empty string."""
    return F.sha2(F.concat_ws(separator, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)


def content_hash(columns: Sequence[str], separator: str = SEPARATOR) -> Column:
    """The row hash over the columns by name, whatever order they are given in."""
    return row_hash(sorted(columns), separator)
