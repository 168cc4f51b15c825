"""Deterministic deduplication: the most complete row wins, then the latest, then the larger content hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lakeloom.functions.hashing import content_hash


def classify_duplicates(df: DataFrame, keys: Sequence[str], order_col: str, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Add row_num, 1 for the winner of each key."""
    order = [F.desc_nulls_last(order_col), F.desc("_tie")]
    if "repaired_columns" in df.columns:
        order.insert(0, F.size(F.filter("repaired_columns", lambda x: x.isNotNull())).asc())
    rest = tiebreak or [c for c in df.columns if c not in ("error_columns", "repaired_columns")]
    return df.withColumn("_tie", content_hash(rest)).withColumn("row_num", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).drop("_tie")


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(winners, losers) of classified rows; losers carry record_type 'duplicate'."""
    return rows.where("row_num = 1").drop("row_num"), rows.where("row_num > 1").drop("row_num").withColumn("record_type", F.lit("duplicate"))


def deduplicate(df: DataFrame, keys: Sequence[str], order_col: str, tiebreak: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(winners, losers); losers carry record_type 'duplicate'."""
    return split(classify_duplicates(df, keys, order_col, tiebreak))
