"""Slowly changing dimensions, type 2, with composite keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lakeloom.functions.hashing import row_hash


def prepare_versions(df: DataFrame, keys: Sequence[str], attributes: Sequence[str], hash_col: str, effective: str) -> DataFrame:
    """Keys, attributes, content hash and effective_from of candidate versions; a missing column is an error."""
    require_columns(df, [*keys, *attributes, effective])
    return df.select(*keys, *attributes, row_hash([*keys, *attributes]).alias(hash_col), F.col(effective).alias("effective_from"))


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def timeline(df: DataFrame, keys: Sequence[str], hash_col: str, effective: str = "effective_from") -> DataFrame:
    """Add effective_to (a microsecond before the next version) and is_current.

    Of versions of one key at one instant only that of the largest hash stays: the others would cover no time.
    """
    following = F.lead(effective).over(W.partitionBy(*keys).orderBy(effective, hash_col))
    rows = df.withColumn("_next", following).where(F.col("_next").isNull() | (F.col("_next") > F.col(effective)))
    return rows.withColumns({"effective_to": F.col("_next") - F.expr("INTERVAL 1 MICROSECOND"), "is_current": F.col("_next").isNull()}).drop("_next")


def collapse_unchanged(df: DataFrame, keys: Sequence[str], hash_col: str, effective: str = "effective_from") -> DataFrame:
    """Versions that differ from the one before them; those of one instant come in the order of their hash."""
    before = F.lag(hash_col).over(W.partitionBy(*keys).orderBy(effective, hash_col))
    return df.withColumn("_before", before).where(F.col("_before").isNull() | (F.col("_before") != F.col(hash_col))).drop("_before")


def overlaps(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions that begin before the one before them has ended, and closed ones that cover no time: keys, effective_from, effective_to and what is wrong."""
    earlier = F.lag("effective_to").over(W.partitionBy(*keys).orderBy("effective_from", F.asc_nulls_last("effective_to")))
    follows = F.lag("effective_from").over(W.partitionBy(*keys).orderBy("effective_from", F.asc_nulls_last("effective_to"))).isNotNull()
    fault = F.when(F.col("effective_to") <= F.col("effective_from"), "covers no time").when(F.col("_follows") & (F.col("_before").isNull() | (F.col("effective_from") <= F.col("_before"))), "overlaps")
    rows = dim.withColumns({"_before": earlier, "_follows": follows}).withColumn("fault", fault)
    return rows.where("fault IS NOT NULL").select(*keys, "effective_from", "effective_to", "fault")


def apply_scd2(dim: DataFrame, source: DataFrame, keys: Sequence[str], hash_col: str, action: str | None = None) -> DataFrame:
    """The dimension after new versions (one row a key): a changed current row ends a second before its successor, which becomes current.

    One shuffle of the current rows and the source; history passes through. `action` names a column that tells rows that are inserted (of new
    keys), replaced (in place of another version), closed or kept.
    """
    columns = dim.columns
    current = dim.where("is_current").select(F.struct(*columns).alias("t"))
    kinds = {f.name: f.dataType for f in dim.schema}
    fresh = source.withColumns({"effective_to": F.lit(None).cast(kinds["effective_to"]), "is_current": F.lit(True)})
    fresh = fresh.select(F.struct(*[(F.col(c) if c in fresh.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in columns]).alias("s"))
    both = current.join(fresh, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")
    same = F.col(f"t.{hash_col}").eqNullSafe(F.col(f"s.{hash_col}"))
    tag = lambda c, what: F.struct(*[c[x].alias(x) for x in columns], *([F.lit(what).alias(action)] if action else []))
    closed = F.struct(*[(F.col("s.effective_from") - F.expr("INTERVAL 1 SECOND") if c == "effective_to" else F.lit(False) if c == "is_current" else F.col(f"t.{c}")).alias(c) for c in columns])
    kept = F.col("s").isNull() | (F.col("t").isNotNull() & same)
    out = F.when(kept, F.array(tag(F.col("t"), "kept"))).when(F.col("t").isNull(), F.array(tag(F.col("s"), "inserted"))).otherwise(F.array(tag(closed, "closed"), tag(F.col("s"), "replaced")))
    past = dim.where("NOT is_current")
    return (past.withColumn(action, F.lit("kept")) if action else past).unionByName(both.select(F.inline(out)))


def soft_delete(dim: DataFrame, present: DataFrame, keys: Sequence[str], at) -> DataFrame:
    """End the current rows whose key is no longer present; `at` is the end's timestamp or column."""
    marked = dim.join(present.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct().withColumn("_present", F.lit(True)), [F.col(k) == F.col(f"_{k}") for k in keys], "left")
    gone = F.col("is_current") & F.col("_present").isNull()
    return marked.withColumns({"effective_to": F.when(gone, F.lit(at)).otherwise(F.col("effective_to")), "is_current": F.col("is_current") & ~gone}).select(dim.columns)
