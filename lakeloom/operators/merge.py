"""Keyed writes as plans: one full outer join decides for every row what happens to it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTION = "_action"


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], update_when: Callable[[Callable, Callable], Column] | None = None) -> DataFrame:
    """Target after the merge, with _action: kept, updated or inserted.

    `update_when(t, s)` gets functions from a column name to the target's and the source's column; without it every match is
    updated. Columns that one side lacks are null there. Null keys match nothing. Source keys must be unique.
    """
    columns = list(dict.fromkeys([*target.columns, *source.columns]))
    t, s = target.select(F.struct(*target.columns).alias("t")), source.select(F.struct(*source.columns).alias("s"))
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    both = t.join(s, on, "full_outer")
    told = F.col("t").isNotNull() & F.col("s").isNotNull()
    change = told & (F.coalesce(update_when(lambda c: F.col(f"t.{c}"), lambda c: F.col(f"s.{c}")), F.lit(False)) if update_when else F.lit(True))
    action = F.when(F.col("t").isNull(), "inserted").when(change, "updated").otherwise("kept")
    both = both.withColumn(ACTION, action)

    def value(c: str) -> Column:
        if c not in source.columns:
            return F.col(f"t.{c}")
        if c not in target.columns:
            return F.when(F.col(ACTION) != "kept", F.col(f"s.{c}"))
        return F.when(F.col(ACTION) == "kept", F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))

    return both.select(*[value(c).alias(c) for c in columns], ACTION)


def upsert_changed(target: DataFrame, source: DataFrame, keys: Sequence[str], hash_col: str) -> DataFrame:
    """Merge that updates only rows whose hash differs."""
    return merge(target, source, keys, lambda t, s: t(hash_col) != s(hash_col))


def action_counts(merged: DataFrame) -> dict[str, int]:
    """Rows inserted, updated and kept: the three are disjoint."""
    found = {r[ACTION]: r["count"] for r in merged.groupBy(ACTION).count().collect()}
    return {a: found.get(a, 0) for a in ("inserted", "updated", "kept")}


def scoped_replace(target: DataFrame, rows: DataFrame, scope: Column | None) -> DataFrame:
    """Target without the rows in scope (None: nothing leaves), then the new rows."""
    left = target if scope is None else target.where(~F.coalesce(scope, F.lit(False)))
    return left.unionByName(rows, allowMissingColumns=True)
