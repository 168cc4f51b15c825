"""Mixing sources to target weights by entropy balancing.

Each source has a target number of words. Among all document rates that meet a source's target, with none above `most`
copies, the one nearest to "every document once" in relative entropy is exponentially tilted: rate = min(most, exp(l * x)),
where x is the document's size over its source's mean size and l is the source's dual variable. Newton iterations solve the
convex dual: each is one aggregation over the table of (source, size, number of documents), which holds every document
and has no more rows a source than there are distinct sizes; the driver holds one number a source.

Rates become whole copies by systematic rounding down the sizes of a source, which misses a target by half its largest document at
most; then copies of one size at a time are moved where they bring the source nearest to its target, as long as any do. Within a size the
documents that get the larger number of copies are chosen by hash; a size of very many documents is dealt out in parts.

The mix is a specification by source: its sources (not documents; at most `MOST_SOURCES`) come to the driver, some numbers each, and a source's distinct sizes
(at most the square root of twice its words) meet in one task.

Defined results: null or wordless texts have size 0, count for no target and are taken once; a null source is a source of
its own, last; repeated documents share alike; a source without words has target 0; an empty table gives an empty result.
Extra columns are not read by `mix_counts`; `mix` returns the input's columns. Texts are counted whole; a very long one is one row like
any other. Newton steps that do not meet the targets are an error, not a result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from lakeloom.llm.common import cut, meet, numbered, own_columns, shared_dir, unused

#: Documents of one size that are ranked in one task (or a thousandth of all), relative error of the dual, sources of a mix at most.
PART, CLOSE, MOST_SOURCES = 1000, 1e-7, 100_000
WORD = r"[^\x20\x09-\x0D]+"


def cyclic(sources: Sequence[str | None], weights: Sequence[float] = (3, 1, 2)) -> dict[str | None, float]:
    """Weights in turn for the sources by code point, null last."""
    return {s: float(weights[i % len(weights)]) for i, s in enumerate(sorted(sources, key=lambda s: (s is None, s or "")))}


def targets(sizes: dict[str | None, int], weights: dict[str | None, float], share: float, most: float) -> dict[str | None, float]:
    """Shares of `share` times all words by weight; a target stops at `most` times its source's size, and the rest is shared again."""
    left, open_, out = share * sum(sizes.values()), set(sizes), {}
    while open_:
        unit = left / (sum(weights[s] for s in open_) or 1)
        full = {s for s in open_ if weights[s] * unit > most * sizes[s]}
        if not full:
            return out | {s: weights[s] * unit for s in open_}
        out |= {s: most * sizes[s] for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return out


def _by_source(spark, names: list, columns: dict[str, tuple[T.DataType, Sequence]], key: str, kind: T.DataType) -> DataFrame:
    schema = T.StructType([T.StructField(key, kind), *[T.StructField(c, t) for c, (t, _) in columns.items()]])
    rows = list(zip(names, *(v for _, v in columns.values()), strict=True))
    return F.broadcast(spark.createDataFrame(rows, schema))  # one row for each source of the specification


def tilt(cells: DataFrame, goal: np.ndarray, size: np.ndarray, most: float) -> np.ndarray:
    """Dual variable of each source: sum of n * size * min(most, exp(l * x)) is its goal. cells: _source, _x, _size, _n."""
    n = len(goal)
    value = np.zeros(n)
    value[goal >= most * size] = np.inf
    value[(goal <= 0) & (size > 0)] = -np.inf
    active = (size > 0) & np.isfinite(value)
    value[active] = np.log(goal[active] / size[active])
    low, high = np.full(n, -np.inf), np.full(n, np.inf)
    while active.any():
        now = _by_source(cells.sparkSession, np.flatnonzero(active).tolist(), {"_l": (T.DoubleType(), value[active].tolist())}, "_source", T.IntegerType())
        rate = F.exp(F.col("_l") * F.col("_x"))
        words = F.col("_n") * F.col("_size")
        sums = cells.join(now, "_source").groupBy("_source").agg(F.sum(words * F.least(rate, F.lit(most))).alias("f"), F.sum(F.when(rate < most, words * F.col("_x") * rate).otherwise(0.0)).alias("g")).collect()
        for r in sums:  # one row a source
            s, f, g = r["_source"], r["f"] - goal[r["_source"]], r["g"]
            if abs(f) <= CLOSE * goal[s]:
                active[s] = False
                continue
            low[s], high[s] = (value[s], high[s]) if f < 0 else (low[s], value[s])
            step = value[s] - f / g if g > 0 else np.nan
            if not low[s] < step < high[s]:  # Newton left the bracket: halve it, or widen it while it is open
                step = (low[s] + high[s]) / 2 if np.isfinite(low[s] + high[s]) else 2 * value[s] + (1 if f < 0 else -1)
            if step in (low[s], high[s]) or abs(step) > 1e15:  # no number is left between the bounds, so the target is out of reach
                raise ArithmeticError(f"source {s} misses its target of {goal[s]} words by {f}")
            value[s] = step
    return value


def plan(docs: DataFrame, weigh: Callable[[Sequence[str | None]], dict[str | None, float]], share: float, most: int, id_col: str, source_col: str, text_col: str, row_col: str | None = None) -> DataFrame:
    """_id, _row, _size, _name (source), _total (its words), _target and _copies of each document."""
    spark = docs.sparkSession
    top = shared_dir(spark)
    sized = docs.select(F.col(id_col).alias("_id"), (docs[row_col] if row_col else F.lit(0).cast("long")).alias("_row"), F.col(source_col).alias("_name"), F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("_size"))
    sized = cut(sized, top, "sized")
    kind = sized.schema["_name"].dataType
    cells = cut(sized.groupBy("_name", "_size").agg(F.count("*").alias("_n")), top, "cells")
    held = cells.groupBy("_name").agg(F.sum(F.col("_n") * F.col("_size")).alias("words"), F.sum("_n").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(held) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: a mix is specified by source")
    total, docs_of = {r["_name"]: r["words"] for r in held}, {r["_name"]: r["n"] for r in held}
    names = sorted(total, key=lambda s: (s is None, s if s is not None else ""))
    target = targets(total, weigh(names), share, most)
    size, goal = np.array([total[s] for s in names], float), np.array([target[s] for s in names], float)
    mean = np.array([max(total[s], 1) / docs_of[s] for s in names])
    number = _by_source(spark, names, {"_source": (T.IntegerType(), range(len(names))), "_mean": (T.DoubleType(), mean.tolist()), "_total": (T.LongType(), [int(x) for x in size]), "_target": (T.DoubleType(), goal.tolist())}, "_of", kind)
    cells = cells.join(number, F.col("_name").eqNullSafe(F.col("_of"))).select("_source", "_size", "_n", (F.col("_size") / F.col("_mean")).alias("_x"))
    cells = cut(cells, top, "numbered")
    dual = tilt(cells, goal, size, float(most))
    finite = [float(np.clip(v, -700, 1e18)) for v in dual]
    rates = cells.join(_by_source(spark, list(range(len(names))), {"_l": (T.DoubleType(), finite)}, "_source", T.IntegerType()), "_source")
    rate = F.when(F.col("_size") == 0, 1.0).otherwise(F.least(F.lit(float(most)), F.exp(F.least(F.lit(50.0), F.col("_l") * F.col("_x")))))
    # Systematic rounding from the largest size down: errors of neighbours cancel. The window holds a source's distinct sizes.
    down = W.partitionBy("_source").orderBy(F.desc("_size")).rowsBetween(W.unboundedPreceding, 0)
    rates = rates.withColumn("_want", F.col("_n") * rate).withColumn("_upto", F.sum("_want").over(down))
    k = F.floor(F.col("_upto") + 0.5 + 1e-9) - F.floor(F.col("_upto") - F.col("_want") + 0.5 + 1e-9)
    rounded = cut(rates.select("_source", "_size", "_n", F.least(k, most * F.col("_n")).cast("long").alias("_k")), top, "rounded")
    reached = {r["_source"]: r["t"] for r in rounded.groupBy("_source").agg(F.sum(F.col("_k") * F.col("_size")).alias("t")).collect()}
    miss = np.array([goal[i] - reached.get(i, 0) for i in range(len(names))])
    moves: dict[tuple[int, int], int] = {}
    step_kind = "_source int, _size long, _move long"
    while True:
        now = rounded.join(_by_source(spark, list(range(len(names))), {"_miss": (T.DoubleType(), miss.tolist())}, "_source", T.IntegerType()), "_source")
        if moves:  # at most a row a source for each turn
            now = now.join(F.broadcast(spark.createDataFrame([(*at, n) for at, n in moves.items()], step_kind)), ["_source", "_size"], "left")
        else:
            now = now.withColumn("_move", F.lit(0).cast("long"))
        held = F.col("_k") + F.coalesce("_move", F.lit(0))
        free = F.when(F.col("_miss") > 0, most * F.col("_n") - held).otherwise(held)
        now = now.where(F.col("_size") > 0).withColumn("_count", F.least(free, F.greatest(F.lit(1), F.round(F.abs("_miss") / F.col("_size")).cast("long")))).where("_count > 0")
        after = F.abs(F.abs("_miss") - F.col("_count") * F.col("_size"))
        # Only a move that brings the source nearer by more than rounding of its numbers, so the turns come to an end.
        best = now.where(after < F.abs("_miss") - 1e-6).groupBy("_source").agg(F.min(F.struct(after.alias("d"), F.col("_count"), F.col("_size"))).alias("b")).collect()
        if not best:
            break
        for r in best:
            sign = 1 if miss[r["_source"]] > 0 else -1
            at = (r["_source"], r["b"]["_size"])
            moves[at] = moves.get(at, 0) + sign * r["b"]["_count"]
            miss[at[0]] -= sign * at[1] * r["b"]["_count"]
    if moves:
        rounded = rounded.join(F.broadcast(spark.createDataFrame([(*at, n) for at, n in moves.items()], step_kind)), ["_source", "_size"], "left").withColumn("_k", F.col("_k") + F.coalesce("_move", F.lit(0))).drop("_move")
    # The copies of a size go to its documents in the order of their hash. A size of more documents than PART and than a thousandth
    # of all is dealt out in parts; there are at most a thousand such sizes.
    most_rows = max(PART, sum(docs_of.values()) // 1000)
    parts = F.ceil(F.col("_n") / most_rows).cast("int")
    large = F.broadcast(rounded.where(F.col("_n") > most_rows).select(F.col("_source"), F.col("_size"), parts.alias("_dealt")))
    cell = rounded.select("_source", "_size", F.floor(F.col("_k") / F.col("_n")).alias("_base"), ((F.col("_k") % F.col("_n")) / F.col("_n")).alias("_more"), F.greatest(F.lit(1), parts).alias("_parts"))
    cell = cell.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    rows = sized.join(number, F.col("_name").eqNullSafe(F.col("_of"))).drop("_of", "_mean").withColumn("_h", F.xxhash64("_id", "_size"))
    rows = rows.join(large, ["_source", "_size"], "left").withColumn("_part", F.pmod(F.shiftrightunsigned("_h", 20), F.coalesce("_dealt", F.lit(1))).cast("int"))
    rows = rows.join(cell, ["_source", "_size", "_part"])
    rank = F.row_number().over(W.partitionBy("_source", "_size", "_part").orderBy("_h", "_id", "_row"))
    lead = F.when(F.col("_parts") == 1, 0.0).otherwise(F.pmod(F.col("_part") * 0.6180339887498949, F.lit(1.0))) + 1e-9
    rows = rows.withColumn("_rank", rank)
    extra = F.floor(F.col("_rank") * F.col("_more") + lead) - F.floor((F.col("_rank") - 1) * F.col("_more") + lead)
    return rows.select("_id", "_row", "_size", "_name", "_total", "_target", (F.col("_base") + extra).cast("int").alias("_copies"))


def mix_counts(docs: DataFrame, weigh: Callable[[Sequence[str | None]], dict[str | None, float]] = cyclic, share: float = 1.5, most: int = 2, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, source_size, target, copies and taken (words that the mix takes from it)."""
    p = plan(docs, weigh, share, most, id_col, source_col, text_col)
    return p.select(F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_total").alias("source_size"), F.col("_target").alias("target"), F.col("_copies").alias("copies"), (F.col("_copies") * F.col("_size")).cast("long").alias("taken"))


def mix(docs: DataFrame, weigh: Callable[[Sequence[str | None]], dict[str | None, float]] = cyclic, share: float = 1.5, most: int = 2, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it. Rows that share an id, or have none, are documents of their own."""
    spark = docs.sparkSession
    top, row, key, number = shared_dir(spark), unused("_row", docs), unused("_taken", docs), unused("_copies", docs)
    rows = numbered(docs, row, top)
    p = plan(rows, weigh, share, most, id_col, source_col, text_col, row)
    copies = cut(p.where("_copies > 0").select(F.col("_row").alias(key), F.col("_copies").alias(number)), top, "copies")
    rows = meet(rows, rows[row] == F.col(key), copies, "inner")
    return rows.select(*own_columns(docs), F.explode(F.sequence(F.lit(1), F.col(number))).alias(unused("_copy", docs))).select(own_columns(docs))
