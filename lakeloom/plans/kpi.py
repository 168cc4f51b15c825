"""KPI views, the run snapshot, alert queries and dashboard panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lakeloom.functions.numbers import ratio, rounded

UNKNOWN = "Unknown"


def _cents(c: str):
    """Exact sum of a money column held as double."""
    return F.sum(F.col(c).cast("decimal(22,2)"))


def places(df: DataFrame, column: str, by: Sequence[str] = (), descending: bool = True) -> DataFrame:
    """Each distinct value of a number column (within `by`) with its rank over all rows: `place`. Nulls come last, or first if ascending.

    Values fall into buckets by their logarithm (a monotone function with at most some 80,000 values, whatever the input); only the
    buckets' counts of one group meet in one task, and ranks within a bucket are taken by bucket.
    """
    x = F.col(column).cast("double")
    bucket = F.coalesce(F.floor(F.signum(x) * F.log1p(F.abs(x)) * 512).cast("int"), F.lit(-(10**9)))
    amounts = df.groupBy(*by, column).agg(F.count("*").alias("_n")).withColumn("_bucket", bucket)
    down = F.desc if descending else F.asc
    before = W.partitionBy(*by).orderBy(down("_bucket")).rowsBetween(W.unboundedPreceding, -1)
    above = amounts.groupBy(*by, "_bucket").agg(F.sum("_n").alias("_n")).select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_bucket").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_above"))
    inside = W.partitionBy(*by, "_bucket").orderBy(F.desc_nulls_last(column) if descending else F.asc_nulls_first(column)).rowsBetween(W.unboundedPreceding, -1)
    placed = amounts.withColumn("_within", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    on = [F.col("_bucket") == F.col("_of"), *[F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]]
    return placed.join(above, on).select(*by, column, (F.col("_above") + F.col("_within") + 1).cast("int").alias("place"))


def with_place(df: DataFrame, name: str, column: str, by: Sequence[str] = (), descending: bool = True) -> DataFrame:
    """Add a rank over the rows of `by`. Rows meet their value's rank in a join, whose skew (a value of very many rows) AQE splits."""
    found = places(df, column, by, descending).select(*[F.col(c).alias(f"_{c}") for c in [*by, column]], F.col("place").alias(name))
    return df.join(found, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*by, column]]).select(*df.columns, name)


def customer_kpi(mart: DataFrame) -> DataFrame:
    """Ranks within region, segment and all customers, with the summaries of region and segment."""
    region = mart.groupBy(F.col("region").alias("_r")).agg(_cents("total_sales").cast("double").alias("region_sales"), _cents("total_profit").cast("double").alias("region_profit"), F.count_distinct("customer_id").alias("region_total_customers"))
    segment = mart.groupBy(F.col("segment").alias("_s")).agg(
        _cents("total_sales").cast("double").alias("segment_sales"), _cents("total_profit").cast("double").alias("segment_profit"), F.count("customer_id").alias("segment_total_customers"),
        F.avg("recency_days").alias("avg_recency"), F.avg("customer_lifetime_days").alias("avg_lifetime"),
    )
    rows = with_place(mart, "overall_sales_rank", "total_sales")
    rows = with_place(rows, "region_sales_rank", "total_sales", ["region"])
    rows = with_place(rows, "segment_sales_rank", "total_sales", ["segment"])
    rows = rows.join(region, F.col("region") == F.col("_r"), "left").join(segment, F.col("segment") == F.col("_s"), "left")
    own = ["customer_id", "customer_name", "segment", "region", "total_sales", "total_profit", "total_orders", "avg_order_value", "recency_days", "customer_lifetime_days", "discount_sensitivity", "profitability_flag"]
    return rows.select(*own, "overall_sales_rank", "region_sales_rank", "segment_sales_rank", *region.columns[1:], *segment.columns[1:])


def product_insights(mart: DataFrame) -> DataFrame:
    """Best and worst ranks within the category (no sales: worst first) and shares of the category."""
    totals = mart.groupBy(F.col("category").alias("_c")).agg(_cents("total_sales").cast("double").alias("_sales"), F.sum("total_quantity").cast("double").alias("_quantity"), F.sum(F.col("profit_margin").cast("decimal(22,4)")).cast("double").alias("_m"), F.count("profit_margin").alias("_n"))
    rows = with_place(mart, "top_in_category_rank", "total_sales", ["category"])
    rows = with_place(rows, "bottom_in_category_rank", "total_sales", ["category"], descending=False)
    rows = rows.join(totals, F.col("category") == F.col("_c"), "left")
    own = ["product_id", "product_name", "category", "sub_category", "total_sales", "total_profit", "profit_margin", "sales_velocity", "total_quantity", "loss_making_flag", "top_in_category_rank", "bottom_in_category_rank"]
    return rows.select(
        *own, rounded(F.col("total_sales") / F.nullif("_sales", F.lit(0.0)) * 100, 2).alias("sales_contribution_pct"), rounded(F.col("total_quantity") / F.nullif("_quantity", F.lit(0.0)) * 100, 2).alias("quantity_contribution_pct"),
        F.when(F.col("_n") > 0, F.col("_m") / F.col("_n")).alias("category_avg_margin"),
    )


def daily(mart: DataFrame) -> DataFrame:
    """Sales, profit and margin by day."""
    return mart.groupBy("order_date").agg(_cents("total_sales").cast("double").alias("total_sales"), _cents("total_profit").cast("double").alias("total_profit")).withColumn("profit_margin", ratio(F.col("total_profit"), F.col("total_sales"), 4))


def daily_ordered(mart: DataFrame) -> DataFrame:
    """The daily view in the order of its days."""
    return daily(mart).orderBy("order_date")


def business(mart: DataFrame, top: int = 10, by_product: bool = False) -> DataFrame:
    """Seven daily metrics in long form. Growth and repeats are relative to each day.

    The top share ranks the mart's rows (ties by customer, product and ship mode), or products with `by_product`.
    """
    days = mart.groupBy("order_date").agg(
        _cents("total_sales").cast("double").alias("total_sales"), _cents("total_profit").cast("double").alias("total_profit"),
        rounded(F.sum(F.col("avg_discount").cast("decimal(22,10)")).cast("double") / F.count("avg_discount"), 8).alias("avg_discount"),
    ).withColumn("profit_margin", ratio(F.col("total_profit"), F.col("total_sales"), 4))
    basic = days.select(F.col("order_date").alias("metric_date"), F.expr("stack(4, 'total_sales', total_sales, 'total_profit', total_profit, 'profit_margin', profit_margin, 'avg_discount', avg_discount) AS (metric_name, metric_value)"))
    visits = mart.where("customer_id IS NOT NULL AND order_date IS NOT NULL").select("customer_id", "order_date").distinct()
    previous = F.lag("order_date").over(W.partitionBy("customer_id").orderBy("order_date"))
    # One pass over the visits gives both: a visit without a previous one is a first order.
    by_day = visits.withColumn("_before", previous).groupBy("order_date").agg(F.count("*").alias("n"), F.count_if(F.col("_before").isNull()).alias("new"), F.count_if(F.col("_before") >= F.date_sub("order_date", 30)).alias("again"))
    known = F.sum("new").over(W.orderBy("order_date").rowsBetween(W.unboundedPreceding, -1))  # one row a day
    by_day = by_day.withColumn("_known", known)
    people = by_day.select(
        F.col("order_date").alias("metric_date"),
        F.inline(F.array(
            F.struct(F.lit("customer_growth_rate").alias("metric_name"), ratio(F.col("new") * F.lit(100.0), F.col("_known").cast("double"), 2).alias("metric_value")),
            F.struct(F.lit("repeat_customer_rate").alias("metric_name"), ratio(F.col("again") * F.lit(100.0), F.col("n").cast("double"), 2).alias("metric_value")),
        )),
    )
    rows = mart.groupBy("order_date", "product_id").agg(_cents("total_sales").cast("double").alias("total_sales")) if by_product else mart
    ties = ["product_id"] if by_product else ["customer_id", "product_id", "ship_mode"]
    place = F.row_number().over(W.partitionBy("order_date").orderBy(F.desc_nulls_last("total_sales"), *ties))
    # Only the first rows of a day are ranked (a group limit before the shuffle); the day's total is known from above.
    best = rows.select("order_date", "total_sales", place.alias("_place")).where(F.col("_place") <= top).groupBy("order_date").agg(_cents("total_sales").cast("double").alias("_top"))
    share = days.select("order_date", "total_sales").join(best, "order_date").select(F.col("order_date").alias("metric_date"), F.lit(f"top_{top}_product_sales_pct").alias("metric_name"), ratio(F.col("_top") * F.lit(100.0), F.col("total_sales"), 2).alias("metric_value"))
    return basic.unionByName(people).unionByName(share)


def snapshot_measures(daily_kpi: DataFrame, customers: DataFrame) -> DataFrame:
    """One row: the data's bounds, its last 30 days, and totals without placeholder regions and segments."""
    days = daily_kpi.select("order_date", F.col("total_sales").cast("decimal(22,2)").alias("s"), F.col("total_profit").cast("decimal(22,2)").alias("p"))
    bounds = days.agg(F.min("order_date").alias("data_from"), F.max("order_date").alias("data_through"))
    recent = days.crossJoin(F.broadcast(bounds)).where(F.col("order_date") > F.date_sub("data_through", 30)).agg(F.sum("s").cast("double").alias("revenue_30d"), F.sum("p").cast("double").alias("profit_30d"))
    known = customers.where((F.col("region") != UNKNOWN) & (F.col("segment") != UNKNOWN)).agg(
        _cents("total_sales").cast("double").alias("revenue_total"), _cents("total_profit").cast("double").alias("profit_total"), F.sum("total_orders").cast("long").alias("orders_total"), F.count_distinct("customer_id").alias("customers_total"),
    )
    return bounds.crossJoin(recent).crossJoin(known)  # one row each


def snapshot_row(env: str, run_id: str, trigger: str | None, at, measures: dict, run: dict | None = None) -> dict:
    """The snapshot of a run; a missing measure stays None."""
    row = {"master_run_id": run_id, "env": env, "trigger_type": (trigger or "unknown").lower(), "snapshot_at": at}
    row |= {k: (run or {}).get(k) for k in ("run_started_at", "raw_rows_ingested")}
    row |= {k: measures.get(k) for k in ("data_from", "data_through")}
    row |= {k: None if measures.get(k) is None else float(measures[k]) for k in ("revenue_30d", "profit_30d", "revenue_total", "profit_total")}
    return row | {k: None if measures.get(k) is None else int(measures[k]) for k in ("orders_total", "customers_total")}


def alert_freshness(runs: DataFrame, now) -> DataFrame:
    """Hours since the last successful run, 999999 if there was none."""
    hours = rounded((F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.max("end_ts"))) / 3600.0, 1)
    return runs.where("run_status = 'SUCCESS'").agg(F.coalesce(hours.cast("double"), F.lit(999999.0)).alias("hours_since_last_success"))


def _latest(rows: DataFrame, at: str, by: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy(*by).agg(F.max_by("master_run_id", at).alias("_run"))


def alert_reconciliation(checks: DataFrame) -> DataFrame:
    """Entities of the latest run that do not balance."""
    rows = checks.where("check_name = 'reconciliation'")
    return rows.join(F.broadcast(_latest(rows, "checked_at")), F.col("master_run_id") == F.col("_run")).agg(F.count_if(~F.col("passed")).alias("unbalanced_entities"))


def alert_orphans(checks: DataFrame) -> DataFrame:
    """Orphaned facts of each subject's latest run."""
    rows = checks.where("check_name = 'orphaned_facts'")
    latest = _latest(rows, "checked_at", ["subject"]).withColumnRenamed("subject", "_subject")
    return rows.join(latest, (F.col("subject") == F.col("_subject")) & (F.col("master_run_id") == F.col("_run"))).agg(F.coalesce(F.sum("observed_value"), F.lit(0.0)).cast("long").alias("orphaned_facts"))


def alert_drift(drift: DataFrame) -> DataFrame:
    """New, missing and rescued columns of the latest run."""
    event = F.col("drift_status").isin("NEW", "MISSING") | ((F.col("drift_status") == "RESCUED") & (F.col("row_count") > 0))
    return drift.join(F.broadcast(_latest(drift, "detected_at")), F.col("master_run_id") == F.col("_run")).agg(F.count_if(event).alias("drift_events"))


def alert_placeholders(checks: DataFrame) -> DataFrame:
    """Largest growth of placeholder exposure from the run before to the last, in percentage points; 0 without two runs."""
    runs = checks.where("check_name = 'placeholder_exposure'").groupBy("subject", "master_run_id").agg(F.max("observed_value").alias("pct"), F.max("checked_at").alias("at"))
    w = W.partitionBy("subject").orderBy(F.desc("at"), F.desc("master_run_id"))
    pairs = runs.withColumns({"_n": F.row_number().over(w), "_before": F.lead("pct").over(w)}).where("_n = 1")
    return pairs.agg(rounded(F.coalesce(F.max(F.col("pct") - F.col("_before")), F.lit(0.0)), 2).alias("max_growth_pct_points"))


def executive(daily_kpi: DataFrame) -> DataFrame:
    """The last 30 days of the data against the 30 before: sales, profit, margin and their changes."""
    days = daily_kpi.select("order_date", F.col("total_sales").cast("decimal(22,2)").alias("s"), F.col("total_profit").cast("decimal(22,2)").alias("p"))
    days = days.crossJoin(F.broadcast(days.agg(F.max("order_date").alias("_to"))))
    now, before = F.col("order_date") > F.date_sub("_to", 30), (F.col("order_date") <= F.date_sub("_to", 30)) & (F.col("order_date") > F.date_sub("_to", 60))
    sums = days.agg(*[F.sum(F.when(c, F.col(v))).cast("double").alias(n) for c, v, n in ((now, "s", "sales"), (before, "s", "_sales"), (now, "p", "profit"), (before, "p", "_profit"))])
    change = lambda c: rounded((F.col(c) - F.col(f"_{c}")) / F.nullif(F.abs(f"_{c}"), F.lit(0.0)), 4).alias(f"{c}_change")
    margin, before = F.col("profit") / F.nullif("sales", F.lit(0.0)), F.col("_profit") / F.nullif("_sales", F.lit(0.0))
    return sums.select("sales", "profit", rounded(margin, 4).alias("margin"), change("sales"), change("profit"), rounded((margin - before) * 100, 2).alias("margin_change_points"))


def weekly(daily_kpi: DataFrame) -> DataFrame:
    """Sales and profit of complete weeks (Monday to Sunday, all within the data)."""
    days = daily_kpi.select("order_date", F.to_date(F.date_trunc("week", "order_date")).alias("week"), F.col("total_sales").cast("decimal(22,2)").alias("s"), F.col("total_profit").cast("decimal(22,2)").alias("p"))
    bounds = days.agg(F.min("order_date").alias("_from"), F.max("order_date").alias("_to"))
    whole = days.crossJoin(F.broadcast(bounds)).where((F.col("week") >= F.col("_from")) & (F.date_add("week", 6) <= F.col("_to")))
    return whole.groupBy("week").agg(F.sum("s").cast("double").alias("total_sales"), F.sum("p").cast("double").alias("total_profit"))


def top_customers(kpi: DataFrame, k: int = 10) -> DataFrame:
    """The k customers of most sales in each known region."""
    place = F.row_number().over(W.partitionBy("region").orderBy(F.desc_nulls_last("total_sales"), "customer_id"))
    return kpi.where(F.col("region") != UNKNOWN).select("region", "customer_id", "customer_name", "total_sales", place.alias("place")).where(F.col("place") <= k)


def mix(mart: DataFrame, by: str) -> DataFrame:
    """Sales and share by category, region or segment, without the placeholder."""
    sums = mart.where(F.col(by) != UNKNOWN).groupBy(by).agg(_cents("total_sales").alias("_s"))
    whole = sums.agg(F.sum("_s").cast("double").alias("_all"))
    return sums.crossJoin(F.broadcast(whole)).select(by, F.col("_s").cast("double").alias("total_sales"), rounded(F.col("_s").cast("double") * 100 / F.nullif("_all", F.lit(0.0)), 2).alias("share_pct"))


def latest_runs(snapshots: DataFrame) -> DataFrame:
    """The last two runs that ingested data, side by side."""
    w = W.orderBy(F.desc("snapshot_at"), F.desc("master_run_id"))  # one row a run
    rows = snapshots.where("raw_rows_ingested > 0").withColumn("_n", F.row_number().over(w)).where("_n <= 2")
    value = lambda c, n: F.max(F.when(F.col("_n") == n, F.col(c)))
    out = [value("master_run_id", 1).alias("run"), value("master_run_id", 2).alias("previous_run")]
    for c in ("revenue_total", "profit_total", "orders_total", "customers_total"):
        out += [value(c, 1).alias(c), (value(c, 1) - value(c, 2)).alias(f"{c}_delta")]
    return rows.agg(*out)


def run_timing(metrics: DataFrame) -> DataFrame:
    """Wall clock of each layer of the last run: from its first start to its last end, not summed over entities."""
    last = metrics.agg(F.max_by("master_run_id", "end_ts").alias("_run"))
    rows = metrics.join(F.broadcast(last), F.col("master_run_id") == F.col("_run"))
    seconds = F.unix_timestamp(F.max("end_ts")) - F.unix_timestamp(F.min("start_ts"))
    return rows.groupBy("master_run_id", "layer").agg(seconds.alias("seconds"), F.sum("rows_read").cast("long").alias("rows_read"), F.count("*").alias("entities"))


def row_flow(checks: DataFrame) -> DataFrame:
    """Where the bronze rows of each entity went in the latest reconciled run, from the details of its check rows: entity, source, target, n."""
    rows = checks.where("check_name = 'reconciliation'")
    rows = rows.join(F.broadcast(_latest(rows, "checked_at")), F.col("master_run_id") == F.col("_run"))  # one row
    said = F.from_json("details", "silver_rows long, quarantine_rows long, audit_rows long, superseded_rows long")
    flows = [("silver_rows", "silver"), ("quarantine_rows", "quarantine"), ("audit_rows", "duplicates"), ("superseded_rows", "superseded")]
    links = F.array(*[F.struct(F.lit("bronze").alias("source"), F.lit(to).alias("target"), F.col(f"_said.{c}").alias("n")) for c, to in flows])
    return rows.withColumn("_said", said).select(F.col("subject").alias("entity"), F.inline(links)).where("n IS NOT NULL")


def reliability(metrics: DataFrame) -> DataFrame:
    """Runs of each layer and entity: how many, how many failed or found nothing, their share that did not fail, rows read and mean seconds."""
    return metrics.groupBy("layer", "entity").agg(
        F.count("*").alias("runs"), F.count_if(F.col("run_status") == "FAILED").alias("failed"), F.count_if(F.col("run_status") == "SKIPPED").alias("skipped"),
        rounded(F.count_if(F.col("run_status") != "FAILED") * 100.0 / F.count("*"), 2).alias("success_pct"), F.sum("rows_read").alias("rows_read"), rounded(F.avg("duration_secs"), 2).alias("avg_seconds"),
    )


def run_history(metrics: DataFrame) -> DataFrame:
    """Wall clock of each layer in each run, not summed over entities, with the rows and the worst status of its entities."""
    seconds = F.unix_timestamp(F.max("end_ts")) - F.unix_timestamp(F.min("start_ts"))
    worst = F.when(F.count_if(F.col("run_status") == "FAILED") > 0, "FAILED").when(F.count_if(F.col("run_status") == "SUCCESS") > 0, "SUCCESS").otherwise("SKIPPED")
    return metrics.groupBy("master_run_id", "layer").agg(F.count("*").alias("entities"), F.sum("rows_read").alias("rows_read"), seconds.alias("seconds"), worst.alias("status"))
