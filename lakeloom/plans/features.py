"""Feature tables, each one aggregation over the joined facts; `as_of` is explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lakeloom.functions.numbers import mean, ratio, rounded, sample_variance, total
from lakeloom.plans.marts import current


def _within(days: int, as_of, value):
    return F.sum(F.when(F.col("order_date") >= F.date_sub(F.lit(as_of), days), value).otherwise(F.lit(0).cast("decimal(18,2)")))


def _codes(df: DataFrame, column: str, name: str) -> DataFrame:
    """Dense rank of each distinct value: ranked over the values, not over the rows."""
    return df.select(column).distinct().withColumn(name, F.dense_rank().over(W.orderBy(F.asc_nulls_first(column))))


def customer(customers: DataFrame, orders: DataFrame, sales: DataFrame, as_of) -> DataFrame:
    """Recency, frequency, money, margin and encodings of current customers with sales."""
    per_order = sales.groupBy("order_id").agg(F.sum("sales").cast("decimal(18,2)").alias("s"), F.sum("profit").cast("decimal(18,2)").alias("p"), mean("discount").alias("d"))
    facts = orders.select("order_id", "customer_id", "order_date").join(per_order, "order_id")
    people = current(customers).select("customer_id", "segment", "region")
    recent = lambda n: F.col("order_date") >= F.date_sub(F.lit(as_of), n)
    made = facts.join(people.select("customer_id"), "customer_id", "left_semi").groupBy("customer_id").agg(
        F.datediff(F.lit(as_of), F.max("order_date")).alias("recency_days"),
        F.count_if(recent(30)).alias("order_frequency_30days"), F.count_if(recent(90)).alias("order_frequency_90days"),
        _within(30, as_of, F.col("s")).cast("double").alias("monetary_30days"), _within(90, as_of, F.col("s")).cast("double").alias("monetary_90days"),
        rounded(F.avg("d"), 6).alias("avg_discount"),
        F.coalesce(ratio(total("p"), total("s"), 4), F.lit(0.0)).alias("profit_margin"),
        F.coalesce(rounded(sample_variance(F.col("s")), 2), F.lit(0.0)).alias("order_variance"),
    )
    sold = people.join(made, "customer_id")
    codes = sold.join(_codes(sold, "segment", "segment_encoded").withColumnRenamed("segment", "_s"), F.col("segment").eqNullSafe(F.col("_s")))
    codes = codes.join(_codes(sold, "region", "region_encoded").withColumnRenamed("region", "_r"), F.col("region").eqNullSafe(F.col("_r")))
    return codes.select("customer_id", F.lit(as_of).cast("date").alias("feature_date"), *made.columns[1:], "segment_encoded", "region_encoded")


def product(orders: DataFrame, sales: DataFrame, as_of) -> DataFrame:
    """Recent sales, trend, discount sensitivity, profit volatility and seasonality of each sold product."""
    facts = sales.join(orders.select("order_id", "order_date"), "order_id")
    by_month = facts.groupBy("product_id", F.month("order_date").alias("m")).agg(
        F.sum("sales").alias("s"), F.count("sales").alias("n"), _within(7, as_of, F.col("sales")).alias("s7"), _within(30, as_of, F.col("sales")).alias("s30"),
        F.sum("discount").alias("d"), F.count("discount").alias("dn"), F.sum("profit").alias("p"), F.count("profit").alias("pn"), F.sum((F.col("profit") * F.col("profit")).cast("decimal(38,4)")).alias("pp"),
    )
    # Months are the partial sums of the product: one shuffle by (product, month), then one of at most 12 rows a product.
    monthly = F.col("s").cast("double") / F.col("n")
    n, p = F.sum("pn"), F.sum("p").cast("double")
    return by_month.groupBy("product_id").agg(
        F.sum("s7").cast("double").alias("sales_last_7days"), F.sum("s30").cast("double").alias("sales_last_30days"),
        F.coalesce(rounded((F.sum("s7").cast("double") / 7.0) / F.nullif(F.sum("s30").cast("double") / 30.0, F.lit(0.0)), 2), F.lit(0.0)).alias("sales_trend"),
        rounded(F.sum("d").cast("double") / F.sum("dn") * 100, 2).alias("discount_sensitivity"),
        rounded(F.when(n > 1, (F.sum("pp").cast("double") - p * p / n) / (n - 1)), 2).alias("profit_volatility"),
        rounded(F.avg(monthly) / F.nullif(F.avg(monthly), F.lit(0.0)), 2).alias("seasonality_index"),
    ).withColumn("feature_date", F.lit(as_of).cast("date"))


def sales_timeseries(orders: DataFrame, sales: DataFrame, order_by: tuple[str, ...] = ("order_id",)) -> DataFrame:
    """Lags and trailing means by row, ordered by date and `order_by`; the first row of each product and day stays."""
    facts = sales.join(orders.select("order_id", "order_date"), "order_id")
    w = W.partitionBy("product_id").orderBy("order_date", *order_by)
    trailing = lambda n: rounded(F.sum("sales").over(w.rowsBetween(-n, -1)).cast("double") / F.nullif(F.count("sales").over(w.rowsBetween(-n, -1)), F.lit(0)), 6)
    first = F.coalesce(F.lag("order_date").over(w) != F.col("order_date"), F.lit(True))
    rows = facts.select(
        "order_date", "product_id", F.lag("sales", 7).over(w).cast("double").alias("lag_7_sales"), F.lag("sales", 30).over(w).cast("double").alias("lag_30_sales"),
        trailing(7).alias("rolling_avg_7"), trailing(30).alias("rolling_avg_30"), F.dayofweek("order_date").alias("day_of_week"), F.month("order_date").alias("month"), first.alias("_first"),
    )
    return rows.where("_first").drop("_first")


def customer_product(orders: DataFrame, sales: DataFrame, as_of) -> DataFrame:
    """Purchases of each customer and product."""
    facts = sales.join(orders.select("order_id", "customer_id", "order_date"), "order_id")
    return facts.groupBy("customer_id", "product_id").agg(
        F.count_distinct("order_id").alias("purchase_count"), total("sales").alias("total_spent"), total("profit").alias("total_profit"), F.max("order_date").alias("last_purchase_date"),
        F.datediff(F.lit(as_of), F.max("order_date")).alias("days_since_last_purchase"), mean("sales").alias("avg_sales_per_order"),
        F.count_distinct(F.when(F.col("order_date") >= F.date_sub(F.lit(as_of), 30), F.col("order_id"))).alias("orders_last_30d"),
    )
