"""Marts: full rebuilds from dimensions and facts. `as_of` is a date (a value or a column), never the clock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.numbers import mean, ratio, total


def current(dim: DataFrame) -> DataFrame:
    return dim.where("is_current") if "is_current" in dim.columns else dim


def customer_360(customers: DataFrame, orders: DataFrame, sales: DataFrame, as_of) -> DataFrame:
    """One row a current customer, with or without orders.

    Sales meet orders once and are summed by order first, so the join to the dimension moves one row an order.
    """
    per_order = sales.groupBy("order_id").agg(F.sum("sales").alias("s"), F.sum("profit").alias("p"), F.sum("discount").alias("d"), F.count("discount").alias("n"))
    facts = orders.select("order_id", "customer_id", "order_date").join(per_order, "order_id", "left").groupBy("customer_id").agg(
        F.sum("s").cast("double").alias("total_sales"), F.sum("p").cast("double").alias("total_profit"), F.count_distinct("order_id").alias("total_orders"),
        F.sum("d").cast("double").alias("_d"), F.sum("n").alias("_n"), F.max("order_date").alias("last_order_date"), F.min("order_date").alias("_first"),
    )
    rows = current(customers).select("customer_id", "customer_name", "segment", "region").join(facts, "customer_id", "left")
    orders_n = F.coalesce("total_orders", F.lit(0))
    return rows.select(
        "customer_id", "customer_name", "segment", "region", "total_sales", "total_profit", orders_n.alias("total_orders"),
        ratio(F.col("total_sales"), orders_n.cast("double"), 2).alias("avg_order_value"),
        "last_order_date", F.datediff(F.lit(as_of), "last_order_date").alias("recency_days"), F.datediff("last_order_date", "_first").alias("customer_lifetime_days"),
        F.when(F.col("_n") > 0, F.col("_d") / F.col("_n")).alias("discount_sensitivity"), F.when(F.col("total_profit") > 0, 1).otherwise(0).alias("profitability_flag"),
    )


def product_performance(products: DataFrame, orders: DataFrame, sales: DataFrame) -> DataFrame:
    """One row a current product; unsold products keep null measures."""
    sold = sales.join(orders.select("order_id", "order_date"), "order_id", "left").groupBy("product_id").agg(
        total("sales").alias("total_sales"), total("profit").alias("total_profit"), F.sum("quantity").cast("long").alias("total_quantity"), mean("discount").alias("avg_discount"),
        F.datediff(F.max("order_date"), F.min("order_date")).alias("_days"),
    )
    rows = current(products).select("product_id", "product_name", "category", "sub_category").join(sold, "product_id", "left")
    return rows.select(
        "product_id", "product_name", "category", "sub_category", "total_sales", "total_profit", "total_quantity", "avg_discount",
        ratio(F.col("total_profit"), F.col("total_sales"), 4).alias("profit_margin"),
        F.when(F.col("_days") == 0, F.col("total_quantity").cast("double")).otherwise(ratio(F.col("total_quantity").cast("double"), F.col("_days").cast("double"), 2)).alias("sales_velocity"),
        F.when(F.col("total_profit") < 0, 1).otherwise(0).alias("loss_making_flag"),
    )


DAILY_GRAIN = ["order_date", "customer_id", "product_id", "region", "segment", "category", "sub_category", "ship_mode"]


def sales_daily(customers: DataFrame, products: DataFrame, orders: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales by day, customer, product and their attributes; facts without current dimension rows are left out.

    Facts meet orders by order, then the attributes of the dimensions; the aggregation sums on each side of its one shuffle.
    """
    facts = sales.join(orders.select("order_id", "customer_id", "order_date", "ship_mode"), "order_id")
    facts = facts.join(current(products).select("product_id", "category", "sub_category"), "product_id").join(current(customers).select("customer_id", "region", "segment"), "customer_id")
    return facts.groupBy(*DAILY_GRAIN).agg(
        total("sales").alias("total_sales"), total("profit").alias("total_profit"), F.sum("quantity").cast("long").alias("total_quantity"), mean("discount").alias("avg_discount"),
        F.count_distinct("order_id").alias("order_count"), ratio(total("profit"), total("sales"), 4).alias("profit_margin"),
    )
