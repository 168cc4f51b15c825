"""The driver's queries over the star tables, each with an equal SQL statement for DuckDB.

Entities: customers (with nation and region), products, orders (ship date: the first of its lines) and sales (the lines).
The tables hold no nulls and no orphans, so dirty cases come from fixed predicates, written alike on both sides.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.dates import parse_date
from lakeloom.functions.hashing import row_hash
from lakeloom.functions.numbers import rounded
from lakeloom.functions.text import clean_strings as clean
from lakeloom.functions.text import conform_values as conform
from lakeloom.functions.text import rename_columns
from lakeloom.operators import dedup, merge, observe, rules, scans, scd2
from lakeloom.plans import features, kpi, marts, medallion
from lakeloom.sources.store import TableStore, inventory
from lakeloom.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: SQL of the entities, put before each statement.
ENTITIES = """
customers AS (
    SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment, n_name AS country, r_name AS region
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
products AS (SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS sub_category FROM part),
f_orders AS (
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date, ship_date, o_orderpriority AS ship_mode
    FROM orders LEFT JOIN (SELECT l_orderkey, min(CAST(l_shipdate AS DATE)) AS ship_date FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey
),
f_sales AS (
    SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS supplier_id, l_linenumber AS line, CAST(l_extendedprice AS DECIMAL(18,2)) AS sales, CAST(l_quantity AS BIGINT) AS quantity,
        CAST(l_discount AS DECIMAL(10,2)) AS discount,
        CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(0.10 AS DECIMAL(10,2)) - CAST(l_discount AS DECIMAL(10,2))) AS DECIMAL(18,2)) AS profit
    FROM lineitem
),
as_of AS (SELECT max(CAST(o_orderdate AS DATE)) AS today FROM orders)
"""


def on_decimals(sql: str) -> str:
    """The statement with every round(x, n) taken on the decimal form of x, as `functions.numbers.rounded` does."""
    at = 0
    while (at := sql.find("round(", at)) >= 0:
        depth, comma, i = 1, 0, at + len("round(")
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[i], 0)
            comma = i if sql[i] == "," and depth == 1 else comma
            i += 1
        inner, digits = sql[at + len("round(") : comma], sql[comma + 1 : i - 1]
        start = f"CAST(ROUND(CAST({inner} AS DECIMAL(38,8)),{digits}) AS DOUBLE)"
        sql = sql[:at] + start + sql[i:]
        at += len("CAST(ROUND(")
    return sql


def query(name: str, sql: str | None = None, entities: bool = True) -> Callable[[Query], Query]:
    """Register a query and its statement (a SELECT, or CTEs that begin with a comma)."""

    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = on_decimals(f"WITH {ENTITIES} {sql}" if entities else sql)
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Entities:
    """The entities over one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        t = lambda name: table(spark, sf_dir, name)
        self.nations = nations = t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))  # 25 nations
        self.customers = t("customer").join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("country"), F.col("r_name").alias("region")
        )
        self.products = t("part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category"), F.col("p_brand").alias("sub_category"))
        self.bare_orders = t("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.to_date("o_orderdate").alias("order_date"), F.col("o_orderpriority").alias("ship_mode"))
        shipped = t("lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(F.min(F.to_date("l_shipdate")).alias("ship_date"))
        self.orders = self.bare_orders.join(shipped, "order_id", "left")
        amount, discount = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_discount").cast("decimal(10,2)")
        self.sales = t("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("supplier_id"), F.col("l_linenumber").alias("line"),
            amount.alias("sales"), F.col("l_quantity").cast("long").alias("quantity"), discount.alias("discount"), (amount * (F.lit("0.10").cast("decimal(10,2)") - discount)).cast("decimal(18,2)").alias("profit"),
        )

    @property
    def today(self) -> datetime.date:
        """The last order date: one number from the files' statistics or one narrow scan."""
        return self.bare_orders.agg(F.max("order_date")).first()[0]


# --- Cleaning, rules, hashing -----------------------------------------------------------------------------------------------

_NOISY = """noisy AS (SELECT customer_id, '  "' || customer_name || ' "' AS customer_name, segment FROM customers)"""


@query("clean_strings", f""", {_NOISY} SELECT customer_id, replace(trim(customer_name), '"', '') AS customer_name, segment FROM noisy""")
def clean_strings(spark, sf_dir):
    noisy = Entities(spark, sf_dir).customers.select("customer_id", F.concat(F.lit('  "'), "customer_name", F.lit(' "')).alias("customer_name"), "segment")
    return clean(noisy, ["customer_name", "segment"])


@query("conform_values", """SELECT product_id, CASE category WHEN 'ECONOMY' THEN 'Budget' WHEN 'PROMO' THEN 'Offer' ELSE category END AS category FROM products""")
def conform_values(spark, sf_dir):
    return conform(Entities(spark, sf_dir).products.select("product_id", "category"), {"category": {"ECONOMY": "Budget", "PROMO": "Offer"}, "absent": {"a": "b"}})


#: Orders as text with planted faults: a null key, a customer that is no number, dates in other formats or impossible, a late order date.
_RAW_ORDERS = """raw AS (
    SELECT CASE WHEN order_id % 97 = 0 THEN NULL ELSE CAST(order_id AS VARCHAR) END AS order_id,
        CASE WHEN order_id % 89 = 0 THEN 'c' || customer_id ELSE CAST(customer_id AS VARCHAR) END AS customer_id,
        CASE order_id % 8 WHEN 1 THEN strftime(order_date, '%d/%m/%Y') WHEN 2 THEN strftime(order_date, '%d-%m-%Y') WHEN 3 THEN strftime(order_date, '%d %b %Y') WHEN 4 THEN '2024-02-31' WHEN 5 THEN 'soon' ELSE strftime(order_date, '%Y-%m-%d') END AS order_date,
        CAST(ship_date AS VARCHAR) AS ship_date, CASE WHEN order_id % 53 = 0 THEN NULL ELSE ship_mode END AS ship_mode, order_id AS n, order_date AS day
    FROM f_orders)"""
_DATE = r"^(\d{4}-\d{2}-\d{2}|\d{2}[-/]\d{2}[-/]\d{4}|\d{1,2} [A-Z][a-z]{2} \d{4})$"
ORDER_RULES = rules.EntityRules(
    name="orders", keys=("order_id",), columns=("order_id", "customer_id", "order_date", "ship_date", "ship_mode"),
    patterns={"order_date": _DATE, "customer_id": r"^\d+$"}, allowed={"ship_mode": ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]}, severity={"ship_mode": rules.REPAIRABLE},
    dates=("order_date", "ship_date"), not_before=(("ship_date", "order_date"),),
)


def raw_orders(e: Entities) -> DataFrame:
    k, d = F.col("order_id") % 8, F.col("order_date")
    text = F.when(k == 1, F.date_format(d, "dd/MM/yyyy")).when(k == 2, F.date_format(d, "dd-MM-yyyy")).when(k == 3, F.date_format(d, "dd MMM yyyy")).when(k == 4, "2024-02-31").when(k == 5, "soon").otherwise(F.date_format(d, "yyyy-MM-dd"))
    return e.orders.select(
        F.when(F.col("order_id") % 97 != 0, F.col("order_id").cast("string")).alias("order_id"),
        F.when(F.col("order_id") % 89 == 0, F.concat(F.lit("c"), "customer_id")).otherwise(F.col("customer_id").cast("string")).alias("customer_id"),
        text.alias("order_date"), F.col("ship_date").cast("string").alias("ship_date"), F.when(F.col("order_id") % 53 != 0, F.col("ship_mode")).alias("ship_mode"), F.col("order_id").alias("n"),
    )


_ASSESSED = f"""{_RAW_ORDERS},
parsed AS (SELECT *, CASE WHEN n % 8 IN (4, 5) THEN NULL ELSE day END AS od FROM raw),
named AS (
    SELECT *, list_filter([
        CASE WHEN order_id IS NULL THEN 'order_id' END, CASE WHEN customer_id IS NULL THEN 'customer_id' END, CASE WHEN order_date IS NULL THEN 'order_date' END, CASE WHEN ship_date IS NULL THEN 'ship_date' END,
        CASE WHEN n % 8 = 5 THEN 'order_date' END, CASE WHEN n % 89 = 0 THEN 'customer_id' END,
        CASE WHEN od IS NULL THEN 'unparseable_order_date' END, CASE WHEN CAST(ship_date AS DATE) < od THEN 'ship_date_before_order_date' END], lambda x: x IS NOT NULL) AS errors,
        CASE WHEN ship_mode IS NULL OR ship_mode NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') THEN 'ship_mode' ELSE '' END AS repaired
    FROM parsed)"""


@query("dq_route", f""", {_ASSESSED} SELECT n, array_to_string(errors, ',') AS errors, repaired, len(errors) = 0 AS is_valid FROM named""")
def dq_route(spark, sf_dir):
    rows = rules.assess(raw_orders(Entities(spark, sf_dir)), ORDER_RULES)
    return rows.select("n", F.array_join("error_columns", ",").alias("errors"), F.array_join("repaired_columns", ",").alias("repaired"), "is_valid")


@query("dq_counts", f""", {_ASSESSED} SELECT CAST(count(*) FILTER (len(errors) = 0) AS BIGINT) AS valid_rows, CAST(count(*) FILTER (len(errors) > 0) AS BIGINT) AS dirty_rows FROM named""")
def dq_counts(spark, sf_dir):
    return observe.validity_counts(rules.assess(raw_orders(Entities(spark, sf_dir)), ORDER_RULES))


@query("dq_valid_typed", f""", {_ASSESSED} SELECT n, od AS order_date, CAST(ship_date AS DATE) AS ship_date FROM named WHERE len(errors) = 0""")
def dq_valid_typed(spark, sf_dir):
    return rules.route(raw_orders(Entities(spark, sf_dir)), ORDER_RULES)[0].select("n", "order_date", "ship_date")


@query("date_parse", f""", {_RAW_ORDERS} SELECT n, CASE WHEN n % 8 IN (4, 5) THEN NULL ELSE day END AS parsed FROM raw""")
def date_parse(spark, sf_dir):
    return raw_orders(Entities(spark, sf_dir)).select("n", parse_date(F.col("order_date")).alias("parsed"))


_TEXT_SALES = """CASE WHEN l_partkey % 31 = 0 THEN 'n/a' WHEN l_partkey % 37 = 0 THEN '123456789.00' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END"""


@query("try_cast_route", f"""SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, CASE WHEN l_partkey % 31 = 0 THEN 'sales,cast_sales' WHEN l_partkey % 37 = 0 THEN 'cast_sales' ELSE '' END AS errors,
    CASE WHEN l_partkey % 31 = 0 OR l_partkey % 37 = 0 THEN NULL ELSE CAST({_TEXT_SALES} AS DOUBLE) END AS sales FROM lineitem""", entities=False)  # fmt: skip
def try_cast_route(spark, sf_dir):
    text = F.when(F.col("l_partkey") % 31 == 0, "n/a").when(F.col("l_partkey") % 37 == 0, "123456789.00").otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", text.alias("sales"))
    spec = rules.EntityRules("sales", ("l_orderkey",), ("sales",), patterns={"sales": r"^\d+(\.\d+)?$"}, casts={"sales": "decimal(10,2)"})
    return rules.typed(rules.assess(rows, spec), spec).select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", F.array_join("error_columns", ",").alias("errors"), F.col("sales").cast("double").alias("sales"))


@query("row_hash", """SELECT customer_id, sha256(customer_id || '||' || customer_name || '||' || coalesce(CASE WHEN customer_id % 53 <> 0 THEN segment END, '') || '||' || region) AS h FROM customers""")
def row_hash_query(spark, sf_dir):
    rows = Entities(spark, sf_dir).customers.withColumn("segment", F.when(F.col("customer_id") % 53 != 0, F.col("segment")))
    return rows.select("customer_id", row_hash(["customer_id", "customer_name", "segment", "region"]).alias("h"))


# --- Deduplication, versions, merges ----------------------------------------------------------------------------------------

_RANKED = """ranked AS (
    SELECT l.*, row_number() OVER (PARTITION BY order_id, product_id ORDER BY (quantity < 5)::INT, line DESC NULLS LAST,
        sha256(concat_ws('||', discount, line, order_id, product_id, profit, quantity, sales, supplier_id)) DESC) AS row_num
    FROM f_sales l)"""


def _classified(spark, sf_dir):
    sales = Entities(spark, sf_dir).sales
    noted = sales.withColumn("repaired_columns", F.when(F.col("quantity") < 5, F.array(F.lit("quantity"))).otherwise(F.array().cast("array<string>")))
    return dedup.deduplicate(noted, ["order_id", "product_id"], "line", sales.columns)


@query("dedup_winners", f""", {_RANKED} SELECT order_id, product_id, line, supplier_id, quantity, CAST(sales AS DOUBLE) AS sales FROM ranked WHERE row_num = 1""")
def dedup_winners(spark, sf_dir):
    return _classified(spark, sf_dir)[0].select("order_id", "product_id", "line", "supplier_id", "quantity", F.col("sales").cast("double").alias("sales"))


@query("dedup_losers", f""", {_RANKED} SELECT order_id, product_id, line, supplier_id, quantity, 'duplicate' AS record_type FROM ranked WHERE row_num > 1""")
def dedup_losers(spark, sf_dir):
    return _classified(spark, sf_dir)[1].select("order_id", "product_id", "line", "supplier_id", "quantity", "record_type")


@query("scd2_timeline", """SELECT user_id, event_type, ts AS effective_from, lead(ts) OVER w - INTERVAL 1 MICROSECOND AS effective_to, lead(ts) OVER w IS NULL AS is_current
    FROM (SELECT user_id, ts, max(event_type) AS event_type FROM events GROUP BY 1, 2) WINDOW w AS (PARTITION BY user_id ORDER BY ts)""", entities=False)  # fmt: skip
def scd2_timeline(spark, sf_dir):
    return scd2.timeline(table(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").alias("effective_from")), ["user_id"], "event_type")


#: A dimension of all events before a day, and each user's last version since that day; five users are only in one of the two.
_VERSIONS = """v AS (SELECT user_id, event_type, ts AS effective_from, sha256(user_id || '||' || event_type) AS h FROM (SELECT user_id, ts, max(event_type) AS event_type FROM events GROUP BY 1, 2)),
    dim AS (SELECT user_id, event_type, h, effective_from, lead(effective_from) OVER w - INTERVAL 1 MICROSECOND AS effective_to, lead(effective_from) OVER w IS NULL AS is_current
            FROM v WHERE effective_from < TIMESTAMP '2024-01-15' WINDOW w AS (PARTITION BY user_id ORDER BY effective_from)
        UNION ALL SELECT -1 - r_regionkey, 'view', sha256((-1 - r_regionkey) || '||view'), TIMESTAMP '2024-01-02', NULL, true FROM region),
    s AS (SELECT user_id, event_type, h, effective_from FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY effective_from DESC) AS n FROM v WHERE effective_from >= TIMESTAMP '2024-01-15') WHERE n = 1
        UNION ALL SELECT -11 - r_regionkey, 'click', sha256((-11 - r_regionkey) || '||click'), TIMESTAMP '2024-01-20' FROM region)"""


def _dimension(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("r"))
    user = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    day = F.lit("2024-01-15").cast("timestamp")
    gone = region.select((-1 - F.col("r")).alias("user_id"), F.lit("view").alias("event_type"), F.lit("2024-01-02").cast("timestamp").alias("ts"))
    fresh = region.select((-11 - F.col("r")).alias("user_id"), F.lit("click").alias("event_type"), F.lit("2024-01-20").cast("timestamp").alias("ts"))
    versions = lambda df: scd2.prepare_versions(df, ["user_id"], ["event_type"], "h", "ts")
    dim = scd2.timeline(versions(user.where(F.col("ts") < day).unionByName(gone)), ["user_id"], "event_type")
    last = user.where(F.col("ts") >= day).groupBy("user_id").agg(F.max(F.struct("ts", "event_type")).alias("v")).select("user_id", "v.event_type", "v.ts")
    return dim, versions(last.unionByName(fresh))


@query("scd2_apply", f"""WITH {_VERSIONS}
    SELECT user_id, event_type, h, effective_from, effective_to, is_current FROM dim WHERE NOT is_current
    UNION ALL SELECT dim.user_id, dim.event_type, dim.h, dim.effective_from, CASE WHEN dim.h <> s.h THEN s.effective_from - INTERVAL 1 SECOND END, s.h IS NULL OR dim.h = s.h FROM dim LEFT JOIN s USING (user_id) WHERE dim.is_current
    UNION ALL SELECT s.user_id, s.event_type, s.h, s.effective_from, NULL, true FROM s LEFT JOIN (SELECT * FROM dim WHERE is_current) c USING (user_id) WHERE c.h IS NULL OR c.h <> s.h""", entities=False)  # fmt: skip
def scd2_apply(spark, sf_dir):
    dim, source = _dimension(spark, sf_dir)
    return scd2.apply_scd2(dim, source, ["user_id"], "h")


@query("soft_delete", f"""WITH {_VERSIONS}
    SELECT user_id, event_type, h, effective_from, CASE WHEN is_current AND user_id NOT IN (SELECT user_id FROM s) THEN TIMESTAMP '2024-02-01' ELSE effective_to END AS effective_to,
        is_current AND user_id IN (SELECT user_id FROM s) AS is_current FROM dim""", entities=False)  # fmt: skip
def soft_delete(spark, sf_dir):
    dim, source = _dimension(spark, sf_dir)
    return scd2.soft_delete(dim, source, ["user_id"], datetime.datetime(2024, 2, 1))


@query("validity_overlaps", f"""WITH {_VERSIONS}, o AS (SELECT user_id, effective_from, effective_to FROM dim WHERE is_current IS NOT NULL UNION ALL SELECT user_id, effective_from - INTERVAL 2 HOUR, CASE WHEN event_type = 'view' THEN effective_from - INTERVAL 3 HOUR ELSE effective_from END FROM s),
    k AS (SELECT *, lag(effective_to) OVER w AS before, lag(effective_from) OVER w IS NOT NULL AS follows FROM o WINDOW w AS (PARTITION BY user_id ORDER BY effective_from, effective_to NULLS LAST))
    SELECT user_id, effective_from, effective_to, CASE WHEN effective_to <= effective_from THEN 'covers no time' ELSE 'overlaps' END AS fault FROM k
    WHERE effective_to <= effective_from OR (follows AND (before IS NULL OR effective_from <= before))""", entities=False)  # fmt: skip
def validity_overlaps(spark, sf_dir):
    """The dimension with a planted version of each user, some of which end before they begin."""
    dim, source = _dimension(spark, sf_dir)
    start = F.col("effective_from")
    planted = source.select("user_id", (start - F.expr("INTERVAL 2 HOURS")).alias("effective_from"), F.when(F.col("event_type") == "view", start - F.expr("INTERVAL 3 HOURS")).otherwise(start).alias("effective_to"))
    return scd2.overlaps(dim.select("user_id", "effective_from", "effective_to").unionByName(planted), ["user_id"])


_MERGED = """t AS (SELECT order_id, ship_mode, order_date, md5(ship_mode) AS h FROM f_orders WHERE order_id % 3 <> 0),
    s AS (SELECT order_id, m AS ship_mode, order_date, md5(m) AS h FROM (SELECT *, CASE WHEN order_id % 4 = 0 THEN 'CHANGED' ELSE ship_mode END AS m FROM f_orders) WHERE order_id % 2 = 0)"""


def _sides(spark, sf_dir):
    orders = Entities(spark, sf_dir).bare_orders.select("order_id", "ship_mode", "order_date")
    target = orders.where("order_id % 3 <> 0").withColumn("h", F.md5("ship_mode"))
    source = orders.where("order_id % 2 = 0").withColumn("ship_mode", F.when(F.col("order_id") % 4 == 0, "CHANGED").otherwise(F.col("ship_mode"))).withColumn("h", F.md5("ship_mode"))
    return target, source


@query("upsert_fact", f""", {_MERGED} SELECT coalesce(t.order_id, s.order_id) AS order_id, CASE WHEN s.order_id IS NULL THEN t.ship_mode ELSE s.ship_mode END AS ship_mode,
    CASE WHEN t.order_id IS NULL THEN 'inserted' WHEN s.h <> t.h THEN 'updated' ELSE 'kept' END AS action FROM t FULL JOIN s ON t.order_id = s.order_id""")  # fmt: skip
def upsert_fact(spark, sf_dir):
    return merge.upsert_changed(*_sides(spark, sf_dir), ["order_id"], "h").select("order_id", "ship_mode", F.col(merge.ACTION).alias("action"))


@query("merge_all", f""", {_MERGED} SELECT CASE WHEN t.order_id IS NULL THEN 'inserted' WHEN s.order_id IS NULL THEN 'kept' ELSE 'updated' END AS action, count(*) AS n FROM t FULL JOIN s ON t.order_id = s.order_id GROUP BY 1""")
def merge_all(spark, sf_dir):
    return merge.merge(*_sides(spark, sf_dir), ["order_id"]).groupBy(F.col(merge.ACTION).alias("action")).agg(F.count("*").alias("n"))


@query("scoped_replace", """SELECT order_id, order_date, ship_mode FROM f_orders WHERE NOT (order_date BETWEEN DATE '1996-01-01' AND DATE '1996-06-30')
    UNION ALL SELECT order_id, order_date, 'again' FROM f_orders WHERE order_date BETWEEN DATE '1996-01-01' AND DATE '1996-06-30' AND order_id % 2 = 0""")  # fmt: skip
def scoped_replace(spark, sf_dir):
    run = scans.RunConfig.of({"run_mode": "replay", "start_date": "1996-01-01", "end_date": "1996-06-30"})
    orders = Entities(spark, sf_dir).bare_orders.select("order_id", "order_date", "ship_mode")
    again = scans.in_window(orders, "order_date", run.start, run.end).where("order_id % 2 = 0").withColumn("ship_mode", F.lit("again"))
    return merge.scoped_replace(orders, again, run.scope("order_date"))


# --- Scans ------------------------------------------------------------------------------------------------------------------


@query("hwm_incremental", """SELECT event_id, ts, event_type FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_id % 10 = 0 AND ts < TIMESTAMP '2024-01-20')""", entities=False)
def hwm_incremental(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    mark = scans.high_water_mark(events.where((F.col("event_id") % 10 == 0) & (F.col("ts") < F.lit("2024-01-20").cast("timestamp"))), "ts")
    return scans.since(events, "ts", mark)


@query("window_read", """SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'""", entities=False)
def window_read(spark, sf_dir):
    run = scans.RunConfig.of({"run_mode": "backfill", "start_date": "2024-01-05", "end_date": "2024-01-09"})
    return scans.read_for_run(table(spark, sf_dir, "events").select("event_id", "ts"), run, "ts")


@query("dry_run_impact", """SELECT count(*) AS "rows", count(DISTINCT CAST(ts AS DATE)) AS days, min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) AS last_day FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'""", entities=False)
def dry_run_impact(spark, sf_dir):
    run = scans.RunConfig.of({"run_mode": "backfill", "start_date": "2024-01-05", "end_date": "2024-01-09", "dry_run": "true"})
    return scans.impact(table(spark, sf_dir, "events"), run, "ts")


@query("without_ingested", """SELECT 'f' || (user_id % 20) AS file_name, CAST(CAST(ts AS DATE) AS VARCHAR) AS modified, count(*) AS n FROM events
    WHERE ('f' || (user_id % 20), CAST(ts AS DATE)) NOT IN (SELECT 'f' || (user_id % 20), CAST(ts AS DATE) FROM events WHERE event_type = 'error') GROUP BY 1, 2""", entities=False)  # fmt: skip
def without_ingested(spark, sf_dir):
    files = table(spark, sf_dir, "events").select(F.concat(F.lit("f"), F.col("user_id") % 20).alias("file_name"), F.to_date("ts").cast("string").alias("modified"), "event_type")
    return scans.without_ingested(files, files.where("event_type = 'error'")).groupBy("file_name", "modified").agg(F.count("*").alias("n"))


@query("layer_inventory", """SELECT * FROM (SELECT 'customer' AS name, count(*) AS "rows", 1 AS place FROM customer UNION ALL SELECT 'orders', count(*), 2 FROM orders UNION ALL SELECT 'lineitem', count(*), 3 FROM lineitem UNION ALL SELECT 'absent', 0, 4)""", entities=False)
def layer_inventory(spark, sf_dir):
    return inventory(spark, {n: f"{sf_dir}/{n}.parquet" for n in ("customer", "orders", "lineitem", "absent")})


# --- Ingest and layers, over folders of their own in the shared place --------------------------------------------------------


def _folder(spark: SparkSession) -> str:
    """A new folder that all executors share; a local master may do without the setting."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        top = f"file:///tmp/lakeloom-checkpoints-{spark.sparkContext.applicationId}"
    return f"{top.rstrip('/')}/{uuid.uuid4().hex}"


def _written(spark: SparkSession, layer: str, name: str, df: DataFrame) -> DataFrame:
    """The table as its readers get it: views and dashboards read marts that were written."""
    store = TableStore(spark, _folder(spark))
    store.replace(layer, name, df)
    return store.read(layer, name)


_CSV = {"customer_id": "Customer ID", "customer_name": "Customer Name", "segment": "Segment", "region": "Region"}


def _land(rows: DataFrame, top: str, columns: list[str]) -> None:
    """Write rows as files of the landing folder, under the source's names."""
    rows.select(*[F.col(c).alias(_CSV[c]) for c in columns]).write.mode("append").option("header", True).csv(f"{top}/landing")


def _two_landings(spark, sf_dir, top: str) -> None:
    """Even customers, then the odd ones with their columns in another order and one missing, each read by one run of the stream."""
    c = Entities(spark, sf_dir).customers
    for i, columns in enumerate((["customer_id", "customer_name", "segment", "region"], ["region", "customer_name", "customer_id"])):
        _land(c.where(f"customer_id % 2 = {i}"), top, columns)
        ingest.ingest(spark, f"{top}/landing", f"{top}/raw", f"{top}/check", {}, f"run{i}", datetime.datetime(2024, 1, 1 + i))


@query("stream_ingest", """SELECT CAST(customer_id AS VARCHAR) AS customer_id, customer_name, CASE WHEN customer_id % 2 = 0 THEN segment END AS segment, region FROM customers""")
def stream_ingest(spark, sf_dir):
    _two_landings(spark, sf_dir, top := _folder(spark))
    return ingest.raw_table(spark, f"{top}/raw").select("customer_id", "customer_name", "segment", "region")


@query("ingest_metadata", """SELECT 'run' || (customer_id % 2) AS master_run_id, TIMESTAMP '2024-01-01' + to_days(CAST(customer_id % 2 AS INTEGER)) AS bronze_ingestion_ts, DATE '2024-01-01' + CAST(customer_id % 2 AS INTEGER) AS ingestion_date,
    count(*) AS n, count(*) AS with_file FROM customers GROUP BY 1, 2, 3""")  # fmt: skip
def ingest_metadata(spark, sf_dir):
    _two_landings(spark, sf_dir, top := _folder(spark))
    known = F.col("source_file_path").endswith(F.col("source_file_name")) & (F.col("source_file_size") > 0) & F.col("source_file_modified").isNotNull()
    return ingest.raw_table(spark, f"{top}/raw").groupBy("master_run_id", "bronze_ingestion_ts", "ingestion_date").agg(F.count("*").alias("n"), F.count_if(known).alias("with_file"))


@query("backfill_after_ingest", """SELECT CAST(customer_id AS VARCHAR) AS customer_id, customer_name, segment, region FROM customers""")
def backfill_after_ingest(spark, sf_dir):
    """Even customers by the stream, then the others by a backfill under the same run, and a second one of its window that finds nothing new."""
    top, today = _folder(spark), datetime.date.today()
    c = Entities(spark, sf_dir).customers
    _land(c.where("customer_id % 2 = 0"), top, list(_CSV))
    ingest.ingest(spark, f"{top}/landing", f"{top}/raw", f"{top}/check", {}, "run", datetime.datetime(2024, 1, 1))
    ingested = ingest.landed_files(spark, f"{top}/landing")
    ingested.write.parquet(f"{top}/known")
    _land(c.where("customer_id % 2 = 1"), top, list(_CSV))
    for _ in range(2):
        ingest.backfill(spark, f"{top}/landing", f"{top}/raw", f"{top}/check", {}, "run", today - datetime.timedelta(2), today + datetime.timedelta(2), spark.read.parquet(f"{top}/known"))
    return ingest.raw_table(spark, f"{top}/raw").select("customer_id", "customer_name", "segment", "region")


@query("rescued_rows", """SELECT region, count(*) AS n, count(*) FILTER (customer_id % 7 = 0) AS rescued FROM customers GROUP BY region""")
def rescued_rows(spark, sf_dir):
    """Every seventh line has a value too many for its header."""
    top = _folder(spark)
    c = Entities(spark, sf_dir).customers
    line = F.concat_ws(",", "customer_id", "region", F.when(F.col("customer_id") % 7 == 0, "one too many"))
    # A separator that does not occur, and no quotes: each line is written as it is.
    c.select(line.alias("Customer ID,Region")).write.option("header", True).option("sep", "\u0001").option("quote", "\u0000").csv(f"{top}/landing")
    ingest.ingest(spark, f"{top}/landing", f"{top}/raw", f"{top}/check", {}, "run", datetime.datetime(2024, 1, 1))
    rows = ingest.raw_table(spark, f"{top}/raw")
    region = F.coalesce("region", F.split_part(F.col(ingest.RESCUED), F.lit(","), F.lit(2)))
    return rows.groupBy(region.alias("region")).agg(F.count("*").alias("n"), F.count_if(F.col(ingest.RESCUED).isNotNull()).alias("rescued"))


@query("entity_projection", """SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line, l_suppkey AS supplier_id, 'run' AS master_run_id FROM lineitem""", entities=False)
def entity_projection(spark, sf_dir):
    """Columns renamed by the map or sanitised, then one entity's of them; the others stay behind."""
    raw = rename_columns(table(spark, sf_dir, "lineitem").toDF(*[f"{c[2:].title()} {i % 2}" for i, c in enumerate(table(spark, sf_dir, "lineitem").columns)]), {"Orderkey 0": "order_id", "Partkey 1": "product_id"})
    raw = raw.withColumnsRenamed({"linenumber_1": "line", "suppkey_0": "supplier_id"}).withColumn("master_run_id", F.lit("run"))
    return ingest.entity_rows(raw, ["order_id", "product_id", "line", "supplier_id"], ["master_run_id"])


@query("landing_files", """SELECT r_regionkey AS file, 'part.csv' AS kind, 1 AS known, 'HAS_WORK' AS scope, 'SOURCE_POPULATED' AS source FROM region WHERE r_regionkey > 0
    UNION ALL SELECT r_regionkey, 'part.csv', 0, 'HAS_WORK', 'SOURCE_POPULATED' FROM region WHERE r_regionkey = 0""", entities=False)  # fmt: skip
def landing_files(spark, sf_dir):
    """Files of the landing folder, which of them are known, and what the planners say of them. One file for each region."""
    top = _folder(spark)
    region = table(spark, sf_dir, "region")
    region.write.partitionBy("r_regionkey").option("header", True).csv(f"{top}/landing")
    files = ingest.landed_files(spark, f"{top}/landing/*")
    at = F.regexp_extract("path", r"r_regionkey=(\d+)", 1).cast("long")
    ingested = files.where(at > 0)
    left = scans.without_ingested(files.withColumn("file_name", F.col("path")), ingested.withColumn("file_name", F.col("path"))).select(F.col("path").alias("_left"))
    n, known = files.count(), ingested.count()
    rows = files.join(left, F.col("path") == F.col("_left"), "left")
    kind = F.when(F.col("file_name").endswith(".csv") & (F.col("size") > 0), "part.csv")
    return rows.select(at.alias("file"), kind.alias("kind"), F.col("_left").isNull().cast("int").alias("known"), F.lit(scans.backfill_scope(n, known)).alias("scope"), F.lit(scans.source_state(n, known)).alias("source"))


@query("plan_acquisition", """SELECT DISTINCT 'f' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || CASE WHEN c_custkey % 2 = 0 THEN '.csv' ELSE '.csv.gz' END AS name FROM customer WHERE c_custkey % 100 >= 40""", entities=False)
def plan_acquisition(spark, sf_dir):
    """Names of the source (a hundred) less those that have landed and those of other kinds."""
    k = F.col("c_custkey") % 100
    names = [r[0] for r in table(spark, sf_dir, "customer").select(F.concat(F.lit("f"), F.lpad(k.cast("string"), 2, "0"), F.when(k % 2 == 0, ".csv").otherwise(".csv.gz"))).distinct().collect()]
    listed = [*names, *[f"{n}.tmp" for n in names], "notes.txt"]
    return spark.createDataFrame([(n,) for n in scans.plan_acquisition(listed, [n for n in names if n < "f40"])], "name string")


@query("full_refresh_read", """SELECT event_type, count(*) AS n, max(ts) AS last_ts FROM events GROUP BY 1""", entities=False)
def full_refresh_read(spark, sf_dir):
    run = scans.RunConfig.of({"run_mode": "full_refresh"}, allow_full_refresh=True)
    return scans.read_for_run(table(spark, sf_dir, "events"), run, "ts", datetime.datetime(2024, 1, 20)).groupBy("event_type").agg(F.count("*").alias("n"), F.max("ts").alias("last_ts"))


_AT = datetime.datetime(2024, 1, 1)


def _bronze(spark, sf_dir) -> TableStore:
    store = TableStore(spark, _folder(spark), buckets=8)
    store.bootstrap()
    store.replace("bronze", "orders", raw_orders(Entities(spark, sf_dir)).withColumn("bronze_ingestion_ts", F.lit(_AT)))
    return store


def _silver(spark, sf_dir) -> TableStore:
    store = _bronze(spark, sf_dir)
    medallion.silver(store, ORDER_RULES, scans.RunConfig.of({}), "run", _AT)
    return store


@query("silver_orders", f""", {_ASSESSED} SELECT order_id, customer_id, od AS order_date, CAST(ship_date AS DATE) AS ship_date, ship_mode FROM named WHERE len(errors) = 0""")
def silver_orders(spark, sf_dir):
    return _silver(spark, sf_dir).read("silver", "orders").select("order_id", "customer_id", "order_date", "ship_date", "ship_mode")


@query("silver_quarantine", f""", {_ASSESSED} SELECT n, order_date, ship_date, array_to_string(errors, ',') AS errors, 'run' AS master_run_id FROM named WHERE len(errors) > 0""")
def silver_quarantine(spark, sf_dir):
    return _silver(spark, sf_dir).read("quarantine", "orders_dirty").select("n", "order_date", "ship_date", F.array_join("error_columns", ",").alias("errors"), "master_run_id")


@query("silver_reconciled", f""", {_ASSESSED} SELECT 'orders' AS entity, count(*) AS bronze_rows, count(*) FILTER (len(errors) = 0) AS silver_rows, count(*) FILTER (len(errors) > 0) AS quarantine_rows, CAST(0 AS BIGINT) AS audit_rows,
    CAST(0 AS BIGINT) AS superseded_rows, count(*) AS accounted_rows, true AS balanced FROM named""")  # fmt: skip
def silver_reconciled(spark, sf_dir):
    return medallion.reconcile(_silver(spark, sf_dir), ORDER_RULES)


@query("silver_metrics", f""", {_ASSESSED} SELECT 'SILVER' AS layer, 'orders' AS entity, 'incremental' AS run_mode, 'INITIAL_LOAD' AS load_type, 'SUCCESS' AS run_status, count(*) AS rows_read, count(*) FILTER (len(errors) = 0) AS inserted_rows, CAST(0 AS BIGINT) AS updated_rows,
        count(*) FILTER (len(errors) > 0) AS unchanged_rows, count(*) FILTER (len(errors) > 0) AS quarantined_rows, CAST(0 AS BIGINT) AS duplicate_rows FROM named
    UNION ALL SELECT 'SILVER', 'orders', 'incremental', 'NO_DATA', 'SKIPPED', 0, 0, 0, 0, 0, 0""")  # fmt: skip
def silver_metrics(spark, sf_dir):
    """The metrics of a run, and of a second one that finds nothing."""
    store = _silver(spark, sf_dir)
    medallion.silver(store, ORDER_RULES, scans.RunConfig.of({}), "run2", _AT)
    return store.read("metrics", "etl_run_metrics").select("layer", "entity", "run_mode", "load_type", "run_status", "rows_read", "inserted_rows", "updated_rows", "unchanged_rows", "quarantined_rows", "duplicate_rows")


class _Stopped(TableStore):
    """A store whose write number `stop` fails."""

    stop = 0

    def _commit(self, *args, **about) -> None:
        self.stop -= 1
        if self.stop == 0:
            raise OSError("stopped")
        super()._commit(*args, **about)


@query("silver_rerun", f""", {_ASSESSED}, k AS (SELECT unnest(range(1, 9)) AS stopped_at)
    SELECT stopped_at, 2 * count(*) AS bronze_rows, count(*) FILTER (len(errors) = 0) AS silver_rows, 2 * count(*) FILTER (len(errors) > 0) AS quarantine_rows, count(*) FILTER (len(errors) = 0) AS audit_rows, true AS balanced FROM named, k GROUP BY 1""")  # fmt: skip
def silver_rerun(spark, sf_dir):
    """Silver of orders that all came twice, stopped at each of its writes in turn and run again."""
    rows, out = raw_orders(Entities(spark, sf_dir)).withColumn("bronze_ingestion_ts", F.lit(_AT)), None
    rows = _written(spark, "bronze", "orders", rows.unionByName(rows.withColumn("bronze_ingestion_ts", F.lit(_AT + datetime.timedelta(hours=1)))))
    for k in range(1, 9):
        store = _Stopped(spark, _folder(spark), buckets=4)
        store.replace("bronze", "orders", rows)
        store.stop = k
        try:
            medallion.silver(store, ORDER_RULES, scans.RunConfig.of({}), "run", _AT)
        except OSError:
            medallion.silver(store, ORDER_RULES, scans.RunConfig.of({}), "run", _AT)
        found = medallion.reconcile(store, ORDER_RULES).select(F.lit(k).cast("long").alias("stopped_at"), "bronze_rows", "silver_rows", "quarantine_rows", "audit_rows", "balanced")
        out = found if out is None else out.unionByName(found)
    return out


CUSTOMER_RULES = rules.EntityRules(name="customers", keys=("customer_id",), columns=("customer_id", "customer_name", "segment", "region"), severity={"segment": rules.REPAIRABLE, "region": rules.REPAIRABLE})


def _gold(spark, sf_dir) -> TableStore:
    """Customers in two batches: all, then those of the first segment again with another region. Silver, dimension and fact take up what is new."""
    store, c = TableStore(spark, _folder(spark), buckets=8), Entities(spark, sf_dir).customers.drop("country")
    moved = c.where("segment = 'BUILDING'").withColumn("region", F.lit("MOVED"))
    for i, rows in enumerate((c, moved)):
        at, run = _AT + datetime.timedelta(days=i), f"run{i}"
        store.append("bronze", "customers", rows.withColumn("bronze_ingestion_ts", F.lit(at)))
        medallion.silver(store, CUSTOMER_RULES, scans.RunConfig.of({}), run, at)
        for _ in range(2):  # the second time finds nothing new
            medallion.load_dimension(store, "customers", "customers", ["customer_id"], ["customer_name", "segment", "region"], scans.RunConfig.of({}), run, at)
            medallion.load_fact(store, "homes", "customers", ["customer_id"], ["customer_id", "region"], scans.RunConfig.of({}), run, at)
    return store


@query("gold_dimension", """SELECT customer_id, segment, region, TIMESTAMP '2024-01-01' AS effective_from, CASE WHEN segment = 'BUILDING' THEN TIMESTAMP '2024-01-01 23:59:59' END AS effective_to, segment <> 'BUILDING' AS is_current FROM customers
    UNION ALL SELECT customer_id, segment, 'MOVED', TIMESTAMP '2024-01-02', NULL, true FROM customers WHERE segment = 'BUILDING'""")  # fmt: skip
def gold_dimension(spark, sf_dir):
    return _gold(spark, sf_dir).read("gold", "dim_customers").select("customer_id", "segment", "region", "effective_from", "effective_to", "is_current")


@query("gold_fact", """SELECT customer_id, CASE WHEN segment = 'BUILDING' THEN 'MOVED' ELSE region END AS region, CASE WHEN segment = 'BUILDING' THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-01' END AS gold_ingestion_ts FROM customers""")
def gold_fact(spark, sf_dir):
    return _gold(spark, sf_dir).read("gold", "facts_homes").select("customer_id", "region", "gold_ingestion_ts")


@query("run_reliability", """, n AS (SELECT count(*) AS n, count(*) FILTER (segment = 'BUILDING') AS m FROM customers)
    SELECT 'SILVER' AS layer, 'customers' AS entity, CAST(2 AS BIGINT) AS runs, CAST(0 AS BIGINT) AS failed, CAST(0 AS BIGINT) AS skipped, 100.0::DOUBLE AS success_pct, CAST(n + m AS BIGINT) AS rows_read FROM n
    UNION ALL SELECT 'GOLD', e, 4, 0, 2, 100.0, CAST(n + m AS BIGINT) FROM n, (VALUES ('dim_customers'), ('facts_homes')) AS t(e)""")  # fmt: skip
def run_reliability(spark, sf_dir):
    return kpi.reliability(_gold(spark, sf_dir).read("metrics", "etl_run_metrics")).drop("avg_seconds")


@query("run_history", """, n AS (SELECT count(*) AS n, count(*) FILTER (segment = 'BUILDING') AS m FROM customers)
    SELECT run AS master_run_id, layer, CAST(CASE layer WHEN 'GOLD' THEN 4 ELSE 1 END AS BIGINT) AS entities, CAST(CASE run WHEN 'run0' THEN n ELSE m END * CASE layer WHEN 'GOLD' THEN 2 ELSE 1 END AS BIGINT) AS rows_read, 'SUCCESS' AS status
    FROM n, (VALUES ('run0'), ('run1')) AS r(run), (VALUES ('SILVER'), ('GOLD')) AS l(layer)""")  # fmt: skip
def run_history(spark, sf_dir):
    return kpi.run_history(_gold(spark, sf_dir).read("metrics", "etl_run_metrics")).drop("seconds")


@query("reconciliation_checks", f""", {_ASSESSED} SELECT 'reconciliation' AS check_name, 'orders' AS subject, CAST(count(*) AS DOUBLE) AS observed_value, CAST(count(*) AS DOUBLE) AS expected_value, true AS passed FROM named""")
def reconciliation_checks(spark, sf_dir):
    store = _silver(spark, sf_dir)
    medallion.run_reconciliation_checks(store, [ORDER_RULES], "run", "dev", _AT)
    return store.read("metrics", "data_quality_checks").select("check_name", "subject", "observed_value", "expected_value", "passed")


@query("dashboard_row_flow", f""", {_ASSESSED}, c AS (SELECT count(*) FILTER (len(errors) = 0) AS good, count(*) FILTER (len(errors) > 0) AS bad FROM named)
    SELECT 'orders' AS entity, 'bronze' AS source, target, CAST(CASE target WHEN 'silver' THEN good WHEN 'quarantine' THEN bad ELSE 0 END AS BIGINT) AS n FROM c, (VALUES ('silver'), ('quarantine'), ('duplicates'), ('superseded')) AS t(target)""")  # fmt: skip
def dashboard_row_flow(spark, sf_dir):
    store = _silver(spark, sf_dir)
    medallion.run_reconciliation_checks(store, [ORDER_RULES], "run", "dev", _AT)
    return kpi.row_flow(store.read("metrics", "data_quality_checks"))


@query("recorded_drift", """SELECT * FROM (VALUES ('o_orderstatus', 'NEW'), ('o_priority', 'MISSING'), ('o_totalprice', 'IGNORED')) AS t(column_name, drift_status)""", entities=False)
def recorded_drift(spark, sf_dir):
    """Drift of a table against the columns that two entities declare, as it is recorded."""
    store = TableStore(spark, _folder(spark))
    declared = {"orders": ["o_orderkey", "o_orderdate", "o_priority"], "customers": ["o_custkey", "o_orderpriority"]}
    medallion.record_drift(store, table(spark, sf_dir, "orders"), declared, ["o_totalprice"], "run", "dev", _AT)
    return store.read("metrics", "schema_drift").select("column_name", "drift_status")


# --- Tables of the store ------------------------------------------------------------------------------------------------------


@query("table_append", """SELECT r_regionkey AS id, r_name AS name, NULL AS note FROM region UNION ALL SELECT n_nationkey, n_name, 'later' FROM nation""", entities=False)
def table_append(spark, sf_dir):
    """An append with a column that the table had not."""
    store = TableStore(spark, _folder(spark))
    store.append("gold", "places", table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("id"), F.col("r_name").alias("name")))
    store.append("gold", "places", table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"), F.lit("later").alias("note")))
    return store.read("gold", "places")


@query("table_layout", """SELECT * FROM (VALUES (1, 'bootstrap', '9'), (2, 'bootstrap again', '0'), (3, 'create', '0'), (4, 'converge', 'ALTER_CLUSTER_BY'), (5, 'converge again', 'NOTHING'), (6, 'missing', 'missing columns: nothing'), (7, 'views', 'many')) AS t(step, what, said)""", entities=False)
def table_layout(spark, sf_dir):
    """What the store says of its folders, an empty table of a schema, its clustering, and views kept for other sessions."""
    store, said = TableStore(spark, _folder(spark)), []
    said += [("bootstrap", len(store.bootstrap())), ("bootstrap again", len(store.bootstrap()))]
    store.create("gold", "orders", table(spark, sf_dir, "orders").schema)
    said.append(("create", store.read("gold", "orders").count()))
    store.append("gold", "orders", table(spark, sf_dir, "orders"))
    said += [("converge", store.converge("gold", "orders", ("o_orderkey",), allow_rewrite=True)), ("converge again", store.converge("gold", "orders", ("o_orderkey",)))]
    try:
        store.converge("gold", "orders", ("nothing",))
    except ValueError as e:
        said.append(("missing", e))
    store.define_view("many", "SELECT count(*) AS n FROM gold__orders")
    said.append(("views", ",".join(v for v in store.open_views() if spark.table(v).first()[0] == table(spark, sf_dir, "orders").count())))
    return spark.createDataFrame([(i, what, str(x)) for i, (what, x) in enumerate(said, 1)], "step int, what string, said string")


@query("snapshot_upsert", """SELECT 'run' || (event_id // 1000) AS master_run_id, max(event_id) AS last_event FROM events GROUP BY 1""", entities=False)
def snapshot_upsert(spark, sf_dir):
    """Snapshots of runs, each recorded twice: the second one replaces the first."""
    store = TableStore(spark, _folder(spark), buckets=4)
    rows = table(spark, sf_dir, "events").groupBy(F.concat(F.lit("run"), F.floor(F.col("event_id") / 1000)).alias("master_run_id")).agg(F.min("event_id").alias("last_event"), F.max("event_id").alias("_last"))
    store.create("metrics", "snapshots", rows.drop("_last").schema)
    for column in ("last_event", "_last"):
        medallion.upsert(store, "metrics", "snapshots", rows.select("master_run_id", F.col(column).alias("last_event")), ["master_run_id"])
    return store.read("metrics", "snapshots")


@query("feature_history", """, d AS (SELECT today - 30 AS day, 0 AS again FROM as_of UNION ALL SELECT today, 0 FROM as_of)
    SELECT customer_id, product_id, day AS feature_date, count(DISTINCT order_id) FILTER (order_date >= day - 30) AS orders_last_30d FROM f_sales JOIN f_orders USING (order_id), d GROUP BY 1, 2, 3""")  # fmt: skip
def feature_history(spark, sf_dir):
    """Features of two dates, the last one recorded twice: a row for each key and date."""
    e = Entities(spark, sf_dir)
    store = TableStore(spark, _folder(spark), buckets=8)
    for day in (e.today - datetime.timedelta(30), e.today, e.today):
        rows = features.customer_product(e.bare_orders, e.sales, day).select("customer_id", "product_id", F.lit(day).alias("feature_date"), "orders_last_30d")
        medallion.record_features(store, "customer_product", rows, ["customer_id", "product_id"])
    return store.read("features", "customer_product")


# --- Observation ------------------------------------------------------------------------------------------------------------


@query("substitute_placeholder", """SELECT customer_id, CASE WHEN customer_id % 53 = 0 OR segment = 'MACHINERY' THEN 'Unknown' ELSE segment END AS segment, CASE WHEN customer_id % 41 = 0 THEN 'Unknown' ELSE region END AS region FROM customers""")
def substitute_placeholder(spark, sf_dir):
    return _placeholders(spark, sf_dir).select("customer_id", "segment", "region")


def _placeholders(spark, sf_dir):
    c = Entities(spark, sf_dir).customers
    rows = c.withColumns({
        "segment": F.when(F.col("customer_id") % 53 != 0, F.col("segment")), "region": F.when(F.col("customer_id") % 41 != 0, F.col("region")),
        "repaired_columns": F.when(F.col("segment") == "MACHINERY", F.array(F.lit("segment"))).otherwise(F.array().cast("array<string>")),
    })
    return observe.substitute_untrusted(rows, ["segment", "region"])


@query("placeholder_exposure", """, p AS (SELECT count(*) AS n, count(*) FILTER (customer_id % 53 = 0 OR segment = 'MACHINERY' OR customer_id % 41 = 0) AS k FROM customers)
    SELECT n AS total_rows, k AS placeholder_rows, CAST(round(CAST(k * 100.0 AS DOUBLE) / n, 4) AS DOUBLE) AS placeholder_pct FROM p""")  # fmt: skip
def placeholder_exposure(spark, sf_dir):
    return observe.placeholder_exposure(_placeholders(spark, sf_dir), ["segment", "region"])


@query("orphans", """SELECT order_id, product_id, line, supplier_id FROM f_sales WHERE product_id % 101 = 0""")
def orphans(spark, sf_dir):
    e = Entities(spark, sf_dir)
    dim = e.products.withColumn("is_current", F.col("product_id") % 101 != 0)
    return observe.orphans(e.sales.select("order_id", "product_id", "line", "supplier_id"), dim, "product_id")


@query("reconcile", """, b AS (SELECT CASE WHEN product_id % 97 = 0 THEN NULL ELSE order_id END AS order_id, product_id, quantity, line, supplier_id FROM f_sales),
    q AS (SELECT * FROM b WHERE order_id IS NULL OR quantity > 48),
    good AS (SELECT *, row_number() OVER (PARTITION BY order_id, product_id ORDER BY line DESC, supplier_id DESC, quantity DESC) AS n FROM b WHERE NOT (order_id IS NULL OR quantity > 48)),
    c AS (SELECT (SELECT count(*) FROM b) AS bronze_rows, (SELECT count(*) FROM good WHERE n = 1) AS silver_rows, (SELECT count(*) FROM q) AS quarantine_rows, (SELECT count(*) FROM good WHERE n > 1 AND line > 2) AS audit_rows,
        (SELECT coalesce(sum(a - 1), 0) FROM (SELECT count(*) AS a FROM good GROUP BY order_id, product_id)) AS extra)
    SELECT 'sales' AS entity, bronze_rows, silver_rows, quarantine_rows, audit_rows, CAST(extra - audit_rows AS BIGINT) AS superseded_rows, CAST(silver_rows + quarantine_rows + extra AS BIGINT) AS accounted_rows,
        silver_rows + quarantine_rows + extra = bronze_rows AND extra >= audit_rows AS balanced FROM c""")  # fmt: skip
def reconcile(spark, sf_dir):
    b = Entities(spark, sf_dir).sales.select(F.when(F.col("product_id") % 97 != 0, F.col("order_id")).alias("order_id"), "product_id", "quantity", "line", "supplier_id")
    bad = F.col("order_id").isNull() | (F.col("quantity") > 48)
    winners, losers = dedup.deduplicate(b.where(~bad), ["order_id", "product_id"], "line")
    return observe.reconcile("sales", b, winners, b.where(bad), losers.where("line > 2"), ["order_id", "product_id"])


@query("file_metrics", """WITH f AS (SELECT user_id % 20 AS f, 1000 + 10 * (user_id % 20) AS size, max(ts) AS seen, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT count(*) AS n_files, CAST(sum(size) AS BIGINT) AS total_bytes, CAST(sum(n) AS BIGINT) AS rows_read, min(seen) AS first_file_at, max(seen) AS last_file_at,
        round(CAST(max(size) AS DOUBLE) / avg(size), 2) AS file_skew_ratio, round(CAST(sum(n) AS DOUBLE) / 8.0, 2) AS throughput_rows_per_sec FROM f""", entities=False)  # fmt: skip
def file_metrics(spark, sf_dir):
    k = F.col("user_id") % 20
    rows = table(spark, sf_dir, "events").select(k.cast("string").alias("file_path"), (1000 + 10 * k).alias("file_size"), F.col("ts").alias("file_modification_time"))
    return observe.file_metrics(rows, 8.0)


@query("skew_stats", """WITH p AS (SELECT (l_orderkey * l_linenumber) % 8 AS part, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT count(*) AS partitions, CAST(sum(n) AS BIGINT) AS "rows", round(CAST(max(n) AS DOUBLE) / avg(n), 2) AS skew_ratio FROM p""", entities=False)  # fmt: skip
def skew_stats(spark, sf_dir):
    """Rows dealt by a number, so that the partitions are known."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return observe.partition_skew(rows.repartitionById(8, (F.col("l_orderkey") * F.col("l_linenumber") % 8).cast("int")))


@query("schema_drift", """SELECT * FROM (VALUES ('o_extra', 'NEW'), ('o_gone', 'MISSING'), ('o_orderpriority', 'IGNORED')) AS t(column_name, drift_status)""", entities=False)
def schema_drift(spark, sf_dir):
    seen = [*table(spark, sf_dir, "orders").columns, "o_extra"]
    drift = observe.detect_drift(seen, [c for c in seen if c not in ("o_extra", "o_orderpriority")] + ["o_gone"], ["o_orderpriority"])
    return spark.createDataFrame(observe.drift_rows("r", "t", drift, None), observe.DRIFT_SCHEMA).select("column_name", "drift_status")


# --- Marts ------------------------------------------------------------------------------------------------------------------

_C360 = """c360 AS (
    SELECT c.customer_id, customer_name, segment, region, CAST(sum(sales) AS DOUBLE) AS total_sales, CAST(sum(profit) AS DOUBLE) AS total_profit, count(DISTINCT o.order_id) AS total_orders,
        round(CAST(sum(sales) AS DOUBLE) / nullif(CAST(count(DISTINCT o.order_id) AS DOUBLE), 0), 2) AS avg_order_value, max(order_date) AS last_order_date,
        CAST((SELECT today FROM as_of) - max(order_date) AS INT) AS recency_days, CAST(max(order_date) - min(order_date) AS INT) AS customer_lifetime_days,
        CAST(sum(discount) AS DOUBLE) / nullif(count(discount), 0) AS discount_sensitivity, CASE WHEN sum(profit) > 0 THEN 1 ELSE 0 END AS profitability_flag
    FROM (SELECT customer_id, customer_name, segment, region FROM customers UNION ALL SELECT -1 - n_nationkey, 'Prospect of ' || n_name, 'PROSPECT', r_name FROM nation JOIN region ON n_regionkey = r_regionkey) c
    LEFT JOIN f_orders o ON c.customer_id = o.customer_id LEFT JOIN f_sales s ON o.order_id = s.order_id
    GROUP BY c.customer_id, customer_name, segment, region)"""


def _c360(e: Entities) -> DataFrame:
    """The mart over all customers, and one more without orders for each nation."""
    n = e.nations
    prospects = n.select((-1 - F.col("n_nationkey")).cast("long").alias("customer_id"), F.concat(F.lit("Prospect of "), "n_name").alias("customer_name"), F.lit("PROSPECT").alias("segment"), F.col("r_name").alias("region"))
    return marts.customer_360(e.customers.drop("country").unionByName(prospects), e.bare_orders, e.sales, e.today)


@query("mart_customer_360", f", {_C360} SELECT * FROM c360")
def mart_customer_360(spark, sf_dir):
    return _c360(Entities(spark, sf_dir))


_PERF = """perf AS (
    SELECT *, round(total_profit / nullif(total_sales, 0), 4) AS profit_margin, CASE WHEN days = 0 THEN CAST(total_quantity AS DOUBLE) ELSE round(CAST(total_quantity AS DOUBLE) / nullif(CAST(days AS DOUBLE), 0), 2) END AS sales_velocity,
        CASE WHEN total_profit < 0 THEN 1 ELSE 0 END AS loss_making_flag
    FROM (SELECT p.product_id, product_name, category, sub_category, CAST(sum(sales) AS DOUBLE) AS total_sales, CAST(sum(profit) AS DOUBLE) AS total_profit, CAST(sum(quantity) AS BIGINT) AS total_quantity,
            CAST(sum(discount) AS DOUBLE) / nullif(count(discount), 0) AS avg_discount, max(order_date) - min(order_date) AS days
        FROM (SELECT * FROM products UNION ALL SELECT -1 - n_nationkey, 'Unsold of ' || n_name, 'UNSOLD', 'none' FROM nation) p LEFT JOIN f_sales s ON p.product_id = s.product_id LEFT JOIN f_orders o ON s.order_id = o.order_id GROUP BY p.product_id, product_name, category, sub_category))"""


def _perf(e: Entities) -> DataFrame:
    """The mart over all products, and one more without sales for each nation."""
    unsold = e.nations.select((-1 - F.col("n_nationkey")).cast("long").alias("product_id"), F.concat(F.lit("Unsold of "), "n_name").alias("product_name"), F.lit("UNSOLD").alias("category"), F.lit("none").alias("sub_category"))
    return marts.product_performance(e.products.unionByName(unsold), e.bare_orders, e.sales)


@query("mart_product_performance", f", {_PERF} SELECT * EXCLUDE (days) FROM perf")
def mart_product_performance(spark, sf_dir):
    return _perf(Entities(spark, sf_dir))


_DAILY = """mart AS (
    SELECT order_date, o.customer_id, s.product_id, region, segment, category, sub_category, ship_mode, CAST(sum(sales) AS DOUBLE) AS total_sales, CAST(sum(profit) AS DOUBLE) AS total_profit,
        CAST(sum(quantity) AS BIGINT) AS total_quantity, CAST(sum(discount) AS DOUBLE) / count(discount) AS avg_discount, count(DISTINCT o.order_id) AS order_count,
        round(CAST(sum(profit) AS DOUBLE) / nullif(CAST(sum(sales) AS DOUBLE), 0), 4) AS profit_margin
    FROM f_orders o JOIN f_sales s ON o.order_id = s.order_id JOIN customers c ON o.customer_id = c.customer_id JOIN products p ON s.product_id = p.product_id GROUP BY ALL)"""


def _daily(e: Entities) -> DataFrame:
    return marts.sales_daily(e.customers, e.products, e.bare_orders, e.sales)


@query("mart_sales_daily", f", {_DAILY} SELECT * FROM mart")
def mart_sales_daily(spark, sf_dir):
    return _daily(Entities(spark, sf_dir))


# --- Features ---------------------------------------------------------------------------------------------------------------


@query("features_customer", """, po AS (SELECT order_id, CAST(sum(sales) AS DECIMAL(18,2)) AS s, CAST(sum(profit) AS DECIMAL(18,2)) AS p, CAST(sum(discount) AS DOUBLE) / count(discount) AS d FROM f_sales GROUP BY order_id),
    co AS (SELECT o.customer_id, order_date, s, p, d FROM f_orders o JOIN po USING (order_id)),
    a AS (SELECT customer_id, CAST((SELECT today FROM as_of) - max(order_date) AS INT) AS recency_days,
        count(*) FILTER (order_date >= (SELECT today FROM as_of) - 30) AS order_frequency_30days, count(*) FILTER (order_date >= (SELECT today FROM as_of) - 90) AS order_frequency_90days,
        CAST(coalesce(sum(s) FILTER (order_date >= (SELECT today FROM as_of) - 30), 0) AS DOUBLE) AS monetary_30days, CAST(coalesce(sum(s) FILTER (order_date >= (SELECT today FROM as_of) - 90), 0) AS DOUBLE) AS monetary_90days,
        round(avg(d), 6) AS avg_discount, coalesce(round(CAST(sum(p) AS DOUBLE) / nullif(CAST(sum(s) AS DOUBLE), 0), 4), 0) AS profit_margin,
        coalesce(round(CASE WHEN count(s) > 1 THEN (CAST(sum(CAST(s * s AS DECIMAL(38,4))) AS DOUBLE) - CAST(sum(s) AS DOUBLE) * CAST(sum(s) AS DOUBLE) / count(s)) / (count(s) - 1) END, 2), 0) AS order_variance
        FROM co GROUP BY customer_id)
    SELECT a.*, (SELECT today FROM as_of) AS feature_date, CAST(dense_rank() OVER (ORDER BY segment) AS INT) AS segment_encoded, CAST(dense_rank() OVER (ORDER BY region) AS INT) AS region_encoded
    FROM a JOIN customers USING (customer_id)""")  # fmt: skip
def features_customer(spark, sf_dir):
    e = Entities(spark, sf_dir)
    return features.customer(e.customers, e.bare_orders, e.sales, e.today)


@query("features_product", """, f AS (SELECT s.*, order_date, (SELECT today FROM as_of) AS today FROM f_sales s JOIN f_orders o USING (order_id)),
    m AS (SELECT product_id, month(order_date) AS mo, CAST(sum(sales) AS DOUBLE) / count(sales) AS x FROM f GROUP BY 1, 2),
    se AS (SELECT product_id, round(avg(x) / nullif(avg(x), 0), 2) AS seasonality_index FROM m GROUP BY 1)
    SELECT product_id, any_value(today) AS feature_date, CAST(coalesce(sum(sales) FILTER (order_date >= today - 7), 0) AS DOUBLE) AS sales_last_7days, CAST(coalesce(sum(sales) FILTER (order_date >= today - 30), 0) AS DOUBLE) AS sales_last_30days,
        coalesce(round((CAST(coalesce(sum(sales) FILTER (order_date >= today - 7), 0) AS DOUBLE) / 7.0) / nullif(CAST(coalesce(sum(sales) FILTER (order_date >= today - 30), 0) AS DOUBLE) / 30.0, 0), 2), 0) AS sales_trend,
        round(CAST(sum(discount) AS DOUBLE) / count(discount) * 100, 2) AS discount_sensitivity,
        round(CASE WHEN count(profit) > 1 THEN (CAST(sum(CAST(profit * profit AS DECIMAL(38,4))) AS DOUBLE) - CAST(sum(profit) AS DOUBLE) * CAST(sum(profit) AS DOUBLE) / count(profit)) / (count(profit) - 1) END, 2) AS profit_volatility,
        any_value(seasonality_index) AS seasonality_index
    FROM f JOIN se USING (product_id) GROUP BY product_id""")  # fmt: skip
def features_product(spark, sf_dir):
    e = Entities(spark, sf_dir)
    return features.product(e.bare_orders, e.sales, e.today)


@query("features_sales_timeseries", """, f AS (SELECT s.*, order_date FROM f_sales s JOIN f_orders o USING (order_id)),
    w AS (SELECT order_date, product_id, CAST(lag(sales, 7) OVER k AS DOUBLE) AS lag_7_sales, CAST(lag(sales, 30) OVER k AS DOUBLE) AS lag_30_sales,
        round(CAST(sum(sales) OVER (k ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS DOUBLE) / nullif(count(sales) OVER (k ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0), 6) AS rolling_avg_7,
        round(CAST(sum(sales) OVER (k ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS DOUBLE) / nullif(count(sales) OVER (k ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), 0), 6) AS rolling_avg_30,
        CAST(dayofweek(order_date) + 1 AS INT) AS day_of_week, CAST(month(order_date) AS INT) AS month, coalesce(lag(order_date) OVER k <> order_date, true) AS first
        FROM f WINDOW k AS (PARTITION BY product_id ORDER BY order_date, order_id, line, supplier_id, sales))
    SELECT * EXCLUDE (first) FROM w WHERE first""")  # fmt: skip
def features_sales_timeseries(spark, sf_dir):
    e = Entities(spark, sf_dir)
    return features.sales_timeseries(e.bare_orders, e.sales, ("order_id", "line", "supplier_id", "sales"))


@query("features_customer_product", """SELECT customer_id, product_id, count(DISTINCT order_id) AS purchase_count, CAST(sum(sales) AS DOUBLE) AS total_spent, CAST(sum(profit) AS DOUBLE) AS total_profit, max(order_date) AS last_purchase_date,
    CAST((SELECT today FROM as_of) - max(order_date) AS INT) AS days_since_last_purchase, CAST(sum(sales) AS DOUBLE) / count(sales) AS avg_sales_per_order,
    count(DISTINCT CASE WHEN order_date >= (SELECT today FROM as_of) - 30 THEN order_id END) AS orders_last_30d FROM f_sales JOIN f_orders USING (order_id) GROUP BY 1, 2""")  # fmt: skip
def features_customer_product(spark, sf_dir):
    e = Entities(spark, sf_dir)
    return features.customer_product(e.bare_orders, e.sales, e.today)


# --- KPI views, snapshot, dashboards ----------------------------------------------------------------------------------------

_CKPI = """ckpi AS (
    SELECT c360.* EXCLUDE (last_order_date), CAST(rank() OVER (ORDER BY total_sales DESC NULLS LAST) AS INT) AS overall_sales_rank, CAST(rank() OVER (PARTITION BY region ORDER BY total_sales DESC NULLS LAST) AS INT) AS region_sales_rank,
        CAST(rank() OVER (PARTITION BY segment ORDER BY total_sales DESC NULLS LAST) AS INT) AS segment_sales_rank, region_sales, region_profit, region_total_customers, segment_sales, segment_profit, segment_total_customers, avg_recency, avg_lifetime
    FROM c360
    LEFT JOIN (SELECT region, CAST(sum(CAST(total_sales AS DECIMAL(22,2))) AS DOUBLE) AS region_sales, CAST(sum(CAST(total_profit AS DECIMAL(22,2))) AS DOUBLE) AS region_profit, count(DISTINCT customer_id) AS region_total_customers FROM c360 GROUP BY 1) USING (region)
    LEFT JOIN (SELECT segment, CAST(sum(CAST(total_sales AS DECIMAL(22,2))) AS DOUBLE) AS segment_sales, CAST(sum(CAST(total_profit AS DECIMAL(22,2))) AS DOUBLE) AS segment_profit, count(customer_id) AS segment_total_customers,
        avg(recency_days) AS avg_recency, avg(customer_lifetime_days) AS avg_lifetime FROM c360 GROUP BY 1) USING (segment))"""


@query("customer_kpi", f", {_C360}, {_CKPI} SELECT * FROM ckpi")
def customer_kpi(spark, sf_dir):
    return kpi.customer_kpi(_written(spark, "mart", "customer_360", _c360(Entities(spark, sf_dir))))


@query("product_insights_kpi", f""", {_PERF} SELECT product_id, product_name, category, sub_category, total_sales, total_profit, profit_margin, sales_velocity, total_quantity, loss_making_flag,
    CAST(rank() OVER (PARTITION BY category ORDER BY total_sales DESC NULLS LAST) AS INT) AS top_in_category_rank, CAST(rank() OVER (PARTITION BY category ORDER BY total_sales ASC NULLS FIRST) AS INT) AS bottom_in_category_rank,
    round(total_sales / nullif(cs, 0) * 100, 2) AS sales_contribution_pct, round(total_quantity / nullif(cq, 0) * 100, 2) AS quantity_contribution_pct, cm AS category_avg_margin
    FROM perf LEFT JOIN (SELECT category, CAST(sum(CAST(total_sales AS DECIMAL(22,2))) AS DOUBLE) AS cs, CAST(sum(total_quantity) AS DOUBLE) AS cq, CAST(sum(CAST(profit_margin AS DECIMAL(22,4))) AS DOUBLE) / count(profit_margin) AS cm FROM perf GROUP BY 1) USING (category)""")  # fmt: skip
def product_insights_kpi(spark, sf_dir):
    return kpi.product_insights(_written(spark, "mart", "product_performance", _perf(Entities(spark, sf_dir))))


_DKPI = """dkpi AS (SELECT order_date, s AS total_sales, p AS total_profit, round(p / nullif(s, 0), 4) AS profit_margin
    FROM (SELECT order_date, CAST(sum(CAST(total_sales AS DECIMAL(22,2))) AS DOUBLE) AS s, CAST(sum(CAST(total_profit AS DECIMAL(22,2))) AS DOUBLE) AS p FROM mart GROUP BY 1))"""


@query("metrics_daily_kpi", f", {_DAILY}, {_DKPI} SELECT * FROM dkpi")
def metrics_daily_kpi(spark, sf_dir):
    return kpi.daily(_daily(Entities(spark, sf_dir)))


@query("metrics_daily_ordered", f", {_DAILY}, {_DKPI} SELECT * FROM dkpi ORDER BY order_date")
def metrics_daily_ordered(spark, sf_dir):
    return kpi.daily_ordered(_daily(Entities(spark, sf_dir)))


@query("metrics_business_kpi", f""", {_DAILY}, {_DKPI},
    d AS (SELECT order_date, round(CAST(sum(CAST(avg_discount AS DECIMAL(22,10))) AS DOUBLE) / count(avg_discount), 8) AS x FROM mart GROUP BY 1),
    v AS (SELECT customer_id, order_date, lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date) AS prev FROM (SELECT DISTINCT customer_id, order_date FROM mart)),
    g AS (SELECT order_date, count(*) AS n, count(*) FILTER (prev IS NULL) AS fresh, count(*) FILTER (prev >= order_date - 30) AS again FROM v GROUP BY 1),
    k AS (SELECT *, sum(fresh) OVER (ORDER BY order_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known FROM g),
    t AS (SELECT order_date, CAST(sum(CAST(total_sales AS DECIMAL(22,2))) AS DOUBLE) AS top FROM (SELECT *, row_number() OVER (PARTITION BY order_date ORDER BY total_sales DESC NULLS LAST, customer_id, product_id, ship_mode) AS n FROM mart) WHERE n <= 10 GROUP BY 1)
    SELECT order_date AS metric_date, 'total_sales' AS metric_name, total_sales AS metric_value FROM dkpi UNION ALL SELECT order_date, 'total_profit', total_profit FROM dkpi UNION ALL SELECT order_date, 'profit_margin', profit_margin FROM dkpi
    UNION ALL SELECT order_date, 'avg_discount', x FROM d
    UNION ALL SELECT order_date, 'customer_growth_rate', round(CAST(fresh * 100.0 AS DOUBLE) / nullif(CAST(known AS DOUBLE), 0), 2) FROM k
    UNION ALL SELECT order_date, 'repeat_customer_rate', round(CAST(again * 100.0 AS DOUBLE) / nullif(CAST(n AS DOUBLE), 0), 2) FROM k
    UNION ALL SELECT order_date, 'top_10_product_sales_pct', round(top * 100.0 / nullif(total_sales, 0), 2) FROM t JOIN dkpi USING (order_date)""")  # fmt: skip
def metrics_business_kpi(spark, sf_dir):
    return kpi.business(_written(spark, "mart", "sales_daily", _daily(Entities(spark, sf_dir))))


@query("kpi_run_snapshot", f""", {_C360}, {_DAILY}, {_DKPI}
    SELECT (SELECT min(order_date) FROM dkpi) AS data_from, (SELECT max(order_date) FROM dkpi) AS data_through,
        (SELECT CAST(sum(CAST(total_sales AS DECIMAL(22,2))) AS DOUBLE) FROM dkpi WHERE order_date > (SELECT max(order_date) FROM dkpi) - 30) AS revenue_30d, (SELECT CAST(sum(CAST(total_profit AS DECIMAL(22,2))) AS DOUBLE) FROM dkpi WHERE order_date > (SELECT max(order_date) FROM dkpi) - 30) AS profit_30d,
        CAST(sum(CAST(total_sales AS DECIMAL(22,2))) AS DOUBLE) AS revenue_total, CAST(sum(CAST(total_profit AS DECIMAL(22,2))) AS DOUBLE) AS profit_total, CAST(sum(total_orders) AS BIGINT) AS orders_total, count(DISTINCT customer_id) AS customers_total FROM c360""")  # fmt: skip
def kpi_run_snapshot(spark, sf_dir):
    e = Entities(spark, sf_dir)
    return kpi.snapshot_measures(kpi.daily(_daily(e)), _c360(e))


@query("dashboard_executive", f""", {_DAILY}, {_DKPI}, m AS (SELECT max(order_date) AS t FROM dkpi),
    x AS (SELECT CAST(sum(CAST(total_sales AS DECIMAL(22,2))) FILTER (order_date > t - 30) AS DOUBLE) AS s, CAST(sum(CAST(total_sales AS DECIMAL(22,2))) FILTER (order_date <= t - 30 AND order_date > t - 60) AS DOUBLE) AS s0,
        CAST(sum(CAST(total_profit AS DECIMAL(22,2))) FILTER (order_date > t - 30) AS DOUBLE) AS p, CAST(sum(CAST(total_profit AS DECIMAL(22,2))) FILTER (order_date <= t - 30 AND order_date > t - 60) AS DOUBLE) AS p0 FROM dkpi, m)
    SELECT s AS sales, p AS profit, round(p / nullif(s, 0), 4) AS margin, round((s - s0) / nullif(abs(s0), 0), 4) AS sales_change, round((p - p0) / nullif(abs(p0), 0), 4) AS profit_change, round((p / nullif(s, 0) - p0 / nullif(s0, 0)) * 100, 2) AS margin_change_points FROM x""")  # fmt: skip
def dashboard_executive(spark, sf_dir):
    return kpi.executive(kpi.daily(_daily(Entities(spark, sf_dir))))


@query("dashboard_weekly", f""", {_DAILY}, {_DKPI} SELECT CAST(date_trunc('week', order_date) AS DATE) AS week, CAST(sum(CAST(total_sales AS DECIMAL(22,2))) AS DOUBLE) AS total_sales, CAST(sum(CAST(total_profit AS DECIMAL(22,2))) AS DOUBLE) AS total_profit
    FROM dkpi, (SELECT min(order_date) AS a, max(order_date) AS z FROM dkpi) WHERE date_trunc('week', order_date) >= a AND CAST(date_trunc('week', order_date) AS DATE) + 6 <= z GROUP BY 1""")  # fmt: skip
def dashboard_weekly(spark, sf_dir):
    return kpi.weekly(kpi.daily(_daily(Entities(spark, sf_dir))))


@query("dashboard_top_customers", f""", {_C360} SELECT * FROM (SELECT region, customer_id, customer_name, total_sales, CAST(row_number() OVER (PARTITION BY region ORDER BY total_sales DESC NULLS LAST, customer_id) AS INT) AS place FROM c360) WHERE place <= 10""")
def dashboard_top_customers(spark, sf_dir):
    return kpi.top_customers(_c360(Entities(spark, sf_dir)))


@query("dashboard_category_mix", f""", {_DAILY}, c AS (SELECT category, sum(CAST(total_sales AS DECIMAL(22,2))) AS s FROM mart GROUP BY 1) SELECT category, CAST(s AS DOUBLE) AS total_sales, round(CAST(s AS DOUBLE) * 100 / CAST((SELECT sum(s) FROM c) AS DOUBLE), 2) AS share_pct FROM c""")
def dashboard_category_mix(spark, sf_dir):
    return kpi.mix(_daily(Entities(spark, sf_dir)), "category")


# --- Alerts: run logs made from events, a run a user and a day's checks an event --------------------------------------------

_CHECKS = """checks AS (SELECT 'run' || lpad(CAST(user_id AS VARCHAR), 4, '0') AS master_run_id, CASE event_type WHEN 'view' THEN 'reconciliation' WHEN 'click' THEN 'orphaned_facts' ELSE 'placeholder_exposure' END AS check_name,
    's' || (event_id % 4) AS subject, round(value, 2) AS observed_value, value < 10 AS passed, ts AS checked_at, event_type, event_id FROM events)"""


def _checks(spark, sf_dir):
    kind = F.when(F.col("event_type") == "view", "reconciliation").when(F.col("event_type") == "click", "orphaned_facts").otherwise("placeholder_exposure")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("run"), F.lpad(F.col("user_id").cast("string"), 4, "0")).alias("master_run_id"), kind.alias("check_name"), F.concat(F.lit("s"), F.col("event_id") % 4).alias("subject"),
        rounded("value", 2).alias("observed_value"), (F.col("value") < 10).alias("passed"), F.col("ts").alias("checked_at"), "event_type", "event_id",
    )


@query("alert_reconciliation", f"""WITH {_CHECKS}, r AS (SELECT * FROM checks WHERE check_name = 'reconciliation') SELECT count(*) FILTER (NOT passed) AS unbalanced_entities FROM r WHERE master_run_id = (SELECT max_by(master_run_id, checked_at) FROM r)""", entities=False)
def alert_reconciliation(spark, sf_dir):
    return kpi.alert_reconciliation(_checks(spark, sf_dir))


@query("alert_orphaned_facts", f"""WITH {_CHECKS}, r AS (SELECT * FROM checks WHERE check_name = 'orphaned_facts'), l AS (SELECT subject, max_by(master_run_id, checked_at) AS master_run_id FROM r GROUP BY 1)
    SELECT CAST(coalesce(floor(sum(CAST(observed_value AS DECIMAL(18,2)))), 0) AS BIGINT) AS orphaned_facts FROM r JOIN l USING (subject, master_run_id)""", entities=False)  # fmt: skip
def alert_orphaned_facts(spark, sf_dir):
    return kpi.alert_orphans(_checks(spark, sf_dir).withColumn("observed_value", F.col("observed_value").cast("decimal(18,2)")))


@query("alert_schema_drift", f"""WITH {_CHECKS} SELECT count(*) FILTER (event_type IN ('view', 'click') OR (event_type = 'error' AND event_id % 2 = 1)) AS drift_events FROM checks WHERE master_run_id = (SELECT max_by(master_run_id, checked_at) FROM checks)""", entities=False)
def alert_schema_drift(spark, sf_dir):
    status = F.when(F.col("event_type") == "view", "NEW").when(F.col("event_type") == "click", "MISSING").when(F.col("event_type") == "error", "RESCUED").otherwise("IGNORED")
    return kpi.alert_drift(_checks(spark, sf_dir).select("master_run_id", status.alias("drift_status"), (F.col("event_id") % 2).alias("row_count"), F.col("checked_at").alias("detected_at")))


@query("alert_placeholder_growth", f"""WITH {_CHECKS}, r AS (SELECT subject, master_run_id, max(observed_value) AS pct, max(checked_at) AS seen FROM checks WHERE check_name = 'placeholder_exposure' GROUP BY 1, 2),
    k AS (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY seen DESC, master_run_id DESC) AS rn FROM r)
    SELECT round(coalesce(max(c.pct - p.pct), 0), 2) AS max_growth_pct_points FROM k c JOIN k p ON c.subject = p.subject WHERE c.rn = 1 AND p.rn = 2""", entities=False)  # fmt: skip
def alert_placeholder_growth(spark, sf_dir):
    return kpi.alert_placeholders(_checks(spark, sf_dir))


@query("alert_freshness", """SELECT coalesce(CAST(round((epoch(TIMESTAMP '2024-02-01') - floor(epoch(max(ts)))) / 3600.0, 1) AS DOUBLE), 999999) AS hours_since_last_success FROM events WHERE event_type <> 'error'""", entities=False)
def alert_freshness(spark, sf_dir):
    runs = table(spark, sf_dir, "events").select(F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("run_status"), F.col("ts").alias("end_ts"))
    return kpi.alert_freshness(runs, datetime.datetime(2024, 2, 1))


@query("run_timing", """WITH r AS (SELECT 'run' || (event_id // 500) AS master_run_id, event_type AS layer, ts AS start_ts, ts + INTERVAL 90 SECOND AS end_ts, user_id AS rows_read FROM events)
    SELECT master_run_id, layer, CAST(floor(epoch(max(end_ts))) - floor(epoch(min(start_ts))) AS BIGINT) AS seconds, CAST(sum(rows_read) AS BIGINT) AS rows_read, count(*) AS entities
    FROM r WHERE master_run_id = (SELECT max_by(master_run_id, end_ts) FROM r) GROUP BY 1, 2""", entities=False)  # fmt: skip
def run_timing(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit("run"), F.floor(F.col("event_id") / 500)).alias("master_run_id"), F.col("event_type").alias("layer"), F.col("ts").alias("start_ts"), (F.col("ts") + F.expr("INTERVAL 90 SECOND")).alias("end_ts"), F.col("user_id").alias("rows_read"))
    return kpi.run_timing(rows)


@query("dashboard_latest_runs", """WITH r AS (SELECT 'run' || event_id AS run, CAST(value AS DOUBLE) AS x, row_number() OVER (ORDER BY ts DESC) AS n FROM events WHERE event_type = 'purchase')
    SELECT a.run, b.run AS previous_run, a.x AS revenue_total, a.x - b.x AS revenue_total_delta, a.x AS profit_total, a.x - b.x AS profit_total_delta, a.x AS orders_total, a.x - b.x AS orders_total_delta, a.x AS customers_total, a.x - b.x AS customers_total_delta
    FROM r a JOIN r b ON a.n = 1 AND b.n = 2""", entities=False)  # fmt: skip
def dashboard_latest_runs(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit("run"), "event_id").alias("master_run_id"), F.col("ts").alias("snapshot_at"), (F.col("event_type") == "purchase").cast("int").alias("raw_rows_ingested"), *[F.col("value").alias(c) for c in ("revenue_total", "profit_total", "orders_total", "customers_total")])
    return kpi.latest_runs(rows)
