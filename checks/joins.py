"""Joins, current versions, ordered calculations, lineage and skew reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from lakewarden.operators import joins
from lakewarden.operators.aggregates import consecutive, share
from lakewarden.operators.latest import latest, top_per_key, with_latest
from lakewarden.operators.lineage import lineage_edges, upstream
from lakewarden.operators.skew import key_skew, partition_skew
from lakewarden.plans import access, cost, retail
from lakewarden.sources import generators

JOB_KEYS = ["workspace_id", "job_id"]
VERSION = ["change_time", "version_id"]


@query("c01_inner_join",
       "SELECT o.order_id, c.loyalty_tier FROM v_orders AS o JOIN v_customers AS c"
       " USING (customer_id)")
def c01(lake):
    tiers = lake.customers().select("customer_id", "loyalty_tier")
    return lake.orders().select("order_id", "customer_id").join(tiers, "customer_id").select(
        "order_id", "loyalty_tier")


@query("c02_left_join_gold",
       "SELECT order_id, product_id, customer_email, customer_region, product_name, profit,"
       " order_region FROM v_gold", "profit")
def c02(lake):
    return retail.gold_orders(lake.order_lines(), lake.customers(), lake.products()).select(
        "order_id", "product_id", "customer_email", "customer_region", "product_name", "profit",
        "order_region")


SEGMENT_SQL = ("CASE WHEN loyalty_tier IN ('Gold', 'Platinum') THEN 'High Value' WHEN"
               " loyalty_tier = 'Silver' THEN 'Medium Value' ELSE 'Standard' END")


@query("c03_enrich",
       "SELECT o.order_id, o.customer_id, CASE WHEN c.customer_id IS NOT NULL THEN"
       f" {SEGMENT_SQL} END AS segment, c.loyalty_tier, o.region, o.channel, o.total_amount,"
       " o.order_timestamp FROM v_orders AS o LEFT JOIN v_customers AS c"
       " ON o.customer_id = c.customer_id", "total_amount")
def c03(lake):
    return retail.enrich(lake.orders(), retail.segments(lake.customers()))


@query("c04_multi_key_join",
       "SELECT workspace_id, job_id, r.run_id, j.name FROM v_runs AS r JOIN v_latest_jobs AS j"
       " USING (workspace_id, job_id)")
def c04(lake):
    names = latest(lake.jobs().select(*JOB_KEYS, "name", *VERSION), JOB_KEYS, VERSION)
    return lake.job_runs().join(names, JOB_KEYS).select(*JOB_KEYS, "run_id", "name")


@query("c05_anti_join",
       "SELECT customer_id, country FROM v_customers AS c WHERE NOT EXISTS (SELECT 1 FROM v_orders"
       " AS o WHERE o.customer_id = c.customer_id AND o.total_amount > 400000)")
def c05(lake):
    large = lake.orders().filter("total_amount > 400000 AND customer_id IS NOT NULL")
    return joins.anti(lake.customers().select("customer_id", "country"), large, ["customer_id"])


def price_sql(upper: str) -> str:
    return ("SELECT u.sku_name, u.usage_date, count(*) AS row_count,"
            " sum(u.usage_quantity * p.price) AS cost, count(p.price) AS priced"
            " FROM v_usage AS u LEFT JOIN v_prices AS p ON u.sku_name = p.sku_name"
            " AND p.currency_code = 'USD' AND p.price_start_time <= u.usage_start_time"
            f" AND (u.usage_start_time {upper} p.price_end_time OR p.price_end_time IS NULL)"
            " GROUP BY ALL")


def priced(lake, closed, width):
    usage = lake.usage().select("sku_name", "usage_date", "usage_start_time", "usage_quantity")
    return cost.price_at(usage, lake.list_prices(), closed=closed, width=width).groupBy(
        "sku_name", "usage_date").agg(
        F.count("*").alias("row_count"),
        F.sum(F.col("usage_quantity") * F.col("price")).alias("cost"),
        F.count("price").alias("priced"))


@query("c06_validity_join", price_sql("<"), "cost")
def c06(lake):
    return priced(lake, "left", "month")


@query("c06_validity_join_closed", price_sql("<="), "cost")
def c06_closed(lake):
    return priced(lake, "both", "year")


@query("c07_with_latest",
       "SELECT r.run_id, r.period_start_time, j.name, j.priority FROM v_runs AS r"
       " LEFT JOIN v_latest_jobs AS j USING (workspace_id, job_id)")
def c07(lake):
    jobs = lake.jobs().withColumn("priority", F.col("tags")["priority"])
    return with_latest(lake.job_runs(), jobs, JOB_KEYS, VERSION, ["name", "priority"],
                       "left").select("run_id", "period_start_time", "name", "priority")


@query("c08_join_size",
       "SELECT (SELECT count(*) FROM v_orders AS o JOIN v_customers AS c USING (customer_id))"
       " AS keyed_rows, CAST((SELECT count(*) FROM v_orders) * (SELECT count(*) FROM v_customers)"
       " AS DOUBLE) AS keyless_rows", "keyless_rows")
def c08(lake):
    return joins.join_size(lake.orders(), lake.customers(), ["customer_id"])


@query("c08_guarded_join",
       "SELECT loyalty_tier, count(*) AS row_count FROM v_orders JOIN v_customers"
       " USING (customer_id) GROUP BY loyalty_tier")
def c08_guarded(lake):
    joined = joins.guarded_join(lake.orders().drop("region"), lake.customers(), ["customer_id"],
                                max_rows=10**12)
    return joined.groupBy("loyalty_tier").agg(F.count("*").alias("row_count"))


CODES = [generators.promo_code(i) for i in range(10)]
PROMO_ROWS = ", ".join(f"('{c}', 'Promo {c}', {5 + 4.5 * i}::DOUBLE)" for i, c in enumerate(CODES))
# 70% of the lines get the first code and 15% the second, as in the skewed order data.
PROMO_OF_LINE = ("CASE WHEN (l_orderkey * 10 + l_linenumber) % 100 < 70 THEN 0"
                 " WHEN (l_orderkey * 10 + l_linenumber) % 100 < 85 THEN 1"
                 " ELSE 2 + (l_orderkey * 10 + l_linenumber) % 8 END")
PROMO_LINES_SQL = (
    f"SELECT l_orderkey * 10 + l_linenumber AS order_id, l_extendedprice AS order_total,"
    f" ([{', '.join(repr(c) for c in CODES)}])[{PROMO_OF_LINE} + 1] AS promo_code FROM lineitem")
JOINED_SQL = (
    "SELECT o.order_id, o.promo_code, o.order_total, p.promo_description, p.discount_pct,"
    " o.order_total * (1 - p.discount_pct / 100) AS discounted_total"
    f" FROM ({PROMO_LINES_SQL}) AS o JOIN (VALUES {PROMO_ROWS})"
    " AS p(promo_code, promo_description, discount_pct) ON o.promo_code = p.promo_code")
TOTALS_SQL = (
    "SELECT promo_code, count(*) AS order_count, sum(order_total) AS gross_total,"
    f" sum(order_total) * (1 - max(discount_pct) / 100) AS discounted_total FROM ({JOINED_SQL})"
    " GROUP BY promo_code")


def promo_orders(lake):
    codes = F.array(*[F.lit(c) for c in CODES])
    return lake.table("lineitem").select(
        F.expr("l_orderkey * 10 + l_linenumber").alias("order_id"),
        F.col("l_extendedprice").alias("order_total"),
        F.element_at(codes, F.expr(f"CAST({PROMO_OF_LINE} AS INT) + 1")).alias("promo_code"))


def discounted(joined):
    return joined.select(
        "order_id", "promo_code", "order_total", "promo_description", "discount_pct",
        (F.col("order_total") * (1 - F.col("discount_pct") / 100)).alias("discounted_total"))


@query("c09_broadcast_join", JOINED_SQL, "order_total discount_pct discounted_total")
def c09(lake):
    return retail.promo_lines(promo_orders(lake), generators.promos(lake.spark))


@query("c10_merge_join", JOINED_SQL, "order_total discount_pct discounted_total")
def c10(lake):
    promos = generators.promos(lake.spark)
    return discounted(joins.merge_join(promo_orders(lake), promos, ["promo_code"]))


@query("c11_salted_join", JOINED_SQL, "order_total discount_pct discounted_total")
def c11(lake):
    promos = generators.promos(lake.spark)
    return discounted(joins.salted_join(promo_orders(lake), promos, "promo_code", "order_id"))


@query("c11_salted_aggregate",
       f"SELECT promo_code, count(*) AS order_count, max(order_total) AS largest,"
       f" sum(order_total) AS total FROM ({PROMO_LINES_SQL}) GROUP BY promo_code",
       "largest total")
def c11_agg(lake):
    return joins.salted_agg(
        promo_orders(lake), ["promo_code"], "order_id", 16,
        [F.count("*").alias("n"), F.max("order_total").alias("m"), F.sum("order_total").alias("s")],
        [F.sum("n").alias("order_count"), F.max("m").alias("largest"), F.sum("s").alias("total")])


LINEAGE_SQL = """
    SELECT * FROM (WITH RECURSIVE e AS (
        SELECT DISTINCT source_table_full_name AS s, target_table_full_name AS t FROM v_lineage
    ), walk AS (
        SELECT s, t, 1 AS depth FROM e WHERE t = 'report.Brand#12'
        UNION
        SELECT e.s, e.t, walk.depth + 1 FROM e JOIN walk ON e.t = walk.s WHERE walk.depth < 5
    ) SELECT DISTINCT s AS source_table_full_name, t AS target_table_full_name, depth FROM walk)"""


@query("c12_upstream", LINEAGE_SQL)
def c12(lake):
    return upstream(lake.table_lineage(), "report.Brand#12")


@query("c13_scalar_subquery",
       "SELECT status, count(*) AS row_count, (SELECT count(*) FROM v_orders) AS all_rows"
       " FROM v_orders GROUP BY status")
def c13(lake):
    orders = lake.orders()
    total = orders.agg(F.count("*").alias("n")).scalar()
    return orders.groupBy("status").agg(F.count("*").alias("row_count")).withColumn(
        "all_rows", total)


# -- E: windows ---------------------------------------------------------------------------------

@query("e01_latest",
       "SELECT workspace_id, job_id, name, creator_id, change_time, version_id, delete_time,"
       " priority FROM v_latest_jobs")
def e01(lake):
    return latest(lake.jobs(), JOB_KEYS, VERSION).select(
        *JOB_KEYS, "name", "creator_id", "change_time", "version_id", "delete_time",
        F.col("tags")["priority"].alias("priority"))


@query("e02_qualify",
       "SELECT customer_id, order_id, total_amount FROM v_orders WHERE customer_id IS NOT NULL"
       " QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY total_amount DESC, order_id)"
       " <= 3", "total_amount")
def e02(lake):
    orders = lake.orders().filter("customer_id IS NOT NULL").select(
        "customer_id", "order_id", "total_amount")
    return top_per_key(orders, ["customer_id"], [F.desc("total_amount"), F.col("order_id")], 3)


CREATES = "action_name IN ('createWarehouse', 'createEndpoint')"
SCD_SQL = f"""
    SELECT * , row_number() OVER (PARTITION BY account_id, workspace_id, warehouse_id
                                  ORDER BY event_time, event_id) AS change_rank,
           row_number() OVER (PARTITION BY account_id, workspace_id, warehouse_id
                              ORDER BY event_time DESC, event_id DESC) AS recency_rank,
           CASE WHEN recency_rank = 1 AND action_name IN ('deleteWarehouse', 'deleteEndpoint')
                THEN 'Deleted' ELSE 'Active' END AS is_deleted
    FROM (SELECT * FROM (SELECT * FROM v_changes WHERE {CREATES} QUALIFY row_number() OVER (
              PARTITION BY warehouse_id ORDER BY event_time DESC, event_id DESC) = 1)
          UNION ALL SELECT * FROM v_changes WHERE NOT ({CREATES}))"""


@query("e03_scd_history", SCD_SQL)
def e03(lake):
    return access.warehouse_scd(access.refine_warehouse_events(lake.audit(), "warehouse"))


@query("e04_percent_of_total",
       "SELECT promo_code, count(*) AS order_count, round(count(*) * 100.0::DOUBLE /"
       f" sum(count(*)) OVER (), 1) AS pct FROM ({PROMO_LINES_SQL}) GROUP BY promo_code", "pct")
def e04(lake):
    return share(promo_orders(lake), ["promo_code"], 1, "order_count")


@query("e05_tumbling_window",
       "SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, count(*) AS row_count,"
       " sum(value) AS total FROM events GROUP BY ALL", "total")
def e05(lake):
    return lake.table("events").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(
        F.count("*").alias("row_count"), F.sum("value").alias("total")).select(
        F.col("w.start").alias("window_start"), "event_type", "row_count", "total")


@query("e06_consecutive_windows",
       "SELECT event_type, day, row_count, lag(day) OVER w AS previous_day, lag(row_count) OVER w"
       " AS previous_row_count, row_count - lag(row_count) OVER w AS row_count_change FROM (SELECT"
       " event_type, CAST(ts AS DATE) AS day, count(*) AS row_count FROM events GROUP BY ALL)"
       " WINDOW w AS (PARTITION BY event_type ORDER BY day)")
def e06(lake):
    daily = lake.table("events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count("*").alias("row_count"))
    return consecutive(daily, ["event_type"], "day", ["row_count"])


# -- lineage and skew ---------------------------------------------------------------------------

@query("j21_lineage_edges",
       "SELECT source_table_full_name, 'TABLE' AS source_type, target_table_full_name, 'TABLE' AS"
       " target_type, max(event_time) AS last_updated FROM v_lineage"
       " WHERE target_table_full_name LIKE 'sell.%' GROUP BY ALL")
def j21(lake):
    return lineage_edges(lake.table_lineage(), "sell.")


@query("j22_upstream_lineage", LINEAGE_SQL)
def j22(lake):
    return upstream(lake.table_lineage(), "report.Brand#12", depth=5).orderBy(
        "depth", "source_table_full_name")


@query("j48_promo_totals", TOTALS_SQL, "gross_total discounted_total")
def j48(lake):
    return retail.promo_totals(promo_orders(lake), generators.promos(lake.spark))


@query("k27_key_skew",
       f"WITH c AS (SELECT promo_code, count(*) AS row_count FROM ({PROMO_LINES_SQL})"
       " GROUP BY promo_code) SELECT promo_code, row_count, round(row_count * 100.0::DOUBLE /"
       " (SELECT sum(row_count) FROM c), 2) AS pct, round(row_count / (SELECT"
       " quantile_disc(row_count, 0.5) FROM c), 2) AS to_median FROM c", "pct to_median")
def k27(lake):
    return key_skew(promo_orders(lake), ["promo_code"])


@query("k28_partition_skew",
       f"SELECT count(*) AS row_count FROM ({PROMO_LINES_SQL})")
def k28(lake):
    report = partition_skew(promo_orders(lake), ["promo_code"], 8)
    return report.agg(F.sum("row_count").alias("row_count"))
