"""Sales reports over orders, customers and products."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lakewarden.functions import at, join_texts, part_texts, trunc
from lakewarden.operators.joins import left_lookup, lookup_join, many_parts


def order_count() -> Column:
    return F.count("order_id").alias("order_count")


def revenue(amount: str = "total_amount") -> Column:
    return F.sum(amount).alias("total_revenue")


def monthly_sales(orders: DataFrame, start: datetime, until: datetime | None = None) -> DataFrame:
    """Orders, revenue and customers per region, channel and month.

    Without ``until`` orders dated in the future make months of their own.
    """
    rows = orders.filter(F.col("order_timestamp") >= at(orders, "order_timestamp", start))
    if until is not None:
        rows = rows.filter(F.col("order_timestamp") < at(orders, "order_timestamp", until))
    return (
        rows.groupBy("region", "channel", trunc(orders, "month", "order_timestamp").alias("month"))
        .agg(order_count(), revenue(), F.countDistinct("customer_id").alias("unique_customers"))
        .orderBy("month", "region")
    )


def channel_month(orders: DataFrame, amount: str) -> DataFrame:
    """Monthly revenue per channel; ``amount`` is the amount column of the schema in use."""
    return (
        orders.groupBy("channel", trunc(orders, "month", "order_timestamp").alias("month"))
        .agg(order_count(), revenue(amount)).orderBy("month", "channel")
    )


def extract_orders(orders: DataFrame, start: datetime, minimum: float) -> DataFrame:
    return orders.filter(
        (F.col("order_timestamp") >= at(orders, "order_timestamp", start))
        & (F.col("total_amount") > minimum)
    ).select("order_id", "customer_id", "quantity", "total_amount", "channel", "region",
             "order_timestamp")


def segments(customers: DataFrame) -> DataFrame:
    """Customer segment from the loyalty tier."""
    tier = F.col("loyalty_tier")
    segment = (F.when(tier.isin("Gold", "Platinum"), "High Value")
               .when(tier == "Silver", "Medium Value").otherwise("Standard"))
    return customers.select("customer_id", "region", "country", "loyalty_tier",
                            segment.alias("segment"), "signup_date")


def enrich(staging: DataFrame, customer_segments: DataFrame) -> DataFrame:
    """Staged orders with segment and tier. Both sides have ``region``: the order's is kept."""
    dim = customer_segments.select("customer_id", "segment", "loyalty_tier")
    return left_lookup(staging, dim, "customer_id", "order_id").select(
        "order_id", "customer_id", "segment", "loyalty_tier", "region", "channel",
        "total_amount", "order_timestamp")


def segment_report(enriched: DataFrame) -> DataFrame:
    return (
        enriched.groupBy("segment", "region", "channel").agg(order_count(), revenue())
        .orderBy(F.desc("total_revenue"))
    )


def region_tier_revenue(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue per order region and tier. Orders without a customer are left out (inner join).

    Orders are combined per customer and region first, so the join moves one row for each and a
    customer with very many orders is not a hot key.
    """
    per_customer = orders.filter("customer_id IS NOT NULL").groupBy("customer_id", "region").agg(
        F.count("order_id").alias("n"), F.sum("total_amount").alias("amount"))
    tiers = customers.select("customer_id", "loyalty_tier")
    return per_customer.join(tiers, "customer_id").groupBy("region", "loyalty_tier").agg(
        F.sum("n").alias("order_count"), F.sum("amount").alias("total_revenue"))


def channel_report(orders: DataFrame, region: str, start: datetime | date) -> DataFrame:
    """Revenue per channel of one region. An unknown region is an error that names close ones."""
    if orders.filter(F.col("region") == region).isEmpty():
        near = (
            orders.select("region").distinct()
            .orderBy(F.levenshtein("region", F.lit(region)), "region").limit(3).collect()
        )
        names = ", ".join(r["region"] for r in near)
        raise ValueError(f"no data for region {region!r}; closest values: {names}")
    return orders.filter(
        (F.col("region") == region)
        & (F.col("order_timestamp") >= at(orders, "order_timestamp", start))
    ).groupBy("channel").agg(order_count(), revenue())


def stock_lookup(stock: DataFrame, city: str | None = None, term: str | None = None) -> DataFrame:
    """Parts in stock; an argument left out does not filter."""
    rows = stock
    if city is not None:
        rows = rows.filter(F.col("city") == city)
    if term is not None:
        rows = rows.filter(F.col("part").contains(term))
    return rows


def gold_orders(lines: DataFrame, customers: DataFrame, products: DataFrame,
                orders: DataFrame | None = None) -> DataFrame:
    """Wide order table with customer, product and profit; rows without a partner are kept.

    With ``orders``, which have the columns that bare lines lack, a line first meets its product, while
    it is narrow, and the customer is looked up once per order: lines move twice and not three times.
    """
    c = customers.select(
        "customer_id", F.col("email").alias("customer_email"),
        F.col("region").alias("customer_region"), F.col("country").alias("customer_country"),
        "loyalty_tier")
    p = products.select("product_id", "product_name", F.col("category").alias("product_category"),
                        F.col("color").alias("product_color"), "cost_price")
    if orders is None:
        wide = left_lookup(lines, c, "customer_id", "order_id").join(p, "product_id", "left")
    else:
        heads = left_lookup(orders, c, "customer_id", "order_id")
        wide = lines.join(p, "product_id", "left").join(heads, "order_id")
    profit = F.col("total_amount") - F.col("quantity") * F.col("cost_price")
    return wide.select(
        "order_id", "order_timestamp", "customer_id", "customer_email", "customer_region",
        "customer_country", "loyalty_tier", "product_id", "product_name", "product_category",
        "product_color", "quantity", "unit_price", "total_amount", "cost_price",
        profit.alias("profit"), "channel", F.col("status").alias("order_status"),
        F.col("region").alias("order_region"))


def daily_wide(gold: DataFrame) -> DataFrame:
    """Seven keys, nine measures.

    Two distinct counts in one aggregate would repeat every row with its keys three times. Here rows
    move once, dealt by group over a number of parts that adaptive execution leaves as it is, and
    their texts travel as one, which takes less room on disk. Within a part the first row of each
    customer of a group is marked, then the first of each order, and one plain aggregate counts the
    marks. A group is the work of one task; sorting may spill, so it need not fit into memory.
    """
    keys = ["product_category", "product_color", "customer_region", "customer_country",
            "loyalty_tier", "channel", "day"]
    rows = gold.withColumn("day", trunc(gold, "day", "order_timestamp"))
    texts = [k for k in keys if rows.schema[k].dataType == T.StringType()]
    group = ["_texts", *[k for k in keys if k not in texts]]
    rows = rows.select(
        join_texts(texts).alias("_texts"), *group[1:], "order_id", "customer_id", "total_amount",
        "profit", "unit_price").repartition(many_parts(gold.sparkSession, 128), *group)
    for value, mark in (("customer_id", "_new_customer"), ("order_id", "_new_order")):
        # The hash comes first, so sorting seldom compares the texts of the keys; it need not move.
        first = F.row_number().over(Window.partitionBy("_group", *group, value).orderBy(F.lit(1))) == 1
        rows = rows.withColumn("_group", F.xxhash64(*group)) \
            .withColumn(mark, F.when(first & F.col(value).isNotNull(), 1)).drop("_group")
    daily = rows.groupBy(*group).agg(
        F.count("*").alias("order_count"),
        F.count("_new_customer").alias("unique_customers"),
        F.count("_new_order").alias("unique_orders"),
        revenue(), F.sum("profit").alias("total_profit"), F.avg("unit_price").alias("avg_price"),
        F.min("unit_price").alias("min_price"), F.max("unit_price").alias("max_price"),
        F.stddev("total_amount").alias("stddev_amount"),
    )
    # Sorting computes its input twice, first to find its ranges: the groups are dealt before it, so the
    # rows are read and marked once.
    daily = daily.repartition(many_parts(gold.sparkSession), "total_revenue").orderBy(F.desc("total_revenue"))
    named = dict(zip(texts, part_texts("_texts", len(texts)), strict=True))
    return daily.select(*[named[k].alias(k) if k in named else k for k in keys],
                        *daily.columns[len(group):])


def weekly_region(gold: DataFrame, region: str, start: datetime) -> DataFrame:
    return gold.filter(
        (F.col("order_timestamp") >= at(gold, "order_timestamp", start))
        & (F.col("customer_region") == region)
    ).groupBy(
        "product_category", "customer_region", "loyalty_tier",
        trunc(gold, "week", "order_timestamp").alias("week"),
    ).agg(
        F.count("*").alias("order_count"),
        F.countDistinct("customer_id").alias("unique_customers"),
        revenue(), F.sum("profit").alias("total_profit"),
        F.avg("unit_price").alias("avg_unit_price"),
    ).orderBy(F.desc("week"), F.desc("total_revenue"))


def daily_sales(orders: DataFrame, digits: int | None = 2) -> DataFrame:
    """Daily summary per region and channel, meant to be stored; ``digits=None`` does not round."""
    def rounded(c: Column) -> Column:
        return c if digits is None else F.round(c, digits)

    return orders.groupBy(
        F.to_date("order_timestamp").alias("order_date"), "region", "channel",
    ).agg(
        F.count("*").alias("order_count"),
        F.countDistinct("customer_id").alias("unique_customers"),
        rounded(F.sum("total_amount")).alias("total_revenue"),
        rounded(F.avg("total_amount")).alias("avg_order_value"))


def recent_sales(daily: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    edge = F.date_sub(F.lit(as_of.date()), days)
    return daily.filter(F.col("order_date") >= edge).orderBy(
        F.desc("order_date"), F.desc("total_revenue"))


def region_rollup(daily: DataFrame) -> DataFrame:
    return daily.groupBy("region").agg(F.sum("order_count").alias("order_count"))


def product_performance(products: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders and buyers per product, products without orders included.

    Counting happens before the join, so only one row per sold product meets the product table. A line
    is one row for its order and one for its buyer, made distinct in parts of their own: dealt by
    product and value, a product with many lines is divided, and adaptive execution, which would bring
    all rows into as many tasks as there are cores, leaves the parts as they are.
    """
    order = F.struct("order_id", F.lit(None).cast(lines.schema["customer_id"].dataType).alias("customer_id"),
                     "order_timestamp")
    buyer = F.struct(F.lit(None).cast(lines.schema["order_id"].dataType).alias("order_id"), "customer_id",
                     F.lit(None).cast(lines.schema["order_timestamp"].dataType).alias("order_timestamp"))
    sold = lines.select("product_id", F.inline(F.when(F.col("customer_id").isNull(), F.array(order))
                                               .otherwise(F.array(order, buyer)))) \
        .repartition(many_parts(lines.sparkSession), "product_id", "order_id", "customer_id") \
        .groupBy("product_id", "order_id", "customer_id").agg(
            F.min("order_timestamp").alias("first_sale"), F.max("order_timestamp").alias("last_sale")) \
        .groupBy("product_id").agg(
            F.count("order_id").alias("order_count"), F.count("customer_id").alias("unique_buyers"),
            F.min("first_sale").alias("first_sale"), F.max("last_sale").alias("last_sale"))
    zero = F.lit(0).cast("long")
    return products.join(sold, "product_id", "left").select(
        "product_id", "product_name", "category", "color",
        F.coalesce("order_count", zero).alias("order_count"),
        F.coalesce("unique_buyers", zero).alias("unique_buyers"), "first_sale", "last_sale")


def category_rollup(performance: DataFrame) -> DataFrame:
    return performance.groupBy("category").agg(
        F.count("*").alias("product_count"), F.sum("order_count").alias("total_orders"),
    ).orderBy(F.desc("total_orders"))


def channel_revenue(orders: DataFrame) -> DataFrame:
    return orders.groupBy("channel").agg(
        F.count("*").alias("order_count"), F.sum("total_amount").alias("revenue"),
    ).orderBy(F.desc("revenue"))


def tier_region(orders: DataFrame, customers: DataFrame, start: datetime) -> DataFrame:
    """Distinct orders and mean order value per tier and customer region."""
    recent = orders.filter(
        (F.col("order_timestamp") >= at(orders, "order_timestamp", start))
        & F.col("customer_id").isNotNull()).select("order_id", "customer_id", "total_amount")
    dim = customers.select("customer_id", "loyalty_tier", "region")
    return recent.join(dim, "customer_id").groupBy("loyalty_tier", "region").agg(
        F.countDistinct("order_id").alias("orders"), revenue(),
        F.avg("total_amount").alias("avg_order_value")).orderBy(F.desc("total_revenue"))


def category_month(gold: DataFrame) -> DataFrame:
    return gold.groupBy(
        "product_category", "customer_region",
        trunc(gold, "month", "order_timestamp").alias("month"),
    ).agg(
        F.count("*").alias("orders"), F.sum("total_amount").alias("revenue"),
        F.sum("profit").alias("profit"), F.avg("unit_price").alias("avg_price"),
        F.countDistinct("customer_id").alias("unique_customers"),
    ).orderBy(F.desc("revenue"))


def channel_status(orders: DataFrame) -> DataFrame:
    return orders.groupBy("channel", "status").agg(
        F.count("*").alias("order_count"),
        F.round(F.sum("total_amount"), 2).alias("total_revenue"),
    ).orderBy(F.desc("total_revenue"))


def promo_lines(orders: DataFrame, promos: DataFrame) -> DataFrame:
    """Discounted total per order line; the promo table is broadcast only if it is small."""
    net = F.col("order_total") * (1 - F.col("discount_pct") / 100)
    return lookup_join(orders, promos, ["promo_code"]).select(
        "order_id", "promo_code", "order_total", "promo_description", "discount_pct",
        net.alias("discounted_total"))


def promo_totals(orders: DataFrame, promos: DataFrame) -> DataFrame:
    """Discounted total per promo code.

    Orders are summed per code before the join, so the hot code is one row when it meets its
    discount.
    """
    per_code = orders.groupBy("promo_code").agg(
        F.count("*").alias("order_count"), F.sum("order_total").alias("gross_total"))
    factor = 1 - F.col("discount_pct") / 100
    return per_code.join(promos, "promo_code").select(
        "promo_code", "order_count", "gross_total",
        (F.col("gross_total") * factor).alias("discounted_total"))
