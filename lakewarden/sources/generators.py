"""Test data with known shares, computed per row on the executors.

Every value is a hash of the row id and a seed, so the same ids give the same rows on any cluster
and after any retry. ``ids`` is any frame with an id column: ``spark.range(n)`` or a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakewarden.functions import unit_hash

# Sales channels, order states, regions, return reasons and return channels.
CHANNELS = ["Web", "Mobile App", "Retail Store", "Marketplace"]
STATUSES = ["Completed", "Completed", "Completed", "Shipped", "Processing", "Cancelled", "Returned"]
REGIONS = ["EMEA", "North America", "APAC", "LATAM"]
REASONS = ["Defective", "Wrong Size", "Changed Mind", "Wrong Color", "Late Delivery",
           "Not As Described"]
RETURN_CHANNELS = ["Online Portal", "In-Store", "Customer Service", "Mobile App"]


def lit_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Small reference table from literals."""
    return spark.createDataFrame(rows, schema)


def promo_code(number: int) -> str:
    return f"P{number:02d}"


def promos(spark: SparkSession, codes: int = 10) -> DataFrame:
    """One row per promo code; each gives 4.5 points more than the one before."""
    rows = [(promo_code(i), f"Promo {promo_code(i)}", 5 + 4.5 * i) for i in range(codes)]
    return lit_table(spark, rows, "promo_code string, promo_description string, discount_pct double")


def _below(u: Column, n: int) -> Column:
    return F.floor(u * n).cast("int")


def _pick(values: Sequence[str], u: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), _below(u, len(values)) + 1)


def _code(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def _place(u: Column, hot: Sequence[float], count: int) -> Column:
    """Number below ``count``: the first ones have the shares ``hot``, the others share the rest evenly."""
    used = [round(sum(hot[:i + 1]), 9) for i in range(len(hot))]
    others, top = count - len(hot), used[-1] if used else 0.0
    place = len(hot) + F.least(
        F.lit(others - 1), F.floor((u - top) / round(1 - top, 9) * others).cast("int"))
    for number, limit in reversed(list(enumerate(used))):
        place = F.when(u < limit, number).otherwise(place)
    return place


def skewed_orders(ids: DataFrame, id_column: str = "id", seed: int = 42,
                  hot: Sequence[float] = (0.70, 0.15), codes: int = 10) -> DataFrame:
    """Orders whose promo codes are hot keys: ``hot`` are the shares of the first codes."""
    if not (0 <= sum(hot) < 1 and len(hot) < codes):
        raise ValueError("hot shares must leave something to the other codes")
    key = F.col(id_column)
    drawn = {name: unit_hash(key, seed + i) for i, name in enumerate(["code", "total", "customer", "day"])}
    return ids.select(
        _code("ORD-S-", key, 8).alias("order_id"),
        _code("P", _place(drawn["code"], hot, codes), 2).alias("promo_code"),
        _code("CUST-", _below(drawn["customer"], 50_000), 6).alias("customer_id"),
        F.round(drawn["total"] * 280 + 20, 2).alias("order_total"),
        F.date_add(F.lit("2024-01-01").cast("date"), _below(drawn["day"], 451)).alias("order_date"),
    )


def retail_orders(ids: DataFrame, id_column: str = "id", seed: int = 42) -> DataFrame:
    """Orders with planted defects: 2% NULL customer, 1% negative quantity, 0.5% future date."""
    key = F.col(id_column)

    def u(k: int) -> Column:
        return unit_hash(key, seed + k)

    drawn = ids.select(
        _code("ORD-", key, 7).alias("order_id"),
        F.when(u(0) >= 0.02, _code("CUST-", _below(u(1), 50_000) + 1, 6)).alias("customer_id"),
        _code("PROD-", _below(u(2), 500) + 1, 5).alias("product_id"),
        (F.when(u(3) < 0.01, -1).otherwise(1) * (_below(u(4), 5) + 1)).alias("quantity"),
        F.round(u(5) * 230 + 19.99, 2).alias("unit_price"),
        _pick(CHANNELS, u(6)).alias("channel"), _pick(STATUSES, u(7)).alias("status"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(
            F.when(u(8) < 0.005, _below(u(9), 335) + 36_500).otherwise(_below(u(9), 451))))
        .alias("order_timestamp"),
        _pick(REGIONS, u(10)).alias("region"),
    )
    return drawn.withColumn("total_amount", F.round(F.col("quantity") * F.col("unit_price"), 2))


def returns(ids: DataFrame, variant: int, id_column: str = "id", seed: int = 99) -> DataFrame:
    """Return records as JSON lines. Variants 2 to 4 add, rename and retype a field."""
    key = F.col(id_column)

    def u(k: int) -> Column:
        return unit_hash(key, seed + 100 * variant + k)

    amount = F.round(u(4) * 235 + 15, 2)
    fields = [
        _code("ORD-", _below(u(0), 500_000) + 1, 7).alias("order_id"),
        _code("PROD-", _below(u(1), 200) + 1, 5).alias("product_id"),
        _pick(REASONS, u(2)).alias("return_reason"),
        F.date_add(F.lit("2025-01-01").cast("date"), _below(u(3), 366)).cast("string")
        .alias("return_date"),
    ]
    if variant == 3:
        fields += [amount.alias("refund_value"),
                   _pick(RETURN_CHANNELS, u(5)).alias("return_channel")]
    elif variant == 4:
        fields += [F.concat(F.lit("EUR "), amount).alias("refund_amount")]
    else:
        fields += [amount.alias("refund_amount")]
    if variant == 2:
        fields += [(_below(u(5), 5) + 1).alias("customer_satisfaction_score")]
    return ids.select(F.to_json(F.struct(*fields)).alias("value"))


def write_returns(spark: SparkSession, variant: int, path: str, files: int = 5,
                  per_file: int = 100) -> None:
    """One batch of return files."""
    ids = spark.range(0, files * per_file, 1, files)
    returns(ids, variant).write.mode("append").text(path)
