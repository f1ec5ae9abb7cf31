"""Generators are functions of id and seed with the stated shares."""

from pyspark.sql import functions as F

from lakewarden.sources import generators
from tests.conftest import plan_of, rows


def test_skewed_orders_have_the_stated_shares(spark):
    df = generators.skewed_orders(spark.range(40_000))
    share = {r["promo_code"]: r["count"] / 40_000 for r in df.groupBy("promo_code").count().collect()}
    assert abs(share["P00"] - 0.70) < 0.01 and abs(share["P01"] - 0.15) < 0.01
    assert len(share) == 10
    assert "Exchange" not in plan_of(df)


def test_retail_orders_have_the_planted_defects(spark):
    df = generators.retail_orders(spark.range(40_000))
    seen = df.agg(F.avg(F.col("customer_id").isNull().cast("int")),
                  F.avg((F.col("quantity") < 0).cast("int")),
                  F.avg((F.year("order_timestamp") > 2100).cast("int"))).first()
    assert abs(seen[0] - 0.02) < 0.004 and abs(seen[1] - 0.01) < 0.003
    assert abs(seen[2] - 0.005) < 0.002
    assert df.filter("abs(total_amount - quantity * unit_price) > 0.01").count() == 0


def test_same_ids_give_the_same_rows_in_any_split(spark):
    one = generators.skewed_orders(spark.range(0, 500, 1, 1))
    many = generators.skewed_orders(spark.range(0, 500, 1, 7))
    other = generators.skewed_orders(spark.range(500), seed=7)
    assert rows(one) == rows(many) and rows(one) != rows(other)


def test_promos(spark):
    got = rows(generators.promos(spark))
    assert len(got) == 10 and ("P00", "Promo P00", 5.0) in got
    assert ("P09", "Promo P09", 45.5) in got
