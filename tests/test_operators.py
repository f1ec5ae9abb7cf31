"""Joins, current versions, ordered calculations, sets and skew."""

import re
from datetime import datetime

import pytest
from pyspark.sql import Window, functions as F

from lakewarden.operators import joins
from lakewarden.operators.aggregates import consecutive, distinct_counts, share
from lakewarden.operators.latest import latest, top_per_key, with_latest
from lakewarden.operators.lineage import upstream
from lakewarden.operators.ranking import ordered_by_key, scd_history
from lakewarden.operators.sets import (
    delete, insert, keyless_diff, snapshot_diff, update, upsert,
)
from lakewarden.operators.shape import evolve, first_rows, flatten_params, replicate
from lakewarden.operators.skew import key_skew, partition_skew
from tests.conftest import plan_of, rows


def test_latest_takes_newest_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, "old"), (1, 5, 1, "a"), (1, 5, 2, "b"), (2, 3, 1, None)],
        "k int, t int, tie int, name string")
    assert rows(latest(df, ["k"], ["t", "tie"])) == [(1, 5, 2, "b"), (2, 3, 1, None)]


def test_latest_shuffles_one_row_per_key_and_task(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS t", "id AS v")
    assert "partial_max_by" in plan_of(latest(df, ["k"], ["t"]))


def test_top_per_key_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    top = top_per_key(df, ["k"], [F.desc("v")], 2)
    plan = plan_of(top)
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert rows(top) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]


def test_with_latest_keeps_facts_without_a_version(spark):
    fact = spark.createDataFrame([(1, "x"), (9, "y")], "k int, v string")
    dim = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k int, t int, name string")
    assert rows(with_latest(fact, dim, ["k"], ["t"], ["name"], "left")) == [
        (1, "x", "b"), (9, "y", None)]


def hot(spark, n=4000):
    """Half of the rows under one key."""
    return spark.range(n).selectExpr("CASE WHEN id % 2 = 0 THEN 7 ELSE id % 50 END AS k",
                                     "id AS v")


def test_salted_join_equals_plain_join(spark):
    left, right = hot(spark), spark.range(40).selectExpr("id AS k", "id * 10 AS w")
    for how in ("inner", "left"):
        plain = rows(left.join(right, "k", how))
        assert rows(joins.salted_join(left, right.hint("merge"), "k", "v", how=how)) == plain
    with pytest.raises(ValueError):
        joins.salted_join(left, right, "k", "v", how="full")


def test_salted_join_divides_the_hot_key(spark):
    left = hot(spark)
    hot_list = joins.hot_keys(left, "k", 64)
    assert hot_list[7] > 3 and len(hot_list) < 64
    right = spark.range(40).selectExpr("id AS k", "id * 10 AS w")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.salted_join(left, right, "k", "v")
        counts = joined.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(counts) > 3


def test_salted_join_is_a_sort_merge_join_on_key_and_salt(spark):
    right = spark.range(40).selectExpr("id AS k", "id * 10 AS w")
    plan = plan_of(joins.salted_join(hot(spark), right, "k", "v"))
    assert "BroadcastHashJoin" not in plan
    assert re.search(r"SortMergeJoin \[k#\w+, _salt#\w+\]", plan)


def test_keys_that_are_hot_on_both_sides_meet_in_a_grid(spark):
    def side(n, value):
        key = "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id END AS k"
        return spark.range(n).selectExpr(key, f"id AS {value}")

    left, right = side(3000, "v"), side(600, "w")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.salted_join(left, right, "k", "v", spread_right="w")
        assert rows(joined) == rows(left.join(right, "k"))
        parts = joined.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(parts) == 8 and max(r["count"] for r in parts) < 0.3 * 1000 * 200
    with pytest.raises(ValueError):
        joins.salted_join(left, right, "k", "v", how="left", spread_right="w")
    assert joins.salted_join(left.limit(0), right, "k", "v", spread_right="w").count() == 0
    assert joins.salted_join(left, right.limit(0), "k", "v", spread_right="w").count() == 0


def test_hot_keys_keep_to_the_error_of_the_sketch(spark):
    # 40 keys of 2 % each are above 1/64, 4,000 keys share the rest.
    df = spark.range(100_000).selectExpr(
        "CASE WHEN id % 10 < 8 THEN concat('hot', id div 10 % 40) ELSE concat('k', id div 10 % 4000) END AS k")
    found = joins.hot_keys(df, "k", 64)
    assert {f"hot{i}" for i in range(40)} == set(found) and set(found.values()) == {2}
    assert joins.hot_keys(df.limit(0), "k", 64) == {}
    assert joins.hot_keys(df.selectExpr("CAST(NULL AS STRING) AS k"), "k", 64) == {}


def test_distinct_counts_equal_the_plain_ones(spark):
    df = spark.range(5000).selectExpr(
        "CASE WHEN id % 3 > 0 THEN id % 3 END AS a", "CASE WHEN id % 7 > 0 THEN concat('g', id % 7) END AS b",
        "CASE WHEN id % 5 > 0 AND id % 7 <> 2 THEN id % 101 END AS x", "concat('y', id % 13) AS y",
        "CASE WHEN id % 11 > 0 THEN id * 1.5D END AS m")
    measures = [F.sum("m").alias("total"), F.stddev("m").alias("spread"), F.min("m").alias("least")]
    plain = df.groupBy("a", "b").agg(
        F.count("*").alias("n"), F.countDistinct("x").alias("xs"), F.countDistinct("y").alias("ys"), *measures)
    found = distinct_counts(df, ["a", "b"], {"xs": "x", "ys": "y"}, measures, rows="n")
    assert found.columns == plain.columns
    for one, other in zip(rows(found), rows(plain)):
        assert one == pytest.approx(other)
    assert "Expand" in plan_of(plain) and "Expand" not in plan_of(found)
    assert distinct_counts(df.limit(0), ["a"], {"xs": "x"}).count() == 0


def test_distinct_counts_divide_a_hot_key_by_its_values(spark):
    df = spark.range(5000).selectExpr("id div 5000 AS a", "id * 2 AS x", "id % 2 AS y")
    found = distinct_counts(df, ["a"], {"xs": "x", "ys": "y"})
    dealt = re.findall(r"hashpartitioning\(([^)]*?), \d+\)", plan_of(found))
    assert sorted(len(keys.split(", ")) for keys in dealt) == [1, 2, 2]
    assert rows(found) == [(0, 5000, 2)]


def test_salted_left_join_keeps_null_keys(spark):
    left = spark.range(1000).selectExpr("CASE WHEN id % 2 = 0 THEN id % 10 END AS k", "id AS v")
    right = spark.range(20).selectExpr("id AS k", "id + 1 AS w")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.salted_join(left, right.hint("shuffle_hash"), "k", "v", how="left")
        assert rows(joined) == rows(left.join(right, "k", "left"))
        merged = joins.salted_join(left.hint("merge"), right, "k", "v", how="left")
        assert rows(merged) == rows(left.join(right, "k", "left"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_left_lookup_spreads_null_keys(spark):
    fact = spark.range(1000).selectExpr("CASE WHEN id % 2 = 0 THEN id END AS k", "id AS v")
    dim = spark.range(500).selectExpr("id AS k", "id + 1 AS w")
    found = joins.left_lookup(fact, dim.hint("merge"), "k", "v")
    assert rows(found) == rows(fact.join(dim, "k", "left"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = joins.left_lookup(fact, dim.hint("merge"), "k", "v").filter("k IS NULL").groupBy(
            F.spark_partition_id()).count().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert parts == 8


def test_plain_join_with_a_hot_key_is_split_by_adaptive_execution(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(0, 200_000, 1, 8).selectExpr(
            "CASE WHEN id % 2 = 0 THEN 7 ELSE id % 5000 END AS k", "id AS v", "uuid() AS text")
        dim = spark.range(5000).selectExpr("id AS k", "id AS t", "id AS w")
        joined = with_latest(fact, dim, ["k"], ["t"], ["w"], "left")
        assert len(joined.collect()) == 200_000
        assert "skew=true" in plan_of(joined)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_lookup_join_broadcasts_only_what_fits(spark):
    fact = spark.range(100).withColumnRenamed("id", "k")
    small = spark.range(10).selectExpr("id AS k", "id AS w")
    assert joins.fits(small) and not joins.fits(small, max_rows=9)
    assert not joins.fits(small, max_bytes=10)
    assert "ResolvedHint" in joins.lookup_join(fact, small, ["k"])._jdf.queryExecution(
    ).analyzed().toString()
    beyond = joins.lookup_join(fact, small, ["k"], max_rows=5)
    assert "ResolvedHint" not in beyond._jdf.queryExecution().analyzed().toString()
    assert beyond.count() == 10


def test_broadcast_join_does_not_shuffle(spark):
    fact = spark.range(0, 1000, 1, 4).withColumnRenamed("id", "k")
    plan = plan_of(joins.lookup_join(fact, spark.range(10).withColumnRenamed("id", "k"), ["k"]))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_merge_join_is_a_sort_merge_join(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    assert "SortMergeJoin" in plan_of(joins.merge_join(small, small, ["k"]))


def test_join_size_and_guard(spark):
    left, right = hot(spark, 100), hot(spark, 60)
    size = joins.join_size(left, right, ["k"]).first()
    assert size["keyed_rows"] == left.join(right, "k").count()
    assert size["keyless_rows"] == 6000.0
    with pytest.raises(ValueError, match="more than 10"):
        joins.guarded_join(left, right, ["k"], 10)
    with pytest.raises(ValueError, match="without keys"):
        joins.guarded_join(left, right, [], 10**9)
    assert joins.guarded_join(left, right, ["k"], 10**6).count() == size["keyed_rows"]


@pytest.mark.parametrize("how", ["inner", "left", "right_outer", "full", "outer", "left_semi", "left_anti"])
def test_join_size_of_every_kind(spark, how):
    left = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (None, 1), (None, None), (4, 1), (5, 2)], "k int, j int")
    right = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (2, 1), (2, 9), (None, 1), (7, 1)], "k int, j int")
    for a, b in [(left, right), (left.limit(0), right), (left, right.limit(0))]:
        for on in (["k"], ["k", "j"]):
            size = joins.join_size(a, b, on, how).first()["keyed_rows"]
            assert size == a.join(b, on, how).count()
            joins.guarded_join(a, b, on, size, how)
            if size:
                with pytest.raises(ValueError, match="more than"):
                    joins.guarded_join(a, b, on, size - 1, how)


def test_join_size_of_an_unknown_kind(spark):
    with pytest.raises(ValueError, match="no join of kind"):
        joins.join_size(spark.range(1), spark.range(1), ["id"], "asof")


def test_anti_join(spark):
    left = spark.range(5).withColumnRenamed("id", "k")
    right = spark.createDataFrame([(1,), (1,), (3,)], "k long")
    assert rows(joins.anti(left, right, ["k"])) == [(0,), (2,), (4,)]


def at(text):
    return datetime.fromisoformat(text)


@pytest.mark.parametrize("width", ["day", "week", "month", "year"])
@pytest.mark.parametrize("closed,at_border", [("left", [2.0]), ("both", [1.0, 2.0])])
def test_validity_join_borders(spark, width, closed, at_border):
    usage = spark.createDataFrame(
        [("a", at("2024-01-31 23:59:59")), ("a", at("2024-02-01")), ("a", at("2025-06-01")),
         ("a", at("2019-01-01")), ("b", at("2024-02-01"))], "sku string, t timestamp_ntz")
    card = spark.createDataFrame(
        [("a", at("2023-12-15"), at("2024-02-01"), 1.0), ("a", at("2024-02-01"), None, 2.0)],
        "sku string, s timestamp_ntz, e timestamp_ntz, price double")
    joined = joins.validity_join(usage, card, ["sku"], "t", "s", "e", closed=closed, width=width)
    got = {}
    for r in joined.collect():
        got.setdefault((r["sku"], str(r["t"])), []).append(r["price"])
    assert {k: sorted(v, key=str) for k, v in got.items()} == {
        ("a", "2024-01-31 23:59:59"): [1.0], ("a", "2024-02-01 00:00:00"): at_border,
        ("a", "2025-06-01 00:00:00"): [2.0], ("a", "2019-01-01 00:00:00"): [None],
        ("b", "2024-02-01 00:00:00"): [None]}
    plan = plan_of(joined)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_ordered_by_key_equals_windows_for_a_key_in_many_partitions(spark):
    df = hot(spark).withColumn("amount", F.col("v") % 11)
    got = ordered_by_key(df, ["k"], ["v"], sums=["amount"], ahead="v")
    w = Window.partitionBy("k").orderBy("v")
    want = df.select(
        "*", F.row_number().over(w).alias("rn"),
        F.row_number().over(Window.partitionBy("k").orderBy(F.desc("v"))).alias("rn_desc"),
        F.sum("amount").over(w).alias("amount_running"), F.lead("v").over(w).alias("next_v"))
    assert rows(got) == rows(want)


def test_ordered_by_key_splits_the_hot_key(spark):
    got = ordered_by_key(hot(spark, 20_000), ["k"], ["v"])
    spread = got.filter("k = 7").groupBy(F.spark_partition_id()).count().count()
    assert spread > 1
    assert got.filter("k = 7").agg(F.max("rn"), F.countDistinct("rn")).first() == (10_400, 10_400)


def test_ordered_by_key_with_null_keys(spark):
    df = spark.range(100).selectExpr("CASE WHEN id < 60 THEN NULL ELSE 1 END AS k", "id AS v")
    got = ordered_by_key(df, ["k"], ["v"])
    assert got.filter("k IS NULL").agg(F.max("rn")).first()[0] == 60


def test_scd_history(spark):
    events = spark.createDataFrame(
        [("w1", 1, "create"), ("w1", 2, "edit"), ("w1", 3, "delete"), ("w2", 1, "create")],
        "id string, t int, action string")
    got = scd_history(events, ["id"], ["t"], F.col("action") == "delete")
    assert rows(got) == [
        ("w1", 1, "create", 1, 3, "Active"), ("w1", 2, "edit", 2, 2, "Active"),
        ("w1", 3, "delete", 3, 1, "Deleted"), ("w2", 1, "create", 1, 1, "Active")]


def walk(edges, target, depth):
    """Brute force over a small edge list."""
    found, frontier = set(), {target}
    for level in range(1, depth + 1):
        step = {(s, t, level) for s, t in edges if t in frontier}
        found |= step
        frontier = {s for s, _, _ in step}
    return sorted(found)


def test_upstream_with_a_cycle(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "b"), ("x", "c"), ("x", "c"), ("q", "z")]
    df = spark.createDataFrame(edges, "source_table_full_name string, target_table_full_name string")
    for depth in (1, 3, 5):
        assert rows(upstream(df, "d", depth)) == walk(set(edges), "d", depth)
    assert upstream(df, "nowhere").count() == 0


def test_share_has_no_window_over_all_groups(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    result = share(df, ["k"], 1)
    assert rows(result) == [("a", 2, 66.7), ("b", 1, 33.3)]
    assert "Window" not in plan_of(result)


def test_consecutive(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 13), ("b", 2, 5)], "k string, w int, n int")
    assert rows(consecutive(df, ["k"], "w", ["n"])) == [
        ("a", 1, 10, None, None, None), ("a", 2, 13, 1, 10, 3), ("b", 2, 5, None, None, None)]


def two_states(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0)],
                                "id int, s string, x double")
    new = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (4, "d", 4.0)],
                                "id int, s string, x double")
    return old, new


def test_snapshot_diff(spark):
    assert rows(snapshot_diff(*two_states(spark), ["id"])) == [
        (2, "changed"), (3, "removed"), (4, "added")]


def test_snapshot_diff_of_null_keys_and_columns_on_one_side(spark):
    old = spark.createDataFrame([(1, None, "a"), (None, 2, "b"), (None, None, "c"), (3, 3, None), (4, 4, "d")],
                                "id int, part int, gone string")
    new = spark.createDataFrame([(1, None, None), (None, 2, None), (None, None, 7), (3, 3, None), (5, None, 1)],
                                "id int, part int, came int")
    found = rows(snapshot_diff(old, new, ["id", "part"]))
    assert sorted(found, key=str) == sorted([
        (1, None, "changed"), (None, 2, "changed"), (None, None, "changed"), (4, 4, "removed"),
        (5, None, "added")], key=str)
    assert rows(snapshot_diff(old, old, ["id", "part"])) == []
    keys = old.select("id", "part")
    assert rows(snapshot_diff(keys, keys.filter("id = 1"), ["id", "part"])) and \
        rows(snapshot_diff(keys, keys, ["id", "part"])) == []



def test_keyless_diff_counts_copies(spark):
    old = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "s string")
    new = spark.createDataFrame([("a",), ("c",), (None,)], "s string")
    assert rows(keyless_diff(old, new)) == [
        ("a", 1, "removed"), ("b", 1, "removed"), ("c", 1, "added")]


def test_row_changes_with_null_conditions(spark):
    old, new = two_states(spark)
    assert insert(old, new).count() == 6
    changed = update(old, F.col("x") > 0, {"s": F.lit("z")})
    assert rows(changed) == [(1, "z", 1.0), (2, "b", None), (3, "z", 3.0)]
    assert rows(delete(old, F.col("x") > 0)) == [(2, "b", None)]
    assert rows(upsert(old, new, ["id"])) == [
        (1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0), (4, "d", 4.0)]


def test_upsert_can_set_null(spark):
    old, new = two_states(spark)
    assert rows(upsert(new, old, ["id"]))[1] == (2, "b", None)


def test_key_skew_and_partition_skew(spark):
    df = spark.createDataFrame([("hot",)] * 70 + [("b",)] * 20 + [("c",)] * 10, "k string")
    assert rows(key_skew(df, ["k"])) == [
        ("b", 20, 20.0, 1.0), ("c", 10, 10.0, 0.5), ("hot", 70, 70.0, 3.5)]
    placed = partition_skew(df, ["k"], 8)
    real = df.repartition(8, "k").groupBy(F.spark_partition_id().alias("p")).count()
    assert sorted(r["row_count"] for r in placed.collect()) == sorted(
        r["count"] for r in real.collect())


def test_replicate_needs_no_shuffle_and_repeats_its_ids(spark):
    df = spark.range(10)
    copies = replicate(df, 5, "batch_id", ["id"])
    assert "Exchange" not in plan_of(copies) and "Join" not in plan_of(copies)
    assert copies.select("batch_id").distinct().count() == 50
    assert rows(copies) == rows(replicate(df, 5, "batch_id", ["id"]))


def test_evolve_and_top_k(spark):
    df = spark.createDataFrame([(1, 2.0, "x"), (2, 9.0, "y")], "id int, total double, region string")
    out = evolve(df, {"total": "order_total"}, {"currency": F.lit("EUR")}, ["region"])
    assert out.columns == ["id", "order_total", "currency"]
    top = first_rows(df, [F.desc("total")], 1)
    assert "TakeOrderedAndProject" in plan_of(top) and top.first()["id"] == 2


def test_flatten_params(spark):
    df = spark.createDataFrame(
        [(1, [("page", "home"), ("n", "3"), ("page", "second")]), (2, [("n", "x")]), (3, [])],
        "id int, params array<struct<key:string,value:string>>")
    flat = flatten_params(df, "params", {"page": "string", "n": "int"})
    assert rows(flat) == [(1, "home", 3), (2, None, None), (3, None, None)]


def test_upsert_refuses_repeated_source_keys(spark):
    old = spark.createDataFrame([(1, "a")], "id int, v string")
    new = spark.createDataFrame([(1, "b"), (1, "c")], "id int, v string")
    with pytest.raises(Exception, match="several source rows"):
        upsert(old, new, ["id"]).collect()
