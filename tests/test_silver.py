"""Silver without copies and gold that grows by batches."""

from datetime import datetime

import pytest

from lakewarden.session import fresh_dir
from lakewarden.sources.files import file_inventory
from lakewarden.streaming import ledger, medallion, merged
from tests.conftest import rows

NOW = datetime(2024, 6, 1)


def land(spark, root, events):
    spark.createDataFrame(events, medallion.HINTS).coalesce(1).write.mode("append").json(f"{root}/raw")


def event(i, product="p1", amount=1, at=datetime(2024, 5, 1), kind="SALE"):
    return (i, product, "W1", kind, amount, at)


def run(spark, root, **how):
    return medallion.medallion(spark, f"{root}/raw", f"{root}/out", f"{root}/ck", NOW, **how)


def test_a_repeated_event_reaches_silver_once(spark):
    root = fresh_dir(spark, "test-silver")
    land(spark, root, [event("e1"), event("e1"), event("e2", at=datetime(2020, 1, 1)), event(None), event(None),
                       event("e3", at=datetime(2030, 1, 1)), event("e3", at=datetime(2030, 1, 1))])
    first = run(spark, root)
    assert rows(first["silver"].select("event_id")) == [("e1",), ("e2",)]
    # A copy in a later batch, a row much older than all before, and an event that was wrong at first.
    land(spark, root, [event("e1", amount=5), event("e4", at=datetime(1999, 1, 1)), event("e3")])
    second = run(spark, root)
    assert rows(second["silver"].select("event_id")) == [("e1",), ("e2",), ("e3",), ("e4",)]
    totals = {}
    for r in second["rules"].collect():
        passed, failed = totals.get(r["name"], (0, 0))
        totals[r["name"]] = passed + r["passed_records"], failed + r["failed_records"]
    assert totals["valid_event_id"] == (6, 2) and totals["valid_timestamp"] == (6, 2)
    assert rows(second["copies"].select("input_rows", "removed_copies")) == [(3, 1), (7, 1)]
    assert rows(second["gold"].select("product_id", "total_quantity_change", "event_count")) == [("p1", 4, 4)]


def test_a_batch_writes_only_the_groups_it_touches(spark):
    root = fresh_dir(spark, "test-gold")
    land(spark, root, [event(f"a{i}", product=f"p{i}") for i in range(100)])
    run(spark, root)
    land(spark, root, [event("b1", product="p7", amount=10, at=datetime(2024, 5, 9))])
    gold = run(spark, root)["gold"]
    assert spark.read.parquet(f"{root}/out/gold/parts").groupBy("batch").count().orderBy("batch").collect()[-1]["count"] == 1
    assert gold.count() == 100
    assert rows(gold.filter("product_id = 'p7'").select("total_quantity_change", "event_count", "last_event")) == [
        (11, 2, datetime(2024, 5, 9))]


def stored(spark):
    rows_ = spark.createDataFrame([("a", 1, 2.0), ("a", None, 3.0), ("b", 5, None)], "k string, n long, x double")
    out = merged.summary(fresh_dir(spark, "test-merged"), ["k"], [
        ("total", "sum", "n"), ("n_rows", "count", "*"), ("known", "count", "x"), ("low", "min", "x"), ("high", "max", "x")])
    return out, rows_, merged.schema_of(out, rows_)


def test_a_repeated_batch_changes_nothing_and_folding_keeps_the_state(spark):
    out, df, schema = stored(spark)
    out.add(df, 0)
    out.add(df.filter("k = 'b'"), 1)
    out.add(df.filter("k = 'b'"), 1)
    want = [("a", 1, 2, 2, 2.0, 3.0), ("b", 10, 2, 0, None, None)]
    assert rows(out.read(spark, schema)) == want
    out.fold(spark, schema, 0)
    assert rows(out.read(spark, schema)) == want
    out.fold(spark, schema, 1)
    out.fold(spark, schema, 1)
    assert rows(out.read(spark, schema)) == want
    out.add(df.filter("k = 'a'"), 2)
    assert rows(out.read(spark, schema)) == [("a", 2, 4, 4, 2.0, 3.0), want[1]]
    # A base that was cut off before its marker is not read.
    df.select("k").write.parquet(f"{out.path}/base-2")
    assert rows(out.read(spark, schema))[0] == ("a", 2, 4, 4, 2.0, 3.0)
    out.fold(spark, schema, 2)
    assert rows(out.read(spark, schema))[0] == ("a", 2, 4, 4, 2.0, 3.0)
    assert out.partial(df).count() == 2


def test_only_mergeable_measures_are_taken(spark):
    with pytest.raises(ValueError, match="can't be merged"):
        merged.summary("/tmp/x", ["k"], [("m", "avg", "n")])


def test_a_ledger_of_many_batches_stays_small(spark):
    checkpoint = f"{fresh_dir(spark, 'test-ledger')}/ck"

    def batch(n):
        ledger._write(spark.createDataFrame([(n, "r", n, 1), (n, "s", 0, n)], ledger.RULES).coalesce(1),
                      checkpoint, "rules", n)

    def files():
        return file_inventory(spark, f"{checkpoint}-ledger").filter("file_path like '%.parquet'").count()

    want = []
    for n in range(18):
        batch(n)
        want += [(n, "r", n, 1), (n, "s", 0, n)]
        if n == 11:
            earlier, then = ledger.rule_counts(spark, checkpoint), rows(spark.createDataFrame(want, ledger.RULES))
        merged_now = ledger.compact(spark, checkpoint, every=5)
        assert merged_now == (["rules"] if n in (5, 11, 17) else [])
        if n == 11:
            assert rows(earlier) == then  # a reader that goes on over a merge
    state = rows(spark.createDataFrame(want, ledger.RULES))
    assert rows(ledger.rule_counts(spark, checkpoint)) == state
    assert files() <= 2 * 6 + 2 * (8 + 1)  # batches of two merges, two bases with their markers
    batch(17)  # a repeated batch that is in the base already changes nothing
    assert rows(ledger.rule_counts(spark, checkpoint)) == state


def test_counters_are_observed_while_rows_are_written(spark):
    root = fresh_dir(spark, "test-observed")
    land(spark, root, [event(None), event("x")])
    stream = spark.readStream.schema(medallion.HINTS).json(f"{root}/raw")
    seen = []
    ledger.run_recorded(stream, f"{root}/out", f"{root}/ck", medallion.silver_rules(NOW),
                        lambda df, n: seen.append((n, df.count())))
    assert seen == [(0, 1)]
    assert rows(ledger.batch_counts(spark, f"{root}/ck").select("input_rows", "output_rows")) == [(2, 1)]
    assert ledger.removed_copies(spark, f"{root}/ck").count() == 0
