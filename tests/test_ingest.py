"""JSON lines, incremental ingest, medallion layers, logs, snapshots and file layout."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from lakewarden.operators import quality
from lakewarden.session import fresh_dir, work_root
from lakewarden.sources import files, generators, jsonlines, layout, snapshots, tables
from lakewarden.streaming import ingest, ledger, logs, medallion
from tests.conftest import plan_of, rows

NOW = datetime(2024, 6, 1)


def job(spark, mode, **settings):
    root = fresh_dir(spark, "test-ingest")
    return ingest.Ingest(f"{root}/landing", f"{root}/table", f"{root}/checkpoint",
                         f"{root}/schema", mode=mode, **settings)


def arrive(spark, setup, variant):
    generators.write_returns(spark, variant, setup.source)


def test_work_root_is_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert work_root(spark) == named.rstrip("/")


def test_first_batch_then_widening(spark):
    setup = job(spark, ingest.ADD)
    arrive(spark, setup, 1)
    setup.run(spark)
    table = ingest.read_ingested(spark, setup)
    assert table.count() == 500 and table.filter("_rescued_data IS NOT NULL").count() == 0
    arrive(spark, setup, 2)
    setup.run(spark)
    table = ingest.read_ingested(spark, setup)
    assert table.count() == 1000
    assert table.filter("customer_satisfaction_score IS NULL").count() == 500
    assert ingest.SchemaStore(spark, setup.schema_path).versions().count() == 2
    setup.run(spark)  # nothing new arrives
    assert ingest.read_ingested(spark, setup).count() == 1000


def test_rescue_of_renamed_and_new_fields(spark):
    setup = job(spark, ingest.RESCUE_MODE)
    arrive(spark, setup, 1)
    setup.run(spark)
    arrive(spark, setup, 3)
    setup.run(spark)
    table = ingest.read_ingested(spark, setup)
    rescued = table.filter("_rescued_data IS NOT NULL")
    assert rescued.count() == 500 and rescued.filter("refund_amount IS NOT NULL").count() == 0
    assert set(json.loads(rescued.first()["_rescued_data"])) == {"refund_value", "return_channel"}
    typed = jsonlines.unrescue(rescued, {"refund_value": "double", "return_channel": "string"})
    assert typed.filter("rescued_refund_value > 0 AND rescued_return_channel IS NOT NULL"
                        ).count() == 500


def test_type_drift_goes_to_rescue(spark):
    setup = job(spark, ingest.RESCUE_MODE)
    arrive(spark, setup, 1)
    setup.run(spark)
    arrive(spark, setup, 4)
    setup.run(spark)
    bad = ingest.read_ingested(spark, setup).filter("_rescued_data IS NOT NULL")
    assert bad.count() == 500 and bad.filter("refund_amount IS NULL").count() == 500
    assert json.loads(bad.first()["_rescued_data"])["refund_amount"].startswith("EUR ")


def test_fail_mode_writes_nothing(spark):
    setup = job(spark, ingest.FAIL)
    arrive(spark, setup, 1)
    setup.run(spark)
    arrive(spark, setup, 2)
    with pytest.raises(ingest.NewFieldsError, match="customer_satisfaction_score"):
        setup.run(spark)
    assert ingest.read_ingested(spark, setup).count() == 500


def test_none_mode_ignores_new_fields(spark):
    setup = job(spark, ingest.NONE, rescue=False)
    arrive(spark, setup, 1)
    setup.run(spark)
    arrive(spark, setup, 2)
    setup.run(spark)
    table = ingest.read_ingested(spark, setup)
    assert table.count() == 1000 and "customer_satisfaction_score" not in table.columns


def test_lost_checkpoint_doubles_rows_unless_the_target_is_new(spark):
    setup = job(spark, ingest.ADD)
    arrive(spark, setup, 1)
    setup.run(spark)
    again = ingest.reprocess(spark, setup, f"{setup.checkpoint}-2")
    assert ingest.read_ingested(spark, again).count() == 1000
    anew = ingest.reprocess(spark, setup, f"{setup.checkpoint}-3", f"{setup.target}-2")
    assert ingest.read_ingested(spark, anew).count() == 500


def test_throttle_ledger_and_backlog(spark):
    setup = job(spark, ingest.ADD, max_files=2)
    arrive(spark, setup, 1)
    setup.run(spark)
    done = ledger.processed_files(spark, setup.checkpoint)
    assert done.count() == 5
    assert sorted(r["count"] for r in done.groupBy("batch_id").count().collect()) == [1, 2, 2]
    assert done.filter("size_bytes > 0 AND committed_at IS NOT NULL").count() == 5
    assert done.agg(F.sum("row_count")).first()[0] == 500
    arrive(spark, setup, 2)
    waiting = ledger.backlog_files(spark, setup.source, setup.checkpoint).filter(
        "file_path LIKE '%.txt'")
    assert waiting.count() == 5
    assert ledger.backlog(spark, setup.source, setup.checkpoint).first()["bytes"] > 0


def test_many_batches_survive_log_compaction(spark):
    setup = job(spark, ingest.ADD, max_files=1)
    for variant in (1, 2, 1):
        arrive(spark, setup, variant)
    setup.run(spark)
    assert ledger.processed_files(spark, setup.checkpoint).count() == 15


def test_ledger_outlives_the_commits_that_spark_keeps(spark):
    keep = spark.conf.get("spark.sql.streaming.minBatchesToRetain")
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", "2")
    try:
        setup = job(spark, ingest.ADD, max_files=1)
        assert ledger.processed_files(spark, setup.checkpoint).count() == 0
        arrive(spark, setup, 1)
        setup.run(spark)
        arrive(spark, setup, 2)
        setup.run(spark)
    finally:
        spark.conf.set("spark.sql.streaming.minBatchesToRetain", keep)
    done = ledger.processed_files(spark, setup.checkpoint)
    assert done.agg(F.count("*"), F.sum("row_count"), F.countDistinct("batch_id")).first() == (10, 1000, 10)
    assert ledger.backlog(spark, setup.source, setup.checkpoint).first()["files"] == 0


def test_recorded_counters_of_a_stateful_stream(spark):
    root = fresh_dir(spark, "recorded")
    rows = spark.range(300).selectExpr("id", "id % 100 AS key", "TIMESTAMP '2024-01-01' AS ts")
    rows.repartition(6).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    checks = [quality.Rule("small", "key < 50", quality.DROP)]
    ledger.run_recorded(medallion.dedup_stream(stream, "key", "ts"), f"{root}/out", f"{root}/ck", checks)
    out = ledger.read_recorded(spark, f"{root}/out", rows.schema)
    assert out.count() == 50
    batches = ledger.batch_counts(spark, f"{root}/ck")
    assert batches.agg(F.sum("input_rows"), F.sum("output_rows")).first() == (100, 50)
    assert batches.select("batch_id").distinct().count() == batches.count() >= 6
    rule = ledger.rule_counts(spark, f"{root}/ck").groupBy("name").agg(
        F.sum("passed_records"), F.sum("failed_records")).collect()
    assert rule == [("small", 50, 50)]


def test_byte_limit_is_accepted(spark):
    setup = job(spark, ingest.ADD, max_bytes=1024)
    arrive(spark, setup, 1)
    setup.run(spark)
    assert ingest.read_ingested(spark, setup).count() == 500


def test_processed_files_are_archived(spark):
    setup = job(spark, ingest.ADD, clean="archive", max_age="7d")
    setup.archive = f"{setup.source}-archive"
    for variant in (1, 2, 2):  # files of a batch are moved when a later batch is planned
        arrive(spark, setup, variant)
        setup.run(spark)
    assert ingest.read_ingested(spark, setup).count() == 1500
    archived = [f for _, _, names in os.walk(setup.archive) for f in names if f.endswith(".txt")]
    assert len(archived) >= 5


def test_missing_folder_is_named(spark):
    with pytest.raises(tables.PathMissing, match="inventori_raw"):
        medallion.bronze_ingest(spark, "/tmp/nowhere/inventori_raw")
    with pytest.raises(tables.PathMissing, match="nowhere"):
        job_at = ingest.Ingest("/tmp/nowhere/x", "t", "c", "s")
        job_at.run(spark)
    with pytest.raises(tables.PathMissing, match="nowhere"):
        tables.read_json(spark, "/tmp/nowhere")


LINES = ['{"a":1,"b":2.5,"c":"x"}', '{"a":"7","b":3,"z":{"q":1}}', "not json", '{"a":null}', "",
         '{"a":2.5,"c":12}', '{"a":9223372036854775808}']


def test_parse_and_rescue(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    schema = T.StructType.fromDDL("a bigint, b double, c string")
    got = [tuple(r) for r in jsonlines.parse(lines, schema).collect()]
    assert got[0] == (1, 2.5, "x", None)
    assert got[1][:3] == (None, 3.0, None) and json.loads(got[1][3]) == {"a": "7", "z": {"q": 1}}
    assert got[2] == (None, None, None, "not json")
    assert got[3] == (None, None, None, None) and got[4] == (None, None, None, None)
    assert got[5][:3] == (None, None, "12") and json.loads(got[5][3]) == {"a": 2.5}
    assert got[6][0] is None and got[6][3] is not None
    assert jsonlines.new_fields(lines, schema) == ["z"]


def test_inferred_types(spark):
    lines = spark.createDataFrame(
        [('{"i":1,"d":1,"s":"x","m":1,"o":{"q":1},"t":true}',), ('{"i":2,"d":1.5,"m":"x"}',)],
        "value string")
    typed = {f.name: f.dataType.simpleString() for f in jsonlines.infer_schema(lines)}
    assert typed == {"i": "bigint", "d": "double", "s": "string", "m": "string", "o": "string",
                     "t": "boolean"}
    text = jsonlines.infer_schema(lines, typed=False, hints={"i": "int"})
    assert {f.dataType.simpleString() for f in text} == {"string", "int"}


def test_medallion_is_incremental(spark):
    root = fresh_dir(spark, "test-medallion")

    def land(name, events):
        spark.createDataFrame(events, medallion.HINTS).coalesce(1).write.mode("append").json(
            f"{root}/raw")

    land("one", [("e1", "p1", "W1", "SALE", -2, datetime(2024, 5, 1)),
                 (None, "p1", "W1", "SALE", -2, datetime(2024, 5, 1)),
                 ("e3", "p1", "W1", "SALE", 5, datetime(2030, 1, 1)),
                 ("e4", "p1", "W1", "SALE", 5, None)])
    first = medallion.medallion(spark, f"{root}/raw", f"{root}/out", f"{root}/ck", NOW)
    assert first["bronze"].count() == 4 and first["silver"].count() == 1
    land("two", [("e5", "p1", "W1", "SALE", 10, datetime(2024, 5, 2))])
    second = medallion.medallion(spark, f"{root}/raw", f"{root}/out", f"{root}/ck", NOW)
    assert second["bronze"].count() == 5
    assert rows(second["gold"]) == [
        ("W1", "p1", "SALE", 8, 2, datetime(2024, 5, 1), datetime(2024, 5, 2))]


@pytest.mark.parametrize("salts", [1, 4])
def test_stream_dedup_of_a_hot_key(spark, salts):
    root = fresh_dir(spark, "test-dedup")
    df = spark.range(0, 3000, 1, 6).selectExpr(
        "CASE WHEN id % 3 = 0 THEN -1 ELSE id % 100 END AS event_id",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS ts")
    df.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{root}/in")
    medallion.run_once(medallion.dedup_stream(stream, "event_id", "ts", salts=salts),
                       f"{root}/out", f"{root}/ck")
    got = spark.read.parquet(f"{root}/out")
    assert got.count() == got.select("event_id").distinct().count() == 101


def test_log_files(spark):
    root = fresh_dir(spark, "test-logs")
    os.makedirs(f"{root}/c1/driver")
    text = {"stdout": "started\ndone\n", "stderr": "2024-05-01 10:00:00 ERROR OutOfMemory\nplain\n",
            "log4j-active.log": "24/05/01 WARN spill to disk\n"}
    for name, content in text.items():
        with open(f"{root}/c1/driver/{name}", "w") as f:
            f.write(content)
    assert files.file_inventory(spark, root).count() == 3
    assert files.file_inventory(spark, root, 2).count() == 2
    lines = files.read_logs(spark, root)
    assert files.log_search(lines, ["OutOfMemory", "spill"]).count() == 2
    assert rows(files.log_stream(lines, "driver/stderr"))[1] == ("plain",)
    out = fresh_dir(spark, "test-central")
    logs.centralise_logs(spark, root, f"{out}/t", f"{out}/c")
    err = logs.log_table(spark, f"{out}/t", "stderr")
    assert err.count() == 2
    assert err.filter("level = 'ERROR'").first()["logged_at"] == datetime(2024, 5, 1, 10)
    assert "PartitionFilters: [isnotnull(log_class" in plan_of(err)
    logs.centralise_logs(spark, root, f"{out}/t", f"{out}/c")
    assert spark.read.parquet(f"{out}/t").count() == 5


def test_snapshots(spark):
    path = fresh_dir(spark, "test-versions")
    base = spark.range(10).withColumn("s", F.lit("a"))
    steps = [(base, "CREATE"), (base.union(spark.range(10, 12).withColumn("s", F.lit("a"))),
                                "INSERT"), (base.filter("id > 3"), "DELETE")]
    for i, (df, name) in enumerate(steps):
        assert snapshots.commit(df, path, name, NOW + timedelta(days=i)) == i
    assert snapshots.as_of(spark, path).count() == 6
    assert snapshots.as_of(spark, path, version=1).count() == 12
    assert snapshots.as_of(spark, path, ts=NOW + timedelta(hours=30)).count() == 12
    with pytest.raises(ValueError):
        snapshots.as_of(spark, path, ts=NOW - timedelta(days=1))
    history = [tuple(r) for r in snapshots.history(spark, path, ["id"]).select(
        "version", "rows_added", "rows_removed", "rows_changed").collect()]
    assert history == [(0, None, None, None), (1, 2, 0, 0), (2, 0, 6, 0)]
    assert snapshots.restore(spark, path, 1, NOW + timedelta(days=3)) == 3
    assert snapshots.as_of(spark, path).count() == 12
    late = NOW + timedelta(days=60)
    old = snapshots.expired(spark, path, late, 7)
    assert {r["version"] for r in old.collect()} == {0, 1, 2}
    kept = snapshots.expired(spark, path, late, 7, keep=3)
    assert {r["version"] for r in kept.collect()} == {0}


def test_data_without_a_manifest_row_is_not_a_version(spark):
    path = fresh_dir(spark, "test-cut-off")
    snapshots.commit(spark.range(3), path, "CREATE", NOW)
    spark.range(99).write.parquet(f"{path}/data/v=1")  # a commit that was cut off
    assert snapshots.as_of(spark, path).count() == 3
    assert snapshots.commit(spark.range(4), path, "INSERT", NOW) == 1
    assert snapshots.as_of(spark, path).count() == 4


def test_compaction_and_clustering(spark):
    root = fresh_dir(spark, "test-layout")
    df = spark.range(0, 10_000, 1, 1).selectExpr("id", "id % 4 AS region", "id AS t")
    df.repartition(30).write.parquet(f"{root}/small")
    layout.compact(spark, f"{root}/small", f"{root}/packed", 64 << 20)
    count = {p: files.file_inventory(spark, f"{root}/{p}").filter("file_path LIKE '%parquet'").count()
             for p in ("small", "packed")}
    assert count == {"small": 30, "packed": 1}
    assert rows(spark.read.parquet(f"{root}/packed").groupBy("region").count()) == [
        (r, 2500) for r in range(4)]
    assert layout.file_count(spark, f"{root}/small", 1 << 30) == 1
    layout.cluster(df, ["region", "t"], "id", f"{root}/clustered", 8)
    report = files.layout_report(spark, f"{root}/clustered", "region")
    share = files.skip_share(report, low=F.lit(2), high=F.lit(2)).first()
    assert share["row_count"] == 10_000 and share["skip_share"] >= 0.5
    plain = files.skip_share(files.layout_report(spark, f"{root}/small", "region"),
                             low=F.lit(2), high=F.lit(2)).first()
    assert plain["skip_share"] < 0.2


def test_one_clustering_value_fills_several_files(spark):
    path = fresh_dir(spark, "test-one-value")
    df = spark.range(10_000).selectExpr("id", "'hot' AS region")
    layout.cluster(df, ["region"], "id", path, 8)
    assert files.layout_report(spark, path, "region").count() == 8


def test_filters_reach_the_scan(spark):
    path = fresh_dir(spark, "test-scan")
    spark.sql("SELECT id, timestamp_ntz'2024-01-01 00:00:00' + id * INTERVAL '1' HOUR AS ts,"
              " 'x' AS unused FROM range(100)").write.parquet(path)
    df = tables.read_table(spark, path, "ts", datetime(2024, 1, 3)).select("id", "ts")
    plan = plan_of(df)
    assert "GreaterThanOrEqual(ts," in plan and "unused" not in plan
    assert df.count() == 52


def test_snapshot_tables_and_json_sample(spark):
    out = fresh_dir(spark, "test-copies")
    df = spark.sql("SELECT id, date_add(DATE '2024-05-20', CAST(id AS INT)) AS d FROM range(12)")
    written = tables.snapshot_tables({"all": df, "recent": df}, out, NOW, {"recent": ("d", 7)})
    assert spark.read.parquet(written["all"]).count() == 12
    assert spark.read.parquet(written["recent"]).count() == 7
    tables.write_json_sample(df, 5, f"{out}/sample")
    assert tables.read_json(spark, f"{out}/sample").count() == 5


def test_freshness(spark):
    out = fresh_dir(spark, "test-fresh")
    stored = {name: tables.refresh(spark.range(3), f"{out}/{name}", NOW - timedelta(hours=h))
              for name, h in (("new", 4), ("older", 5), ("old", 25))}
    got = {r["name"]: r["status"] for r in tables.freshness(stored, NOW).collect()}
    assert got == {"new": "FRESH", "older": "AGING", "old": "STALE"}


def test_files_of_any_age_arrive(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    setup = ingest.Ingest(*[str(tmp_path / p) for p in ("landing", "table", "checkpoint", "schema")],
                          mode="add")
    for n, age in enumerate((0, 10, 400)):
        path = landing / f"{n}.json"
        path.write_text('{"a": %d}\n' % n)
        past = (datetime.now() - timedelta(days=age)).timestamp()
        os.utime(path, (past, past))
        setup.run(spark)
    assert ingest.read_ingested(spark, setup).count() == 3


def test_fields_beyond_the_most_frequent_go_to_the_rescue_column(spark):
    # 3,000 names that the data choose, each on one line, beside three that all lines have.
    lines = spark.range(3000).selectExpr(
        """concat('{"id":', id, ',"name":"n', id, '","score":', CASE WHEN id % 10 = 0 THEN '"bad"' ELSE '1.5' END,
           ',"tag', id, '":', id, '}') AS value""")
    schema = jsonlines.infer_schema(lines, hints={"score": "double"}, most=2)
    assert schema.simpleString() == "struct<id:bigint,name:string,score:double>"
    found = jsonlines.parse(lines, schema)
    assert found.columns == ["id", "name", "score", "_rescued_data"]
    got = {r["id"]: (r["name"], r["score"], json.loads(r["_rescued_data"])) for r in found.collect()}
    assert got == {i: (f"n{i}", None, {"score": "bad", f"tag{i}": i}) if i % 10 == 0
                   else (f"n{i}", 1.5, {f"tag{i}": i}) for i in range(3000)}
    assert len(jsonlines.infer_schema(lines).fields) == 3003
    assert jsonlines.infer_schema(lines.limit(0), most=2).fields == []


def test_rescue_tests_each_type_once(spark):
    fields = [T.StructField(f"f{i}", T.LongType() if i % 2 else T.BooleanType()) for i in range(40)]
    lines = spark.createDataFrame([('{"f0":true,"f1":1,"f2":5,"f3":null,"g":2}',), ("no json",)], "value string")
    found = jsonlines.parse(lines, T.StructType(fields))
    got = {(r["f0"], r["f1"], r["f2"], r["f3"], r["_rescued_data"]) for r in found.collect()}
    assert got == {(True, 1, None, None, '{"f2":5,"g":2}'), (None, None, None, None, "no json")}
    rescued = found.select("_rescued_data")._jdf.queryExecution().optimizedPlan().toString()
    assert 2 <= rescued.count("variant_get(") <= 4  # two types, and not 40 fields
