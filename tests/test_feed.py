import datetime as dt
import gzip
import os
import tempfile

import pytest
import zipfile

from pyspark.sql import functions as F

from inspecta.sources.feed import read_feed, read_feed_zip, split_corrupt, latest_feed
from inspecta.sources.sinks import read_latest, table_versions, write_version, to_flat
from inspecta.streaming.streams import budget_overruns, ingest, stream_feed

GOOD = ('{"registration":"A1","make":"ford","lastMotTestDate":"2024-01-02T10:00:00",'
        '"motTests":[{"completedDate":"2024-01-02T10:00:00","testResult":"PASSED","odometerValue":"12"}],'
        '"modification":"UPDATED","unknownField":1}')


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with gzip.open(os.path.join(folder, name), "wt") as f:
        f.write("\n".join(lines) + "\n")


def test_blank_corrupt_and_tags(spark):
    root = tempfile.mkdtemp()
    _write(f"{root}/delta-light-vehicle_02-02-2026", "a.json.gz",
           [GOOD, "", "   ", '{"registration": "B2", "make"', '{"registration":"C3"}'])
    _write(f"{root}/bulk-light-vehicle_nodate", "b.json.gz", ['{"registration":"Z9"}'])
    _write(f"{root}/other-folder_02-02-2026", "c.json.gz", ['{"registration":"X"}'])
    good, bad = split_corrupt(read_feed(spark, root))
    g = {r.registration: r for r in good.collect()}
    assert set(g) == {"A1", "C3", "Z9"}
    assert g["A1"].feed_date == dt.date(2026, 2, 1) and g["A1"].date == "01-02-2026"
    assert g["Z9"].feed_date is None and g["Z9"].date == ""
    assert g["C3"].motTests is None
    assert [r.raw for r in bad.collect()] == ['{"registration": "B2", "make"']
    assert read_feed(spark, root, kind="bulk").count() == 1
    flat = {r.registration: r for r in to_flat(good).collect()}
    assert flat["C3"].motTestCount == 0 and flat["C3"].motTests == "[]" and flat["C3"].make == ""
    assert flat["A1"].motTestCount == 1 and '"motTestNumber":null' in flat["A1"].motTests


def test_latest_feed_and_zip(spark):
    root = tempfile.mkdtemp()
    _write(f"{root}/delta-light-vehicle_02-02-2026", "a.json.gz", [GOOD])
    _write(f"{root}/delta-light-vehicle_09-02-2026", "a.json.gz", [GOOD.replace("A1", "A2")])
    latest = latest_feed(read_feed(spark, root, kind="delta")).collect()
    assert [r.registration for r in latest] == ["A2"]
    zroot = tempfile.mkdtemp()
    with zipfile.ZipFile(f"{zroot}/delta-light-vehicle_02-02-2026.zip", "w") as z:
        z.writestr("part1.json.gz", gzip.compress((GOOD + "\n\n" + "{bad" + "\n").encode()))
    good, bad = split_corrupt(read_feed_zip(spark, zroot))
    rows = good.collect()
    assert [r.registration for r in rows] == ["A1"] and rows[0].feed_date == dt.date(2026, 2, 1)
    assert bad.count() == 1


def test_stream_processes_each_file_once(spark):
    root, sink, ckpt = tempfile.mkdtemp(), tempfile.mkdtemp(), tempfile.mkdtemp()
    _write(f"{root}/delta-light-vehicle_02-02-2026", "a.json.gz", [GOOD])
    ingest(stream_feed(spark, root), sink + "/t", ckpt).awaitTermination()
    ingest(stream_feed(spark, root), sink + "/t", ckpt).awaitTermination()
    assert spark.read.parquet(sink + "/t").count() == 1
    _write(f"{root}/delta-light-vehicle_09-02-2026", "b.json.gz", [GOOD.replace("A1", "A2")])
    ingest(stream_feed(spark, root), sink + "/t", ckpt).awaitTermination()
    assert sorted(r.registration for r in spark.read.parquet(sink + "/t").collect()) == ["A1", "A2"]


def test_versioned_table(spark):
    path = tempfile.mkdtemp() + "/main"
    assert table_versions(spark, path) == []
    write_version(spark.range(3), path)
    write_version(spark.range(5), path)
    assert table_versions(spark, path) == [1, 2] and read_latest(spark, path).count() == 5


def test_versions_by_uri_and_taken_number(spark):
    path = "file:" + tempfile.mkdtemp() + "/main"       # the form Spark itself reports
    write_version(spark.range(3), path)
    assert table_versions(spark, path) == [1] and read_latest(spark, path).count() == 3
    spark.range(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path + "/v=000002")
    with pytest.raises(Exception, match="already exists"):
        write_version(spark.range(4), path)
    assert table_versions(spark, path) == [1]


def test_null_keys_are_dropped_by_the_stream_and_rows_reported(spark):
    import datetime as dt
    from inspecta.operators.enrich import enrich
    from inspecta.plans.pipelines import weekly_delta_ingest
    from inspecta.schema import VEHICLE
    root, table, ckpt = tempfile.mkdtemp(), tempfile.mkdtemp() + "/main", tempfile.mkdtemp()
    base = {f: None for f in VEHICLE.fieldNames()}
    write_version(enrich(spark.createDataFrame([{**base, "registration": r} for r in ("A1", "B2")], VEHICLE),
                         dt.date(2026, 2, 1)), table)
    nameless = '{"modification":"UPDATED","make":"x"}'
    _write(f"{root}/delta-light-vehicle_02-02-2026", "a.json.gz", [GOOD, nameless, nameless])
    got = weekly_delta_ingest(spark, root, table, ckpt, dt.date(2026, 2, 1))
    assert sorted((a, n) for _, a, n in got) == [("keep", 1), ("update", 1)]
    assert read_latest(spark, table).count() == 2
    assert weekly_delta_ingest(spark, root, table, ckpt, dt.date(2026, 2, 1)) == []


def test_counts_refresh_replaces_the_table(spark, tmp_path):
    import datetime as dt
    from inspecta.sources.sinks import read_daily_counts, write_daily_counts
    t = dt.datetime
    rows = [(t(2024, 5, 1), "PASSED", 1), (t(2024, 6, 1), "PASSED", 2), (t(2024, 6, 20), "PASSED", 3)]
    df = spark.createDataFrame(rows, "test_date timestamp_ntz, result_type string, count bigint")
    write_daily_counts(df, str(tmp_path / "c"))
    write_daily_counts(df.where("test_date >= timestamp_ntz'2024-06-10'"), str(tmp_path / "c"))
    assert [r["count"] for r in read_daily_counts(spark, str(tmp_path / "c")).collect()] == [3]


def test_limit_takes_the_first_by_order(spark):
    root = tempfile.mkdtemp()
    _write(f"{root}/bulk-light-vehicle_02-02-2026", "a.json.gz", [GOOD.replace("A1", f"R{k}") for k in (5, 3, 9, 1)])
    df = read_feed(spark, root, kind="bulk", limit=2, limit_order=["registration"])
    assert sorted(r.registration for r in df.collect()) == ["R1", "R3"]


def test_budget_overruns_batch_and_stream(spark):
    body = F.base64(F.encode(F.to_json(F.struct(F.col("c").alias("costAmount"),
                                                F.col("b").alias("budgetAmount"))), "UTF-8"))
    df = spark.createDataFrame([(10.0, 50.0), (50.0, 50.0), (75.5, 50.0)], "c double, b double").select(body.alias("data"))
    assert [r.costAmount for r in budget_overruns(df).collect()] == [75.5]
    d = tempfile.mkdtemp()
    df.write.mode("overwrite").parquet(d + "/msgs")
    s = spark.readStream.schema("data string").parquet(d + "/msgs")
    q = budget_overruns(s).writeStream.format("memory").queryName("alerts_t").start()
    q.processAllAvailable()
    q.stop()
    assert [r.costAmount for r in spark.table("alerts_t").collect()] == [75.5]


def test_csv_export_and_drop_stage(spark):
    root = tempfile.mkdtemp()
    _write(f"{root}/delta-light-vehicle_02-02-2026", "a.json.gz", [GOOD])
    from inspecta.sources.sinks import drop_stage, write_csv
    good, _ = split_corrupt(read_feed(spark, root))
    out = write_csv(good, root + "/csv")
    back = spark.read.option("header", True).option("escape", '"').csv(out).collect()
    import csv
    import glob
    import json
    with open(glob.glob(out + "/part-*.csv")[0], newline="") as f:       # readable outside Spark
        rows = list(csv.DictReader(f))
    assert len(rows) == 1 and json.loads(rows[0]["motTests"])[0]["testResult"] == "PASSED"
    assert back[0].registration == "A1" and back[0].motTestCount == "1" and back[0].date == "01-02-2026"
    spark.range(3).write.mode("overwrite").saveAsTable("inspecta_stage_t")
    drop_stage(spark, "inspecta_stage_t")
    drop_stage(spark, "inspecta_stage_t")   # missing table is fine
    assert not spark.catalog.tableExists("inspecta_stage_t")


def test_read_latest_feed_reads_one_folder(spark):
    from inspecta.sources.feed import read_latest_feed
    root = tempfile.mkdtemp()
    _write(f"{root}/delta-light-vehicle_02-02-2026", "a.json.gz", [GOOD])
    _write(f"{root}/delta-light-vehicle_09-02-2026", "a.json.gz", [GOOD.replace("A1", "A2")])
    _write(f"{root}/delta-light-vehicle_undated", "a.json.gz", [GOOD.replace("A1", "A3")])
    df = read_latest_feed(spark, root)
    assert [r.registration for r in df.collect()] == ["A2"]
    assert {r._source_file.rsplit("/", 2)[-2] for r in df.collect()} == {"delta-light-vehicle_09-02-2026"}


def test_stream_upsert_in_single_file_batches_equals_sequential_batch_upserts(spark):
    import datetime as dt
    from inspecta.operators.enrich import enrich
    from inspecta.operators.merge import prepare_delta, upsert
    from inspecta.schema import VEHICLE
    from inspecta.streaming.streams import start_upsert
    root, table, ckpt = tempfile.mkdtemp(), tempfile.mkdtemp() + "/main", tempfile.mkdtemp()
    as_of = dt.date(2026, 2, 1)
    base = {f: None for f in VEHICLE.fieldNames()}
    main = enrich(spark.createDataFrame([{**base, "registration": "A1", "make": "OLD"},
                                         {**base, "registration": "B2", "make": "OLD"}], VEHICLE), as_of)
    write_version(main, table)
    first = [GOOD.replace('"modification":"UPDATED"', '"modification":"DELETED"')]
    second = [GOOD.replace("2024-01-02T10:00:00", "2024-01-09T10:00:00").replace("ford", "kia"),
              GOOD.replace("A1", "C3")]
    _write(f"{root}/delta-light-vehicle_02-02-2026", "a.json.gz", first)
    _write(f"{root}/delta-light-vehicle_09-02-2026", "b.json.gz", second)
    q = start_upsert(stream_feed(spark, root, max_files_per_trigger=1), table, ckpt, as_of)
    q.awaitTermination()
    got = {r.registration: (r.make, r.modification) for r in read_latest(spark, table).collect()}
    # batch 1 deletes A1; batch 2 re-inserts it (not matched any more) and inserts C3
    assert got == {"A1": ("kia", "UPDATED"), "B2": ("OLD", None), "C3": ("ford", "UPDATED")}
    assert table_versions(spark, table) == [1, 2, 3]


def test_job_runner_end_to_end(spark, tmp_path):
    from inspecta.plans.jobs import main as run
    root = tempfile.mkdtemp()
    _write(f"{root}/bulk-light-vehicle_02-02-2026", "a.json.gz",
           [GOOD, GOOD.replace("A1", "B2").replace("PASSED", "FAILED")])
    _write(f"{root}/delta-light-vehicle_09-02-2026", "b.json.gz", [GOOD.replace("A1", "C3")])
    table, ckpt = str(tmp_path / "main"), str(tmp_path / "ckpt")
    assert run(["bulk-load", "--feed", root, "--table", table, "--as-of", "2024-02-01"]) == 0
    assert run(["weekly", "--feed", root, "--table", table, "--checkpoint", ckpt, "--as-of", "2024-02-01"]) == 0
    assert sorted(r.registration for r in read_latest(spark, table).collect()) == ["A1", "B2", "C3"]
    assert run(["counts", "--table", table, "--out", str(tmp_path / "counts"), "--as-of", "2024-02-01"]) == 0
    got = {r.result_type: r["count"] for r in spark.read.parquet(str(tmp_path / "counts")).collect()}
    assert got == {"PASSED": 2, "FAILED": 1}
    # a later delta deletes a vehicle by a record without a date; runs without new files change nothing
    _write(f"{root}/delta-light-vehicle_16-02-2026", "c.json.gz", ['{"registration":"C3","modification":"DELETED"}', '{"modification":"UPDATED"}'])
    for _ in range(3):
        assert run(["weekly", "--feed", root, "--table", table, "--checkpoint", ckpt, "--as-of", "2024-02-01"]) == 0
    assert sorted(r.registration for r in read_latest(spark, table).collect()) == ["A1", "B2"]
    assert table_versions(spark, table) == [1, 2, 3]
    assert run(["forecast", "--counts", str(tmp_path / "counts"), "--out", str(tmp_path / "fc"), "--as-of", "2024-02-01"]) == 0
    assert run(["view", "--counts", str(tmp_path / "counts"), "--forecast", str(tmp_path / "fc"), "--name", "chart_t",
                "--as-of", "2024-02-01"]) == 0
    assert {r.chart_series for r in spark.table("chart_t").collect()} == {"PASSED - ACTUAL", "FAILED - ACTUAL"}
    spark.sql("DROP VIEW chart_t")


def test_empty_counts_refresh_reads_back(spark, tmp_path):
    from inspecta.sources.sinks import read_daily_counts, write_daily_counts
    empty = spark.createDataFrame([], "test_date timestamp_ntz, result_type string, count bigint")
    write_daily_counts(empty, str(tmp_path / "c"))
    back = read_daily_counts(spark, str(tmp_path / "c"))
    assert back.count() == 0 and back.columns == ["test_date", "result_type", "count", "p_month"]
