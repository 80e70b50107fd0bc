"""Schema of feed folders as an aggregate, rows counted by the load, archives as a source."""

import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inspecta.plans.pipelines import load_feed, weekly_delta_ingest
from inspecta.sources.feed import (
    counted, feed_folders, feed_schema, folder_schemas, load_counts, read_feed, schema_drift, split_corrupt, widen,
)
from inspecta.sources.sinks import read_latest, write_version
from inspecta.sources.zips import read_zips, stream_zips
from inspecta.streaming.streams import ingest

OLD, NEW = "delta-light-vehicle_15-01-2024", "delta-light-vehicle_31-01-2024"


def _lines(spark, root, folder, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").write.option("compression", "gzip").text(f"{root}/{folder}")


RECORDS = {
    OLD: ['{"registration":"A","n":1,"deep":{"x":1,"y":[{"k":true}]},"list":[1,2],"none":null,"mixed":1}', '{"registration":"B","n":2.5}', "", '{"regi'],
    NEW: ['{"registration":7,"n":3,"deep":{"x":"t","z":1e3},"list":["a"],"mixed":{"a":1}}', '{"other":[]}', '{"big":123456789012}'],
}


def test_schemas_equal_sparks_inference(spark, tmp_path):
    root = str(tmp_path)
    for folder, lines in RECORDS.items():
        _lines(spark, root, folder, lines)
    found = folder_schemas(spark, root, ext="*.gz")
    assert set(found) == set(RECORDS)
    plain = lambda t: T.StructType([f for f in t.fields if f.name not in ("_corrupt_record",)]).simpleString()      # noqa: E731
    for folder in RECORDS:
        want = spark.read.option("prefersDecimal", False).json(f"{root}/{folder}").schema
        assert feed_schema({folder: found[folder]}).simpleString() == plain(want)
    want = spark.read.json([f"{root}/{f}" for f in RECORDS]).schema
    assert feed_schema(found).simpleString() == plain(want)
    got = {r.registration for r in read_feed(spark, root, schema=feed_schema(found), ext="*.gz").collect()}
    assert got == {"A", "B", "7", None}


def test_drift_names_what_differs(spark, tmp_path):
    for folder, lines in RECORDS.items():
        _lines(spark, str(tmp_path), folder, lines)
    rows = {(r.folder, r.path): (r.type, r.feed_type) for r in schema_drift(spark, folder_schemas(spark, str(tmp_path), ext="*.gz")).collect()}
    assert rows[OLD, "registration"] == ("string", "string") and rows[NEW, "registration"] == ("bigint", "string")
    assert rows[OLD, "deep.x"] == ("bigint", "string") and rows[NEW, "deep.z"] == ("double", "double")
    assert rows[OLD, "deep.z"] == (None, "double") and rows[OLD, "deep.y[].k"] == ("boolean", "boolean")
    assert rows[OLD, "n"] == ("double", "double") and rows[NEW, "n"] == ("bigint", "double")


def test_lattice():
    n, i, d, s, b = T.NullType(), T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()
    kinds = [n, i, d, s, b, T.ArrayType(i), T.ArrayType(n), T.StructType([T.StructField("a", i)]), T.StructType([T.StructField("b", d)])]
    for x in kinds:
        assert widen(x, x) == x and widen(n, x) == x
        for y in kinds:
            assert widen(x, y) == widen(y, x)
            for z in kinds:
                assert widen(widen(x, y), z) == widen(x, widen(y, z))


def test_empty_feed_has_no_schema(spark, tmp_path):
    _lines(spark, str(tmp_path), OLD, ["", "not json"])
    found = folder_schemas(spark, str(tmp_path), ext="*.gz")
    assert feed_schema(found) == T.StructType([]) and schema_drift(spark, found).count() == 0


def test_load_counts_its_rows(spark, tmp_path):
    root = str(tmp_path / "feed")
    _lines(spark, root, OLD, ['{"registration":"A"}', '{"registration":"B"}', "", '{"regi'])
    _lines(spark, root, NEW, ['{"registration":"C"}'])
    assert feed_folders(spark, root) == [OLD, NEW] and feed_folders(spark, root, "bulk") == []
    for partitions in (None, 3):
        folders, seen = feed_folders(spark, root), Observation()
        rows = counted(read_feed(spark, root, ext="*.gz", partitions=partitions), folders, seen)
        split_corrupt(rows)[0].write.mode("overwrite").parquet(str(tmp_path / "out"))
        assert load_counts(folders, seen) == {OLD: 2, NEW: 1, "malformed": 1}
    for f in (OLD, NEW):
        spark.createDataFrame([("X",)], "registration string").write.option("compression", "gzip").json(f"{tmp_path}/json/{f}")
    got = load_feed(spark, str(tmp_path / "json"), str(tmp_path / "staged"))
    assert got == {OLD: 1, NEW: 1, "malformed": 0} and spark.read.parquet(str(tmp_path / "staged")).count() == 2


def _zip(root, name, members):
    with zipfile.ZipFile(f"{root}/{name}.zip.part", "w") as z:
        for m, rows in members.items():
            z.writestr(m, "\n".join(json.dumps(r) if isinstance(r, dict) else r for r in rows))
    import os
    os.rename(f"{root}/{name}.zip.part", f"{root}/{name}.zip")


def _vehicle(reg, mod="UPDATED", make="NEW", day=2):
    return {"registration": reg, "modification": mod, "make": make, "lastMotTestDate": f"2024-01-{day:02d}T00:00:00"}


def test_stream_takes_each_archive_once(spark, tmp_path):
    root, sink, ckpt = (tmp_path / n for n in ("zips", "sink", "ckpt"))
    root.mkdir()

    def run():
        ingest(stream_zips(spark, str(root)), str(sink), str(ckpt)).awaitTermination()
        return sorted(str(r.registration) for r in spark.read.parquet(str(sink)).collect()) if sink.exists() else []
    _zip(root, NEW, {"a.json": [_vehicle("A"), "", "{bad"], "sub/b.json": [_vehicle("B")]})
    (root / "notes.txt").write_text("x")
    _zip(root, "other", {"a.json": [_vehicle("Z")]})
    assert run() == ["A", "B", "None"]
    assert run() == ["A", "B", "None"]
    _zip(root, OLD, {"c.json": [_vehicle("C")]})          # an earlier name that appears later
    assert run() == ["A", "B", "C", "None"]
    rows = read_zips(spark, str(root)).collect()
    assert {r.feed_date for r in rows} == {dt.date(2024, 1, 14), dt.date(2024, 1, 30)}
    assert sorted(r._source_file.rsplit("/", 2)[-2:] for r in rows if r.registration) == [[OLD, "c.json"], [NEW, "a.json"], [NEW, "b.json"]]
    assert read_zips(spark, str(root), kind="bulk").count() == 0


def test_weekly_job_on_archives(spark, tmp_path):
    from inspecta.operators.enrich import enrich
    from inspecta.schema import VEHICLE
    root, table, ckpt = tmp_path / "zips", str(tmp_path / "main"), str(tmp_path / "ckpt")
    root.mkdir()
    base = {f: None for f in VEHICLE.fieldNames()}
    write_version(enrich(spark.createDataFrame([{**base, "registration": r, "make": "OLD"} for r in "AB"], VEHICLE), dt.date(2024, 1, 31)), table)
    _zip(root, OLD, {"a.json": [_vehicle("A"), _vehicle("C")]})
    assert sorted(weekly_delta_ingest(spark, str(root), table, ckpt, dt.date(2024, 1, 31), zips=True)) == [(0, "insert", 1), (0, "keep", 1), (0, "update", 1)]
    assert weekly_delta_ingest(spark, str(root), table, ckpt, dt.date(2024, 1, 31), zips=True) == []
    _zip(root, NEW, {"a.json": [_vehicle("A", "DELETED", None, 3)]})
    weekly_delta_ingest(spark, str(root), table, ckpt, dt.date(2024, 1, 31), zips=True)
    assert {r.registration: r.make for r in read_latest(spark, table).collect()} == {"B": "OLD", "C": "NEW"}


@pytest.mark.parametrize("buckets", [4, 64])
def test_hashed_categories_score_like_their_weights(spark, buckets):
    from inspecta.operators.classify import fit_pass_fail, model_weights, score, score_by_weights
    rows = [(f"R{i}", "PASSED" if (i * 7) % 5 < 3 else "FAILED", i * 100, i % 9, f"make{i % 6}", f"Model{i % 4}", None if i % 11 == 0 else "red") for i in range(80)]
    df = spark.createDataFrame(rows, "registration string, last_test_result string, mileage bigint, vehicle_age bigint, make string, model string, primaryColour string")
    model = fit_pass_fail(df, buckets=buckets)
    w = model_weights(model)
    assert w.where("feature = 'intercept'").count() == 1 and w.where("slot >= " + str(buckets)).count() == 0
    # NULL numbers, values that training didn't have, other case
    odd = df.unionByName(spark.createDataFrame([("X1", None, None, 3, "NEVER", "seen", None), ("X2", None, 5, None, None, None, "RED")], df.schema))
    a = {r.registration: r.pass_probability for r in score(model, odd).collect()}
    b = {r.registration: r.pass_probability for r in score_by_weights(w, odd, buckets).collect()}
    assert set(a) == set(b) and len(a) == 82
    assert all(a[k] == pytest.approx(b[k], abs=1e-9) for k in a)
