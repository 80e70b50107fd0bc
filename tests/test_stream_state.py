"""Newest record per key over batches: the result doesn't depend on how files are dealt."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from inspecta.operators import changelog
from inspecta.operators.enrich import enrich
from inspecta.schema import VEHICLE
from inspecta.sources.feed import write_feed
from inspecta.streaming.streams import newest_records, start_log, stream_feed

AS_OF = dt.date(2024, 1, 31)


def _frame(spark, rows):
    base = {f: None for f in VEHICLE.fieldNames()}
    return spark.createDataFrame([{**base, "registration": r, "modification": m, "make": make,
                                   "lastMotTestDate": dt.datetime(2024, 1, day, 1, 2, 3, 456789) if day else None} for r, m, make, day in rows], VEHICLE)


OLD, NEW = "delta-light-vehicle_15-01-2024", "delta-light-vehicle_31-01-2024"
FILES = [
    (OLD, [("A", "UPDATED", "a1", 3), ("B", "DELETED", None, 9), ("C", "UPDATED", "c1", 5), ("N1", "CREATED", "n1", 2), (None, "CREATED", "no", 1)]),
    (NEW, [("A", "DELETED", None, 2), ("B", "CREATED", "b2", 4), ("C", "DELETED", None, 5), ("N1", "DELETED", None, None), ("D", "NOISE", "d", 9)]),
    (OLD + "b", [("A", "CREATED", "a3", 8), ("B", "UPDATED", "b3", 7), ("E", "DELETED", None, None), ("E", "UPDATED", "e3", None)]),
]


@pytest.mark.parametrize("order,limit,files", [("last_test", None, [0, 1, 2]), ("last_test", 1, [0, 1, 2]), ("last_test", 1, [2, 1, 0]),
                                               ("last_test", 1, [1, 0, 2, 1, 0]), ("feed_date", None, [0, 1]), ("feed_date", 1, [1, 0])])
def test_result_is_independent_of_batches(spark, tmp_path, order, limit, files):
    path, root, ckpt = str(tmp_path / "t"), str(tmp_path / "feed"), str(tmp_path / "ckpt")
    main = enrich(_frame(spark, [(r, "CREATED", "old", 1) for r in "ABCE"]), AS_OF).withColumn("date", F.lit("x"))
    changelog.create(main, path, 3)
    runs = [files] if limit is None else [[k] for k in files]
    done = 0
    for run in runs:
        for k in run:
            folder, rows = FILES[k]
            write_feed(_frame(spark, rows).coalesce(1), root, folder + ("" if done < len(set(files)) else f"x{done}"))
            done += 1
        start_log(stream_feed(spark, root, kind="delta", max_files_per_trigger=limit), path, ckpt, AS_OF, order=order).awaitTermination()
    got = {r.registration: (r.make, r.date, r.lastMotTestDate) for r in changelog.read(spark, path, in_turn=False).collect()}
    late = lambda d: dt.datetime(2024, 1, d, 1, 2, 3, 456789)      # noqa: E731
    if order == "last_test":
        # B's newest record deletes it; C's tie goes to the delete; E has no dates: its delete wins
        assert got == {"A": ("a3", "x", late(8)), "N1": ("n1", None, late(2))}
    else:
        assert got == {"B": ("b2", "x", late(4)), "E": ("old", "x", late(1))}


def test_state_needs_no_python_per_key(spark, tmp_path):
    write_feed(_frame(spark, FILES[0][1]), str(tmp_path), OLD)
    plan = newest_records(stream_feed(spark, str(tmp_path), kind="delta"))._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "Py" not in plan


@pytest.mark.parametrize("order", [[0, 1, 2, 3], [3, 2, 1, 0], [2, 0, 3, 1]])
def test_only_newer_records_are_passed_on(spark, tmp_path, order):
    root, out = str(tmp_path / "feed"), []
    records = [("A", "UPDATED", "a1", 3), ("A", "UPDATED", "a2", 7), ("A", "UPDATED", "a3", None), ("A", "UPDATED", "a2", 7)]
    for n, k in enumerate(order):
        write_feed(_frame(spark, [records[k]]).coalesce(1), root, f"{OLD}x{n}")
        stream = stream_feed(spark, root, kind="delta").drop("_source_file", "date", "feed_date")
        (newest_records(stream).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "ckpt"))
         .foreachBatch(lambda b, _: out.extend(r.make for r in b.collect())).trigger(availableNow=True).start().awaitTermination())
    age = {"a3": 0, "a1": 3, "a2": 7}
    want = [records[k][2] for n, k in enumerate(order) if all(age[records[k][2]] > age[records[j][2]] for j in order[:n])]
    assert out == want
