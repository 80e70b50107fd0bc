"""Merge-on-read tables and counts kept up to date, against merges one after the other."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from inspecta.operators import changelog
from inspecta.operators.counts import all_counts, apply_changes, count_changes
from inspecta.operators.enrich import enrich
from inspecta.operators.merge import upsert
from inspecta.schema import VEHICLE

AS_OF = dt.date(2024, 1, 31)


def _frame(spark, rows):
    """Vehicles (registration, modification, make, last result)."""
    base = {f: None for f in VEHICLE.fieldNames()}
    data = []
    for reg, mod, make, result in rows:
        when = dt.datetime(2024, 1, 1 + len(make or "") % 5)
        test = {"completedDate": when, "motTestNumber": 1, "testResult": result, "odometerValue": "5"}
        data.append({**base, "registration": reg, "modification": mod, "make": make, "lastMotTestDate": when, "motTests": [test]})
    return enrich(spark.createDataFrame(data, VEHICLE), AS_OF)


def _main(spark, n=40):
    rows = _frame(spark, [(f"R{i}", "CREATED", "OLD", "PASSED") for i in range(n)] + [(None, "CREATED", "N", "FAILED")] * 3)
    return rows.withColumn("date", F.concat(F.lit("d"), F.coalesce("registration", F.lit("")))).withColumn("feed_date", F.lit(dt.date(2024, 1, 1)))


def _deltas(spark, seed, number=3):
    rnd, out = random.Random(seed), []
    for k in range(number):
        regs = rnd.sample([f"R{i}" for i in range(50)], 12)
        rows = [(r, rnd.choice(["UPDATED", "CREATED", "DELETED"]), "M" * rnd.randrange(1, 9) + str(k), rnd.choice(["PASSED", "FAILED", "ABANDONED"]))
                for r in regs]
        out.append(_frame(spark, rows + [(None, rnd.choice(["UPDATED", "DELETED"]), f"null{k}", "PASSED")] * 2))
    return out


def _same(a, b):
    key = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))      # noqa: E731
    return key(a) == key(b)


def _files(m):
    return {b: sorted(os.listdir(f.removeprefix("file:"))) for b, (_, f) in m.base.items() if f}


@pytest.mark.parametrize("seed", [1, 2])
def test_read_equals_merges_in_turn(spark, tmp_path, seed):
    main, path = _main(spark), str(tmp_path / "t")
    changelog.create(main, path, 7)
    assert _same(changelog.read(spark, path), main)
    want = main
    for k, delta in enumerate(_deltas(spark, seed)):
        assert changelog.append(delta, path) == k + 1
        want = upsert(want, delta, duplicates="trust").checkpoint()
        assert _same(changelog.read(spark, path), want)
        assert _same(changelog.read(spark, path, strategy="bloom"), want)
        if k == 1:       # a part of the buckets, with open deltas left for the others
            changelog.compact(spark, path, [0, 1, 2])
            assert _same(changelog.read(spark, path), want)
            assert changelog.manifest(spark, path).log
    changelog.compact(spark, path)
    assert _same(changelog.read(spark, path), want)
    assert not changelog.manifest(spark, path).log and changelog.compact(spark, path) == []


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    changelog.create(_main(spark), path, 16)
    before = changelog.manifest(spark, path)
    files = _files(before)
    changelog.append(_frame(spark, [("R1", "UPDATED", "NEW", "FAILED"), ("R2", "DELETED", None, None)]), path)
    done = changelog.compact(spark, path)
    after = changelog.manifest(spark, path)
    assert 1 <= len(done) <= 2 and after.last == 1
    for b in range(16):
        assert (after.base[b] != before.base[b]) == (b in done)
    assert {b: f for b, f in _files(after).items() if b not in done} == {b: f for b, f in files.items() if b not in done}
    assert all(os.path.isdir(f.removeprefix("file:")) for _, f in before.base.values() if f)       # still readable
    assert {r.make for r in changelog.read(spark, path).where("registration = 'R1'").collect()} == {"NEW"}


def test_read_joins_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    changelog.create(_main(spark), path, 8)
    changelog.append(_frame(spark, [("R1", "UPDATED", "NEW", "FAILED")]), path)
    m = changelog.manifest(spark, path)
    touched = [b for b in m.base if m.pending(b)]
    assert len(touched) == 1
    plan = changelog.read(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and plan.splitlines()[1].startswith(":- Relation [")      # the untouched: read as they are


def test_newest_only_keeps_what_a_delete_in_between_would_drop(spark, tmp_path):
    path = str(tmp_path / "t")
    changelog.create(_main(spark), path, 4)
    changelog.append(_frame(spark, [("R1", "DELETED", None, None)]), path)
    changelog.append(_frame(spark, [("R1", "CREATED", "NEW", "FAILED"), ("R2", "DELETED", None, None)]), path)
    one = "registration in ('R1', 'R2')"
    assert [(r.make, r.date) for r in changelog.read(spark, path).where(one).collect()] == [("NEW", None)]
    assert [(r.make, r.date) for r in changelog.read(spark, path, in_turn=False).where(one).collect()] == [("NEW", "dR1")]


def test_empty_deltas_and_tables(spark, tmp_path):
    path, none = str(tmp_path / "t"), _main(spark).where("false")
    changelog.create(none, path, 3)
    assert changelog.read(spark, path).count() == 0 and changelog.read(spark, path).columns == none.columns
    changelog.append(_deltas(spark, 3)[0].where("false"), path)
    assert changelog.compact(spark, path) == [] and changelog.read(spark, path).count() == 0
    changelog.append(_frame(spark, [("R1", "CREATED", "NEW", "PASSED"), (None, "CREATED", "N", "PASSED")]), path)
    changelog.compact(spark, path)
    assert sorted(str(r.make) for r in changelog.read(spark, path).collect()) == ["N", "NEW"]
    with pytest.raises(ValueError, match="make"):
        changelog.append(_frame(spark, [("R1", "CREATED", "NEW", "PASSED")]).drop("make"), path)


@pytest.mark.parametrize("strategy", ["auto", "bloom", "shuffle"])
def test_counts_equal_a_recount(spark, strategy):
    main = _main(spark)
    counts = all_counts(main)
    for delta in _deltas(spark, 7):
        counts = apply_changes(counts, count_changes(main, delta, strategy=strategy)).checkpoint()
        main = upsert(main, delta, duplicates="trust").checkpoint()
        assert _same(counts, all_counts(main))
        assert counts.where("count < 0").count() == 0


def test_counts_of_repeated_keys_in_main(spark):
    main = _main(spark, 3).unionByName(_main(spark, 3))
    delta = _frame(spark, [("R0", "UPDATED", "XX", "FAILED"), ("R1", "DELETED", None, None), ("R9", "DELETED", None, None), ("R8", "CREATED", "Y", "PASSED")])
    counts = apply_changes(all_counts(main), count_changes(main, delta))
    assert _same(counts, all_counts(upsert(main, delta, duplicates="trust")))
