"""Property test: both upsert forms equal a plain-Python model of MERGE."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inspecta.operators.merge import prepare_delta, upsert
from inspecta.operators.enrich import enrich
from inspecta.schema import VEHICLE

KEYS = ["a", "b", "c", "d", None]
MODS = ["CREATED", "UPDATED", "DELETED", "NOISE"]
AS_OF = dt.date(2024, 1, 31)

# (key, day) unique: the newest record per key is never a tie
delta_rows = st.lists(st.tuples(st.sampled_from(KEYS), st.sampled_from(MODS),
                                st.integers(1, 5), st.sampled_from(["X", "Y"])),
                      max_size=8, unique_by=lambda r: (r[0], r[2]))
main_keys = st.sets(st.sampled_from(KEYS[:-1]))


def model(main_keys, rows):
    valid = [r for r in rows if r[1] in ("CREATED", "UPDATED", "DELETED")]
    best = {}
    for k, m, day, make in valid:
        cur = best.get(k)
        rank = (day, m == "DELETED", make)
        if cur is None or rank > cur[0]:
            best[k] = (rank, m, make)
    out = {k: ("OLD", "main") for k in main_keys}
    for k, (_, m, make) in best.items():
        if k is not None and k in out:
            if m == "DELETED":
                del out[k]
            else:
                out[k] = (make, "main")
        elif m != "DELETED":
            out[k] = (make, None)
    return sorted((str(k), v) for k, v in out.items())


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(main_keys, delta_rows)
def test_upsert_matches_model(spark, mk, rows):
    base = {f: None for f in VEHICLE.fieldNames()}
    main = enrich(spark.createDataFrame([{**base, "registration": k, "make": "OLD"} for k in sorted(mk)] or [],
                                        VEHICLE), AS_OF).withColumn("origin", F.lit("main"))
    delta = spark.createDataFrame(
        [{**base, "registration": k, "modification": m, "make": mk_,
          "lastMotTestDate": dt.datetime(2024, 1, d)} for k, m, d, mk_ in rows] or [], VEHICLE)
    prepared = prepare_delta(delta, AS_OF)
    want = model(mk, rows)
    for strategy in ("broadcast", "shuffle"):
        got = sorted((str(r.registration), (r.make, r.origin))
                     for r in upsert(main, prepared, strategy=strategy).collect())
        assert got == want, strategy
