"""Property: the nested form and the flat-log form of enrich agree."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from inspecta.operators.enrich import enrich, enrich_flat
from inspecta.schema import VEHICLE

RESULTS = ["PASSED", "FAILED", "ABANDONED", None]
ODO = ["1", "250000", "99", None]

vehicle = st.tuples(
    st.sampled_from([None, dt.date(2015, 12, 31), dt.date(2020, 1, 1)]),
    st.lists(st.tuples(st.integers(1, 300), st.sampled_from(RESULTS), st.sampled_from(ODO)),
             max_size=5, unique_by=lambda t: t[0]))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(vehicle, min_size=1, max_size=6))
def test_enrich_forms_agree(spark, vehicles):
    base = {f: None for f in VEHICLE.fieldNames()}
    rows, flat = [], []
    for i, (first, tests) in enumerate(vehicles):
        tests = sorted(tests)
        arr = [(dt.datetime(2020, 1, 1) + dt.timedelta(days=d), n, r, o)
               for n, (d, r, o) in enumerate(tests)]
        rows.append({**base, "registration": f"V{i}", "firstUsedDate": first, "motTests": arr})
        flat += [(f"V{i}",) + t for t in arr]
    df = spark.createDataFrame(rows, VEHICLE)
    tests_df = spark.createDataFrame(
        flat, "registration string, completedDate timestamp_ntz, motTestNumber bigint, "
              "testResult string, odometerValue string")
    cols = ["registration", "last_test_date", "last_test_result", "mileage", "vehicle_age",
            "pass_count", "fail_count"]
    as_of = dt.date(2024, 6, 1)
    a = enrich(df, as_of).select(*cols)
    b = enrich_flat(df.drop("motTests"), tests_df, as_of).select(*cols)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
