"""Property: gap fill and spike cleaning equal a brute-force pandas version."""

import datetime as dt

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from inspecta.operators.forecast import MAD_TO_SIGMA, clean_spikes, fill_daily

series = st.dictionaries(st.integers(0, 40), st.integers(0, 60), min_size=1, max_size=25)


def brute_fill(points: dict) -> dict:
    days = sorted(points)
    out = {}
    for d in range(days[0], days[-1] + 1):
        if d in points:
            out[d] = float(points[d])
        else:
            lo = max(x for x in days if x < d)
            hi = min(x for x in days if x > d)
            out[d] = points[lo] + (points[hi] - points[lo]) * ((d - lo) / (hi - lo))
    return out


def brute_clean(filled: dict, h: int = 3, k: float = 3.0) -> dict:
    days = sorted(filled)
    vals = [filled[d] for d in days]
    out = {}
    for i, d in enumerate(days):
        win = vals[max(0, i - h): i + h + 1]
        med = float(np.median(win))
        mad = float(np.median([abs(v - med) for v in win]))
        spike = abs(vals[i] - med) > k * max(MAD_TO_SIGMA * mad, 1.0)
        out[d] = med if spike else vals[i]
    return out


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(series, series)
def test_fill_and_clean_match_brute_force(spark, a, b):
    base = dt.date(2024, 1, 1)
    rows = [(base + dt.timedelta(days=d), "A", v) for d, v in a.items()]
    rows += [(base + dt.timedelta(days=d), "B", v) for d, v in b.items()]
    df = spark.createDataFrame(rows, "test_date date, result_type string, count bigint")
    filled = fill_daily(df)
    got_fill = {(r.result_type, (r.test_date - base).days): r["count"] for r in filled.collect()}
    got_clean = {(r.result_type, (r.test_date - base).days): r["count"]
                 for r in clean_spikes(filled.drop("filled")).collect()}
    for name, pts in (("A", a), ("B", b)):
        want_fill = brute_fill(pts)
        want_clean = brute_clean(want_fill)
        for d, v in want_fill.items():
            assert abs(got_fill[(name, d)] - v) < 1e-9
            assert abs(got_clean[(name, d)] - want_clean[d]) < 1e-9
        assert len([k for k in got_fill if k[0] == name]) == len(want_fill)
