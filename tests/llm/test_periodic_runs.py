"""Periodic runs against a scan of every period, and on odd tables."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from inspecta.llm import periodic_runs
from inspecta.llm.periodic_runs import WaveletTree, run_rows
from inspecta.llm.registry import QUERIES
from tests.conftest import SF_SMOKE


def brute(w):
    """Every period by itself; the smallest period of a stretch counts."""
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def collapsed(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return b" ".join(x for k, x in enumerate(w) if k not in gone).decode()


def nested(rnd):
    """Periods within periods, cut off anywhere, among noise of few or many words."""
    k, out = rnd.choice([1, 2, 3, 10, 500]), []
    target = rnd.randrange(rnd.choice([10, 60, 300, 1200]))
    while len(out) < target:
        u = [rnd.randrange(k) for _ in range(rnd.randrange(1, 8))]
        u = u * rnd.randrange(1, 9) + [rnd.randrange(k) for _ in range(rnd.randrange(4))]
        x = u * rnd.randrange(1, 8)
        out += rnd.choice([x[:rnd.randrange(len(x) + 1)], [rnd.randrange(k)] * rnd.randrange(1, 30),
                           out[-rnd.randrange(1, len(out) + 2):] * rnd.randrange(1, 7)])
    return [b"%d" % x for x in out[:2500]]


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed, monkeypatch):
    rnd = random.Random(seed)
    monkeypatch.setattr(periodic_runs, "CHUNK", rnd.choice([1, 700, 100_000]))
    texts = [nested(rnd) for _ in range(60)]
    assert run_rows(texts) == [brute(w) for w in texts]


@pytest.mark.parametrize("q,n", [(1, 5), (1, 6), (2, 7), (2, 8), (3, 11), (3, 12), (8, 31), (8, 32), (13, 51), (13, 52), (64, 257)])
def test_bounds(q, n):
    w = [b"%d" % (k % q) for k in range(n)]
    assert run_rows([[b"x", *w, b"y"], w]) == [[(1, n, q)], [(0, n, q)]] if n >= max(6, 4 * q) else [[], []]


def test_fibonacci_words():
    a, b = [b"0"], [b"0", b"1"]
    while len(b) < 1500:
        a, b = b, b + a
    assert run_rows([b, b * 5]) == [brute(b), brute(b * 5)]


def test_long_runs_take_little_time():
    w = [b"a"] * 300_000 + [b"%d" % (k % 1000) for k in range(300_000)]
    assert run_rows([w]) == [[(0, 300_000, 1), (300_000, 300_000, 1000)]]


def test_range_successor():
    rng = np.random.default_rng(1)
    for n, bits in ((1, 1), (63, 6), (64, 7), (1000, 10), (129, 20)):
        values = rng.permutation(1 << min(bits, 12))[:n]
        n = len(values)
        tree = WaveletTree(values, bits)
        lo, hi = np.sort(rng.integers(0, n + 1, (2, 500)), axis=0)
        least = rng.integers(0, (1 << bits) + 3, 500)
        want = [min((v for v in values[a:b] if v >= x), default=1 << bits) for a, b, x in zip(lo, hi, least)]
        assert tree.successor(lo, hi, least).tolist() == want


SCHEMA = "doc_id long, text string, START string, runs int, key int"
ODD = [(1, None), (2, ""), (3, "a a a a a"), (3, "a a a a a a"), (None, "a b " * 4), (None, None), (6, "word\t\n " * 30000),
       (7, "x😀y \x00 \t é " * 9), (8, "a b c a b c a b c a b c a b"), (8, "a b c a b c a b c a b c a b"), (9, "\x0b\x0c\r\n")]


def test_find_runs(spark):
    got = periodic_runs.find_runs(spark.createDataFrame([(i, t, "x", 1, 2) for i, t in ODD], SCHEMA)).collect()
    want = []
    for i, t in ODD:
        w = (t or "").encode().split()
        runs = brute(w) if len(w) < 10000 else [(0, len(w), 1)]
        want.append((i, len(w), runs, collapsed(w, runs)))
    assert sorted(map(repr, ((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got))) == sorted(map(repr, want))
    empty = periodic_runs.digest_rows(periodic_runs.find_runs(spark.createDataFrame([], SCHEMA)))
    assert empty.count() == 0


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_query_equals_brute_force(spark):
    """The contract's query over the whole small table."""
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SF_SMOKE).collect()}
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        w = (d.text or "").encode().split()
        h = zlib.crc32(str(d.doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        r = got[d.doc_id]
        if n > 2500:      # the scan of every period is quadratic
            assert r.n_runs == len(run_rows([w])[0])
            continue
        runs = brute(w)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if runs else (None,) * 3
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert r.collapsed_sha256 == sha(collapsed(w, runs))
        some += bool(runs)
    assert some > 3
