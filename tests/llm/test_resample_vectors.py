"""Importance resampling and embedding near-dedup against brute force, and on odd tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from inspecta.llm import embedding_dedup, importance_resample
from inspecta.llm.importance_resample import REACH, Features, long_crc

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, rank string, SCORE int, key int"


def words_of(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


# ---- CRC ------------------------------------------------------------------------
@pytest.mark.parametrize("n", [0, 1, REACH - 1, REACH, REACH + 1, 2 * REACH, 5000, 1_100_003])
def test_long_spans_fold_blockwise(n):
    data = random.Random(n).randbytes(n)
    assert long_crc(np.frombuffer(data, np.uint8)) == zlib.crc32(data)


@pytest.mark.parametrize("grams", [1, 2, 3])
def test_features_equal_zlib(grams):
    rnd = random.Random(3)
    texts = [" ".join("".join(rnd.choice("abÉß9-Z\n") for _ in range(rnd.choice([0, 1, 3, 9, 40, 300])))
                      for _ in range(rnd.randrange(30))) for _ in range(50)] + ["", "x", "É" * 500, "a " * 9, "é 😀"]
    f = Features([t.encode() for t in texts], grams)
    for g in range(grams):
        want = []
        for i, t in enumerate(texts):
            w = words_of(t)
            want += [(i, zlib.crc32(" ".join(w[k:k + g + 1]).encode())) for k in range(len(w) - g)]
        assert list(zip(f.owner[g].tolist(), f.crc[g].tolist())) == want


# ---- resampling ------------------------------------------------------------------
def brute_draw(rows, target, percent=25, least=20):
    def buckets(text):
        w = words_of(text)
        return w, Counter(zlib.crc32(x.encode()) % 10000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    cut = [(i, *buckets(t)) for i, t in rows]
    s, t = Counter(), Counter()
    for _, _, b in cut:
        s.update(b)
    for x in target:
        t.update(buckets(x)[1])
    s_all, t_all = sum(s.values()) + 10000, sum(t.values()) + 10000

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all)))
    out = []
    for i, w, b in cut:
        n = sum(b.values())
        weight = sum(c * gain(k) for k, c in b.items()) // n if n else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, n, weight, score, len(w)])
    may = sorted((-r[3], r[0]) for r in out if r[4] >= least and r[0] is not None)
    drawn = may[:len(may) * percent // 100]
    return out, drawn


def check_draw(spark, rows, target, **kw):
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)
    wanted = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = importance_resample.draw(docs, wanted, **kw).collect()
    want, drawn = brute_draw(rows, target, **({"percent": kw["percent"]} if "percent" in kw else {}))
    assert sorted(map(repr, ((r.doc_id, r.n_features, r.weight, r.score) for r in got))) == sorted(repr(tuple(w[:4])) for w in want)
    ranked = sorted((r["rank"], -r["score"], r["doc_id"]) for r in got if r["rank"] is not None)
    assert [r[0] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [r[1:] for r in ranked] == drawn
    return docs, wanted


def test_draw_equals_brute_force(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice(["Red", "blue", "green", "été", "x1", "word" * 90]) for _ in range(rnd.choice([3, 19, 20, 60]))))
            for i in range(300)]
    rows += [(None, "red " * 30), (None, None), (7, None), (8, ""), (9, "blue " * 25), (9, "blue " * 25), (9, "blue " * 25),
             (1000, "red " * 3000), (1001, "😀 \x00 \t é " * 9)]
    target = ["blue blue green été", None, "", "x1 Blue"]
    docs, wanted = check_draw(spark, rows, target)
    check_draw(spark, rows, [])
    check_draw(spark, rows, target, percent=100)
    kept = importance_resample.resample(docs, wanted)
    drawn = {i for _, i in brute_draw(rows, target)[1]}
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in rows if i in drawn)


def test_draw_of_few_or_no_documents(spark):
    check_draw(spark, [(1, "a b c"), (2, None)], ["a"])          # none has 20 words
    check_draw(spark, [(1, "a " * 20)], ["a"])                    # a quarter of one is none
    empty = spark.createDataFrame([], SCHEMA)
    got = importance_resample.draw(empty, spark.createDataFrame([], "text string"))
    assert got.count() == 0 and got.columns[-1] == "rank"


# ---- vectors ---------------------------------------------------------------------
V = "vec_id long, embedding array<{}>, label string, KEY int, n_links string"


def brute_vectors(rows, cosine=0.98):
    ok = []
    for k, (_, v, label) in enumerate(rows):
        if label is not None and v and None not in v and np.isfinite(v).all() and any(v):
            ok.append(k)
    links = {k: set() for k in range(len(rows))}
    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / (math.sqrt(x @ x) * math.sqrt(y @ y)) >= cosine:
                    links[a].add(b)
                    links[b].add(a)
    out = []
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[k][0], len(links[k]), low, rows[k][0] == low))
    return out


def vectors(rng, n, dim, labels):
    """Clusters, near copies on both sides of the bound, copies and scaled copies."""
    rows = []
    while len(rows) < n:
        base = rng.normal(size=dim)
        for _ in range(int(rng.choice([1, 1, 2, 30]))):
            noise = rng.normal(size=dim) * np.linalg.norm(base) / math.sqrt(dim) * rng.choice([0, .05, .14, .2, .21, .5])
            v = (base + noise) * rng.choice([1, 3])
            rows.append((len(rows), v.tolist(), str(rng.choice(labels))))
    return rows


@pytest.mark.parametrize("kind,dim,settings", [
    ("double", 16, {}), ("double", 11, {"lists": 9, "block": 16, "queries": 32}), ("double", 64, {"lists": 5, "block": 50, "queries": 20})])
def test_vectors_equal_brute_force(spark, kind, dim, settings):
    rows = vectors(np.random.default_rng(dim), 400, dim, ["a", "a", "a", "b"])
    rows += [(500, None, "a"), (501, [], "a"), (502, [0.0] * dim, "a"), (503, [1.0, None] + [0.0] * (dim - 2), "a"),
             (504, [float("nan")] + [1.0] * (dim - 1), "a"), (505, [float("inf")] + [1.0] * (dim - 1), "a"), (506, rows[0][1], None),
             (507, [1.0, 2.0], "a"), (508, [1.0, 2.0], "a"), (509, [1.0, 2.0, 0.0], "a"), (3, rows[3][1], rows[3][2]),
             (3, [-x for x in rows[3][1]], rows[3][2]), (None, rows[5][1], rows[5][2]), (None, [0.0], "b"),
             (510, [-0.0, 1.0], "b"), (511, [0.0, 1.0], "b"), (512, [0.0, 1e100], "b"), (513, [0.0, 1e-100], "b")]
    rows += [(600 + i, [1.0] * dim, "hot") for i in range(300)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], V.format(kind))
    got = [tuple(r) for r in embedding_dedup.near_duplicates(df, **settings).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_vectors(rows)))


def test_vectors_without_label_and_empty(spark):
    rows = [(i, [1.0, i / 10, 0.5], str(i)) for i in range(20)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], V.format("float"))
    got = sorted(tuple(r) for r in embedding_dedup.near_duplicates(df, label_col=None).collect())
    assert got == sorted(brute_vectors([(i, np.array(v, np.float32).tolist(), "") for i, v, _ in rows]))
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0
    assert embedding_dedup.near_duplicates(df.withColumn("label", df.label.substr(9, 1)).where("vec_id < 3")).count() == 3


def test_probes_are_sufficient():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = x + rng.normal(size=x.shape) * 0.045
    y /= np.linalg.norm(y, axis=1)[:, None]
    index = embedding_dedup.fit_index(x[:1000], 20)
    near = embedding_dedup.squares(y, index.centroids).argmin(1)
    probes = embedding_dedup.sufficient_probes(x, index, 0.2)
    linked = (x * y).sum(1) >= 0.98
    assert linked.sum() > 1000 and probes[linked, near[linked]].all() and probes.mean() < 0.9
