"""The scorers against plain versions: edit distance over the whole lexicon, dense TF-IDF cosines."""

import collections
import math

import numpy as np
import pytest

from inspecta.llm import language_id, toxicity
from tests.conftest import SF_CHECK, SF_SMOKE


def distance_one(a, b):
    """Whether a and b are at most one edit apart."""
    if abs(len(a) - len(b)) > 1:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1] <= 1


def plain_lookup(terms, known):
    bands = ((6, 10 ** 9), (4, 6), (2, 4))

    def look(word):
        for k, (least, over) in enumerate(bands):
            if k and word in known:
                continue
            near = [s for t, s in terms.items() if least <= len(t) < over and distance_one(word, t)]
            if near:
                return k, max(near)
        return 0, 0.0
    return look


def plain_features(text, terms, look):
    low = text.lower()
    spans = [m.span() for m in toxicity.WORD.finditer(low)]
    words = [low[a:b] for a, b in spans]
    hits = []
    for i, w in enumerate(words):
        if w in terms:
            hits.append((i, terms[w], None))
        else:
            k, s = look(w)
            if s:
                hits.append((i, s, k))
    sums = collections.Counter()
    places = {i for i, _, _ in hits}
    for i, s, k in hits:
        a, b = max(0, i - 8), min(len(words), i + 9)
        quotes_before = sum(c in "\"“”„«»‹›" for c in low[spans[a][0]:spans[i][0]])
        quotes_after = sum(c in "\"“”„«»‹›" for c in low[spans[i][1]:spans[b - 1][1] + 2])
        others = [words[j] for j in range(a, b) if j != i]
        if quotes_before % 2 and quotes_after or any(w in toxicity.REPORTING for w in others) and (quotes_before or quotes_after):
            sums["quoted"] += s
            continue
        sums["exact" if k is None else f"fuzzy{k}"] += s
        if any(w in toxicity.ADDRESS for w in others) or any(j in places for j in range(a, b) if j != i):
            sums["abusive"] += s
    total = sums["exact"] + sums["fuzzy0"] + sums["fuzzy1"] + sums["fuzzy2"] + sums["quoted"]
    return [math.log1p(sums["exact"]), math.log1p(sums["fuzzy0"]), math.log1p(sums["quoted"]), math.log1p(sums["abusive"]),
            total / (len(words) + 20.0) if hits else 0.0, math.log1p(sums["fuzzy1"]), math.log1p(sums["fuzzy2"])]


@pytest.fixture(scope="module")
def toxic(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    return docs, toxicity.fit(docs, spark.read.parquet(f"{SF_CHECK}/labels.parquet"))


def test_toxicity_scores_equal_plain_scores(spark, toxic):
    docs, model = toxic
    assert model.terms
    small = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    rows += [(10_000 + i, toxicity.with_misspellings(t or "", model.terms)) for i, t in rows]
    t0 = next(iter(model.terms))
    rows += [(20_000, f'He said "{t0}" and left'), (20_001, f"you {t0}x you"), (20_002, None), (20_003, f"{t0} " * 5)]
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    look, seen = plain_lookup(model.terms, model.known), {}
    cached = lambda w: seen[w] if w in seen else seen.setdefault(w, look(w))      # noqa: E731
    for i, t in rows:
        x = plain_features(t or "", model.terms, cached)
        want = 1 / (1 + math.exp(-(model.bias + sum(a * b for a, b in zip(model.weights, x)))))
        assert got[i] == pytest.approx(want, abs=1e-12), i
    assert len({round(v, 6) for v in got.values()}) > 5


def test_weights_are_fitted_when_a_fold_lacks_a_label(spark):
    rows, labels = [], []
    for i in range(400):
        bad = i % 2
        rows.append((i, f"w{i % 37} word{i % 11} " + (f"you m{i % 31} dreadful v{i % 41} thing" if bad else f"a fine w{i % 29} day") + f" x{i % 13} end{i % 17}"))
        labels.append((i, bad))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    part = toxicity.fold(marks.doc_id, 5)
    model = toxicity.fit(docs, marks.where((part != 4) | (marks.toxic == 0)))
    assert model.bias is not None and "dreadful" in model.terms
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    assert sum(got[i] == i % 2 for i in got) >= 390


def plain_vector(text, idf):
    """Hashed counts of 1- to 3-grams of letters and single spaces, by plain integers."""
    mask = 2 ** 64 - 1
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    if not letters.strip():
        return None
    s = " " + " ".join(letters.split()) + " "
    n = collections.Counter()
    for i in range(len(s)):
        h = (ord(s[i]) + 1) * 0x9E3779B97F4A7C15 & mask
        n[h >> 52] += 1
        for k in (1, 2):
            if i + k < len(s):
                h = ((h ^ h >> 29) * 0xBF58476D1CE4E5B9 + ord(s[i + k]) * 0x94D049BB133111EB) & mask
                n[h >> 52] += 1
    v = np.zeros(language_id.DIM)
    for at, c in n.items():
        v[at] = (1 + math.log(c)) * idf[at]
    return v / np.linalg.norm(v)


def test_language_scores_equal_dense_cosines(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    model = language_id.fit(docs)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()] + [(9001, None), (9002, "12 ☃"), (9003, "İstanbul ß Ünïcode")]
    got = {r.doc_id: r for r in language_id.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    langs = np.array(model.langs)
    for i, t in rows:
        v = plain_vector(t or "", model.idf.astype(float))
        r = got[i]
        if v is None:
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        sim = model.centroids.astype(float) @ v
        assert r.score == pytest.approx(min(1, max(0, sim.max())), abs=1e-4), i
        near = set(langs[sim >= sim.max() - 1e-5])
        assert r.lang_pred in near
