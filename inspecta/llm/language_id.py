"""Language identification by the nearest of several centroids per language.

A text becomes counts of its character 1- to 3-grams (lower case, runs of
non-letters as one space) hashed to ``DIM`` places, as 1 + log(count) times the
inverse document frequency, normalised.  Document frequencies cover all rows that
may be learned from.  Per language, ``CENTROIDS`` centroids come from spherical
k-means over a bounded sample (``fit_rows`` per language, chosen by a hash of
doc_id).  The language of the centroid with the largest cosine is predicted.  A
text farther from it than nearly all sample texts were (``REJECT`` quantile of
their cosines) is marked in ``rejected``.

Learned from: text and non-null language of rows with crc32(doc_id) mod 4 not 2.

Defined cases: null text or text without a letter: ``und``, score 0, rejected.
Without any row to learn from every text is ``und``.  Rows with a null doc_id are
predicted, not learned from.  On equal cosines the first language in order wins.
Rows that repeat are predicted alike.  Very long texts are read whole.  An empty
table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inspecta.llm.base import first_by_hash, id_text, map_rows
from inspecta.llm.toxicity import fold

DIM = 4096
CENTROIDS = 3
FIT_ROWS = 1500
REJECT = 0.005
ROUNDS = 12
BLOCK = 1 << 20      # characters that are counted at once


@functools.lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)], bool)


def counts(text: str) -> np.ndarray | None:
    """Hashed n-gram counts; None if the text has no letter."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[c]
    if not letter.any():
        return None
    c = np.where(letter, c, 32).astype(np.uint64)
    c = np.concatenate([[32], c, [32]]).astype(np.uint64)
    c = c[np.concatenate([[True], (c[1:] != 32) | (c[:-1] != 32)])]
    out = np.zeros(DIM, np.int64)
    for at in range(0, len(c), BLOCK):
        x = c[at:at + BLOCK + 2]
        own = min(BLOCK, len(c) - at)
        h = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        out += np.bincount((h[:own] >> np.uint64(52)).astype(np.int64), minlength=DIM)
        for n in (1, 2):
            if len(x) > n:
                h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + x[n:] * np.uint64(0x94D049BB133111EB)
                out += np.bincount((h[:own] >> np.uint64(52)).astype(np.int64), minlength=DIM)
    return out


def vectors(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised TF-IDF rows, and whether each text has a letter."""
    out, ok = np.zeros((len(texts), DIM), np.float32), np.zeros(len(texts), bool)
    for i, t in enumerate(texts):
        n = counts(t)
        if n is not None:
            ok[i] = True
            at = np.flatnonzero(n)
            v = (1 + np.log(n[at])) * idf[at]
            out[i, at] = v / np.sqrt(v @ v)
    return out, ok


def learnable(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    return (docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"),
                        docs[lang_col].cast("string").alias("lang"))
            .where("doc_id is not null and text is not null and lang is not null")
            .where(fold(F.col("doc_id"), 4) != 2))


def inverse_frequencies(rows: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequency of each place over all ``rows`` (text)."""
    def run(batch: pa.RecordBatch) -> dict:
        df, n = np.zeros(DIM, np.int64), 0
        for t in batch.column(0).to_pylist():
            c = counts(t)
            if c is not None:
                df += c > 0
                n += 1
        return {"place": np.arange(-1, DIM), "n": np.concatenate([[n], df])}
    got = map_rows(rows.select("text"), run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    all_ = {r.place: r.n for r in got.collect()}
    df = np.array([all_.get(k, 0) for k in range(DIM)], float)
    return (np.log((1 + all_.get(-1, 0)) / (1 + df)) + 1).astype(np.float32)


def cluster(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means; starts at the mean's farthest points, so it has no chance in it."""
    near = x @ (x.mean(0) / max(np.linalg.norm(x.mean(0)), 1e-12))
    seeds = [x[int(near.argmax())]]
    while len(seeds) < min(k, len(x)):
        far = (x @ np.array(seeds).T).max(1)
        if far.min() > 1 - 1e-6:
            break
        seeds.append(x[int(far.argmin())])
    c = np.array(seeds, np.float32)
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        for j in range(len(c)):
            if (own == j).any():
                m = x[own == j].mean(0)
                c[j] = m / np.linalg.norm(m)
    return c


class LanguageModel:
    def __init__(self, idf: np.ndarray, langs: list[str], centroids: np.ndarray, radius: np.ndarray):
        self.idf, self.langs, self.centroids, self.radius = idf, langs, centroids, radius

    def predict(self, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
        if not self.langs:
            return ["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)
        x, ok = vectors(texts, self.idf)
        sim = x @ self.centroids.T
        best = sim.argmax(1)
        top = sim[np.arange(len(x)), best]
        return ([self.langs[b] if o else "und" for b, o in zip(best, ok)],
                [float(min(1, max(0, s))) if o else 0.0 for s, o in zip(top, ok)],
                [bool(not o or s < self.radius[b]) for s, b, o in zip(top, best, ok)])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        fit_rows: int = FIT_ROWS, centroids: int = CENTROIDS) -> LanguageModel:
    rows = learnable(docs, id_col, text_col, lang_col)
    idf = inverse_frequencies(rows)
    some = first_by_hash(rows.select("doc_id", "lang").distinct(), "lang", "doc_id", fit_rows)

    def run(batch: pa.RecordBatch) -> dict:
        x, ok = vectors(batch.column(1).to_pylist(), idf)
        keep = np.flatnonzero(ok)
        return {"lang": batch.column(0).take(pa.array(keep)), "v": [x[i].tobytes() for i in keep]}
    # rows that share doc_id and language count as one, whatever their number
    picked = rows.join(F.broadcast(some), ["doc_id", "lang"], "left_semi").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    sampled = map_rows(picked.select("lang", "text"), run,
                       "lang string, v binary", max_rows=256)

    def per_language(group: pa.Table) -> pa.Table:
        x = np.stack([np.frombuffer(v, np.float32) for v in group.column("v").to_pylist()])
        c = cluster(x, centroids)
        sim = x @ c.T
        own = sim.argmax(1)
        radius = [float(np.quantile(sim[own == j, j], REJECT)) if (own == j).any() else 1.0 for j in range(len(c))]
        return pa.table({"lang": [group.column("lang")[0].as_py()] * len(c), "c": [v.tobytes() for v in c],
                         "radius": radius})
    found = sampled.groupBy("lang").applyInArrow(per_language, "lang string, c binary, radius double").collect()
    found.sort(key=lambda r: (r.lang, bytes(r.c)))
    return LanguageModel(idf, [r.lang for r in found],
                         np.stack([np.frombuffer(bytes(r.c), np.float32) for r in found]) if found else np.zeros((0, DIM), np.float32),
                         np.array([r.radius for r in found]))


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score (cosine) and rejected per row of ``docs``."""
    def run(batch: pa.RecordBatch) -> dict:
        lang, score, rejected = model.predict(batch.column(1).to_pylist())
        return {"doc_id": batch.column(0), "lang_pred": lang, "score": score, "rejected": rejected}
    out = map_rows(id_text(docs, id_col, text_col), run, "doc_id long, lang_pred string, score double, rejected boolean",
                   max_rows=256)
    return out.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")
