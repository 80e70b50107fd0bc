"""Periodic runs of words by internal pattern matching.

A run of period q has at least max(``SHORTEST``, ``TIMES`` * q) words.  With b the
largest power of two up to q (2 if q is 1), every such run holds an aligned block, one
of b words that starts at a multiple of b, early enough that the block also occurs q
and 2q words on.  So all runs are found from the dyadic blocks:

1. A suffix array of the words, sorted by prefix doubling: step k tells the classes of
   equal stretches of 2^k words, each an interval of the array.  Stretches that occur
   fewer than three times can't lie so in a run and leave the sorting; no more steps
   are made than the longest text can need.
2. A wavelet tree over the array answers range successor: the next occurrence of a
   block at or after a place, within the block's interval.
3. Each aligned block asks for its occurrences in the neighbouring window, the starts
   b to 2b words on.  Occurrences at most b/2 apart form a progression whose
   difference r is the block's period; if the block and the progression lie in two
   stretches of period r, a common period must map one's end onto the other's, so a
   progression gives one candidate period, as does every occurrence by itself.
4. A candidate is extended in both directions as far as words q apart are equal.
   Stretches are remembered by period, so each is walked once, and blocks deep inside
   a run that is known already ask nothing.

Texts are handled whole, several short ones at once: words of different texts have
different numbers, so nothing is found across texts.  Tasks need no shuffle, and a
lost one is simply run again.  A text of 50 MB (about 8 million words) takes some
2 GB of a task's memory, most of it the words themselves.

Defined cases: null text has no words.  Words are what is between ASCII white space.
A row without a doc_id is handled like any other.  Repeated rows give repeated
results; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inspecta.llm.base import id_text, map_rows

SHORTEST = 6
TIMES = 4              # of the period; the argument above needs four
LEAST = 3              # occurrences of a block
CHUNK = 100_000        # words that are handled at once, or one text
_U = np.uint64


# ---- suffix array and wavelet tree ---------------------------------------------
def suffix_levels(ids: np.ndarray, longest: int) -> tuple[np.ndarray, list[tuple]]:
    """The suffix array of the places that matter, and by block length b the aligned
    blocks (b, places, interval starts, interval ends) that occur twice more behind."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    first, size = _classes(ids[order])
    big = size >= LEAST
    array = order[np.repeat(big, size)]
    size = size[big]
    rank = np.arange(n, 2 * n)               # a name of its own for what doesn't matter any more
    rank[array] = np.repeat(np.cumsum(size) - size, size)
    slots, b, levels = np.arange(len(array)), 1, []
    while len(slots) and longest >= max(SHORTEST, TIMES * 2 * b if b > 1 else 0):
        at = array[slots]
        second = np.where(at + b < n, rank[np.minimum(at + b, n - 1)], 2 * n + at)
        key = rank[at] * (3 * n) + second
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        array[slots] = at
        first, size = _classes(key)
        big = size >= LEAST
        keep = np.repeat(big, size)
        rank[at[~keep]] = n + at[~keep]
        lo = np.repeat(slots[first[big]], size[big])
        hi = lo + np.repeat(size[big], size[big])
        at, slots, b = at[keep], slots[keep], 2 * b
        rank[at] = lo
        # within a class places ascend: the last two have no two occurrences behind them
        aligned = (at % b == 0) & (slots < hi - 2)
        levels.append((b, at[aligned], lo[aligned], hi[aligned]))
    return array, levels


def _classes(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place, size) of the runs of equal keys."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return first, np.diff(np.concatenate([first, [len(key)]]))


class WaveletTree:
    """Range successor over an array of numbers below 2**bits; one bit vector a level,
    with counts per 64 bits."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.level, n = bits, [], len(values)
        for k in range(bits - 1, -1, -1):
            one = (values >> k & 1).astype(bool)
            packed = np.zeros((n // 64 + 1) * 8, np.uint8)
            packed[:(n + 7) // 8] = np.packbits(one, bitorder="little")
            words = packed.view("<u8")
            count = np.cumsum(np.bitwise_count(words), dtype=np.int64) - np.bitwise_count(words)
            self.level.append((words, count, n - int(one.sum())))
            values = np.concatenate([values[~one], values[one]])

    @staticmethod
    def _ones(words: np.ndarray, count: np.ndarray, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        below = (_U(1) << (i & 63).astype(_U)) - _U(1)
        return count[w] + np.bitwise_count(words[w] & below)

    def successor(self, lo: np.ndarray, hi: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest value >= least in [lo, hi) of each query; 2**bits if none."""
        top = 1 << self.bits
        a, b, smaller = lo, hi, np.zeros(len(lo), np.int64)
        for k, (words, count, zeros) in zip(range(self.bits - 1, -1, -1), self.level):
            ra, rb = self._ones(words, count, a), self._ones(words, count, b)
            one = (least >> k & 1).astype(bool)
            smaller += np.where(one, (b - a) - (rb - ra), 0)
            a, b = np.where(one, zeros + ra, a - ra), np.where(one, zeros + rb, b - rb)
        smaller = np.where(least >= top, hi - lo, smaller)
        out = np.full(len(lo), top)
        ok = np.flatnonzero(smaller < hi - lo)
        a, b, nth, value = lo[ok], hi[ok], smaller[ok], np.zeros(len(ok), np.int64)
        for k, (words, count, zeros) in zip(range(self.bits - 1, -1, -1), self.level):
            ra, rb = self._ones(words, count, a), self._ones(words, count, b)
            low = (b - a) - (rb - ra)
            one = nth >= low
            nth = np.where(one, nth - low, nth)
            value += one.astype(np.int64) << k
            a, b = np.where(one, zeros + ra, a - ra), np.where(one, zeros + rb, b - rb)
        out[ok] = value
        return out


# ---- runs ----------------------------------------------------------------------
class Stretches:
    """Largest stretches of a period, each walked once."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.known = ids, {}

    def _equal(self, i: int, j: int, step: int) -> int:
        """How many places from i and j (i < j) on, in the direction ``step``, are equal."""
        ids, done, block = self.ids, 0, 64
        room = len(ids) - j if step > 0 else i + 1
        while done < room:
            block = min(block, room - done)
            if step > 0:
                x, y = ids[i + done:i + done + block], ids[j + done:j + done + block]
            else:
                x, y = ids[i - done - block + 1:i - done + 1][::-1], ids[j - done - block + 1:j - done + 1][::-1]
            differ = x != y
            k = int(differ.argmax())
            if differ[k]:
                return done + k
            done += block
            block *= 4
        return done

    def around(self, p: int, q: int) -> tuple[int, int]:
        """(start, end) of the largest stretch of period q that holds p and p + q."""
        starts, spans = self.known.setdefault(q, ([], []))
        k = bisect_right(starts, p)
        if k and p + q < spans[k - 1][1]:
            return spans[k - 1]
        span = (p + 1 - self._equal(p, p + q, -1), p + q + self._equal(p, p + q, 1))
        starts.insert(k, span[0])
        spans.insert(k, span)
        return span


def all_runs(ids: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, in order.  ``longest`` bounds a run's length."""
    array, levels = suffix_levels(ids, longest)
    if not any(len(places) for _, places, _, _ in levels):
        return []
    n = len(ids)
    tree = WaveletTree(array, n.bit_length())
    stretches, runs = Stretches(ids), {}
    inside = np.zeros(n, np.int64)           # end of a known run around each place
    for b, p, lo, hi in levels:
        fresh = inside[p] < p + 3 * b
        for at, q in sorted(candidates(b, p[fresh], lo[fresh], hi[fresh], tree, stretches)):
            s, e = stretches.around(at, q)
            if e - s >= max(SHORTEST, TIMES * q) and (s, e) not in runs:     # a smaller period came before
                runs[s, e] = q
                inside[s:e] = np.maximum(inside[s:e], e)
    return sorted((s, e - s, q) for (s, e), q in runs.items())


def candidates(b: int, p: np.ndarray, lo: np.ndarray, hi: np.ndarray, tree: WaveletTree, stretches: Stretches) -> set[tuple[int, int]]:
    """(place, period) that the blocks of b words at ``p`` suggest."""
    ids, found = stretches.ids, []
    n, least = len(ids), 1 if b == 2 else b       # blocks of two words also stand for period 1
    end, x = p + 2 * b, p + least
    while len(p):
        o = tree.successor(lo, hi, x)
        ok = o < end
        p, lo, hi, end, o = p[ok], lo[ok], hi[ok], end[ok], o[ok]
        if not len(p):
            break
        x, period = o + 1, o - p
        if b > 2:
            r = tree.successor(lo, hi, o + 1) - o
            for k in np.flatnonzero(r <= b // 2).tolist():
                mine = stretches.around(int(p[k]), int(r[k]))
                other = stretches.around(int(o[k]), int(r[k]))
                x[k] = other[1] - b + 1               # behind the progression
                period[k] = other[1] - mine[1]        # 0 in the same stretch: r was found before
        ok = (period >= least) & (period < 2 * b)
        at, q = p[ok], period[ok]
        # places that a run of period q around its first aligned block must have
        ok = at + 3 * q <= n
        at, q = at[ok], q[ok]
        ok = np.ones(len(at), bool)
        for place in (at, at + b - 1, at + q - 1):
            word = ids[place]
            ok &= (word == ids[np.minimum(place + q, n - 1)]) & (word == ids[np.minimum(place + 2 * q, n - 1)])
        found.extend(zip(at[ok].tolist(), q[ok].tolist()))
    return set(found)


def run_rows(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text (a list of words)."""
    out: list[list] = [[] for _ in texts]
    at, size = 0, 0
    for i, words in enumerate(texts):
        size += len(words)
        if size >= CHUNK or i == len(texts) - 1:
            part = texts[at:i + 1]
            numbers, above = [], 0
            for w in part:
                names = {x: k for k, x in enumerate(dict.fromkeys(w), above)}
                above += len(names)
                numbers.append(np.fromiter(map(names.__getitem__, w), np.int64, len(w)))
            length = np.array([len(w) for w in part])
            start = np.cumsum(length) - length
            runs = all_runs(np.concatenate(numbers), int(length.max()))
            for (s, n, q), k in zip(runs, np.searchsorted(start + length, [r[0] for r in runs], side="right").tolist()):
                out[at + k].append((s - int(start[k]), n, q))
            at, size = i + 1, 0
    return out


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | tuple[None, None, None]:
    """The run of the greatest exact length / period; ties: smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              order: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (start, length and period of
    each, numbered in words), start, length and period of the strongest, and
    ``collapsed``: the words that lie in no run behind its first period, by one space.

    ``order(doc_id, n)`` may name the original word that stands at each of n places."""
    def run(batch: pa.RecordBatch) -> dict:
        ids = batch.column(0).to_pylist()
        texts = [t.split() for t in batch.column(1).cast(pa.binary()).to_pylist()]
        if order is not None:
            for i, (d, w) in enumerate(zip(ids, texts)):
                places = order(d, len(w))
                if places is not None:
                    texts[i] = [w[k] for k in places.tolist()]
        found, kept = run_rows(texts), []
        for w, runs in zip(texts, found):
            if runs:
                stays = np.ones(len(w), bool)
                for s, n, q in runs:
                    stays[s + q:s + n] = False
                w = [w[k] for k in np.flatnonzero(stays).tolist()]
            kept.append(b" ".join(w).decode())
        best = [strongest(r) for r in found]
        return {"doc_id": ids, "n_words": [len(w) for w in texts], "collapsed": kept,
                "runs": [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found],
                **{c: [x[k] for x in best] for k, c in enumerate(("start", "length", "period"))}}
    return map_rows(id_text(docs, id_col, text_col), run,
                    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
                    "start long, length long, period long, collapsed string", max_rows=400)


def digest_rows(found: DataFrame) -> DataFrame:
    """Counts and digests of the rows of ``find_runs``."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n"))))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "start", "length", "period",
                        F.expr("1000 * length div period").alias("exponent_milli"),
                        F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
