"""Importance resampling towards a target distribution over hashed word n-grams.

Features are all runs of 1 to ``GRAMS`` consecutive words; a feature's bucket is its
CRC-32 modulo ``BUCKETS``.  A bucket's gain is the smoothed log ratio of its share in
the target to its share in the corpus; a document's weight is the mean gain of its
features, and Gumbel noise from its id turns a ranking by weight into a draw without
replacement.

The CRC is linear over bits: the CRC of n bytes is that of n zero bytes (the length
constant) XOR one contribution per byte, which depends on the byte and on its distance
from the end.  Contributions come from one position table, and
``bitwise_xor.reduceat`` folds them over the spans of all words at once.  A longer
feature is its first word at a larger distance XOR the feature behind it.  Spans
longer than the table fold block by block: the state moves on by a block (four
lookups in the same table) and takes the block's contributions.

Two passes read the texts: one counts buckets (partial counts per task, at most
``BUCKETS`` rows each), one scores.  The gains, ``BUCKETS`` numbers, are broadcast.
For the ranking, scores are counted in bins first; only rows of the bins that can be
drawn are sorted, by ranges of (score, doc_id), and a row's rank is its place in its
range plus the sizes of the ranges before.  No task holds a bin or the whole ranking.

Defined cases: null text has no words.  A document without features has weight 0.  A
row without a doc_id has no score, is never drawn and doesn't count as a document to
draw from; its text counts in the corpus.  Rows that share score and doc_id take
consecutive ranks.  An empty target has the counts 0; an empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inspecta.llm.base import free_name, id_text, map_rows, stored

GRAMS = 2
BUCKETS = 10_000
SMOOTH = 10_000           # added to both totals, one per bucket
MIN_WORDS = 20
PERCENT = 25
SEED = 7
REACH = 256               # distances in the position table
BIN = 64                  # scores of one bin of the ranking's histogram
CHUNK = 2_000_000         # bytes that are hashed at once, or one text
POLYNOMIAL = 0xEDB88320   # CRC-32, reflected


@functools.lru_cache(1)
def positions() -> np.ndarray:
    """What a byte adds to the CRC by its distance from the end, flat: [distance * 256 + byte]."""
    last = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        last = np.where(last & 1, (last >> 1) ^ np.uint32(POLYNOMIAL), last >> 1).astype(np.uint32)
    rows = [last]
    for _ in range(REACH - 1):      # one zero byte more behind it
        rows.append((rows[-1] >> 8) ^ last[rows[-1] & 0xFF])
    return np.concatenate(rows)


@functools.lru_cache(1)
def constants() -> np.ndarray:
    """CRC of n zero bytes, n up to REACH."""
    return np.array([zlib.crc32(bytes(n)) for n in range(REACH + 1)], np.uint32)


def long_crc(data: np.ndarray) -> int:
    """CRC-32 of one span of any length, folded block by block."""
    table = positions()
    head = len(data) % REACH
    state = int(constants()[head]) ^ int(np.bitwise_xor.reduce(
        table[np.arange(head - 1, -1, -1) * 256 + data[:head]], initial=0))
    blocks = data[head:].reshape(-1, REACH)
    way = np.arange(REACH - 1, -1, -1) * 256
    for at in range(0, len(blocks), 4096):
        part = blocks[at:at + 4096]
        own = np.bitwise_xor.reduceat(table[(way + part).ravel()], np.arange(0, part.size, REACH))
        for c in own.tolist():
            state ^= 0xFFFFFFFF     # the register, as the final XOR is undone
            for k in range(4):      # its four bytes, seen from the end of the block
                c ^= int(table[(REACH - 1 - k) * 256 + (state >> 8 * k & 0xFF)])
            state = c ^ 0xFFFFFFFF
    return state


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Features:
    """CRCs of the features of some texts: ``crc[g]`` and ``owner[g]`` for runs of g+1 words."""

    def __init__(self, texts: list[bytes], grams: int):
        data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
        size = np.array([len(t) + 1 for t in texts], np.int64)
        inside = _WORD[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside]).astype(np.int8)))
        lo, hi = edge[::2], edge[1::2]
        word_owner = np.repeat(np.arange(len(texts)), size)[lo]
        # words joined by one space: the byte behind each word is kept as that space
        inside[hi] = True
        data[hi] = 0x20
        data = data[inside]
        n = hi - lo
        lo = np.cumsum(n + 1) - n - 1
        self.words = np.bincount(word_owner, minlength=len(texts))
        self.crc, self.owner = [], []
        table, fixed = positions(), constants()
        if not len(lo):
            self.crc, self.owner = [np.zeros(0, np.uint32)] * grams, [word_owner] * grams
            return
        step = np.arange(len(data))
        back = np.repeat(lo + n, n + 1) - step      # 0 at the space behind the word
        # words: the span ends in front of the space, which adds nothing here
        own = table[np.minimum(np.maximum(back - 1, 0), REACH - 1) * 256 + data]
        own[lo + n] = 0
        linear, length = np.bitwise_xor.reduceat(own, lo), n
        for g in range(grams):
            if g:
                # the first word and its space, in front of the feature of g words behind it
                ok = (word_owner[g:] == word_owner[:len(lo) - g])
                rest = np.concatenate([length[1:len(lo) - g + 1], np.zeros(g, np.int64)])
                far = np.minimum(back + np.repeat(rest, n + 1), REACH - 1)
                front = np.bitwise_xor.reduceat(table[far * 256 + data], lo)
                m = len(lo) - g
                linear = front[:m] ^ linear[1:m + 1]
                length = n[:m] + 1 + length[1:m + 1]
            else:
                ok = np.ones(len(lo), bool)
            crc = linear ^ fixed[np.minimum(length, REACH)]
            for i in np.flatnonzero((length > REACH) & ok).tolist():
                crc[i] = long_crc(data[lo[i]:lo[i] + length[i]])
            self.crc.append(crc[ok])
            self.owner.append(word_owner[:len(ok)][ok])


def chunks(texts: list[bytes], grams: int) -> Iterator[tuple[int, Features]]:
    """(number of texts, their features) by about CHUNK bytes."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK or i == len(texts) - 1:
            yield i + 1 - at, Features(texts[at:i + 1], grams)
            at, size = i + 1, 0


def _bytes(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def bucket_counts(texts: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of the features of all rows of ``texts`` (text, not null)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, f in chunks(_bytes(batch, 0), grams):
                for crc in f.crc:
                    held += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["bucket", "n"])
    return (texts.mapInArrow(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(docs: DataFrame, target: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS,
          smooth: int = SMOOTH) -> np.ndarray:
    """The gain of each bucket; ``buckets`` numbers come to the driver."""
    import math

    def counts(df: DataFrame) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        for r in bucket_counts(df.select("text"), grams, buckets).toLocalIterator():
            out[r["bucket"]] = r["n"]
        return out
    s, t = counts(docs), counts(target)
    s_all, t_all = float(s.sum() + smooth), float(t.sum() + smooth)
    return np.array([math.floor(1000 * math.log((b + 1) * s_all / ((a + 1) * t_all)))
                     for a, b in zip(s.astype(float).tolist(), t.astype(float).tolist())], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, grams: int = GRAMS) -> DataFrame:
    """doc_id, n_words, n_features, weight per row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batch: pa.RecordBatch) -> dict:
        table, words, number, total = shared.value, [], [], []
        for n, f in chunks(_bytes(batch, 1), grams):
            words.append(f.words)
            count, whole = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for crc, owner in zip(f.crc, f.owner):
                got = np.cumsum(np.concatenate([[0], table[crc % np.uint32(len(table))]]))
                ends = np.searchsorted(owner, np.arange(n + 1))
                whole += got[ends[1:]] - got[ends[:-1]]
                count += np.diff(ends)
            number.append(count)
            total.append(whole)
        count = np.concatenate(number)
        return {"doc_id": batch.column(0), "n_words": np.concatenate(words), "n_features": count,
                "weight": np.concatenate(total) // np.maximum(count, 1)}
    return map_rows(docs, run, "doc_id long, n_words long, n_features long, weight long")


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         target_text: str = "text", grams: int = GRAMS, buckets: int = BUCKETS, smooth: int = SMOOTH,
         min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_features, weight, score, rank
    (null: not drawn).  ``percent`` of the documents of ``min_words`` words are drawn."""
    rows = id_text(docs, id_col, text_col)
    wanted = target.select(F.coalesce(target[target_text].cast("string"), F.lit("")).alias("text"))
    gain = gains(rows, wanted, grams, buckets, smooth)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / F.lit(4294967296.0))))
    scored = stored(weights(rows, gain, grams)
                    .withColumn("score", (F.col("weight") + noise).cast("long"))
                    .withColumn("pos", F.monotonically_increasing_id()), "resample-scores")
    may = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    bins = sorted(scored.where(may).groupBy(F.expr(f"floor(score / {BIN})").alias("bin")).count().collect(), reverse=True)
    number = sum(n for _, n in bins) * percent // 100
    out = ["doc_id", "n_words", "n_features", "weight", "score"]
    if not number:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    upto = 0
    for low, n in bins:
        upto += n
        if upto >= number:
            break
    high = may & (F.col("score") >= low * BIN)
    # the place within a sorted range, and the range, are the two halves of this id
    order = [F.desc("score"), F.asc("doc_id"), F.asc("pos")]
    ranges = max(1, min(20_000, upto // 1_000_000 + 16))
    place = stored(scored.where(high).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
                   .withColumn("place", F.monotonically_increasing_id()), "resample-order")
    part = F.shiftright("place", 33)
    before, start = 0, {}
    for k, n in sorted(place.groupBy(part.alias("part")).count().collect()):
        start[k], before = before, before + n
    starts = F.broadcast(docs.sparkSession.createDataFrame(sorted(start.items()), "part long, start long"))
    rank = F.col("start") + F.col("place").bitwiseAND(F.lit(2 ** 33 - 1)) + 1
    drawn = (place.withColumn("part", part).join(starts, "part")
             .select(*out, F.when(rank <= number, rank).alias("rank")))
    return scored.where(~F.coalesce(high, F.lit(False))).select(*out, F.lit(None).cast("long").alias("rank")).unionByName(drawn)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all and only its columns; rows that
    share a doc_id stay if one of them is drawn."""
    key = free_name(docs, "x_id")
    ids = (draw(docs, target, id_col, **settings).where("rank is not null")
           .select(F.col("doc_id").alias(key)).distinct())
    return docs.join(ids, docs[id_col].cast("long") == ids[key], "left_semi")
