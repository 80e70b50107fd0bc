"""SimHash near-duplicates by anchor-point covering.

Fingerprints have 64 bits.  Anchors are pairs of words of the binary Golay code
of length 23 on bits 0-22 and 23-45; that code is perfect, so every point lies
within its covering radius 3 of an anchor in each half.  Let two fingerprints
differ in at most t bits.  A point halfway between them is within h = ceil(t/2)
of both, and its anchor is within 3 of it in each half.  So both fingerprints
reach that anchor with at most h bits beyond the radius, over both halves
together: replicated to all such anchors (61 on average for t = 4), every linked
pair meets at least once.  This is the rule "covering radius plus threshold" with
the threshold shared by the two sides, which needs far fewer copies.

Equal fingerprints are one point, so copies of a text never meet at an anchor.
Per anchor, pairs are compared in shifted blocks; at an anchor with many points
links are found by a walk that takes each found point out of the rest, so a dense
group costs about its size.  Links go through ``components``.

Defined cases: null text equals empty text; a text without words has fingerprint
zero and is linked like any other.  Rows that repeat share a fingerprint.  A row
whose doc_id is null is compared, but never names a component unless all its rows
are null.  Very long texts are hashed in blocks.  An empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inspecta.llm.base import free_name, id_text, map_rows, short_batches, stored
from inspecta.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
HASH_BLOCK = 1 << 16
SMALL = 48            # points of an anchor that are compared pair by pair
BITS = 23
RADIUS = 3
GENERATOR = 0b101011100011    # of the Golay code of length 23
ROWS = 1000           # rows that a Python worker gets at once


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bit i is 1 if it is set in over half of the shingles' XXH64."""
    import xxhash
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    k = min(shingle, len(words))
    one = xxhash.xxh64_intdigest
    spans = zip(starts, ends[k - 1:])
    n = len(words) - k + 1
    bits = np.zeros(64, np.int64)
    for at in range(0, n, HASH_BLOCK):
        size = min(HASH_BLOCK, n - at)
        h = np.array([one(joined[a:b - 1], SEED) for _, (a, b) in zip(range(size), spans)], np.uint64)
        bits += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) per row; fp is the fingerprint as a signed 64-bit number."""
    def run(batch: pa.RecordBatch) -> dict:
        fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
        return {"doc_id": batch.column(0), "fp": fps.view(np.int64)}
    return map_rows(id_text(docs, id_col, text_col), run, "doc_id long, fp long")


def stored_fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    with short_batches(docs.sparkSession, ROWS):
        return stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")


@functools.lru_cache(1)
def syndromes() -> np.ndarray:
    """Syndrome of each single bit of a 23-bit word."""
    out = []
    for bit in range(BITS):
        x = 1 << bit
        for k in range(BITS - 1, 10, -1):
            if x >> k & 1:
                x ^= GENERATOR << (k - 11)
        out.append(x)
    return np.array(out, np.int64)


@functools.lru_cache(4)
def patterns(extra: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For j = 0..extra: differences from a word to the anchors that lie j bits
    beyond the radius (0: within it), by syndrome: (first, number, differences)."""
    syn, out = syndromes(), []
    words, syns = np.zeros(1, np.int64), np.zeros(1, np.int64)
    tops = np.full(1, -1, np.int64)
    groups = [(words, syns)]
    for _ in range(RADIUS + extra):
        ws, ss, ts = [], [], []
        for bit in range(BITS):
            ok = tops < bit
            ws.append(words[ok] | (1 << bit))
            ss.append(syns[ok] ^ syn[bit])
            ts.append(np.full(int(ok.sum()), bit, np.int64))
        words, syns, tops = np.concatenate(ws), np.concatenate(ss), np.concatenate(ts)
        groups.append((words, syns))
    for j in range(extra + 1):
        pick = groups[:RADIUS + 1] if j == 0 else [groups[RADIUS + j]]
        w = np.concatenate([g[0] for g in pick])
        s = np.concatenate([g[1] for g in pick])
        order = np.argsort(s, kind="stable")
        number = np.bincount(s, minlength=1 << 11)
        out.append((np.cumsum(number) - number, number, w[order]))
    return out


def anchors(fps: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) of every replica of the fingerprints ``fps`` (uint64)."""
    extra = (max_bits + 1) // 2
    table, syn = patterns(extra), syndromes()
    half, code = [], []
    for shift in (0, BITS):
        y = ((fps >> np.uint64(shift)) & np.uint64((1 << BITS) - 1)).astype(np.int64)
        s = np.zeros(len(y), np.int64)
        for bit in range(BITS):
            s ^= np.where(y >> bit & 1, syn[bit], 0)
        half.append(y)
        code.append(s)
    rows, out = [], []
    for i in range(extra + 1):
        for j in range(extra + 1 - i):
            (fa, na, wa), (fb, nb, wb) = table[i], table[j]
            la, lb = na[code[0]], nb[code[1]]
            n = la * lb
            row = np.repeat(np.arange(len(fps)), n)
            k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            a = half[0][row] ^ wa[fa[code[0]][row] + k // lb[row]]
            b = half[1][row] ^ wb[fb[code[1]][row] + k % lb[row]]
            rows.append(row)
            out.append(a | b << BITS)
    return np.concatenate(rows), np.concatenate(out)


def link_group(fp: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``fp`` (places), by a walk."""
    rest = np.arange(len(fp))
    out = []
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            i = front.pop()
            near = np.bitwise_count(fp[rest] ^ fp[i]) <= max_bits
            found = rest[near]
            out.extend((int(i), int(j)) for j in found)
            front.extend(found.tolist())
            rest = rest[~near]
    return out


def link_sorted(anchor: np.ndarray, fp: np.ndarray, rep: np.ndarray, max_bits: int) -> np.ndarray:
    """Links (2, n) of reps among rows that are sorted by anchor."""
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    size = np.diff(np.concatenate([first, [len(anchor)]]))
    found = []
    for k in np.flatnonzero(size > SMALL):
        s = slice(first[k], first[k] + size[k])
        pairs = link_group(fp[s], max_bits)
        if pairs:
            p = np.array(pairs).T + first[k]
            found.append(np.stack([rep[p[0]], rep[p[1]]]))
    small = np.repeat((size > 1) & (size <= SMALL), size)
    at = np.flatnonzero(small)
    for d in range(1, SMALL):
        at = at[at + d < len(anchor)]
        at = at[anchor[at] == anchor[at + d]]
        if not len(at):
            break
        hit = at[np.bitwise_count(fp[at] ^ fp[at + d]) <= max_bits]
        found.append(np.stack([rep[hit], rep[hit + d]]))
    if not found:
        return np.zeros((2, 0), np.int64)
    pairs = np.concatenate(found, axis=1)
    return np.unique(np.sort(pairs, axis=0), axis=1)


def links(points: DataFrame, max_bits: int = MAX_BITS, chunk: int = 250_000) -> DataFrame:
    """Edges (a, b) that join all rows of ``points`` (fp, rep) within ``max_bits``."""
    def replicate(batch: pa.RecordBatch) -> dict:
        fp = batch.column(0).to_numpy().view(np.uint64)
        row, anchor = anchors(fp, max_bits)
        return {"anchor": anchor, "fp": fp[row].view(np.int64), "rep": batch.column(1).to_numpy()[row]}

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def edges(rows: np.ndarray) -> pa.RecordBatch:
            e = link_sorted(rows[0], rows[1].view(np.uint64), rows[2], max_bits)
            return pa.RecordBatch.from_arrays([pa.array(e[0]), pa.array(e[1])], names=["a", "b"])
        for batch in batches:
            held.append(np.stack([batch.column(k).to_numpy() for k in range(3)]))
            if sum(h.shape[1] for h in held) >= chunk:
                rows = np.concatenate(held, axis=1)
                cut = int(np.searchsorted(rows[0], rows[0][-1]))   # the last anchor may go on
                if cut:
                    yield edges(rows[:, :cut])
                held = [rows[:, cut:]]
        if held:
            yield edges(np.concatenate(held, axis=1))

    near = map_rows(points.select("fp", "rep"), replicate, "anchor long, fp long, rep long", max_rows=4096)
    return (near.repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(compare, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp, fingerprint (16 hex digits), component_id per row of ``docs``."""
    fps = stored_fingerprints(docs, id_col, text_col, shingle)
    return fps.join(labels(fps, max_bits), "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def labels(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component_id) of the distinct fingerprints of ``fps`` (doc_id, fp).

    A fingerprint that only rows without a doc_id have gets a negative stand-in
    while links are found; such a component's id is null."""
    points = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    # without a doc_id the stand-in comes after every doc_id
    points = stored(points.withColumn("rep", F.coalesce(
        "low", F.lit(2 ** 62) + F.pmod(F.xxhash64("fp"), F.lit(2 ** 61)))), "points")
    roots = components(links(points, max_bits))
    root = F.coalesce("root", "rep")
    return (points.join(roots, points.rep == roots.node, "left")
            .select("fp", F.when(root < F.lit(2 ** 62), root).alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document whose doc_id
    is the component's id.  Columns are those of ``docs``.  Rows that share a
    doc_id stay or go together: they go if none of them names its component.  A
    row without a doc_id can't be named and stays."""
    fps = stored_fingerprints(docs, id_col, text_col, shingle)
    found = fps.where("doc_id is not null").distinct().join(labels(fps, max_bits), "fp")
    key = free_name(docs, "x_id")
    gone = (found.groupBy(F.col("doc_id").alias(key))
            .agg(F.max(F.col("doc_id") == F.col("component_id")).alias("stays")).where("not stays").select(key))
    return docs.join(gone, docs[id_col].cast("long") == gone[key], "left_anti")
