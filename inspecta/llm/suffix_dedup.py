"""Repeated byte strings by anchors and digests, in place of a radix sort of suffixes.

What matters of a suffix is its first ``LENGTH`` bytes, the threshold (its window):
suffixes with equal windows are exactly the repeats.  They are grouped and never
ordered.  Passes go from coarse keys, called digits here, to whole windows; a pass
goes on only with groups that can still hold windows of two documents.

Pass 1, counting.  The leading digit of a window is its anchor: of the ``DIGIT``-byte
strings inside it the one with the smallest hash, at its place.  Equal windows have
equal anchors at equal places.  As in a counting sort, the digits' histogram is
merged from partition histograms (``sketch``, with hashed digits); digits that
only one document has are done.

Pass 2.  Neighbouring windows with the same anchor form a unit.  Units of the
remaining digits are grouped by all their bytes (128 bits of hash) and each group
keeps its smallest doc_id.  In every other document of the group the whole unit is
repeated.  The groups' first documents are marked in a bitmap, and so are digits
with more than one group.

Pass 3 checks all units that are marked as firsts, so a wrong mark only means more
work.  At a digit with several groups they may share a part of their windows: these
are counted, as in pass 1, by blocks, each block by the bytes that all its windows
share; at a digit with one group the unit is counted whole.  The windows of blocks
and the units that may be in two documents are grouped by their bytes (128 bits),
again with the smallest doc_id.

The suffixes are never gathered: groups are partial minima by digest, so a group
that holds a third of all rows leaves each task as one row.  Documents meet only the
items they are the first of, by one join on doc_id.

Defined cases: null text is empty.  A text of fewer than ``LENGTH`` bytes loses
nothing.  A row without a doc_id has no smaller doc_id and names none: it loses
nothing and takes nothing from others.  Rows that share a doc_id don't take from
each other.  Bytes that stay are not always valid UTF-8, so they are binary.  Very
long texts take part whole.  An empty table gives no rows.  Other columns are not
read.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inspecta.llm import sketch
from inspecta.llm.base import id_text, map_rows, short_batches, shuffles_dropped, stored
from inspecta.llm.sketch import Shape, is_marked
from inspecta.llm.windows import Digests, Ranges, anchor_places, mixed

LENGTH = 50
DIGIT = 24
CHUNK = 100_000            # bytes that are hashed at once
ROWS = 1000
BLOCKS = 4                 # of the windows that have an anchor


class Chunk:
    """Windows and units of some texts."""

    def __init__(self, texts: list[bytes], docs: np.ndarray, length: int, digit: int):
        self.texts, self.docs, self.length, self.width = texts, docs, length, digit
        self.size = np.array([len(t) for t in texts], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.data = b"".join(texts)
        self.ranges = Ranges(self.data)
        n = max(0, len(self.data) - length + 1)
        h = self.ranges.every(digit)
        place = anchor_places(h, length - digit + 1) if n else np.zeros(0, np.int64)
        # windows that don't cross texts, and where neighbours have other anchors
        end = self.first + self.size
        whole = np.ones(n + length, bool)
        for a, b in zip(np.maximum(self.first, end - length + 1).tolist(), end.tolist()):
            whole[a:b] = False
        whole = whole[:n]
        new = np.ones(n + 1, bool)
        new[1:-1] = place[1:] != place[:-1]
        self.lo = np.flatnonzero(whole & (new[:-1] | ~np.concatenate([[False], whole])[:-1]))
        self.hi = np.flatnonzero(whole & (new[1:] | ~np.concatenate([whole, [False]])[1:]))
        self.place = place[self.lo]
        self.digit = h[self.place] if n else np.zeros(0, np.uint64)
        self.owner = np.searchsorted(end, self.lo, side="right")

    def digits(self) -> np.ndarray:
        """The leading digits, once per document."""
        order = np.lexsort((self.digit, self.owner))
        d, o = self.digit[order], self.owner[order]
        return d[np.concatenate([[True], (d[1:] != d[:-1]) | (o[1:] != o[:-1])])] if len(d) else d

    @functools.cached_property
    def words(self) -> Digests:
        return Digests(self.data)

    def unit_hashes(self, units: np.ndarray) -> np.ndarray:
        """Second half of the identity of units; the first is their digit."""
        lo = self.lo[units]
        return self.words.of(lo, self.hi[units] + self.length - lo, 0, self.place[units] - lo)

    def blocks(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first start, last start, key) of the blocks of windows of some units.  A block
        has the windows whose anchor lies ``step * b`` to ``step * b + step - 1`` bytes in, and
        its key is of the bytes that all of them would share."""
        step = max(1, -(-(self.length - self.width + 1) // BLOCKS))
        place = self.place[units]
        least, most = place - self.hi[units], place - self.lo[units]       # bytes before the anchor
        n = most // step - least // step + 1
        at = np.repeat(np.arange(len(units)), n)
        b = least[at] // step + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        place, first = place[at], b * step
        last = np.minimum(first + step - 1, self.length - self.width)
        key = mixed(self.ranges.hashes(place - first, place - last + self.length) + b.astype(np.uint64))
        return place - np.minimum(last, most[at]), place - np.maximum(first, least[at]), key

    def digests(self, starts: np.ndarray) -> np.ndarray:
        size = np.full(len(starts), self.length, np.int64)
        return np.stack([self.words.of(starts, size, k) for k in (0, 1)], axis=1).view(np.int64)

    # ---- what the passes have found so far ----
    def candidates(self, digits: list[bytes]) -> np.ndarray:
        """Units whose digit may be in two documents."""
        return np.flatnonzero(is_marked(self.digit, digits))

    def claims(self, digits: list[bytes], found: list[list[bytes]]) -> tuple[np.ndarray, "Items"]:
        """Settled units, which are repeated whole, and what pass 3 has to check of
        the units that are marked as the first of their group."""
        cand = self.candidates(digits)
        unit = self.unit_hashes(cand)
        first = is_marked(first_key(self.digit[cand], unit, self.docs[self.owner[cand]]), found[0])
        shared = is_marked(self.digit[cand], found[1])
        return cand[~first], Items(self, cand[first & shared], cand[first & ~shared], unit[first & ~shared])


class Items:
    """Blocks of windows of units whose digit has several groups, and whole units else."""

    def __init__(self, chunk: Chunk, opened: np.ndarray, alone: np.ndarray, unit: np.ndarray):
        self.chunk = chunk
        self.first, self.last, h = chunk.blocks(opened)
        self.alone, self.digit, self.unit = alone, chunk.digit[alone], unit
        self.key = np.concatenate([h, mixed(self.digit ^ mixed(unit))])

    def marked(self, counted: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows of blocks, and units, that may be in two documents: first and last starts,
        digests (n, 2), owners."""
        c, hit = self.chunk, is_marked(self.key, counted)
        block = np.flatnonzero(hit[:len(self.first)])
        unit = np.flatnonzero(hit[len(self.first):])
        n = (self.last - self.first + 1)[block]
        starts = np.repeat(self.first[block], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        lo = np.concatenate([starts, c.lo[self.alone[unit]]])
        hi = np.concatenate([starts, c.hi[self.alone[unit]]])
        digests = np.concatenate([c.digests(starts), np.stack([self.digit[unit], self.unit[unit]], axis=1).view(np.int64)])
        return lo, hi, digests, np.searchsorted(c.first + c.size, lo, side="right")


def first_key(digit: np.ndarray, unit: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return mixed(digit ^ mixed(unit ^ mixed(doc.astype(np.uint64))))


def _within(digest: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Digests told apart by the row they belong to."""
    return digest.astype(np.int64).view(np.uint64) ^ mixed(row.astype(np.uint64))


def chunks(batch: pa.RecordBatch, length: int, digit: int):
    """(rows, Chunk) of an Arrow batch (doc_id, text); a chunk has about CHUNK bytes, or one text."""
    docs, rows, texts, size = batch.column(0).to_numpy(zero_copy_only=False), [], [], 0
    for i, t in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
        rows.append(i)
        texts.append(t)
        size += len(t)
        if size >= CHUNK:
            yield rows, Chunk(texts, docs[rows], length, digit)
            rows, texts, size = [], [], 0
    if rows:
        yield rows, Chunk(texts, docs[rows], length, digit)


def _joined(parts: list[np.ndarray], kind=np.uint64) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def shapes_for(size: int, length: int = LENGTH, digit: int = DIGIT) -> tuple[Shape, Shape, Shape, Shape]:
    """Sketches of digits, firsts, groups and blocks for ``size`` bytes of text.  They only decide
    how much work the passes save; every Python worker holds all four in passes 3 and 4."""
    units = size * 2 / (length - digit + 2)
    return (Shape(sketch.cells_for(units / 2), 1), Shape(sketch.cells_for(units / 8), 2, 1),
            Shape(sketch.cells_for(units / 4), 1), Shape(sketch.cells_for(size / 64), 2))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   digit: int = DIGIT, shapes: tuple[Shape, Shape, Shape, Shape] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (the
    remaining bytes) and spans (start and end of each removed run)."""
    spark = docs.sparkSession
    every = id_text(docs, id_col, text_col)
    rows = every.where("doc_id is not null")
    if shapes is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shapes = shapes_for(size, length, digit)
    digit_shape, first_shape, group_shape, window_shape = shapes

    # pass 1
    def leading(batch: pa.RecordBatch) -> list[np.ndarray]:
        return [_joined([c.digits() for _, c in chunks(batch, length, digit)])]
    digits = sketch.marked(rows, leading, [digit_shape])

    # pass 2
    def unit_rows(batch: pa.RecordBatch) -> dict:
        a, b, d = [], [], []
        for _, c in chunks(batch, length, digit):
            cand = c.candidates(digits.value[0])
            a.append(c.digit[cand])
            b.append(c.unit_hashes(cand))
            d.append(c.docs[c.owner[cand]])
        return {"digit": _joined(a).view(np.int64), "unit": _joined(b).view(np.int64), "doc": _joined(d, np.int64)}
    groups = (map_rows(rows, unit_rows, "digit long, unit long, doc long", max_rows=ROWS)
              .groupBy("digit", "unit").agg(F.min("doc").alias("doc")))

    def firsts(batch: pa.RecordBatch) -> list[np.ndarray]:
        d, u, doc = (batch.column(k).to_numpy() for k in range(3))
        return [first_key(d.view(np.uint64), u.view(np.uint64), doc), d.view(np.uint64)]
    found = sketch.marked(groups, firsts, [first_shape, group_shape])

    # pass 3
    def item_keys(batch: pa.RecordBatch) -> list[np.ndarray]:
        return [_joined([c.claims(digits.value[0], found.value)[1].key for _, c in chunks(batch, length, digit)])]
    counted = sketch.marked(rows, item_keys, [window_shape])

    def item_rows(batch: pa.RecordBatch) -> dict:
        w, d = [np.zeros((0, 2), np.int64)], []
        for _, c in chunks(batch, length, digit):
            _, _, digests, owner = c.claims(digits.value[0], found.value)[1].marked(counted.value[0])
            w.append(digests)
            d.append(c.docs[owner])
        w = np.concatenate(w)
        return {"w1": w[:, 0], "w2": w[:, 1], "doc": _joined(d, np.int64)}
    with shuffles_dropped(spark), short_batches(spark, ROWS):
        own = stored(map_rows(rows, item_rows, "w1 long, w2 long, doc long", max_rows=ROWS)
                     .groupBy("w1", "w2").agg(F.min("doc").alias("own_doc"))
                     # which of a document's items are its own: 64 bits tell them apart within it
                     .groupBy("own_doc").agg(F.collect_list("w1").alias("own")), "own-items")

    def finish(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept", "spans")}
        null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        filled = pa.RecordBatch.from_arrays([batch.column(0).fill_null(0), batch.column(1)], names=["d", "t"])
        for part, c in chunks(filled, length, digit):
            settled, items = c.claims(digits.value[0], found.value)
            first, last, digests, owner = items.marked(counted.value[0])
            if len(first):
                mine = batch.column(2).take(pa.array(part))
                of = np.repeat(np.arange(len(part)), mine.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                own = np.isin(_within(digests[:, 0], owner), _within(mine.flatten().to_numpy(zero_copy_only=False), of))
                first, last = first[~own], last[~own]
            lo = np.concatenate([c.lo[settled], first])
            hi = np.concatenate([c.hi[settled], last])
            cover = np.bincount(lo, minlength=len(c.data) + 1) - np.bincount(hi + length, minlength=len(c.data) + 1)
            gone = np.cumsum(cover[:-1]) > 0
            for i, t, a in zip(part, c.texts, c.first.tolist()):
                g = gone[a:a + len(t)]
                if null[i] or not g.any():
                    g = np.zeros(len(t), bool)
                edge = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]]).astype(np.int8))).reshape(-1, 2)
                out["n_bytes"].append(len(t))
                out["n_removed"].append(int(g.sum()))
                out["n_spans"].append(len(edge))
                out["kept"].append(np.frombuffer(t, np.uint8)[~g].tobytes() if len(edge) else t)
                out["spans"].append(edge.astype(np.int64).tolist())
        out["doc_id"] = batch.column(0)
        return out
    both = every.join(own, every.doc_id == own.own_doc, "left").select("doc_id", "text", "own")
    return map_rows(both, finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, "
                    "spans array<array<long>>", max_rows=ROWS)
