"""Count-min sketches of 64-bit keys, merged from partition sketches.

Each task counts the keys of its partition into rows of cells; it sends the cells
it touched, by block, with counts that stop at 2.  Blocks are merged in a shuffle
and become bitmaps of the cells that reached ``least``.  What is broadcast is these
bitmaps: ``depth * cells / 8`` bytes, ``cells`` being at most ``MAX_CELLS`` (128 MiB
a row), whatever the input.  Beyond that size a sketch only overestimates more
keys, and the exact pass behind it sorts them out; no key is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from inspecta.llm.base import give_back, short_batches, shuffles_dropped, stored

BLOCK = 1 << 16
ROWS = 1000             # rows whose keys are held at once
MIN_CELLS = 1 << 20
MAX_CELLS = 1 << 30
CELLS_PER_KEY = 8
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


class Shape(NamedTuple):
    cells: int
    depth: int = 2      # rows; a key is estimated by the least of its cells
    least: int = 2      # count (1 or 2) whose cells are marked


def cells_for(keys: float) -> int:
    want = max(1, int(keys * CELLS_PER_KEY))
    return min(MAX_CELLS, max(MIN_CELLS, 1 << (want - 1).bit_length()))


def cell(keys: np.ndarray, row: int, cells: int) -> np.ndarray:
    shift = np.uint64(64 - (cells.bit_length() - 1))
    return (keys * np.uint64(_ODD[row])) >> shift


def marked(rows: DataFrame, keys_of: Callable[[pa.RecordBatch], list[np.ndarray]], shapes: list[Shape]) -> Broadcast:
    """Broadcast list of bitmaps, one ``bytes`` per row of each shape.  ``keys_of``
    gives, for an Arrow batch of ``rows``, the keys (uint64) of each sketch."""
    lines = [(k, r) for k, shape in enumerate(shapes) for r in range(shape.depth)]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the cells touched so far, sorted, with counts up to 2; memory follows the partition
        held = [(np.zeros(0, np.uint32), np.zeros(0, np.uint8)) for _ in lines]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                keys = keys_of(batch.slice(at, ROWS))
                for i, (k, r) in enumerate(lines):
                    c, n = np.unique(cell(keys[k], r, shapes[k].cells).astype(np.uint32), return_counts=True)
                    held[i] = _merged(*held[i], c, np.minimum(n, 2).astype(np.uint8))
            give_back()
        for i, (c, n) in enumerate(held):
            if len(c):
                block = c // np.uint32(BLOCK)
                first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
                ends = np.concatenate([first[1:], [len(c)]])
                at = (c % np.uint32(BLOCK)).astype("<u2")
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(first), i, np.int32)), pa.array(block[first].astype(np.int64)),
                    pa.array([at[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
                    pa.array([np.packbits(n[a:b] > 1).tobytes() for a, b in zip(first, ends)], pa.binary())],
                    names=["line", "block", "at", "twice"])
        held = keys = c = n = block = at = None
        give_back()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for line, block, at, twice in zip(*(c.to_pylist() for c in batch.columns)):
                count = counts.setdefault((line, block), np.zeros(BLOCK, np.uint8))
                at = np.frombuffer(at, "<u2")
                add = 1 + np.unpackbits(np.frombuffer(twice, np.uint8), count=len(at))
                count[at] = np.minimum(count[at] + add, 2)
        for (line, block), count in counts.items():
            bits = np.packbits(count >= shapes[lines[line][0]].least, bitorder="little")
            yield pa.RecordBatch.from_arrays([pa.array([line], pa.int32()), pa.array([block], pa.int64()),
                                              pa.array([bits.tobytes()], pa.binary())], names=["line", "block", "bits"])

    blocks = sum(s.depth * s.cells // BLOCK for s in shapes)
    parts = max(8, min(512, blocks // 64))
    with shuffles_dropped(rows.sparkSession), short_batches(rows.sparkSession, ROWS):
        merged = stored(rows.mapInArrow(partial, "line int, block long, at binary, twice binary")
                        .repartition(parts, "line", "block")
                        .mapInArrow(merge, "line int, block long, bits binary"), "sketch")
    out = [[bytearray(s.cells // 8) for _ in range(s.depth)] for s in shapes]
    for line, block, bits in merged.toLocalIterator():
        k, r = lines[line]
        out[k][r][block * (BLOCK // 8):(block + 1) * (BLOCK // 8)] = bytes(bits)
    # plain bytes are unpickled without a second copy
    return rows.sparkSession.sparkContext.broadcast([[bytes(r) for r in rows_] for rows_ in out])


def _merged(c0, n0, c1, n1):
    """Two sorted cell lists as one; a cell in both has count 2."""
    if not len(c0) or not len(c1):
        return (c0, n0) if len(c0) else (c1, n1)
    at = np.minimum(np.searchsorted(c0, c1), len(c0) - 1)
    known = c0[at] == c1
    n0[at[known]] = 2
    c1, n1 = c1[~known], n1[~known]
    place = np.searchsorted(c0, c1)
    return np.insert(c0, place, c1), np.insert(n0, place, n1)


def is_marked(keys: np.ndarray, bits: list[bytes]) -> np.ndarray:
    """True where the key's cell is marked in every row."""
    out = np.ones(len(keys), bool)
    for r, row in enumerate(bits):
        c = cell(keys, r, len(row) * 8)
        out &= (np.frombuffer(row, np.uint8)[c >> np.uint64(3)] >> (c & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return out
