"""Substring dedup over word windows with a count-min prefilter.

First pass: every window of ``WINDOW`` words has an anchor, the shingle of
``ANCHOR`` words in it with the smallest hash.  Equal windows have equal anchors
at equal offsets, so the count of an anchor is never below the count of a window
that has it.  Anchors (one in about a dozen words) are counted in a count-min
sketch that is merged from partition sketches (``sketch``), and the sketch's
estimate of a window is that of its anchor: an overestimate, never less.

Second pass: only windows estimated at two or more are shuffled, by a 128-bit
digest of their words, and counted exactly with partial sums.  What comes back is
the few that turn out to be single; all other estimated windows are repeated.

Words are maximal runs of bytes other than space and \\x09-\\x0d.  Windows are
judged on the input.  Each word covered by a repeated window is removed.

Defined cases: null or empty text has no words and keeps the empty text.  A text
shorter than a window loses nothing.  Rows that repeat whole repeat each other's
windows.  A null doc_id is allowed.  Very long texts take part whole.  An empty
table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inspecta.llm import sketch
from inspecta.llm.base import id_text, map_rows
from inspecta.llm.windows import Ranges, anchor_places

WINDOW = 35
ANCHOR = 12
CHUNK = 1_000_000           # bytes of text that are hashed at once


class Chunk:
    """Words, windows and anchors of some texts."""

    def __init__(self, texts: list[bytes], window: int, anchor: int):
        words = [t.split() for t in texts]
        self.counts = np.array([len(w) for w in words], np.int64)
        every = [w for doc in words for w in doc]
        self.words = words
        self.data = b" ".join(every)
        size = np.fromiter(map(len, every), np.int64, len(every))
        self.end = np.cumsum(size + 1) - 1
        self.start = self.end - size
        n = len(every)
        self.first = np.cumsum(self.counts) - self.counts
        # windows that end in the document they start in
        last = np.repeat(self.first + self.counts, self.counts)
        self.at = np.flatnonzero(np.arange(n) + window <= last)
        self.window = window
        if len(self.at):
            h = Ranges(self.data).hashes(self.start[:n - anchor + 1], self.end[anchor - 1:])
            place = anchor_places(h, window - anchor + 1)[self.at]
            self.place, self.key = place, h
        else:
            self.place, self.key = self.at, np.zeros(0, np.uint64)

    def anchor_keys(self) -> np.ndarray:
        p = self.place
        return self.key[p[np.concatenate([[True], p[1:] != p[:-1]])]] if len(p) else self.key

    def estimated(self, bits: list[bytes]) -> np.ndarray:
        """Starts (word numbers) of windows estimated as repeated."""
        return self.at[sketch.is_marked(self.key[self.place], bits)]

    def digests(self, at: np.ndarray) -> np.ndarray:
        import xxhash
        data, one = self.data, xxhash.xxh3_128_digest
        spans = zip(self.start[at].tolist(), self.end[at + self.window - 1].tolist())
        return np.frombuffer(b"".join([one(data[a:b]) for a, b in spans]), "<i8").reshape(-1, 2)


def chunks(batch: pa.RecordBatch, column: int, window: int, anchor: int):
    """(rows, Chunk) of an Arrow batch; a chunk has about CHUNK bytes, or one text."""
    from_row, texts, size = 0, [], 0
    for i, t in enumerate(batch.column(column).cast(pa.binary()).to_pylist()):
        texts.append(t)
        size += len(t)
        if size >= CHUNK:
            yield range(from_row, i + 1), Chunk(texts, window, anchor)
            from_row, texts, size = i + 1, [], 0
    if texts:
        yield range(from_row, batch.num_rows), Chunk(texts, window, anchor)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, anchor: int = ANCHOR, cells: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed and kept_text, the
    words that stay, joined by one space."""
    rows = id_text(docs, id_col, text_col)
    keyed = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    if cells is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        cells = sketch.cells_for(size / 6.5 * 2 / (window - anchor + 2))

    def keys_of(batch: pa.RecordBatch) -> list[np.ndarray]:
        return [np.concatenate([c.anchor_keys() for _, c in chunks(batch, 0, window, anchor)] or [np.zeros(0, np.uint64)])]

    shared = sketch.marked(rows.select("text"), keys_of, [sketch.Shape(cells)])

    def emit(batch: pa.RecordBatch) -> dict:
        keys, out, doc = batch.column(0).to_numpy(), [], []
        for part, c in chunks(batch, 1, window, anchor):
            at = c.estimated(shared.value[0])
            out.append(c.digests(at))
            owner = np.repeat(np.arange(len(c.counts)), c.counts)[at]
            doc.append(keys[part.start:part.stop][owner])
        d = np.concatenate(out)
        return {"d1": d[:, 0], "d2": d[:, 1], "key": np.concatenate(doc)}

    windows = map_rows(keyed.select("key", "text"), emit, "d1 long, d2 long, key long", max_rows=2000)
    single = (windows.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("key"))
              .where("n = 1").groupBy("key").agg(F.collect_list(F.struct("d1", "d2")).alias("single")))

    def finish(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"n_words": [], "n_removed": [], "kept_text": []}
        singles = batch.column(2)
        for part, c in chunks(batch, 1, window, anchor):
            at = c.estimated(shared.value[0])
            known = [None if s is None else {(d["d1"], d["d2"]) for d in s}
                     for s in singles.slice(part.start, len(part)).to_pylist()]
            if any(known):
                owner = np.repeat(np.arange(len(c.counts)), c.counts)[at]
                look = np.array([k is not None for k in known])[owner]
                d = c.digests(at[look]).tolist()
                wrong = np.array([tuple(x) in known[o] for x, o in zip(d, owner[look].tolist())], bool)
                at = np.delete(at, np.flatnonzero(look)[wrong])
            cover = np.zeros(len(c.start) + 1, np.int64)
            cover[at] += 1
            cover[at + window] -= 1
            gone = np.cumsum(cover[:-1]) > 0
            lost = np.add.reduceat(np.concatenate([gone, [False]]), np.minimum(c.first, len(gone))) * (c.counts > 0)
            for words, a, n, k in zip(c.words, c.first.tolist(), c.counts.tolist(), lost.tolist()):
                if k:
                    words = [w for w, g in zip(words, gone[a:a + n].tolist()) if not g]
                out["n_words"].append(n)
                out["n_removed"].append(int(k))
                out["kept_text"].append(b" ".join(words).decode("utf-8"))
        out["doc_id"] = batch.column(0)
        return out

    joined = keyed.join(single, "key", "left").select("doc_id", "text", "single")
    return map_rows(joined, finish, "doc_id long, n_words long, n_removed long, kept_text string", max_rows=2000)
