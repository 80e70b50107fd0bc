"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text becomes ``\\u2581`` (the dummy prefix) and the text with spaces as
``\\u2581``.  Symbols start as single characters; an agenda of adjacent pairs
whose join is a piece, ordered by score and then by position, is worked off
best first, and a join puts its new pairs on the agenda.  Characters without a
piece become byte pieces.  Short segments of the same length are worked off side by
side, as rows of an array: each round joins the best pair of every row.

No piece of such a vocabulary has ``\\u2581`` after another character (checked when
it is loaded), so a merge never crosses the start of a run of ``\\u2581``: the text
is cut there, and each segment is encoded once per cache.  Every segment that is
encoded is checked, by Arrow batch, against the sentencepiece library; on a
difference the library's ids are used and counted in ``n_corrected``.  Decoding
calls the library's ``decode``.

Defined cases: null equals empty, whose ids are begin and end only and whose
decoded text is empty.  Rows that repeat are encoded each.  Very long texts are
encoded whole.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inspecta.llm.base import give_back, id_text, short_batches, stored

SPACE = "▁"
CACHE = 100_000        # segments in each of the two cache generations of a task
CACHED_CHARS = 48      # longer segments are encoded again each time
ROW_CHARS = 32         # longer segments have an agenda of their own
ROWS = 500             # rows whose texts are Python strings at once, and rows that a worker gets at once
SCHEMA = "doc_id long, ids binary, decoded string, n_corrected long"


class Joins:
    """The joins of a vocabulary as arrays.  Symbols are its pieces and their characters."""

    NONE = np.int64(1 << 62)       # value of a pair whose join is no piece

    def __init__(self, ids: dict[str, int], rank: dict[str, int]):
        number = {p: k for k, p in enumerate(ids)}
        for c in {c for p in ids for c in p}:
            number.setdefault(c, len(number))
        found = sorted((number[p[:k]] << 32 | number[p[k:]], rank[p] << 32 | number[p]) for p in ids
                       for k in range(1, len(p)) if p[:k] in number and p[k:] in number)
        # a last entry that no pair has; a pair's value is its rank, then the joined symbol
        self.pairs, self.values = (np.array(v, np.int64) for v in zip(*found, ((1 << 62), int(self.NONE))))
        self.ids = np.array([ids.get(p, -1) for p in number] + [-1], np.int64)      # symbol -1 is any other character
        self.symbol = np.full(0x110000, -1, np.int64)
        for c, k in number.items():
            if len(c) == 1:
                self.symbol[ord(c)] = k

    def value(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left << 32 | right
        k = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[k] == pair, self.values[k], self.NONE)

    def rows(self, segments: list[str]):
        """(places, ids) of segments of one length, as their agendas end; an id of -1 is
        a character without a piece."""
        n, at = len(segments[0]), np.arange(len(segments))
        sym = self.symbol[np.frombuffer("".join(segments).encode("utf-32-le"), "<u4").reshape(-1, n)]
        pair = self.value(sym[:, :-1], sym[:, 1:])
        while True:
            best = (pair >> 32).argmin(axis=1) if n > 1 else at     # the leftmost of the best score
            value = np.take_along_axis(pair, best[:, None], 1)[:, 0] if n > 1 else np.full(len(at), self.NONE)
            go = value != self.NONE
            if not go.all():
                yield at[~go], self.ids[sym[~go]]
                if not go.any():
                    return
                at, sym, pair, best, value = at[go], sym[go], pair[go], best[go], value[go]
            row = np.arange(len(at))
            sym[row, best] = value & 0xFFFFFFFF
            sym, pair = _without(sym, best + 1), _without(pair, best)
            n -= 1
            right, left = np.flatnonzero(best < n - 1), np.flatnonzero(best > 0)
            pair[right, best[right]] = self.value(sym[right, best[right]], sym[right, best[right] + 1])
            pair[left, best[left] - 1] = self.value(sym[left, best[left] - 1], sym[left, best[left]])


def _without(a: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Rows without the entry in the given column of each."""
    keep = np.ones(a.shape, bool)
    keep[np.arange(len(a)), column] = False
    return a[keep].reshape(len(a), a.shape[1] - 1)


class Encoder:
    def __init__(self, model_file: str):
        import sentencepiece as sp
        self.lib = sp.SentencePieceProcessor(model_file=model_file)
        n = self.lib.get_piece_size()
        self.id, self.byte, score = {}, {}, {}
        for i in range(n):
            p = self.lib.id_to_piece(i)
            if self.lib.is_byte(i):
                self.byte[int(p[1:-1], 16)] = i
            elif not (self.lib.is_control(i) or self.lib.is_unknown(i) or self.lib.is_unused(i)):
                self.id[p] = i
                score[p] = self.lib.get_score(i)
        bad = [p for p in self.id if SPACE in p.lstrip(SPACE)]
        if bad or len(self.byte) != 256:
            raise ValueError(f"not a merge-type vocabulary with byte pieces that can be cut at spaces: {bad[:3]}")
        places = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = {p: places[s] for p, s in score.items()}
        self.joins = Joins(self.id, self.rank)
        self.cut = re.compile(f"{SPACE}+[^{SPACE}]*")
        self.cache: dict[str, bytes] = {}     # two generations: the older one is dropped
        self.older: dict[str, bytes] = {}     # when the newer one is full

    def agenda(self, segment: str) -> list[int]:
        """Ids of one segment.  An agenda entry is rank * n + place: best score
        first, then leftmost; an entry whose pair has changed since is skipped."""
        sym = list(segment)
        n = len(sym)
        rank = self.rank.get
        pair = [rank(a + b) for a, b in zip(sym, sym[1:])]
        heap = [r * n + i for i, r in enumerate(pair) if r is not None]
        heapq.heapify(heap)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            r, i = divmod(pop(heap), n)
            if pair[i] != r:
                continue
            j = nxt[i]
            joined = sym[i] = sym[i] + sym[j]
            sym[j] = ""
            k = nxt[i] = nxt[j]
            if j < n - 1:
                pair[j] = None
            if k < n:
                prv[k] = i
                pair[i] = r = rank(joined + sym[k])
                if r is not None:
                    push(heap, r * n + i)
            else:
                pair[i] = None
            h = prv[i]
            if h >= 0:
                pair[h] = r = rank(sym[h] + joined)
                if r is not None:
                    push(heap, r * n + h)
        out = []
        get = self.id.get
        for s in sym:
            if s:
                i = get(s)
                if i is not None:
                    out.append(i)
                else:
                    out.extend(self.byte[b] for b in s.encode("utf-8"))
        return out

    def agendas(self, segments: list[str]) -> list[list[int]]:
        """Ids of each segment."""
        out: list = [None] * len(segments)
        by_size: dict[int, list[int]] = {}
        for k, s in enumerate(segments):
            by_size.setdefault(len(s), []).append(k)
        for n, places in by_size.items():
            if not 0 < n <= ROW_CHARS:
                continue
            for at, ids in self.joins.rows([segments[k] for k in places]):
                whole = (ids >= 0).all(axis=1)
                for k, i in zip(at[whole].tolist(), ids[whole].tolist()):
                    out[places[k]] = i
        # long segments, and those with byte pieces
        return [self.agenda(s) if i is None else i for s, i in zip(segments, out)]

    def checked(self, segments: list[str]) -> tuple[dict[str, bytes], int]:
        """Encoded segments as little-endian bytes; how many the library changed."""
        own = self.agendas(segments)
        # the library puts its own dummy prefix for the first mark of a segment
        lib = self.lib.encode([s[1:].replace(SPACE, " ") if len(s) > 1 else "" for s in segments], num_threads=1)
        out, wrong = {}, 0
        for s, a, b in zip(segments, own, lib):
            if len(s) > 1 and a != b:
                a, wrong = b, wrong + 1
            out[s] = struct.pack(f"<{len(a)}I", *a)
        return out, wrong

    def encode_batch(self, texts: list[str]) -> tuple[list[bytes], int]:
        """Ids of each text, with begin and end, as little-endian bytes."""
        bos = self.lib.bos_id().to_bytes(4, "little")
        eos = self.lib.eos_id().to_bytes(4, "little")
        # texts as numbers of their segments: each different segment is held once
        now: dict[str, int | bytes] = {}
        cut = [array("I", [now.setdefault(s, len(now)) for s in self.cut.findall(SPACE + t.replace(" ", SPACE))] if t else [])
               for t in texts]
        missing = []
        for s in now:
            v = self.cache.get(s)
            if v is None:
                v = self.older.get(s)
                if v is None:
                    missing.append(s)
                    continue
                self.cache[s] = v
            now[s] = v
        new, wrong = self.checked(missing)
        now.update(new)
        self.cache.update((s, v) for s, v in new.items() if len(s) <= CACHED_CHARS)
        if len(self.cache) > CACHE:
            self.older, self.cache = self.cache, {}
        coded = list(now.values())     # in the order of their numbers
        return [bos + b"".join(map(coded.__getitem__, segs)) + eos for segs in cut], wrong


_ENCODERS: dict[str, Encoder] = {}


def encoder(model_file: str) -> Encoder:
    """One encoder per Python worker and model."""
    if model_file not in _ENCODERS:
        _ENCODERS[model_file] = Encoder(model_file)
    return _ENCODERS[model_file]


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
           batch_chars: int = 1_000_000) -> DataFrame:
    """Per row of ``docs``: doc_id, ids (little-endian unsigned 32-bit numbers, begin
    and end included), the text decoded from them, and n_corrected (on the first row
    of each batch: segments of the batch that the library encoded otherwise)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    arrow = to_arrow_schema(_parse_datatype_string(SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model_file)
        try:
            for batch in batches:
                for ids, texts in _by_size(batch, batch_chars):
                    raw, wrong = enc.encode_batch(texts)
                    plain = [enc.lib.decode(np.frombuffer(r, "<u4").tolist()) for r in raw]
                    cols = [ids, raw, plain, [wrong] + [0] * (len(ids) - 1)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, arrow)], schema=arrow)
        finally:        # the worker goes on to other stages: it keeps the vocabulary, not the segments
            enc.cache, enc.older = {}, {}
            give_back()
    return id_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def digest_rows(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and n_corrected."""
    return encoded.select("doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
                          "n_corrected")


def stored_digests(docs: DataFrame, model_file: str) -> DataFrame:
    """``digest_rows`` of the encoded ``docs``, stored: so the rows go to Python by few at once."""
    with short_batches(docs.sparkSession, ROWS):
        return stored(digest_rows(encode(docs, model_file)), "encoded")


def _by_size(batch: pa.RecordBatch, chars: int):
    ids, texts, size = [], [], 0
    for at in range(0, batch.num_rows, ROWS):
        part = batch.slice(at, ROWS)
        for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            ids.append(i)
            texts.append(t)
            size += len(t)
            if size >= chars:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts
