"""Rolling hashes and content-chosen anchors of byte ranges, in numpy."""

from __future__ import annotations

import functools

import numpy as np

_U = np.uint64
BASE = 0x9E3779B97F4A7C15      # odd multiplier of the rolling hash
PLACE_BITS = 24                # an anchor is chosen among fewer than 2**24 places


@functools.lru_cache(1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(20).integers(1, 2 ** 63, 256, dtype=np.uint64)


@functools.lru_cache(2)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


class Ranges:
    """Hashes of any byte range of ``data``; equal bytes have equal hashes."""

    def __init__(self, data: bytes):
        size = 1 << max(16, len(data).bit_length())
        self.back = _powers(size, pow(BASE, -1, 1 << 64))
        buf = np.frombuffer(data, np.uint8)
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_byte_values()[buf] * _powers(size, BASE)[:len(buf)], out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start])

    def every(self, width: int) -> np.ndarray:
        """Hashes of all ranges of ``width`` bytes."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[width:] - self.sums[:n]) * self.back[:n])


class Digests:
    """Digests of byte ranges of ``data``, whole ranges chained word by word through a
    bijection; ``lane`` 0 and 1 have other multipliers and seeds."""

    def __init__(self, data: bytes):
        self.words = np.ndarray(len(data) + 1, "<u8", data + bytes(8), strides=(1,)).copy()

    def of(self, start: np.ndarray, size: np.ndarray, lane: int = 0, seed: np.ndarray | int = 0) -> np.ndarray:
        m1, m2 = _LANES[lane]
        h = (size.astype(_U) + _U(lane)) * m1 ^ np.asarray(seed, _U) * m2
        shortest, longest = (int(size.min()), int(size.max())) if len(size) else (0, 0)
        for at in range(0, longest, 8):
            if at + 8 <= shortest:
                h = _step(h ^ self.words[start + at], m1, m2)
                continue
            some = np.flatnonzero(size > at)       # the last words: bytes behind the range don't count
            rest = np.minimum(size[some] - at, 8).astype(_U)
            word = self.words[start[some] + at] & (~_U(0) >> (_U(64) - _U(8) * rest))
            h[some] = _step(h[some] ^ word, m1, m2)
        return h


_LANES = ((_U(0xD6E8FEB86659FD93), _U(0x9E3779B97F4A7C15)), (_U(0xC2B2AE3D27D4EB4F), _U(0xBF58476D1CE4E5B9)))


def _step(h: np.ndarray, m1, m2) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * m1
    h = (h ^ (h >> _U(29))) * m2
    return h ^ (h >> _U(32))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    if len(x) < width:
        return x[:0]
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    if have < width:
        x = np.minimum(x[:len(x) - (width - have)], x[width - have:])
    return x


def anchor_places(h: np.ndarray, width: int) -> np.ndarray:
    """For every ``width`` neighbours the place of the smallest hash, leftmost on a
    tie.  The offset in the window depends on its hashes alone.  Longer inputs are
    cut into blocks of fewer than 2**PLACE_BITS places that share ``width - 1``."""
    block = (1 << PLACE_BITS) - 1
    if len(h) <= block:
        return _block_places(h, width)
    step = block - width + 1
    if step < 1:
        raise ValueError(f"no anchors among {width} places of {PLACE_BITS} bits")
    return np.concatenate([_block_places(h[a:a + block], width) + a for a in range(0, len(h) - width + 1, step)]
                          or [np.zeros(0, np.int64)])


def _block_places(h: np.ndarray, width: int) -> np.ndarray:
    packed = (h >> _U(PLACE_BITS) << _U(PLACE_BITS)) | np.arange(len(h), dtype=np.uint64)
    return (sliding_min(packed, width) & _U((1 << PLACE_BITS) - 1)).astype(np.int64)
