"""Words of an Arrow string column as arrays: boundaries and 64-bit hashes, without a Python object per word."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

U = np.uint64
BASE, STEP = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


BYTE = mix(np.arange(1, 257, dtype=U))
BYTE[SPACES] = 0


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 12, 1 << (n - 1).bit_length())
        have = np.ones(size, dtype=U)
        have[1:] = U(base)
        have = _powers[base] = np.multiply.accumulate(have)
    return have[:n]


class Words(NamedTuple):
    data: np.ndarray      # bytes of all texts
    offsets: np.ndarray   # first byte of each text, and the end
    start: np.ndarray     # first byte of each word
    end: np.ndarray       # byte after each word
    doc: np.ndarray       # text of each word
    first: np.ndarray     # first word of each text, and the end
    hash: np.ndarray


def words(texts: pa.Array) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text; a null text has none."""
    texts = texts.fill_null("") if texts.null_count else texts
    at = np.frombuffer(texts.buffers()[1], dtype=np.int32, count=len(texts) + 1 + texts.offset)[texts.offset:].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[at[0]:at[-1]] if raw is not None else np.zeros(0, dtype=np.uint8)
    at = at - at[0]
    solid = ~SPACES[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    before = np.r_[False, solid[:-1]] if len(data) else solid
    start = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.r_[solid[1:], False] if len(data) else solid
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    if len(start):
        weighted = BYTE[data]
        weighted *= powers(BASE, len(data))
        total = np.add.reduceat(weighted, start)
        total *= powers(pow(BASE, -1, 1 << 64), len(data))[start]
        hashed = mix(total)
    else:
        hashed = np.zeros(0, dtype=U)
    doc = np.searchsorted(at, start, side="right") - 1
    # texts without a byte share an offset with the next one; the last of equals owns the word
    first = np.searchsorted(start, at)
    return Words(data, at, start, end, doc, first, hashed)


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of every run of ``size`` words inside one text, and the hash of the run."""
    n = len(w.hash)
    if n < size:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U)
    total = np.zeros(n + 1, dtype=U)
    np.cumsum(w.hash * powers(STEP, n), out=total[1:])
    place = np.flatnonzero(w.doc[: n - size + 1] == w.doc[size - 1:])
    run = (total[place + size] - total[place]) * powers(pow(STEP, -1, 1 << 64), n)[place]
    return place, mix(run)
