"""The first 32 bits of the MD5 of very many short words at once: the rounds
run over arrays with a lane for every word."""

from __future__ import annotations

import hashlib
import math

import numpy as np

#: Longest word (bytes) that fits one block; words of one pass (its arrays
#: stay in the processor's cache).
BLOCK, LANES = 55, 1 << 13
_SHIFTS = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2 ** 32)) for i in range(64)]
_PLACES = [i if i < 16 else (5 * i + 1) % 16 if i < 32 else (3 * i + 5) % 16 if i < 48 else 7 * i % 16 for i in range(64)]
#: By the bytes of a word's rest in four bytes, -1 to 4 and one up: which of them count, and the end mark.
_MASK = np.array([0, 0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)
_MARK = np.array([0, 0x80, 0x8000, 0x800000, 0x80000000, 0], dtype=np.uint32)


def md5_heads(words: list[str], chars: np.ndarray) -> np.ndarray:
    """The first four bytes of every word's digest, as a big-endian number;
    ``chars``: the words' lengths."""
    out = np.empty(len(words), dtype=np.uint32)
    for i in range(0, len(words), LANES):
        some = words[i:i + LANES]
        hi = np.cumsum(chars[i:i + LANES])
        lo = hi - chars[i:i + LANES]
        text = "".join(some)
        raw = np.frombuffer(text.encode() + bytes(BLOCK + 9), dtype=np.uint8)
        if not text.isascii():
            begins = np.flatnonzero(raw & 0xC0 != 0x80)
            lo, hi = begins[lo], begins[hi]
        raw = raw.astype(np.uint32)
        fours = raw[:-3] | raw[1:-2] << np.uint32(8) | raw[2:-1] << np.uint32(16) | raw[3:] << np.uint32(24)
        size = hi - lo
        out[i:i + LANES] = _heads(fours, lo, np.minimum(size, BLOCK))
        for k in np.flatnonzero(size > BLOCK).tolist():
            out[i + k] = int.from_bytes(hashlib.md5(some[k].encode(), usedforsecurity=False).digest()[:4], "little")
    return out.byteswap().astype(np.int64)


def _heads(fours: np.ndarray, lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    n = len(lo)
    words: list[np.ndarray | None] = [None] * 16
    for k in range(int(size.max(initial=0)) // 4 + 1):
        rest = np.clip(size - 4 * k, -1, 4) + 1
        words[k] = (fours[lo + 4 * k] & _MASK[rest]) | _MARK[rest]
    words[14] = (size * 8).astype(np.uint32)
    a, b, c, d = (np.full(n, x, dtype=np.uint32) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476))
    f, t = np.empty(n, dtype=np.uint32), np.empty(n, dtype=np.uint32)
    # What the last three rounds add does not reach the first number.
    for i in range(61):
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
        f += a
        f += _SINES[i]
        if words[_PLACES[i]] is not None:
            f += words[_PLACES[i]]
        by = _SHIFTS[i // 16][i % 4]
        np.left_shift(f, np.uint32(by), out=t)
        np.right_shift(f, np.uint32(32 - by), out=f)
        f |= t
        f += b
        a, b, c, d, f = d, f, b, c, a
    return b + np.uint32(0x67452301)
