"""The first 32 bits of md5 digests of short texts, many side by side; the same numbers as of ``draw``."""

from __future__ import annotations

import hashlib
import math

import numpy as np

#: Rows that are computed together, so that they stay in a core's cache; the longest text that is one block of md5.
ROWS, LONGEST = 1 << 14, 55
START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
ADDED = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
SHIFTS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
PLACES = ((1, 0), (5, 1), (3, 5), (7, 0))


def md5_heads(words: list[np.ndarray], size: int) -> np.ndarray:
    """The numbers of texts of ``size`` bytes, given as little-endian words of 32 bits with a byte 0x80 behind each text."""
    out = np.empty(len(words[0]), dtype=np.uint32)
    for lo in range(0, len(out), ROWS):
        own = [w[lo : lo + ROWS] for w in words]
        n = len(own[0])
        a, b, c, d = (np.full(n, v, dtype=np.uint32) for v in START)
        f, high = np.empty((2, n), dtype=np.uint32)
        for i in range(64):
            turn = i // 16
            if turn == 0:
                np.bitwise_xor(c, d, out=f)
                f &= b
                f ^= d
            elif turn == 1:
                np.bitwise_xor(b, c, out=f)
                f &= d
                f ^= c
            elif turn == 2:
                np.bitwise_xor(b, c, out=f)
                f ^= d
            else:
                np.invert(d, out=f)
                f |= b
                f ^= c
            g = (PLACES[turn][0] * i + PLACES[turn][1]) % 16
            a += f
            a += np.uint32((ADDED[i] + (8 * size if g == 14 else 0)) % 2**32)
            if g < len(own):
                a += own[g]
            s = SHIFTS[turn][i % 4]
            np.right_shift(a, np.uint32(32 - s), out=high)
            a <<= np.uint32(s)
            a |= high
            a += b
            a, b, c, d = d, a, b, c
        a += np.uint32(START[0])
        out[lo : lo + ROWS] = a.byteswap()
    return out


def window_heads(data: np.ndarray, k: int) -> np.ndarray:
    """The numbers of the ``k`` bytes from each place on."""
    n = len(data) - k + 1
    if k > LONGEST:
        text = data.tobytes()
        return np.array([int(hashlib.md5(text[i : i + k]).hexdigest()[:8], 16) for i in range(n)], dtype=np.uint32)
    x = np.concatenate([data, np.zeros(8, dtype=np.uint8)]).astype(np.uint32)
    four = x[:-3] | (x[1:-2] << np.uint32(8)) | (x[2:-1] << np.uint32(16)) | (x[3:] << np.uint32(24))
    whole, rest = divmod(k, 4)
    last = (four[4 * whole : 4 * whole + n] & np.uint32((1 << 8 * rest) - 1)) | np.uint32(0x80 << 8 * rest)
    return md5_heads([*(four[4 * i : 4 * i + n] for i in range(whole)), last], k)


def numbered_heads(prefixes: list[bytes], n: int) -> np.ndarray:
    """A row per prefix: the numbers of the prefix followed by 1, 2, ... ``n`` as text."""
    out = np.empty((len(prefixes), n), dtype=np.uint32)
    length = np.array([len(p) for p in prefixes])
    for own in np.unique(length):
        rows = np.flatnonzero(length == own)
        for digits in range(1, len(str(n)) + 1):
            lo, hi = 10 ** (digits - 1), min(10**digits - 1, n)
            size = int(own) + digits
            if size > LONGEST:
                raise ValueError("a prefix is too long")
            wide = 4 * (size // 4 + 1)
            front = np.array([prefixes[r].ljust(wide, b"\0") for r in rows]).astype(f"S{wide}").view(np.uint8).reshape(len(rows), wide).view(np.uint32)
            ends = b"".join((b"\0" * int(own) + str(i).encode() + b"\x80").ljust(wide, b"\0") for i in range(lo, hi + 1))
            behind = np.frombuffer(ends, dtype=np.uint32).reshape(-1, wide // 4)
            words = [(front[:, j, None] | behind[None, :, j]).ravel() for j in range(wide // 4)]
            out[rows, lo - 1 : hi] = md5_heads(words, size).reshape(len(rows), -1)
    return out
