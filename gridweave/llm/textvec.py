"""Word hashes of whole Arrow string columns at once.

A word's hash is a Karp-Rabin polynomial over its bytes, read from running sums: with
S(i) the sum of value(byte j) * B^j for j < i, a word at [s, e) has (S(e) - S(s)) * B^-s,
modulo 2^64. Texts are taken in pieces of about 128 KB, cut between words, so memory does not
grow with the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

PIECE = 1 << 17
#: rows whose offsets and bytes are copied at a time
ROWS = 512
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_table(separators: bytes) -> np.ndarray:
    """Per byte: 0 for a separator, else 1 + the byte with A-Z lower-cased."""
    t = np.arange(1, 257, dtype=np.uint16)
    t[65:91] += 32
    t[np.frombuffer(separators, np.uint8)] = 0
    return t


#: words of the shingle contracts: all but space and 09-0D
SPACED = byte_table(b" \t\n\x0b\x0c\r")
#: runs of ASCII letters and digits and of all other characters than ASCII ones
PLAIN = byte_table(bytes(b for b in range(128) if not chr(b).isalnum()))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


@lru_cache(maxsize=1)
def _values() -> np.ndarray:
    return mix(np.arange(1, 258, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


def _piece(
    buf: np.ndarray, bounds: np.ndarray, table: np.ndarray, prefixes: tuple[int, ...]
) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Hashes of the words of one piece, the count of words before each bound, prefix hashes."""
    n = len(buf)
    size = PIECE * 2
    while size < n:
        size *= 2
    power, inverse = _powers(size)
    folded = table[buf]
    is_word = folded != 0
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    before[1:] = is_word[:-1]
    after[:-1] = is_word[1:]
    inner = bounds[(bounds > 0) & (bounds < n)]
    before[0] = after[-1] = False
    before[inner] = False
    after[inner - 1] = False
    starts = np.flatnonzero(is_word & ~before)
    ends = np.flatnonzero(is_word & ~after) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_values()[folded] * power[:n], out=sums[1:])
    back, first = inverse[starts], sums[starts]
    hashes = mix((sums[ends] - first) * back)
    short = [mix((sums[np.minimum(ends, starts + p)] - first) * back + np.uint64(p)) for p in prefixes]
    return hashes, np.searchsorted(starts, bounds), short


def words(
    texts: pa.Array, table: np.ndarray, prefixes: tuple[int, ...] = ()
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Yields (first row, last row + 1, word hashes, offsets of the rows in them, prefix hashes).

    Null and empty texts have no words. Every word of every text is hashed.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    for first in range(0, len(texts), ROWS):
        for a, b, *rest in _words(texts.slice(first, ROWS), table, prefixes):
            yield first + a, first + b, *rest


def _words(
    texts: pa.Array, table: np.ndarray, prefixes: tuple[int, ...]
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list[np.ndarray]]]:
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a, n = 0, len(texts)
    while a < n:
        b = max(a + 1, int(np.searchsorted(at, at[a] + PIECE, "right")) - 1)
        b = min(b, n)
        buf = raw[at[a] : at[b]]
        if len(buf) == 0:
            empty = np.zeros(0, np.uint64)
            yield a, b, empty, np.zeros(b - a + 1, np.int64), [empty for _ in prefixes]
        elif len(buf) <= 2 * PIECE or b > a + 1:
            hashes, offs, short = _piece(buf, at[a : b + 1] - at[a], table, prefixes)
            yield a, b, hashes, offs, short
        else:  # one long text, cut between words
            parts, lo = [], 0
            while lo < len(buf):
                hi = min(lo + PIECE, len(buf))
                while hi < len(buf):
                    ahead = np.flatnonzero(table[buf[hi : hi + PIECE]] == 0)
                    hi = hi + int(ahead[0]) if len(ahead) else min(hi + PIECE, len(buf))
                    if len(ahead):
                        break
                parts.append(_piece(buf[lo:hi], np.array([0, hi - lo]), table, prefixes))
                lo = hi
            hashes = np.concatenate([p[0] for p in parts])
            short = [np.concatenate([p[2][k] for p in parts]) for k in range(len(prefixes))]
            yield a, b, hashes, np.array([0, len(hashes)]), short
        a = b


_WEIGHTS = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words (by position of its first word)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n] * _WEIGHTS[0]
    for i in range(1, k):
        out += hashes[i : i + n] * _WEIGHTS[i]
    return mix(out)


def sequence(hashes: np.ndarray) -> np.ndarray:
    """One hash of a whole short sequence, apart from those of other lengths."""
    n = len(hashes)
    total = (hashes * _WEIGHTS[:n]).sum(keepdims=True)
    return mix(total + np.array([n], np.uint64) * _WEIGHTS[63])


def shingle_sets(
    texts: pa.Array, k: int = 5, table: np.ndarray = SPACED
) -> Iterator[tuple[int, np.ndarray]]:
    """Yields (row, sorted distinct hashes of its k-word shingles); of fewer words, the sequence's."""
    for a, b, hashes, offs, _ in words(texts, table):
        every = grams(hashes, k)
        for i in range(b - a):
            lo, hi = offs[i], offs[i + 1]
            if hi - lo >= k:
                got = np.sort(every[lo : hi - k + 1])
                if len(got) > 1:
                    got = got[np.concatenate(([True], got[1:] != got[:-1]))]
                yield a + i, got
            elif hi > lo:
                yield a + i, sequence(hashes[lo:hi])
            else:
                yield a + i, hashes[:0]
