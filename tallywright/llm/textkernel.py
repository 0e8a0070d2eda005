"""Vectorised word splitting and hashing over Arrow string columns.

Words are found on the UTF-8 bytes. All separators in use are ASCII, so splitting bytes and splitting
code points give the same words. Each word gets a 64-bit hash: a polynomial in an odd base over
per-byte random values, taken as a difference of prefix sums, then finalised with its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
#: For work on words, shingles or features, whose arrays hold some hundred times a block's bytes.
WORK_BYTES = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        both = []
        for base in (_BASE, _INVERSE):
            step = np.full(n, base, np.uint64)
            step[0] = 1
            both.append(np.cumprod(step, dtype=np.uint64))
        _powers = (both[0], both[1])
    return _powers


class Alphabet:
    """Which bytes belong to words, and the value of each byte (A-Z as a-z if ``lower``)."""

    def __init__(self, is_word: np.ndarray, lower: bool = True):
        self.is_word = is_word
        self.values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        if lower:
            self.values[65:91] = self.values[97:123]


def _not_space() -> np.ndarray:
    out = np.ones(256, bool)
    out[[0x20, *range(0x09, 0x0E)]] = False
    return out


def _alphanumeric() -> np.ndarray:
    out = np.zeros(256, bool)
    out[0x30:0x3A] = out[0x41:0x5B] = out[0x61:0x7B] = out[0x80:] = True
    return out


#: Words [^\x20\x09-\x0D]+ and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (after lower-casing A-Z).
NOT_SPACE = Alphabet(_not_space())
ALPHANUMERIC = Alphabet(_alphanumeric())


def string_blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) over blocks of whole rows; nulls are empty."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield row, end, raw[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def _bounds(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    inside = alphabet.is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edges[edges > 0] - 1] = inside[edges[edges > 0] - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _prefix_sums(data: np.ndarray, alphabet: Alphabet) -> np.ndarray:
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(alphabet.values[data] * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def words(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, end byte, hash, row) of every word of a block."""
    start, end, (hashes,), rows = words_and_heads(data, offsets, alphabet, ())
    return start, end, hashes, rows


def words_and_heads(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet, heads: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """Like ``words``; after the words' hashes also those of their first so many bytes (0 for words no longer than that)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, [np.zeros(0, np.uint64)] * (1 + len(heads)), none
    start, end = _bounds(data, offsets, alphabet)
    prefix, down = _prefix_sums(data, alphabet), powers(len(data) + 1)[1]
    hashes = [mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))]
    for n in heads:
        longer = end - start > n
        part = np.zeros(len(start), np.uint64)
        at = start[longer]
        part[longer] = mix((prefix[at + n] - prefix[at]) * down[at] + np.uint64(n) + np.uint64(0x100000000))
        hashes.append(part)
    return start, end, hashes, np.searchsorted(offsets, start, "right") - 1


def grams(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each run of ``k`` words within one row."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    whole = rows[:n] == rows[k - 1 :]
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = total * np.uint64(0x9E3779B185EBCA87) + hashes[i : i + n]
    return mix(total + np.uint64(k))[whole], rows[:n][whole]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of many slices, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
