"""Counting quotient filters over packed tuples of word ids, lossless.

A tuple of word ids of ``width`` bits each is packed in two halves and moved by an invertible permutation
(a Feistel network), so that keys lie evenly over the whole range whatever words are frequent. The top bits of
a permuted key are its quotient, all other bits its remainder. A filter keeps, sorted by key, the run length of
each quotient in unary (one bit an entry, one a quotient), the full remainders in whole bytes and one byte a counter
(larger counts beside them). Nothing of the key is lost: decoding and inverting give the word ids back.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

from wakeline.llm.words import mix

_ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
_HEAD = "<qqq"
_U = np.uint64


def half_bits(width: int, words: int) -> int:
    """Bits of either half of a packed key."""
    half = (width * words + 1) // 2
    if half > 62:
        raise ValueError("word ids of more than 41 bits")
    return half


def _mask(bits: int) -> np.uint64:
    return _U((1 << bits) - 1)


def pack(ids: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two or three arrays of word ids to the left and right halves of keys."""
    half = half_bits(width, len(ids))
    first, *_, last = (x.astype(_U) for x in ids)
    if len(ids) == 2:
        return first, last
    middle = ids[1].astype(_U)
    low = half - width  # bits of the middle word in the right half
    return first << _U(width - low) | middle >> _U(low), (middle & _mask(low)) << _U(width) | last


def unpack(left: np.ndarray, right: np.ndarray, width: int, words: int) -> list[np.ndarray]:
    if words == 2:
        return [left, right]
    low = half_bits(width, 3) - width
    middle = (left & _mask(width - low)) << _U(low) | right >> _U(width)
    return [left >> _U(width - low), middle, right & _mask(width)]


def permute(left: np.ndarray, right: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    for key in _ROUNDS:
        left, right = right, left ^ (mix(right ^ _U(key)) & _mask(half))
    return left, right


def invert(left: np.ndarray, right: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    for key in reversed(_ROUNDS):
        left, right = right ^ (mix(left ^ _U(key)) & _mask(half)), left
    return left, right


@dataclass
class Entries:
    """Different permuted keys, ascending, and their counts."""

    left: np.ndarray
    right: np.ndarray
    count: np.ndarray

    def __len__(self) -> int:
        return len(self.count)

    def cut(self, at: int, till: int) -> Entries:
        return Entries(self.left[at:till], self.right[at:till], self.count[at:till])


def summed(left: np.ndarray, right: np.ndarray, count: np.ndarray | None, half: int) -> Entries:
    """Sorts keys and adds the counts of equal ones (1 each without counts)."""
    if 2 * half <= 64:
        key = left << _U(half) | right
        if count is None:
            key, found = np.unique(key, return_counts=True)
            return Entries(key >> _U(half), key & _mask(half), found.astype(np.int64))
        order = np.argsort(key, kind="stable")  # merges runs that are sorted already
    else:
        order = np.lexsort((right, left))
    left, right = left[order], right[order]
    new = np.ones(len(left), bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    first = np.flatnonzero(new)
    if count is None:
        total = np.diff(np.append(first, len(left)))
    else:
        total = np.add.reduceat(count[order], first) if len(first) else count[:0]
    return Entries(left[first], right[first], total.astype(np.int64))


def count_tuples(ids: list[np.ndarray], width: int) -> Entries:
    half = half_bits(width, len(ids))
    return summed(*permute(*pack(ids, width), half), None, half)


def merge(parts: list[Entries], half: int) -> Entries:
    """One filter's entries from several: sorted runs are merged, counts of equal keys added."""
    if not parts:
        nothing = np.zeros(0, _U)
        return Entries(nothing, nothing, np.zeros(0, np.int64))
    if len(parts) == 1:
        return parts[0]
    joined = [np.concatenate([getattr(p, x) for p in parts]) for x in ("left", "right", "count")]
    return summed(*joined, half)


def words_of(entries: Entries, width: int, words: int) -> list[np.ndarray]:
    return unpack(*invert(entries.left, entries.right, half_bits(width, words)), width, words)


def split(entries: Entries, half: int, known: int, bits: int) -> list[tuple[int, Entries]]:
    """Entries that share their first ``known`` bits by their first ``bits`` bits."""
    prefix = entries.left >> _U(half - bits) if bits else np.zeros(len(entries), _U)
    cuts = np.flatnonzero(prefix[1:] != prefix[:-1]) + 1
    edges = [0, *cuts.tolist(), len(entries)] if len(entries) else [0]
    return [(int(prefix[a]), entries.cut(a, b)) for a, b in zip(edges, edges[1:])]


def _bytes_of(values: np.ndarray, size: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def _values_of(data: memoryview, size: int, n: int) -> np.ndarray:
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :size] = np.frombuffer(data, np.uint8, n * size).reshape(n, size)
    return wide.reshape(-1).view("<u8").astype(_U)


def _sizes(half: int, known: int, spread: int) -> tuple[int, int]:
    """Bytes of a remainder's left and right part."""
    return -(-(half - known - spread) // 8), -(-half // 8)


def encode(entries: Entries, half: int, known: int) -> bytes:
    """The filter of entries that share their first ``known`` bits."""
    n = len(entries)
    spread = min(half - known, max(0, n.bit_length() - 1))
    rest = half - known - spread
    quotient = (entries.left >> _U(rest) & _mask(spread)).astype(np.int64)
    runs = np.zeros(n + (1 << spread), np.uint8)
    runs[quotient + np.arange(n)] = 1  # an entry is a one, the end of a quotient's run a zero
    a, b = _sizes(half, known, spread)
    large = np.flatnonzero(entries.count > 255)
    return b"".join(
        (
            struct.pack(_HEAD, n, spread, len(large)),
            np.packbits(runs).tobytes(),
            _bytes_of(entries.left & _mask(rest), a),
            _bytes_of(entries.right, b),
            np.where(entries.count > 255, 0, entries.count).astype(np.uint8).tobytes(),
            entries.count[large].astype("<i8").tobytes(),
        )
    )


def decode(data: bytes, half: int, known: int, prefix: int) -> Entries:
    n, spread, n_large = struct.unpack_from(_HEAD, data)
    at, view = struct.calcsize(_HEAD), memoryview(data)
    size = -(-(n + (1 << spread)) // 8)
    runs = np.unpackbits(np.frombuffer(view[at : at + size], np.uint8), count=n + (1 << spread))
    quotient = (np.flatnonzero(runs) - np.arange(n)).astype(_U)
    at += size
    a, b = _sizes(half, known, spread)
    rest = half - known - spread
    left = _U(prefix) << _U(half - known) | quotient << _U(rest) | _values_of(view[at:], a, n)
    at += a * n
    right = _values_of(view[at:], b, n)
    at += b * n
    count = np.frombuffer(view[at : at + n], np.uint8).astype(np.int64)
    count[count == 0] = np.frombuffer(view[at + n :], "<i8", n_large)
    return Entries(left, right, count)
