"""Words and word hashes of whole Arrow batches, vectorised over their bytes.

A word is ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 text; a null text has none. Hashes depend on the
word's bytes alone, so every task gives a word the same value without a dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

#: Bytes of text that one vectorised step takes, unless a single text is longer.
STEP_BYTES = 1 << 19
_CHUNK = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    have = _tables.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, _CHUNK + 1)
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            step = np.full(size, b, np.uint64)
            step[0] = 1
            pair.append(np.cumprod(step, dtype=np.uint64))
        have = _tables[base] = (pair[0], pair[1])
    return have


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A name for the ordered pair (a, b)."""
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + (b ^ np.uint64(0x632BE59BD9B4E019)))


@dataclass
class Words:
    """The words of some texts laid end to end."""

    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # first byte of each text, and the end
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray
    bounds: np.ndarray  # first word of each text, and the end

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1, dtype=np.int32), self.counts())

    def hashes(self, which: int = 0) -> np.ndarray:
        out = np.empty(len(self), np.uint64)
        base = _BASES[which]
        at = 0
        while at < len(self):
            left = int(self.starts[at])
            till = max(at + 1, int(np.searchsorted(self.ends, left + _CHUNK, "right")))
            right = int(self.ends[till - 1])
            up, down = powers(base, right - left)
            total = np.zeros(right - left + 1, np.uint64)
            np.cumsum((self.data[left:right].astype(np.uint64) + np.uint64(1)) * up[: right - left], out=total[1:])
            s, e = self.starts[at:till] - left, self.ends[at:till] - left
            out[at:till] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
            at = till
        return out


def words(texts: pa.Array) -> Words:
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    offs = offs - offs[0]
    space = _SPACE[raw]
    before, after = np.ones(len(raw), bool), np.ones(len(raw), bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    inner = offs[1:-1]
    before[inner[inner < len(raw)]] = True
    after[inner[inner > 0] - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return Words(raw, offs, starts, ends, np.searchsorted(starts, offs))


def steps(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in slices of about STEP_BYTES of text (whole texts)."""
    sizes = np.array([0, *np.cumsum(np.nan_to_num(np.asarray(pa.compute.binary_length(batch.column(text)).fill_null(0))))])
    at = 0
    while at < batch.num_rows:
        till = max(at + 1, int(np.searchsorted(sizes, sizes[at] + STEP_BYTES, "right")) - 1)
        yield batch.slice(at, till - at)
        at = till
