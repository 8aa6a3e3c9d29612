"""Substring deduplication by recompression.

A text is a sequence of word names. Rounds shorten it: the first names runs of one word, each
later one cuts the names into left and right halves by a salted bit and replaces every pair
(left, right) by one new symbol. A name is a hash of what it stands for, so equal runs and pairs
get equal names everywhere and no dictionary has to be built or shipped.

Which symbol appears depends on its own words and few neighbours: its context. A window takes as
anchor the symbol of the highest round that has any whose context lies inside the window; of several the one
whose hash is least. The anchor
is a function of the window's words alone, so equal windows have equal anchors. Two Spark rounds
follow: the first counts anchors over all documents (one row for some ten words), which rules out
the windows whose anchor is met once; the second names the windows that are left with 128 bits
and counts them. Both return what is met once, from partial counts, so no key, however frequent,
gathers its rows in one task and nothing is joined on a frequent key.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.words import Words, combine, mix, powers, steps, words

_BASE = 0xC2B2AE3D27D4EB4F
#: Rounds of pairs. After three a symbol and its context span ten words or so: short enough for
#: windows of 35 words to hold several, which keeps one anchor in use over many windows.
ROUNDS = 3
_KEY = "cid long, cid2 int"


def anchors(names: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word that starts a window inside its text: its place, the anchor's name, and a
    number that tells the anchor's own place and round."""
    n = len(names)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    first, last = bounds[:-1][text], bounds[1:][text]
    place = np.flatnonzero(np.arange(n) + window <= last)
    if not len(place):
        return place, np.zeros(0, np.uint64), place
    up, down = powers(_BASE, n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(names * up[:n], out=total[1:])

    sym, left, right, where = names, np.arange(n), np.arange(n) + 1, text  # [left, right): context
    anchor, spot = np.zeros(len(place), np.uint64), np.zeros(len(place), np.int64)
    for level in range(ROUNDS + 1):
        k0, k1 = np.searchsorted(left, place), np.searchsorted(right, place + window, "right")
        inside = k0 < k1
        if not inside.any():
            break
        k = _least(mix(sym ^ np.uint64(level)), k0[inside], k1[inside])
        content = (total[right[k]] - total[left[k]]) * down[left[k]]
        anchor[inside] = combine(content + np.uint64(level), sym[k])
        spot[inside] = k * (ROUNDS + 1) + level
        # What a text's first and last symbol become also depends on what lies outside the window.
        edge = np.flatnonzero(where[1:] != where[:-1]) + 1
        heads, tails = np.concatenate(([0], edge)), np.concatenate((edge, [len(sym)])) - 1
        out_left, out_right = bounds[where[heads]] - 1, np.minimum(bounds[where[tails] + 1] + 1, n + 1)
        before, after = np.empty_like(left), np.empty_like(right)
        before[1:], after[:-1] = left[:-1], right[1:]
        before[heads], after[tails] = out_left, out_right
        if level == 0:
            fresh = np.ones(len(sym), bool)
            fresh[1:] = (sym[1:] != sym[:-1]) | (where[1:] != where[:-1])
            a = np.flatnonzero(fresh)
            z = np.concatenate((a[1:], [len(sym)])) - 1
            run = (z - a + 1).astype(np.uint64)
            sym, where = np.where(run > 1, combine(sym[a], run), sym[a]), where[a]
            left, right = before[a], after[z]
        else:
            side = (mix(sym + np.uint64(level)) & np.uint64(1)).astype(bool)  # True: right half
            pair = np.zeros(len(sym), bool)
            pair[:-1] = ~side[:-1] & side[1:] & (where[1:] == where[:-1])
            second = np.concatenate(([False], pair[:-1]))
            new_left = np.where(side, before, left)
            new_right = np.where(side, right, after)
            merged = np.flatnonzero(pair)
            new_left[merged], new_right[merged] = left[merged], right[merged + 1]
            sym = sym.copy()
            sym[merged] = combine(sym[merged], sym[merged + 1])
            keep = ~second
            sym, left, right, where = sym[keep], new_left[keep], new_right[keep], where[keep]
    return place, anchor, spot


def _least(value: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Place of the smallest value in each range (the leftmost of equals), by a sparse table."""
    low = ((value >> np.uint64(32)) << np.uint64(32)) | np.arange(len(value), dtype=np.uint64)
    size = (end - begin).astype(np.int64)
    depth = np.frexp(size)[1] - 1
    out = np.empty(len(begin), np.uint64)
    for d in range(int(depth.max()) + 1):
        own = depth == d
        out[own] = np.minimum(low[begin[own]], low[end[own] - (1 << d)])
        low = np.minimum(low[: -(1 << d) or None], low[1 << d :]) if len(low) > 1 << d else low
    return (out & np.uint64(0xFFFFFFFF)).astype(np.int64)


def window_names(names: np.ndarray, place: np.ndarray, window: int) -> np.ndarray:
    """A name for the ``window`` words from each place, by doubling."""
    out, at, width, power = None, 0, 1, names
    while True:
        if window & width:
            part = power[place + at]
            out = part if out is None else combine(out, part)
            at += width
        if at == window:
            return out
        power = combine(power[:-width], power[width:])
        width *= 2


def _marked(size: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0


def _listed(column: pa.Array, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and, for each, the first word of its text."""
    column = column.cast(pa.list_(pa.int64()))
    lengths = np.asarray(pa.compute.list_value_length(column).fill_null(0))
    return np.asarray(column.flatten(), dtype=np.int64), np.repeat(bounds[:-1], lengths)


def _open(batch: pa.RecordBatch, w: Words, window: int) -> np.ndarray:
    """Which words start a window whose anchor is shared."""
    last = np.repeat(w.bounds[1:], w.counts())
    open_ = np.arange(len(w)) + window <= last
    values, first = _listed(batch.column("once"), w.bounds)
    return open_ & ~_marked(len(w), first + (values >> 6), values & 63)


def _anchor_rows(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                w = words(part.column("text"))
                place, anchor, spot = anchors(w.hashes(), w.bounds, window)
                if not len(place):
                    continue
                text = w.text_of_word()[place]
                fresh = np.ones(len(place), bool)
                fresh[1:] = (spot[1:] != spot[:-1]) | (place[1:] != place[:-1] + 1) | (text[1:] != text[:-1])
                a = np.flatnonzero(fresh)
                # A run is cut at 63 windows so that its length has six bits.
                length = np.diff(np.concatenate((a, [len(place)])))
                pieces = -(-length // 63)
                a = np.repeat(a, pieces)
                step = np.arange(len(a)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                length = np.minimum(63, np.repeat(length, pieces) - 63 * step)
                a = a + 63 * step
                own = text[a]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[a].view(np.int64)),
                        part.column("cid").take(pa.array(own)),
                        part.column("cid2").take(pa.array(own)),
                        pa.array(((place[a] - w.bounds[own]) << 6) | length),
                    ],
                    names=["name", "cid", "cid2", "piece"],
                )

    return rows


def _window_rows(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                w = words(part.column("text"))
                place = np.flatnonzero(_open(part, w, window))
                if not len(place):
                    continue
                own = w.text_of_word()[place]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(window_names(w.hashes(0), place, window).view(np.int64)),
                        pa.array(window_names(w.hashes(1), place, window).view(np.int64)),
                        part.column("cid").take(pa.array(own)),
                        part.column("cid2").take(pa.array(own)),
                        pa.array(place - w.bounds[own]),
                    ],
                    names=["name", "name2", "cid", "cid2", "place"],
                )

    return rows


def _kept_rows(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                w = words(part.column("text"))
                repeated = _open(part, w, window)
                values, first = _listed(part.column("single"), w.bounds)
                repeated[first + values] = False
                repeated |= np.repeat(np.asarray(part.column("copies")) > 1, w.counts()) & (
                    np.arange(len(w)) + window <= np.repeat(w.bounds[1:], w.counts())
                )
                place = np.flatnonzero(repeated)
                gone = _marked(len(w), place, np.full(len(place), window))
                left = np.concatenate(([0], np.cumsum(gone)))
                texts = []
                for i, text in enumerate(part.column("text")):
                    own = (text.as_py() or "").encode().split()
                    a, z = w.bounds[i], w.bounds[i + 1]
                    if left[z] > left[a]:
                        own = compress(own, ~gone[a:z])
                    texts.append(b" ".join(own).decode())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("cid"),
                        part.column("cid2"),
                        pa.array(w.counts(), pa.int64()),
                        pa.array(left[w.bounds[1:]] - left[w.bounds[:-1]], pa.int64()),
                        pa.array(texts, pa.string()),
                    ],
                    names=["cid", "cid2", "n_words", "n_removed", "kept_text"],
                )

    return rows


def content_key(text: str = "text") -> list:
    """Two columns that stand for a text (96 bits); a null text counts as empty."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return [F.xxhash64(whole).alias("cid"), F.hash(whole).alias("cid2")]


def kept_texts(docs: DataFrame, text: str = "text", window: int = 35) -> DataFrame:
    """Each different text of ``docs`` without the words of repeated windows.

    Returns cid, cid2 (see ``content_key``), n_words, n_removed and kept_text: the words that no
    window covers whose word sequence also starts elsewhere (same text included), joined by one
    space. Windows are judged on the input. Copies of a text count as elsewhere.

    Null and empty texts: one row with no words, if there are any. Texts below ``window`` words
    lose nothing. Repeated rows are copies. An empty table gives no rows. Other columns are not read.
    """
    if not 1 <= window:
        raise ValueError("window must be positive")
    texts = (
        docs.select(*content_key(text), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
        .groupBy("cid", "cid2")
        .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    )
    once = (
        texts.mapInArrow(_anchor_rows(window), f"name long, {_KEY}, piece long")
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("n"), *(F.min(c).alias(c) for c in ("cid", "cid2", "piece")))
        .where("n = 1")
        .groupBy("cid", "cid2")
        .agg(F.collect_list("piece").alias("once"))
    )
    narrowed = texts.join(once, ["cid", "cid2"], "left")
    single = (
        narrowed.mapInArrow(_window_rows(window), f"name long, name2 long, {_KEY}, place long")
        .groupBy("name", "name2")
        .agg(F.count(F.lit(1)).alias("n"), *(F.min(c).alias(c) for c in ("cid", "cid2", "place")))
        .where("n = 1")
        .groupBy("cid", "cid2")
        .agg(F.collect_list("place").alias("single"))
    )
    return narrowed.join(single, ["cid", "cid2"], "left").mapInArrow(
        _kept_rows(window), f"{_KEY}, n_words long, n_removed long, kept_text string"
    )


def remove_repeats(docs: DataFrame, text: str = "text", window: int = 35) -> DataFrame:
    """``docs`` with kept_text in place of ``text``; same rows and columns.

    A column n_chars, if there is one, is set to the new length. Other columns stay as they are,
    whatever their names; a null text stays null.
    """
    result = kept_texts(docs, text, window).select(
        F.struct(F.col("cid"), F.col("cid2")).alias("k"), F.col("kept_text").alias("v")
    )
    # The old text stays behind: the join moves its key, the other columns and the new text.
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    left = docs.select(
        F.struct(*content_key(text)).alias("k"),
        F.col(f"`{text}`").isNotNull().alias("has"),
        (F.struct(*rest) if rest else F.lit(None)).alias("d"),
    )
    new = F.when(F.col("has"), F.col("v"))
    joined = left.join(result, "k", "left")
    return joined.select(
        *(
            new.alias(c)
            if c == text
            else F.char_length(new).cast(docs.schema[c].dataType).alias(c)
            if c == "n_chars"
            else F.col(f"d.`{c}`").alias(c)
            for c in docs.columns
        )
    )
