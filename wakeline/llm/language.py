"""Language identification by rank-order profiles of character n-grams.

A profile lists the ``size`` most frequent n-grams (1 to 3 characters, inside words with one space at
either end) by falling count, ties by the gram. A text gets the language whose profile has the least
out-of-place distance to its own: the sum over the text's grams of the difference of ranks, ``size`` for
a gram that the language's profile lacks.

Tasks count whole texts and emit partial counts, Spark adds them and ranks them; the driver only gets the profiles.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.words import steps
from wakeline.sources.scratch import materialise

#: Grams of a profile.
PROFILE = 1000
#: Languages whose profiles may travel to the tasks; more of them end the fit with ValueError.
MOST_LANGUAGES = 1000
#: What a text without a letter is called.
UNDETERMINED = "und"
#: Characters that are counted at a time, and partial counts that a task holds before it emits them.
_SLICE = 1 << 20
_HELD = 1 << 20
_FOLDS, _HELD_OUT = 4, 2
_kinds = [np.zeros(0, np.uint8)]


def _kind_table(highest: int) -> np.ndarray:
    """2 for letters, 1 for marks, 0 for others, for all code points up to ``highest`` at least."""
    have = len(_kinds[0])
    if have <= highest:
        size = max(1024, 1 << highest.bit_length())
        more = np.fromiter(({"L": 2, "M": 1}.get(unicodedata.category(chr(i))[0], 0) for i in range(have, min(size, 0x110000))), np.uint8)
        _kinds[0] = np.concatenate((_kinds[0], more))
    return _kinds[0]


def characters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased words, one space around each; empty without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    kind = _kind_table(int(codes.max(initial=0)))[codes]
    if not (kind == 2).any():
        return np.zeros(0, np.uint64)
    line = np.full(len(codes) + 2, 32, np.uint64)
    line[1:-1] = np.where(kind > 0, codes, 32)
    blank = line == 32
    return line[~(blank & np.concatenate(([False], blank[:-1])))]


def gram_counts(line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different n-grams of a line of characters (packed, 21 bits a character), ascending, and their counts."""
    found = []
    step = np.uint64(21)
    for at in range(0, len(line), _SLICE):
        part = line[at : at + _SLICE + 2]
        own = min(_SLICE, len(line) - at)
        solid = part != 32
        one = part[:own]
        two = (part[:-1] << step | part[1:])[:own]
        inner = solid[1:-1][:own]  # no gram spans two words
        three = (part[:-2] << step + step | part[1:-1] << step | part[2:])[:own][inner]
        found.append(np.unique(np.concatenate((one[solid[:own]], two, three)), return_counts=True))
    return merge_counts(found)


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    total = np.zeros(len(grams), np.int64)
    np.add.at(total, place, np.concatenate([c for _, c in parts]))
    return grams, total


def ranked(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent grams by falling count; ``grams`` ascend, so equal counts follow the gram."""
    return grams[np.argsort(-counts, kind="stable")[:size]]


@dataclass
class Profiles:
    """All profiles as one table sorted by gram."""

    languages: list[str]
    grams: np.ndarray
    language: np.ndarray
    rank: np.ndarray
    size: int

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Out-of-place distance of a ranked list of grams to each language."""
        first, last = np.searchsorted(self.grams, own, "left"), np.searchsorted(self.grams, own, "right")
        many = last - first
        rank = np.repeat(np.arange(len(own)), many)
        entry = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(len(rank))
        saved = self.size - np.abs(self.rank[entry] - rank)
        return self.size * len(own) - np.bincount(self.language[entry], saved, len(self.languages))

    def judge(self, text: str | None) -> tuple[str, float]:
        own = ranked(*gram_counts(characters(text)), self.size)
        if not len(own) or not self.languages:
            return UNDETERMINED, 0.0
        far = self.distances(own)
        best = int(far.argmin())  # equal distances: the first language by code point
        return self.languages[best], 1.0 - float(far[best]) / (self.size * len(own))


def fold(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % _FOLDS


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that never take part in a fit; rows without an id are held out as well."""
    return F.coalesce(fold(id_col) == _HELD_OUT, F.lit(True))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def emit() -> Iterator[pa.RecordBatch]:
        for lang, (grams, counts) in held.items():
            columns = [pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "count"])
        held.clear()

    for batch in (part for whole in batches for part in steps(whole)):
        texts: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            texts.setdefault(lang, []).append(characters(text))
        for lang, lines in texts.items():
            # Lines end and begin with a space: grams of two spaces are no grams of a word.
            grams, counts = gram_counts(np.concatenate(lines))
            word = grams != (32 << 21 | 32)
            held[lang] = merge_counts([held[lang], (grams[word], counts[word])] if lang in held else [(grams[word], counts[word])])
        if sum(len(g) for g, _ in held.values()) > _HELD:
            yield from emit()
    yield from emit()


def profiles(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> DataFrame:
    """lang, gram, rank (from 0): the ``size`` most frequent grams of each language over all rows given.

    Rows with a null language or null text count nothing, repeated rows count each time, an empty table has no profiles.
    """
    rows = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    counted = rows.where("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(_count, "lang string, gram long, count long")
    total = counted.groupBy("lang", "gram").agg(F.sum("count").alias("count"))
    order = [F.desc("count"), "gram"]
    # First the best of each of some parts, so that no task takes all grams of a language.
    part = Window.partitionBy("lang", F.pmod(F.col("gram"), F.lit(16))).orderBy(*order)
    some = total.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= size)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order)) - 1
    return some.withColumn("rank", place).where(F.col("rank") < size).select("lang", "gram", "rank")


def fit(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", size: int = PROFILE) -> Profiles:
    """Profiles of all languages of the rows whose crc32(id as text) mod 4 is not 2.

    The driver gets ``size`` rows a language. Columns beside the three named ones are not read.
    """
    if size < 1:
        raise ValueError("size must be positive")
    found = materialise(profiles(docs.where(~held_out(id_col)), text, lang, size), "profiles")
    if found.select("lang").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    rows = found.orderBy("gram", "lang").toArrow()
    names = rows.column("lang").combine_chunks().dictionary_encode() if rows.num_rows else pa.array([], pa.string()).dictionary_encode()
    known = names.dictionary.to_pylist()
    order = sorted(range(len(known)), key=known.__getitem__)
    number = np.argsort(order)
    return Profiles(
        [known[i] for i in order],
        rows.column("gram").to_numpy().astype(np.uint64),
        number[names.indices.to_numpy()] if known else np.zeros(0, np.int64),
        rows.column("rank").to_numpy().astype(np.int64),
        size,
    )


def identify(text: Column, model: Profiles) -> Column:
    """Struct of ``lang`` and ``score`` for a text.

    The score is 1 at distance 0 and 0 where no gram of the text is in the profile. Null texts, texts without a letter
    and all texts under a model without languages are ``und`` with score 0. Whole texts are read, in slices.
    """

    @F.pandas_udf("lang string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.judge(t) for t in texts], columns=["lang", "score"])

    return run(text.cast("string"))


def predict(docs: DataFrame, model: Profiles, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per row given, repeated and null ids included."""
    found = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), held_out(id_col).alias("held_out"), identify(F.col(f"`{text}`"), model).alias("found")
    )
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")
