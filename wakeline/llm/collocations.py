"""Phrase collocation mining with counting quotient filters.

1. Tasks cut the texts into words and store chunks of about ``CHUNK_WORDS`` words as chunk-local numbers, each with
   its own word list. The word lists, not the words, are shuffled: Spark adds the counts of each (lang, word),
   numbers those with at least ``least`` occurrences (no phrase with a rarer word can be a candidate) and brings the
   numbers back to the chunks that hold them.
2. A chunk's pairs and triples of numbered words go into counting quotient filters (``quotient``), one for each value
   of the first bits of the permuted key.
3. Filters of equal first bits are merged, in rounds that fix more bits until one group holds about ``BLOCK_ENTRIES``;
   no group grows with the input. Entries with ``least`` occurrences or more are turned back into word numbers.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm import quotient
from wakeline.sources.scratch import materialise

#: Words of a chunk (the slice of text that reaches it is taken whole).
CHUNK_WORDS = 1 << 20
#: Entries that one group of filters holds at most, about.
BLOCK_ENTRIES = 1 << 21
#: Bits of the key that one round of merging fixes at most.
ROUND_BITS = 8
#: Bytes of text that are cut into words at a time.
SLICE_BYTES = 1 << 20
#: Parts of a language that are ranked before the language is.
RANK_PARTS = 32

_BREAK = b"\n"


def _bytes_table() -> bytes:
    """A-Z to lower case, tab to space, what ends a piece to a line feed; UTF-8 keeps all other characters."""
    table = bytearray(range(256))
    for upper in range(ord("A"), ord("Z") + 1):
        table[upper] = upper + 32
    table[0x09] = 0x20
    for mark in b".,;:!?\x0a\x0b\x0c\x0d":
        table[mark] = 0x0A
    return bytes(table)


_TABLE = _bytes_table()


def slices(data: bytes, size: int) -> Iterator[bytes]:
    """The bytes in slices of about ``size`` that end with whole words."""
    at = 0
    while at < len(data):
        till = at + size
        while till < len(data) and data[till] not in b" \n":
            till += 1
        yield data[at:till]
        at = till


class _Chunk:
    """Words of a chunk as local numbers from 1, in the order of their first occurrence; 0 ends a piece."""

    def __init__(self, context: list[bytes], lang: str | None) -> None:
        self.numbers = itertools.count(1)
        self.words: dict[str, dict[bytes, int]] = {}
        self.parts: list[list[int]] = []
        self.size = 0
        self.head = len(context)  # leading words that belong to the chunk before
        if context:
            self.add(lang, context)

    def add(self, lang: str, tokens: list[bytes]) -> None:
        known = self.words.get(lang)
        if known is None:
            known = self.words[lang] = defaultdict(self.numbers.__next__)
            known[_BREAK], known[b""] = 0, -1
        ids = np.fromiter(map(known.__getitem__, tokens), np.int32, len(tokens))
        self.parts.append(ids[ids >= 0])  # empty pieces lie between two spaces
        self.size += len(self.parts[-1])

    def row(self, number: int) -> pa.RecordBatch:
        tokens = np.concatenate(self.parts)
        langs, words, order = [], [], []
        for lang, known in self.words.items():
            del known[_BREAK], known[b""]
            langs += [lang] * len(known)
            words += known
            order += known.values()
        counts = np.bincount(tokens[self.head :], minlength=len(words) + 1)
        place = np.argsort(np.array(order, np.int64))
        listed = pa.StructArray.from_arrays(
            [
                pa.array(langs, pa.string()).take(pa.array(place)),
                pa.array(words, pa.binary()).cast(pa.string()).take(pa.array(place)),
                pa.array(counts[1:].astype(np.int64)),
            ],
            names=["lang", "word", "count"],
        )
        packed = pa.compress(tokens.tobytes(), codec="zstd", asbytes=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([self.head], pa.int32()),
                pa.array([len(tokens)], pa.int64()),
                pa.array([packed], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), listed),
            ],
            names=["chunk", "head", "size", "tokens", "words"],
        )


def _last_two(tokens: list[bytes]) -> list[bytes]:
    return list(itertools.islice(filter(None, reversed(tokens)), 2))[::-1]


def _cut(chunk_words: int, slice_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Chunks are read back from a stored table, so a number per task and chunk is enough.
        first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        numbers = itertools.count(first)
        chunk = _Chunk([], None)
        for batch in batches:
            for i in range(batch.num_rows):
                text, lang = batch.column("text")[i].as_py(), batch.column("lang")[i].as_py()
                context: list[bytes] = []
                for data in slices(text.translate(_TABLE), slice_bytes):
                    if chunk.size >= chunk_words:
                        yield chunk.row(next(numbers))
                        chunk = _Chunk(context, lang)
                    tokens = data.replace(_BREAK, b" \n ").split(b" ")
                    chunk.add(lang, tokens)
                    context = (context + _last_two(tokens))[-2:]
                if context:
                    chunk.add(lang, [_BREAK])
        if chunk.size:
            yield chunk.row(next(numbers))

    return run


_CHUNK_SCHEMA = "chunk long, head int, size long, tokens binary, words array<struct<lang: string, word: string, count: long>>"
_FILTER_SCHEMA = "words int, prefix long, shard long, filter binary"
_FOUND_SCHEMA = "words int, w1 long, w2 long, w3 long, a long"


def tuples(ids: np.ndarray, head: int, words: int) -> list[np.ndarray]:
    """Runs of ``words`` numbered words (ids of 0 or more) that end behind the first ``head`` places."""
    columns = [ids[k : len(ids) - words + 1 + k] for k in range(words)]
    good = np.ones(len(columns[0]), bool)
    good[: max(0, head - words + 1)] = False
    for column in columns:
        good &= column >= 0
    return [column[good] for column in columns]


def _filter_rows(found: list[tuple[int, int, int, bytes]]) -> pa.Table:
    words, prefix, shard, data = zip(*found) if found else ((), (), (), ())
    return pa.table(
        [pa.array(words, pa.int32()), pa.array(prefix, pa.int64()), pa.array(shard, pa.int64()), pa.array(data, pa.binary())],
        names=["words", "prefix", "shard", "filter"],
    )


def _count_chunk(width: int, bits: dict[int, int]):
    def run(chunk: pa.Table, known: pa.Table) -> pa.Table:
        found = []
        for row in chunk.to_pylist():
            tokens = np.frombuffer(pa.decompress(row["tokens"], row["size"] * 4, "zstd", asbytes=True), np.int32)
            number = np.full(int(tokens.max(initial=0)) + 1, -1, np.int64)
            number[known.column("local").to_numpy()] = known.column("id").to_numpy()
            ids = number[tokens]
            for words in (2, 3):
                if len(ids) < words:
                    continue
                half = quotient.half_bits(width, words)
                entries = quotient.count_tuples(tuples(ids, row["head"], words), width)
                for prefix, part in quotient.split(entries, half, 0, bits[words]):
                    found.append((words, prefix, row["chunk"], quotient.encode(part, half, bits[words])))
        return _filter_rows(found)

    return run


def _merged(group: pa.Table, width: int, bits: dict[int, int]) -> tuple[int, int, quotient.Entries]:
    words, prefix = group.column("words")[0].as_py(), group.column("prefix")[0].as_py()
    half = quotient.half_bits(width, words)
    parts = [quotient.decode(f.as_py(), half, bits[words], prefix) for f in group.column("filter")]
    return words, half, quotient.merge(parts, half)


def _merge_round(width: int, bits: dict[int, int], further: dict[int, int]):
    def run(group: pa.Table) -> pa.Table:
        words, half, entries = _merged(group, width, bits)
        shard = group.column("salt")[0].as_py()
        parts = quotient.split(entries, half, bits[words], further[words])
        return _filter_rows([(words, prefix, shard, quotient.encode(part, half, further[words])) for prefix, part in parts])

    return run


def _merge_last(width: int, bits: dict[int, int], least: int):
    def run(group: pa.Table) -> pa.Table:
        words, _, entries = _merged(group, width, bits)
        keep = entries.count >= least
        entries = quotient.Entries(entries.left[keep], entries.right[keep], entries.count[keep])
        ids = [pa.array(x.astype(np.int64)) for x in quotient.words_of(entries, width, words)]
        columns = [pa.array(np.full(len(entries), words, np.int32)), *ids, *[pa.nulls(len(entries), pa.int64())] * (3 - words)]
        return pa.table([*columns, pa.array(entries.count)], names=["words", "w1", "w2", "w3", "a"])

    return run


def count_phrases(chunks: DataFrame, known: DataFrame, ids: int, occurrences: int, least: int) -> DataFrame:
    """words, w1, w2, w3 (null in a pair), a: pairs and triples of numbered words with ``least`` occurrences or more.

    ``known`` maps (chunk, local) to ids below ``ids``; ``occurrences`` bounds the tuples of one length.
    """
    width = max(1, (ids - 1).bit_length())
    wanted = max(0, (-(-occurrences // BLOCK_ENTRIES) - 1).bit_length())

    def fixed(n: int) -> dict[int, int]:
        return {words: min(n, quotient.half_bits(width, words)) for words in (2, 3)}

    now = min(wanted, ROUND_BITS)
    filters = (
        chunks.select("chunk", "head", "size", "tokens")
        .groupBy("chunk")
        .cogroup(known.select(F.col("chunk").alias("of"), "local", "id").groupBy("of"))
        .applyInArrow(_count_chunk(width, fixed(now)), _FILTER_SCHEMA)
    )
    while now < wanted:
        further = min(wanted, now + ROUND_BITS)
        salt = F.pmod(F.xxhash64("shard"), F.lit(1 << (wanted - now)))
        filters = filters.withColumn("salt", salt).groupBy("words", "prefix", "salt").applyInArrow(
            _merge_round(width, fixed(now), fixed(further)), _FILTER_SCHEMA
        )
        now = further
    return filters.groupBy("words", "prefix").applyInArrow(_merge_last(width, fixed(now), least), _FOUND_SCHEMA)


def number_words(vocabulary: DataFrame, least: int) -> tuple[DataFrame, int, int]:
    """lang, word, f, id of the words with ``least`` occurrences or more; how many they are and how often they occur."""
    total = vocabulary.groupBy("lang", "word").agg(F.sum("count").alias("f")).where(F.col("f") >= least)
    stored = materialise(total.withColumn("place", F.monotonically_increasing_id()), "words")
    part, at = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = stored.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.sum("f").alias("f")).orderBy("part").collect()
    # One row for each partition that wrote words.
    starts = itertools.accumulate((r.n for r in sizes), initial=0)
    offsets = vocabulary.sparkSession.createDataFrame([(r.part, s) for r, s in zip(sizes, starts)], "part long, start long")
    numbered = stored.withColumn("part", part).join(F.broadcast(offsets), "part").select("lang", "word", "f", (F.col("start") + at).alias("id"))
    return numbered, sum(r.n for r in sizes), sum(r.f for r in sizes)


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)) in whole numbers of up to 38 digits (exact for counts up to 10**16)."""
    a, left, right = (x.cast("decimal(20,0)") for x in (a, left, right))
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * a * a, left * right)


def candidates(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10) -> tuple[DataFrame, DataFrame]:
    """(lang, n) and (words, w1, w2, w3, a, lang, phrase, l, r, score): all phrases of 2 or 3 words with ``least`` occurrences or more.

    Of the cuts of a triple the one of the lower score counts, the first of equal ones.
    """
    rows = docs.select(
        F.col(f"`{text}`").cast("string").cast("binary").alias("text"),
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
    ).where("text IS NOT NULL")
    chunks = materialise(rows.mapInArrow(_cut(CHUNK_WORDS, SLICE_BYTES), _CHUNK_SCHEMA), "chunks")
    vocabulary = chunks.select("chunk", F.posexplode("words").alias("at", "word")).select(
        "chunk", (F.col("at") + 1).alias("local"), "word.lang", "word.word", "word.count"
    )
    all_words = vocabulary.groupBy("lang").agg(F.sum("count").alias("n"))
    numbered, ids, occurrences = number_words(vocabulary, least)
    numbered = materialise(numbered, "numbers")
    # The frequent words are the small side of each partition; the word lists need not be sorted.
    known = vocabulary.join(numbered.hint("shuffle_hash"), ["lang", "word"]).select("chunk", "local", "id")
    found = materialise(count_phrases(chunks, known, ids, occurrences or 0, least), "phrases")

    def word(place: int) -> DataFrame:
        return numbered.select(F.col("id").alias(f"w{place}"), F.col("word").alias(f"word{place}"), F.col("f").alias(f"f{place}"), "lang")

    pairs = found.where("words = 2").join(word(1), "w1").join(word(2).drop("lang"), "w2")
    pairs = materialise(pairs.select("w1", "w2", "a", "lang", "word1", "word2", "f1", "f2"), "pairs")
    left = pairs.select("w1", "w2", "lang", F.concat_ws(" ", "word1", "word2").alias("first"), F.col("a").alias("a12"), "f1")
    right = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), "word2", F.col("a").alias("a23"), F.col("f2").alias("f3"))
    # Every part of a candidate occurs as often as the candidate: both pairs of a triple are there.
    triples = found.where("words = 3").join(left, ["w1", "w2"]).join(right, ["w2", "w3"])
    cut1, cut2 = _score(F.col("a"), F.col("f1"), F.col("a23")), _score(F.col("a"), F.col("a12"), F.col("f3"))
    early = cut1 <= cut2
    scored = pairs.select(
        F.lit(2).alias("words"), "w1", "w2", F.lit(None).cast("long").alias("w3"), "a", "lang",
        F.concat_ws(" ", "word1", "word2").alias("phrase"), F.col("f1").alias("l"), F.col("f2").alias("r"),
        _score(F.col("a"), F.col("f1"), F.col("f2")).alias("score"),
    ).unionByName(
        triples.select(
            F.lit(3).alias("words"), "w1", "w2", "w3", "a", "lang",
            F.concat_ws(" ", "first", "word2").alias("phrase"),
            F.when(early, F.col("f1")).otherwise(F.col("a12")).alias("l"),
            F.when(early, F.col("a23")).otherwise(F.col("f3")).alias("r"),
            F.least(cut1, cut2).alias("score"),
        )
    )
    return all_words, scored


def phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, percent: int = 50, top: int = 2000
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of 2 or 3 words of each language by score.

    ``a`` counts the phrase, ``l`` and ``r`` its two parts, ``n`` all words of the language. Equal scores go by falling ``a``,
    then by the phrase's bytes. A pair inside a triple with ``percent`` of its occurrences or more is left out. Null texts have no
    words, a null language is ``und``, repeated rows count each time, words of any length are kept, an empty table has
    no phrases; other columns are not read.
    """
    if least < 1 or top < 1:
        raise ValueError("least and top must be positive")
    all_words, scored = candidates(docs, text, lang, least)
    scored = materialise(scored, "scored")
    triples = scored.where("words = 3")
    inside = triples.select("w1", "w2", "a").unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    inside = inside.groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    pairs = scored.where("words = 2").join(inside, ["w1", "w2"], "left")
    pairs = pairs.where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a")))
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    kept = pairs.select(columns).unionByName(triples.select(columns))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).orderBy(*order)
    kept = kept.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    kept = kept.withColumn("rank", place).where(F.col("rank") <= top)
    return kept.join(all_words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
