"""Quotient filters, and phrases against a plain recomputation."""

import re
from collections import Counter

import numpy as np
import pytest

from wakeline.llm import collocations, quotient

SCHEMA = "doc_id long, text string, lang string, words string, score string"


def upper_to_lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute(rows, least=10, percent=50, top=2000):
    counts, n = {}, Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", upper_to_lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        found = []
        for t, a in f.items():
            if len(t) < 2 or a < least:
                continue
            if len(t) == 2 and any(100 * c >= percent * a for u, c in f.items() if len(u) == 3 and c >= least and t in (u[:2], u[1:])):
                continue
            cuts = [(1_000_000 * a * a // (f[t[:k]] * f[t[k:]]), k) for k in range(1, len(t))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(t).encode(), f[t[:k]], f[t[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def given():
    rng = np.random.default_rng(4)
    common = ["the", "of", "Of", "New", "York", "é", "straße", "😀", "x" * 70, "a", "b\x00", "\x1c", "İ"]
    texts = ["".join(w + sep for w, sep in zip(rng.choice(common, 60), rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b"], 60))) for _ in range(40)]
    rows = [(i, t, ["en", "de", None, "und", ""][i % 5], "q", "q") for i, t in enumerate(texts)]
    rows += [(100, "new york city " * 25, "en", "", ""), (101, "a a a a a a a a a a a a a", "fr", "", ""), (102, None, "fr", "", ""), (103, "", "it", "", "")]
    rows += [(104, " \t\n.;", None, "", ""), (105, "one two three four " * 30, "en", "", ""), (None, "one two. three", "en", "", "")]
    return rows + [rows[3]] * 12 + [(106, " ".join(f"w{i % 30}" for i in range(2000)), "es", "", "")]


def collect(df):
    return sorted((tuple(r) for r in df.collect()))


def test_phrases_equal_brute_force(spark):
    rows = given()
    assert collect(collocations.phrases(spark.createDataFrame(rows, SCHEMA).repartition(3))) == brute(rows)


def test_chunks_slices_and_merge_rounds_do_not_matter(spark, monkeypatch):
    rows = given()
    monkeypatch.setattr(collocations, "CHUNK_WORDS", 7)
    monkeypatch.setattr(collocations, "SLICE_BYTES", 5)
    monkeypatch.setattr(collocations, "BLOCK_ENTRIES", 300)
    monkeypatch.setattr(collocations, "ROUND_BITS", 2)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    assert collect(collocations.phrases(docs)) == brute(rows)


def test_other_parameters(spark):
    rows = given()
    docs = spark.createDataFrame(rows, SCHEMA)
    assert collect(collocations.phrases(docs, least=3, percent=80, top=5)) == brute(rows, 3, 80, 5)
    with pytest.raises(ValueError, match="positive"):
        collocations.phrases(docs, least=0)


def test_nothing_to_count(spark):
    for rows in ([], [(1, None, "en", "", "")], [(1, "too rare words", "en", "", "")]):
        assert collocations.phrases(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 3_037_000_501, 3_037_000_507, 3_037_000_903
    row = spark.range(1).select(collocations._score(*(collocations.F.lit(x).cast("long") for x in (a, left, right))).alias("s")).first()
    assert row.s == 1_000_000 * a * a // (left * right)


def test_slices_end_with_words():
    data = b"aa bb\ncccccccccc d " * 3
    for size in range(1, 30):
        parts = list(collocations.slices(data, size))
        assert b"".join(parts) == data
        assert [w for p in parts for w in p.split()] == data.split()


@pytest.mark.parametrize("width", [1, 2, 7, 20, 21, 22, 31, 41])
@pytest.mark.parametrize("words", [2, 3])
def test_filters_lose_nothing(width, words):
    rng = np.random.default_rng(width)
    high = 1 << width
    ids = [np.where(rng.random(800) < 0.5, rng.integers(0, min(high, 4), 800), high - 1 - rng.integers(0, min(high, 4), 800)).astype(np.uint64) for _ in range(words)]
    half = quotient.half_bits(width, words)
    parts = [quotient.count_tuples([x[k::3] for x in ids], width) for k in range(3)]
    entries = quotient.merge(parts, half)
    want = Counter(zip(*(x.tolist() for x in ids)))
    assert dict(zip(zip(*(x.tolist() for x in quotient.words_of(entries, width, words))), entries.count.tolist())) == want
    entries.count[:4] = [255, 256, 1 << 40, 65536][: len(entries)]
    for bits in {0, min(1, half), min(5, half)}:
        for prefix, part in quotient.split(entries, half, 0, bits):
            back = quotient.decode(quotient.encode(part, half, bits), half, bits, prefix)
            assert all((getattr(back, x) == getattr(part, x)).all() for x in ("left", "right", "count"))


def test_filters_are_compact_and_even():
    ids = [np.arange(20_000, dtype=np.uint64) for _ in range(2)]
    entries = quotient.count_tuples(ids, 20)
    half = quotient.half_bits(20, 2)
    assert len(quotient.encode(entries, half, 0)) < 7 * len(entries)  # the pair of ids alone takes 5 bytes
    sizes = [len(p) for _, p in quotient.split(entries, half, 0, 4)]
    assert len(sizes) == 16 and max(sizes) < 2 * min(sizes)


def test_empty_filter():
    nothing = quotient.count_tuples([np.zeros(0, np.uint64)] * 3, 9)
    back = quotient.decode(quotient.encode(nothing, 14, 3), 14, 3, 5)
    assert len(back) == 0 and quotient.split(nothing, 14, 0, 3) == [] and len(quotient.merge([], 14)) == 0
