"""SimHash near-duplicates, components and repeated passages against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wakeline.llm import queries, simhash, substrings
from wakeline.llm.components import smallest_reachable
from wakeline.llm.words import words

SF = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"
#: Extra columns whose names the operators use inside.
CLASH = ["cid", "cid2", "name", "place", "copies", "once", "k", "d", "v", "n", "block", "fingerprint", "owner", "has", "none"]


def docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit("x") for c in CLASH})


def text(seed, n, vocabulary=5000):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def brute_fingerprint(value):
    w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), value or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, budget=4):
    up = list(range(len(prints)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= budget:
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return [top(i) for i in range(len(prints))]


def brute_kept(texts, window=35):
    """(words, removed, kept text) of each text."""
    split = [re.findall(WORD, t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("value", [None, "", " \t\n", "One", "a b c", "A B C D", "x y z\x85 w q", text(1, 3000), "ß Ä é " * 50])
def test_fingerprint(value):
    assert simhash.fingerprint(value) == brute_fingerprint(value)


def test_trie_join_finds_all_links():
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), False)) for c in centres for _ in range(25)]
    keys = np.unique(np.array(near, np.uint64))
    label = simhash.trie_join(keys, np.zeros(len(keys), np.uint64), 0, 4)
    assert label.tolist() == brute_components([int(k) for k in keys])


def test_dense_group_is_walked_in_pieces(monkeypatch):
    monkeypatch.setattr(simhash, "_FRONTIER", 64)
    rng = np.random.default_rng(4)
    keys = np.unique(np.array([sum(1 << int(b) for b in rng.choice(64, 2, False)) for _ in range(400)], np.uint64))
    assert set(simhash.trie_join(keys, np.zeros(len(keys), np.uint64), 0, 4).tolist()) == {0}


def test_components_of_chains_and_stars(spark, rows):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(1, i) for i in range(2, 60)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (200, None)], "a long, b long")
    found = dict(rows(smallest_reachable(links)))
    assert found == {**{i: 100 for i in range(100, 141)}, **{i: 1 for i in range(1, 60)}}
    assert smallest_reachable(links.limit(0)).count() == 0


def test_near_duplicates(spark, rows):
    base = text(5, 400)
    near = base.replace(base.split()[7], "changed", 1)
    given = [(5, base), (3, near), (9, base), (9, base), (20, text(6, 400)), (1, None), (2, ""), (None, base), (None, text(7, 300))]
    found = rows(simhash.near_duplicates(docs(spark, given)), "doc_id", "fingerprint", "component_id")
    assert len(found) == len(given)
    prints = [brute_fingerprint(t) for _, t in given]
    component = brute_components(prints)
    for (doc, value), p, c in zip(given, prints, component):
        ids = [d for (d, _), x in zip(given, component) if x == c and d is not None]
        signed = p - (1 << 64) if p >> 63 else p
        assert (doc, signed, min(ids, default=None)) in found


@pytest.mark.parametrize("crowded", [200_000, 20, 0])
def test_crowded_block_values_are_divided(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = np.random.default_rng(9)
    centres = [int(c) for c in rng.integers(0, 1 << 62, 12)]
    near = {c ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), False)) for c in centres for _ in range(60)}
    prints = sorted(near)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(s,) for s in signed], "fingerprint long"))
    found = {r.node: r.smallest for r in smallest_reachable(links).collect()}
    component = brute_components(prints)
    for i, s in enumerate(signed):
        own = [signed[j] for j in range(len(signed)) if component[j] == component[i]]
        assert found.get(s, s) == min(own)


def test_one_of_each_group_stays(spark, rows):
    base = text(5, 400)
    given = [(5, base), (3, base), (3, base), (20, text(6, 400)), (None, base)]
    kept = simhash.one_of_each(docs(spark, given))
    assert kept.columns == docs(spark, given).columns
    assert rows(kept, "doc_id", "text") == sorted([(3, base), (20, text(6, 400))], key=repr)
    assert simhash.one_of_each(docs(spark, given).limit(0)).count() == 0


def test_ids_do_not_decide_what_stays(spark, rows):
    a, b, c, d = (text(i, 300) for i in (31, 32, 33, 34))
    given = [(1, a), (1, b), (2, c), (None, a), (None, a), (None, d), (None, d), (7, None), (None, ""), (2, c)]
    kept = simhash.one_of_each(docs(spark, given))
    assert rows(kept, "doc_id", "text") == sorted([(1, a), (1, b), (2, c), (None, d), (7, None)], key=repr)
    # A component of two texts under one id keeps one of them.
    near = a.replace(a.split()[9], "other", 1)
    assert simhash.one_of_each(docs(spark, [(4, a), (4, near), (4, b)])).count() == 2


def test_ids_of_any_type(spark):
    given = spark.createDataFrame([("x", text(5, 100)), ("b", text(5, 100)), ("c", text(6, 100))], "doc_id string, text string")
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(given).collect()}
    assert found == {"x": "b", "b": "b", "c": "c"}
    assert {r.doc_id for r in simhash.one_of_each(given).collect()} == {"b", "c"}


PASSAGE = text(8, 60)
CASES = [
    [None, "", "one two", text(1, 34), text(1, 34)],
    [f"{text(2, 50)} {PASSAGE} {text(3, 40)}", f"{PASSAGE}\n{text(4, 80)}", text(9, 200)],
    [PASSAGE, PASSAGE, PASSAGE.replace(" ", "\t\n")],
    ["la " * 200, "la " * 36, "la " * 34],
    ["a b " * 60, "b a " * 40, f"{text(3, 20)} " * 3],
    [f"{text(5, 30)} {text(6, 35)}", f"{text(6, 35)} {text(5, 30)}"],
    ["".join(f"{text(i, 10)} {PASSAGE} " for i in range(30)), text(99, 5000)],
    ["x y\x85z " * 40, "é ß 漢字 " * 40],
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_repeats_are_removed(spark, case):
    texts = CASES[case]
    given = docs(spark, list(enumerate(texts)))
    cut = {(r.cid, r.cid2): (r.n_words, r.n_removed, r.kept_text) for r in substrings.kept_texts(given).collect()}
    keys = given.select("doc_id", *[c.alias(f"key{i}") for i, c in enumerate(substrings.content_key())]).collect()
    found = [cut[k.key0, k.key1] for k in sorted(keys, key=lambda r: r.doc_id)]
    assert found == brute_kept(texts)
    new = substrings.remove_repeats(given.withColumn("n_chars", F.char_length("text")))
    kept = {r.doc_id: (r.text, r.n_chars) for r in new.collect()}
    want = {i: (None if t is None else b[2]) for i, (t, b) in enumerate(zip(texts, brute_kept(texts)))}
    assert kept == {i: (t, None if t is None else len(t)) for i, t in want.items()}
    assert new.columns == [*given.columns, "n_chars"]


def test_random_small_alphabets(spark):
    texts = [text(i, 120, vocabulary=2 + i % 3) for i in range(25)]
    given = docs(spark, list(enumerate(texts)))
    for window in (5, 9):
        found = Counter((r.n_words, r.n_removed, r.kept_text) for r in substrings.kept_texts(given, window=window).collect())
        assert found == Counter(brute_kept(texts, window))


def test_no_rows(spark):
    assert substrings.kept_texts(docs(spark, []).limit(0)).count() == 0
    assert substrings.remove_repeats(docs(spark, []).limit(0)).count() == 0


def test_words_of_slices():
    import pyarrow as pa

    given = [None, "", "a b", "  c", "d ", " e\x1cf g"]
    w = words(pa.array(["zz", *given, "yy"]).slice(1, len(given)))
    raw = w.data.tobytes()
    assert [raw[a:z].decode() for a, z in zip(w.starts, w.ends)] == ["a", "b", "c", "d", " e\x1cf", "g"]
    assert w.counts().tolist() == [0, 0, 2, 1, 1, 2]
    again = words(pa.array(["g d a"]))
    assert set(again.hashes().tolist()) <= set(w.hashes().tolist())


def test_whole_tables(spark):
    table = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(table)
    brute = dict(zip(ids, brute_kept([table[i] for i in ids])))
    for r in queries.op3_substring_dedup(spark, SF).collect():
        n, gone, kept = brute[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())
    prints = [brute_fingerprint(table[i]) for i in ids]
    want = {i: (f"{p:016x}", ids[c]) for i, p, c in zip(ids, prints, brute_components(prints))}
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op9_simhash(spark, SF).collect()}
    assert found == want
