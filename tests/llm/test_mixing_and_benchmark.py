"""Decontamination against brute force; mixing by its guarantees."""

import re

import pytest
from pyspark.sql import functions as F

from wakeline.llm import mixing, winnowing

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"


def brute(texts, items, window=13):
    def split(t):
        return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    out = []
    for t in texts:
        w, hit, met = split(t), set(), set()
        for name, body in items:
            b = split(body)
            size = min(window, len(b))
            spans = {tuple(b[i : i + size]) for i in range(len(b) - size + 1)} if b else set()
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in spans:
                    hit.update(range(i, i + size))
                    met.add(name)
        out.append((len(w), len(hit), sorted(str(m) for m in met if m is not None), bool(hit) and 20 * len(hit) >= len(w)))
    return out


ITEMS = [(1, SPAN), (2, f"before {SPAN} after it all"), (10, "short item"), (11, "five words are right here"), (12, "solo"),
         (13, None), (14, ""), (15, "la " * 20), (15, "another row of item fifteen with more than thirteen words in it for sure yes"), (None, "no id here")]
TEXTS = [
    None, "", "!!!", SPAN.upper(), SPAN.replace(" ", "--"), " ".join(SPAN.split()[:12]), " ".join(SPAN.split()[1:14]) + " tail" * 300,
    "a SHORT item in a text", "short", "five words are right here five words are right", "so solo!", "la la " * 30, "la " * 12,
    f"x {SPAN} y {SPAN} z", "no id here", "Été 漢字 naïve " * 10, " ".join(f"u{i}" for i in range(3000)) + " " + SPAN,
]


def tables(spark, items=ITEMS):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    names = ["cid", "cid2", "h", "prints", "print", "item", "row", "span", "k", "gram", "t", "d"]
    docs = docs.withColumns({c: F.lit(1) for c in names})
    return docs, spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("q") for c in ("item", "row", "k")})


@pytest.mark.parametrize("broadcast", [400_000, -1])
def test_contamination(spark, monkeypatch, broadcast):
    monkeypatch.setattr(winnowing, "BROADCAST_ROWS", broadcast)
    docs, items = tables(spark)
    found = {r.doc_id: (r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in winnowing.contamination(docs, items).collect()}
    assert found == dict(enumerate(brute(TEXTS, ITEMS)))
    kept = winnowing.clean(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, b in enumerate(brute(TEXTS, ITEMS)) if not b[3]}


def test_repeated_words_are_one_row_a_place(spark, monkeypatch):
    """Texts and items of one word, or of two in turn: rows grow with the places, not with places times places."""
    stored = {}
    keep = winnowing.materialise

    def counted(df, label):
        out = keep(df, label)
        stored[label] = out.count()
        return out

    monkeypatch.setattr(winnowing, "materialise", counted)
    items = [(1, "la " * 400), (2, "la lo " * 200), (3, "solo")]
    texts = ["la " * 500, "lo la " * 250, "x " * 50 + "la " * 13]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = winnowing.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in found} == dict(enumerate(brute(texts, items)))
    assert stored["runs"] <= 1100 and stored["item-windows"] == 4


def test_contamination_of_nothing(spark):
    docs, items = tables(spark)
    assert winnowing.contamination(docs.limit(0), items).count() == 0
    none = winnowing.contamination(docs, items.limit(0)).collect()
    assert len(none) == len(TEXTS) and not any(r.n_hit or r.contaminated or r["items"] for r in none)
    twice = winnowing.contamination(docs.unionAll(docs), items)
    assert twice.count() == 2 * len(TEXTS) and twice.where("contaminated").count() == 2 * sum(b[3] for b in brute(TEXTS, ITEMS))


def shares(sizes, weights, most=3):
    """Water filling, one source at a time."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, open_, target = float(sum(sizes.values())), set(sizes), {}
    while open_:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if most * sizes[s] <= level * weight[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: float(most * sizes[s]) for s in over}
        open_ -= over
    return target


def mixture(spark):
    rows = [(i, f"s{i % 7}", "w " * (1 + i * 37 % 90)) for i in range(700)]
    rows += [(1000, "tiny", "one two"), (1001, None, "a b c d"), (1002, None, None), (1003, "empty", ""), (5, "s5", "w " * 9), (5, "s5", "w " * 9),
             (None, "s1", "w w"), (None, "s1", "w w"), (1004, "big", "w " * 4000), (1005, "big", "w " * 3)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    return df.withColumns({c: F.lit(0) for c in ("doc", "size", "frac", "tie", "row", "largest", "group", "x", "y", "n", "target")})


def test_mix(spark, rows):
    docs = mixture(spark)
    mixed = mixing.mix(docs, fan_in=8)
    found = mixed.collect()
    assert len(found) == docs.count()
    sizes = {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").split())
    target = shares(sizes, (1, 2, 3))
    taken, largest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        rate = r.target / r.source_size if r.source_size else 0
        assert int(rate + 1e-9) <= r.copies <= int(rate + 1 - 1e-9) or r.size == 0 or r.copies == round(rate)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] + 1
    for s in [f"s{i}" for i in range(7)]:
        assert abs(taken[s] - target[s]) <= 90
    assert rows(mixed) == rows(mixing.mix(docs.repartition(5), fan_in=8))


def test_mix_is_fair(spark):
    """Over many draws each document is taken as often as its rate says."""
    rows = [(i, "ab"[i // 200 % 2] + str(i // 400), "w " * (5 + i % 3)) for i in range(4000)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), fan_in=16)
    by_size = mixed.groupBy("size").agg(F.avg(F.col("copies") - F.col("target") / F.col("source_size")).alias("off")).collect()
    assert all(abs(r.off) < 0.05 for r in by_size)


def test_mix_of_nothing(spark):
    assert mixing.mix(mixture(spark).limit(0)).count() == 0
    only_empty = spark.createDataFrame([(1, "a", None), (2, "b", "")], "doc_id long, source string, text string")
    assert [(r.size, r.target, r.taken) for r in mixing.mix(only_empty).collect()] == [(0, 0.0, 0)] * 2


def test_equal_rows_are_settled_by_count(spark, monkeypatch, rows):
    monkeypatch.setattr(mixing, "EQUAL_ROWS", 50)
    given = [(None, "a", "w w w")] * 700 + [(None, "a", "w w")] * 3 + [(i, "b", "w " * (3 + i % 5)) for i in range(300)] + [(4, "b", "q q")] * 120
    docs = spark.createDataFrame(given, "doc_id long, source string, text string")
    mixed = mixing.mix(docs, weights=(1, 2), fan_in=4)
    found = mixed.collect()
    assert len(found) == len(given)
    assert sorted((r.doc_id is None, r.size) for r in found) == sorted((i is None, len(t.split())) for i, _, t in given)
    for name in "ab":
        some = [r for r in found if r.source == name]
        assert abs(sum(r.taken for r in some) - some[0].target) <= 10
        rate = some[0].target / some[0].source_size
        assert {r.copies for r in some} <= {int(rate), int(rate) + 1}
    equal = [r.copies for r in found if r.doc_id is None and r.size == 3]
    assert abs(sum(equal) - 700 * found[0].target / found[0].source_size) <= 2 or found[0].source != "a"
    assert rows(mixed) == rows(mixing.mix(docs.repartition(7), weights=(1, 2), fan_in=4))


def test_text_ids(spark):
    docs = spark.createDataFrame([(f"d{i}", "ab"[i % 2], "w " * (1 + i % 4)) for i in range(40)], "doc_id string, source string, text string")
    mixed = mixing.mix(docs, fan_in=4)
    assert {r.doc_id for r in mixed.collect()} == {f"d{i}" for i in range(40)}
