"""Rank-order profiles against a plain recomputation and held-out languages."""

import binascii
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wakeline.llm import language, queries

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score string, gram string"


def brute_grams(text):
    found = Counter()
    kept = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in (text or "").lower())
    if not any(unicodedata.category(c)[0] == "L" for c in kept):
        return []
    for word in kept.split():
        for n in (1, 2, 3):
            padded = f" {word} "
            grams = [padded[i : i + n] for i in range(len(padded) - n + 1)]
            found.update(g for g in grams if g != " ")
    return sorted(found, key=lambda g: (-found[g], sum(ord(c) << 21 * i for i, c in enumerate(reversed(g))))), found


def brute_rank(texts, size):
    total = Counter()
    for t in texts:
        if got := brute_grams(t):
            total.update(got[1])
    value = lambda g: sum(ord(c) << 21 * i for i, c in enumerate(reversed(g)))
    return sorted(total, key=lambda g: (-total[g], value(g)))[:size]


def brute_judge(profiles, text, size):
    got = brute_grams(text)
    if not got or not profiles:
        return "und", 0.0
    own = got[0][:size]
    far = {
        lang: sum(abs(ranks.index(g) - i) if g in ranks else size for i, g in enumerate(own)) for lang, ranks in profiles.items()
    }
    best = min(far, key=lambda lang: (far[lang], lang))
    return best, 1 - far[best] / (size * len(own))


def given():
    rows = [(i, t, lang, "x", "y") for i, (t, lang) in enumerate([
        ("The cat sat on the mat, the end.", "en"), ("Der Hund und die Katze", "de"), ("le chat est là où il était", "fr"),
        ("the thing", "en"), ("Straße ÜBER", "de"), (None, "en"), ("", "de"), ("12 34 !?", "fr"), ("no language", None),
        ("кот и собака", "ru"), ("漢字とかな", "ja"), ("𝔘𝔫𝔦 😀 x", "en"), ("a", ""), ("न मस्ते", "hi"), ("ab ab ab ab", "xx"),
    ] * 3)]
    return rows + [(None, "the cat", "en", "x", "y"), (3, "the thing", "en", "x", "y"), (0, "the " * 5000, "en", "x", "y")]


def fitted(rows):
    return [r for r in rows if r[0] is not None and binascii.crc32(str(r[0]).encode()) % 4 != 2 and r[2] is not None]


def test_profiles_and_predictions_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(language, "_SLICE", 17)  # long texts are counted in slices
    rows, size = given(), 12
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {}
    kept = docs.where(~language.held_out("doc_id"))
    for r in sorted(language.profiles(kept, size=size).collect(), key=lambda r: (r.lang, r["rank"])):
        gram = "".join(chr(r.gram >> 21 * i & 0x1FFFFF) for i in (2, 1, 0) if r.gram >> 21 * i & 0x1FFFFF)
        found.setdefault(r.lang, []).append(gram)
    want = {lang: brute_rank([r[1] for r in fitted(rows) if r[2] == lang], size) for lang in {r[2] for r in fitted(rows)}}
    assert found == {lang: grams for lang, grams in want.items() if grams}
    model = language.fit(docs, size=size)
    got = sorted(((r.doc_id or -1, r.lang_pred, round(r.score, 9)) for r in language.predict(docs, model).collect()))
    assert got == sorted((r[0] or -1, *(lambda x: (x[0], round(x[1], 9)))(brute_judge(found, r[1], size))) for r in rows)


def test_slices_do_not_change_counts(monkeypatch):
    line = language.characters("Über die Brücke, and then über the bridge")
    whole = language.gram_counts(line)
    monkeypatch.setattr(language, "_SLICE", 3)
    for a, b in zip(whole, language.gram_counts(line)):
        assert a.tolist() == b.tolist()


@pytest.mark.parametrize("text", [None, "", " \n", "123 -- 45", "́"])
def test_texts_without_letters_are_undetermined(spark, text):
    model = language.fit(spark.createDataFrame(given(), SCHEMA))
    assert model.judge(text) == ("und", 0.0)


def test_no_rows_no_languages_and_text_ids(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = language.fit(empty)
    assert model.languages == [] and language.predict(empty, model).count() == 0
    assert language.predict(spark.createDataFrame(given(), SCHEMA), model).where("lang_pred != 'und'").count() == 0
    named = spark.createDataFrame([("a", "the cat", "en"), ("b", "der hund", "de"), ("c", "le chat", "fr")], "doc_id string, text string, lang string")
    assert language.predict(named, language.fit(named)).count() == 3


def test_too_many_languages_end_the_fit(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 2)
    with pytest.raises(ValueError, match="languages"):
        language.fit(spark.createDataFrame(given(), SCHEMA))


def test_held_out_accuracy_and_shape(spark):
    found = queries.QUERIES["op11_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found.count() == docs.count()
    both = found.join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL")
    right, n = both.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right >= 0.99 * n
    assert found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    want = {r.doc_id: binascii.crc32(str(r.doc_id).encode()) % 4 == 2 for r in docs.select("doc_id").collect()}
    assert {r.doc_id: r.held_out for r in found.select("doc_id", "held_out").collect()} == want


def test_label_source_and_id_are_no_inputs(spark):
    rows = given()
    model = language.fit(spark.createDataFrame(rows, SCHEMA))
    asked = spark.createDataFrame([(9, "the cat sat", "ru", "q", "q"), (10, "the cat sat", None, "r", "r")], SCHEMA)
    assert len({(r.lang_pred, r.score) for r in language.predict(asked, model).collect()}) == 1
    assert re.fullmatch("[a-z]+", model.judge("the cat sat")[0])
