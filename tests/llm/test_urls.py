"""URL filters: the segmentation and the classifier against a plain recomputation."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wakeline.llm import urls
def cost(words, counts, total):
    return sum(math.log(counts[w] / total) if counts.get(w) else -math.log(total) - len(w) * math.log(10) for w in words)


def segmentations(label):
    if not label:
        return [[]]
    return [[label[:n], *rest] for n in range(1, len(label) + 1) for rest in segmentations(label[n:])]


@pytest.mark.parametrize("label", ["themorning", "dieblume", "xxqqzz", "abab", "a", "theqqqqthe"])
def test_segmentation_is_the_most_likely(label):
    counts, total = {"the": 50, "morning": 9, "die": 20, "blume": 3, "a": 5, "ab": 4, "mor": 2, "i": 1}, 400
    best = max(cost(w, counts, total) for w in segmentations(label))
    assert cost(urls.segment(label, counts, total), counts, total) == pytest.approx(best)


def test_long_words_count(spark):
    long = "donaudampfschifffahrtsgesellschaft"
    assert len(long) == 34
    assert urls.segment("die" + long, {"die": 9, long: 50}, 200) == ["die", long]
    junk = "q" * 5000
    assert urls.segment(f"die{junk}die", {"die": 90}, 100) == ["die", junk, "die"]
    hosts = spark.createDataFrame([(f"www.die{long}.de",)], "host string")
    counts = spark.createDataFrame([("die", 9), (long, 50), (long * 9, 3)], "word string, n long")
    found = {r.label: r.words for r in urls.host_words(hosts, counts).collect()}
    assert found["die" + long] == ["die", long]


def brute_verdicts(pages, rules):
    """Unigrams, Viterbi by all cuts, and multinomial naive Bayes, from plain rows (page_id, url, html)."""
    unigrams = Counter(w for _, _, h in pages for w in re.findall(r"[^\W\d_]+", re.sub(r"<[^>]*>", " ", (h or "").lower())))
    total = sum(unigrams.values()) or 1
    rows = []
    for page, url, _ in pages:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
        fits = [r for r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
        rule = max(fits, key=len, default=None)
        bag = []
        for label in re.findall(r"[^\W\d_]+", host):
            bag += [("host", w) for w in max(segmentations(label), key=lambda w: cost(w, unigrams, total))]
        bag += [("path", t if t.isalpha() else f"#{len(t)}") for t in re.findall(r"[^\W\d_]+|[0-9]+", path.lower())]
        rows.append((page, host, path, rule, bag))
    tally = {v: Counter(t for *_, r, bag in rows if r and rules[r] == v for t in bag) for v in ("allow", "block")}
    known = {t for *_, bag in rows for t in bag}
    n = {v: sum(1 for *_, r, _ in rows if r and rules[r] == v) for v in tally}

    def score(bag):
        if not n["allow"] or not n["block"]:
            return math.log((n["block"] + 1) / (n["allow"] + 1))
        weight = lambda t, v: math.log((tally[v][t] + 1) / (sum(tally[v].values()) + len(known)))
        return math.log((n["block"] + 1) / (n["allow"] + 1)) + sum(weight(t, "block") - weight(t, "allow") for t in bag)

    return {p: (h, path, r, rules[r] if r else "block" if round(score(bag), 6) > 0 else "allow", round(score(bag), 4)) for p, h, path, r, bag in rows}


def test_verdicts_equal_a_plain_recomputation(spark):
    html = "<p class='x'>the morning post and the daily news</p> casino win money casino daily post"
    pages = [
        (1, "https://morningpost.com/news/12", html), (2, "http://casinowin.net/es/play/1", html), (3, "http://winmoney.net/es/win", "casino win"),
        (4, "https://dailynews.com/post", None), (5, "https://newsdaily.org/news/post", html), (6, "https://casino.org/play/77", "play play"),
        (7, None, html), (8, "no url", ""), (9, "HTTP://WIN.Org/", "win"), (10, "https://dailynews.com/post", html),
    ]
    rules = {"com/": "allow", "net/es/": "block"}
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({c: F.lit("z") for c in ("host", "token", "word", "n")})
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict, round(r.score, 4)) for r in urls.judge(df, rules).collect()}
    want = brute_verdicts(pages, rules)
    assert {k: v[:4] for k, v in found.items()} == {k: v[:4] for k, v in want.items()}
    assert all(found[k][4] == pytest.approx(want[k][4], abs=2e-4) for k in want)
    assert urls.judge(df.limit(0), rules).count() == 0
