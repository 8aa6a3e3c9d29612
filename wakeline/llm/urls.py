"""URL filters: allow and block rules, and for what they leave open a classifier on segmented hosts.

Host labels such as ``themorningpost`` are cut into words by a unigram Viterbi search; the unigrams
are counted over all pages, and only those that are substrings of some host label are looked at. A
multinomial naive Bayes model over host words and path tokens learns from the urls that rules decide
and judges the others. Urls are first reduced to their different (host, path tokens), so a frequent
host is one row for each kind of path.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.sources.scratch import materialise

#: Rows up to which a side is broadcast; they are counted first, and beyond it both sides are shuffled.
BROADCAST_ROWS = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def matched_rule(host_col: Column, path_col: Column, rules: dict[str, str]) -> Column:
    """The longest rule (host, then path from the first ``/``) that fits, or null.

    A rule fits its host and every subdomain if the path starts with the rule's. Of rules of one length
    the smaller by code point wins. ``rules`` is a parameter list, not data."""
    found = F.lit(None).cast("string")
    for rule in sorted(sorted(rules, reverse=True), key=len):
        name, slash, rest = rule.partition("/")
        fits = ((host_col == name) | F.endswith(host_col, F.lit("." + name))) & F.startswith(path_col, F.lit(slash + rest))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def segment(label: str, counts: dict[str, int], total: int) -> list[str]:
    """Most likely words of a label of any length. An unknown piece costs the more the longer it is, a known one never more
    than if it were unknown."""
    longest, letter = max(map(len, counts), default=0), math.log(10)
    best: list[tuple[float, int]] = [(0.0, 0)]
    # The best place for an unknown piece to begin, whatever its length: its letters cost the same each.
    start = (0.0, 0)
    for end in range(1, len(label) + 1):
        options = [(start[0] - math.log(total) - end * letter, start[1])]
        for begin in range(max(0, end - longest), end):
            n = counts.get(label[begin:end])
            if n:
                options.append((best[begin][0] + math.log(n / total), begin))
        best.append(max(options))
        start = max(start, (best[end][0] + end * letter, end))
    words, end = [], len(label)
    while end:
        begin = best[end][1]
        words.append(label[begin:end])
        end = begin
    return words[::-1]


def _segmented(total: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for label, pieces in zip(batch.column("label").to_pylist(), batch.column("pieces").to_pylist()):
                counts = {p["word"]: p["n"] for p in pieces or () if p["word"] is not None}
                out.append(segment(label, counts, total))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(out, pa.list_(pa.string()))], names=["label", "words"]
            )

    return rows


def _labels(host_col: Column) -> Column:
    return F.array_remove(F.split(host_col, r"[^\p{L}]+"), "")


def _hinted(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def unigrams(texts: DataFrame, text: str) -> DataFrame:
    """word, n: lower-cased letter runs of all texts, markup left out."""
    bare = F.regexp_replace(F.lower(F.col(f"`{text}`").cast("string")), r"<[^>]*>", " ")
    words = texts.select(F.explode(F.split(bare, r"[^\p{L}]+")).alias("word"))
    return words.where("word != ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def host_words(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """label, words for each different label of ``hosts`` (host). Words of all lengths are looked for: no piece of a label
    longer than the longest counted word, and no word longer than the longest label, can be one."""
    labels = materialise(hosts.select(F.explode(_labels(F.col("host"))).alias("label")).distinct(), "labels")
    size = F.char_length("label")
    longest_label = labels.agg(F.max(size)).first()[0] or 0
    counts = materialise(counts, "unigrams")
    total, longest = counts.agg(F.sum("n"), F.max(F.when(F.char_length("word") <= longest_label, F.char_length("word")))).first()
    total, longest = total or 1, longest or 0
    cuts = (
        labels.select("label", F.explode(F.sequence(F.lit(1), size)).alias("begin"))
        .select("label", "begin", F.explode(F.sequence(F.lit(1), F.least(F.lit(max(1, longest)), size - F.col("begin") + 1))).alias("length"))
        .select("label", F.expr("substring(label, begin, length)").alias("word"))
        .distinct()
    )
    wanted = materialise(counts.join(_hinted(materialise(cuts.select("word").distinct(), "cuts")), "word", "left_semi"), "words")
    known = cuts.join(_hinted(wanted), "word").groupBy("label").agg(F.collect_list(F.struct("word", "n")).alias("pieces"))
    return labels.join(known, "label", "left").mapInArrow(_segmented(total), "label string, words array<string>")


def judge(
    pages: DataFrame,
    rules: dict[str, str],
    id_col: str = "page_id",
    url: str = "url",
    text: str = "html",
    smoothing: float = 1.0,
) -> DataFrame:
    """page_id, host, path, rule, verdict, score for each row of ``pages``.

    ``rules`` maps a rule to allow or block. ``score`` is the model's log-odds of block; it decides where no
    rule fits (block above 0). If the rules decide no url one way, the model has nothing to tell apart
    and its verdict is the way of the others (allow, if there are none). Null urls, and urls without ``://``,
    have an empty host and path. Urls, labels and words of any length are read whole. Repeated rows come back as often. Other
    columns are not read. An empty table gives no rows.
    """
    urls = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"))
    urls = urls.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    tokens = F.transform(
        F.regexp_extract_all(F.lower("path"), F.lit(r"\p{L}+|[0-9]+"), F.lit(0)),
        lambda t: F.when(t.rlike("^[0-9]"), F.concat(F.lit("#"), F.char_length(t).cast("string"))).otherwise(t),
    )
    urls = urls.withColumn("rule", matched_rule(F.col("host"), F.col("path"), rules)).withColumn("tokens", F.array_join(tokens, " "))
    ruled = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        ruled = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(ruled)
    kinds = materialise(
        urls.select("host", "tokens", ruled.alias("ruled"))
        .groupBy("host", "tokens")
        .agg(F.count_if(F.col("ruled") == "allow").alias("allow"), F.count_if(F.col("ruled") == "block").alias("block"))
        .withColumn("kind", F.xxhash64("host", "tokens")),
        "kinds",
    )
    sums = kinds.agg(F.sum("allow"), F.sum("block")).first()
    allow, block = sums[0] or 0, sums[1] or 0
    segmented = host_words(kinds.select("host").distinct(), unigrams(pages, text))
    by_label = kinds.select("host").distinct().select("host", F.explode(_labels(F.col("host"))).alias("label"))
    by_host = by_label.join(segmented, "label").select("host", F.explode("words").alias("token"))
    by_path = kinds.select("kind", "allow", "block", F.explode(F.array_remove(F.split("tokens", " "), "")).alias("token"))
    bags = materialise(
        kinds.select("kind", "host", "allow", "block").join(by_host, "host").select("kind", "allow", "block", F.concat(F.lit("host "), "token").alias("token"))
        .unionAll(by_path.select("kind", "allow", "block", F.concat(F.lit("path "), "token").alias("token"))),
        "bags",
    )
    tally = materialise(bags.groupBy("token").agg(F.sum("allow").alias("a"), F.sum("block").alias("b")), "tally")
    seen = tally.agg(F.sum("a"), F.sum("b"), F.count(F.lit(1))).first()
    size = smoothing * max(1, seen[2])
    odds = F.log((F.col("b") + smoothing) / ((seen[1] or 0) + size)) - F.log((F.col("a") + smoothing) / ((seen[0] or 0) + size))
    weights = tally.select("token", odds.alias("w"))
    prior = math.log((block + 1) / (allow + 1))
    one_sided = (not allow) or (not block)
    scored = bags.join(_hinted(weights), "token").groupBy("kind").agg(F.sum(F.round("w", 9)).alias("w"))
    kinds_scored = materialise(
        kinds.join(scored, "kind", "left").select(
            "host", "tokens", (F.lit(prior) + (F.lit(0.0) if one_sided else F.coalesce("w", F.lit(0.0)))).alias("score")
        ),
        "scores",
    )
    judged = urls.join(_hinted(kinds_scored), ["host", "tokens"])
    # The last places of a sum depend on the order of its terms.
    judged = judged.withColumn("score", F.round("score", 6))
    own = F.when(F.col("score") > 0, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce(ruled, own).alias("verdict"), "score")
