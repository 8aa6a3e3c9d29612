"""Benchmark decontamination by winnowing, in DataFrame functions only.

Each text keeps the least hash of every nine consecutive 5-grams: texts that share 13 words share
such a fingerprint. Fingerprints are stored beside the document's key and joined with those of the
benchmark; texts that meet one are read again and the hits extended to whole windows: each place where a
window of an item begins is found by the window's 128-bit name, and the windows cover the words that are hit. A place is
one row however often an item repeats what stands there, so texts of one repeated word cost no more than others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.sources.scratch import materialise

GRAM = 5
#: Rows of (hash, item, place) or of document keys up to which one side of a join is broadcast
#: (some 40 bytes a row); they are counted first, and beyond this both sides are shuffled.
BROADCAST_ROWS = 400_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; null has none."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(low, _BETWEEN), "")


def grams(hashes: Column, k: int) -> Column:
    """Hashes of all k consecutive word hashes."""
    count = F.size(hashes) - (k - 1)
    each = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(*(F.get(hashes, i + d) for d in range(k))))
    return F.when(count > 0, each).otherwise(F.array().cast("array<long>"))


def names(hashes: Column, size: int) -> Column:
    """128-bit names of all windows of ``size`` consecutive word hashes."""
    count = F.size(hashes) - (size - 1)

    def name(i: Column) -> Column:
        part = F.slice(hashes, i + 1, F.lit(size))
        return F.struct(F.xxhash64(part).alias("n1"), F.xxhash64(F.lit("second"), part).alias("n2"))

    each = F.transform(F.sequence(F.lit(0), count - 1), name)
    return F.when(count > 0, each).otherwise(F.array().cast("array<struct<n1: bigint, n2: bigint>>"))


def _no_windows(items: DataFrame) -> DataFrame:
    return items.limit(0).select("item", "span", names(F.col("h"), 1)[0].alias("name"))


def with_prints(df: DataFrame, hashes: str, name: str, k: int, span: int) -> DataFrame:
    """Adds the different least values of every ``span`` consecutive k-gram hashes (of fewer: of all).

    Steps are projections of their own, so that no step is computed twice.
    """
    df = df.withColumn("_low", grams(F.col(hashes), k)).withColumn("_n", F.size("_low"))
    width = 1
    while width < span:
        by = min(width, span - width)
        # Beyond the end a shorter list gives nulls, which least() leaves out: the tail is cut off below.
        shifted = F.slice("_low", F.lit(by + 1), F.greatest(F.col("_n") - by, F.lit(0)))
        df = df.withColumn("_low", F.zip_with("_low", shifted, lambda a, b: F.least(a, b)))
        width += by
    count = F.greatest(F.col("_n") - (span - 1), F.least(F.col("_n"), F.lit(1)))
    return df.withColumn(name, F.array_distinct(F.slice("_low", F.lit(1), count))).drop("_low", "_n")


def _hinted(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _key(text: str) -> list[Column]:
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return [F.xxhash64(whole).alias("cid"), F.hash(whole).alias("cid2")]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 13,
) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids as strings), contaminated for each row of ``docs``.

    A window is ``window`` consecutive words of an item, or all of a shorter one. A document's word
    inside any occurrence of a window is hit; a document is contaminated if words are hit and they
    are one in twenty or more. Null and wordless texts have no words and no windows. Repeated
    rows each come back; rows of one item_id count as one item, and an item without id hits words
    but is not listed. Tables without rows give no hits, or no rows. Other columns are not read.
    """
    if window < GRAM:
        raise ValueError(f"window must be {GRAM} or more")
    items = materialise(
        benchmark.select(
            F.col(f"`{item_id}`").cast("string").alias("item"), F.transform(words(F.col(f"`{item_text}`")), lambda w: F.xxhash64(w)).alias("h")
        )
        .where(F.size("h") > 0)
        .distinct()
        .select(
            "item",
            "h",
            F.xxhash64("item", "h").alias("row"),
            F.least(F.size("h"), F.lit(window)).alias("span"),
            F.least(F.size("h"), F.lit(GRAM)).alias("k"),
        ),
        "items",
    )
    spans = sorted(r.span for r in items.select("span").distinct().collect())  # ``window`` numbers at most
    # Items below the window are found by their first gram instead: their gram sizes, five at most.
    short = sorted({min(s, GRAM) for s in spans if s < window})
    heads = [items.where((F.col("k") == k) & (F.col("span") < window)).select(F.get(grams(F.col("h"), k), F.lit(0)).alias("print")) for k in short]
    every = (items.where(F.col("span") == s).select("item", "span", F.explode(names(F.col("h"), s)).alias("name")) for s in spans)
    windows = materialise(reduce(DataFrame.unionAll, every, _no_windows(items)).distinct(), "item-windows")

    full = with_prints(items.where(F.col("span") == window), "h", "prints", GRAM, window - GRAM + 1).select(F.explode("prints").alias("print"))
    wanted = materialise(full.distinct(), "item-prints")

    hashed = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), *_key(text), F.transform(words(F.col(f"`{text}`")), lambda w: F.xxhash64(w)).alias("h")
    )
    firsts = {k: grams(F.col("h"), k) for k in short}
    marked = materialise(
        with_prints(hashed, "h", "prints", GRAM, window - GRAM + 1).select(
            "doc_id",
            "cid",
            "cid2",
            F.size("h").cast("long").alias("n_words"),
            "prints",
            *(F.array_distinct(g).alias(f"grams{k}") for k, g in firsts.items()),
        ),
        "prints",
    )
    met = [marked.select("cid", "cid2", F.explode("prints").alias("print")).join(_hinted(wanted), "print", "left_semi")]
    for k, head in zip(short, heads):
        met.append(marked.select("cid", "cid2", F.explode(f"grams{k}").alias("print")).join(_hinted(head.distinct()), "print", "left_semi"))
    candidates = materialise(reduce(DataFrame.unionAll, (m.select("cid", "cid2") for m in met)).distinct(), "candidates")

    again = (
        docs.select(*_key(text), F.col(f"`{text}`").alias("text"))
        .join(_hinted(candidates), ["cid", "cid2"], "left_semi")
        .select("cid", "cid2", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
        .dropDuplicates(["cid", "cid2"])
    )
    again = materialise(again, "again")
    placed = [again.select("cid", "cid2", F.lit(s).alias("span"), F.posexplode(names(F.col("h"), s)).alias("a", "name")) for s in spans]
    empty = again.limit(0).select("cid", "cid2", F.lit(0).alias("span"), F.lit(0).alias("a"), names(F.col("h"), 1)[0].alias("name"))
    known = _hinted(materialise(windows.select("span", "name").distinct(), "window-names"))
    runs = materialise(reduce(DataFrame.unionAll, placed, empty).join(known, ["span", "name"], "left_semi"), "runs")
    hit = (
        runs.groupBy("cid", "cid2", "a")
        .agg(F.max("span").alias("span"))
        .select("cid", "cid2", F.explode(F.sequence(F.col("a"), F.col("a") + F.col("span") - 1)).alias("place"))
        .distinct()
        .groupBy("cid", "cid2")
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    met_items = runs.select("cid", "cid2", "span", "name").distinct().join(_hinted(windows), ["span", "name"]).select("cid", "cid2", "item")
    listed = met_items.groupBy("cid", "cid2").agg(F.array_sort(F.collect_set("item")).alias("items"))
    # Stored, so that adaptive execution may split a text with very many copies on the left.
    found = materialise(hit.join(listed, ["cid", "cid2"]), "hits")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0).cast("long"))
    return (
        marked.select("doc_id", "cid", "cid2", "n_words")
        .join(found, ["cid", "cid2"], "left")
        .select(
            "doc_id",
            "n_words",
            n_hit.alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **columns) -> DataFrame:
    """The rows of ``docs`` whose text is not contaminated; ids play no part."""
    bad = contamination(docs.select(F.struct(*_key(text)).alias("k"), F.col(f"`{text}`").alias("t")), benchmark, "k", "t", **columns)
    bad = bad.where("contaminated").select("doc_id.cid", "doc_id.cid2").distinct()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("d"), *_key(text))
    return rows.join(_hinted(materialise(bad, "bad")), ["cid", "cid2"], "left_anti").select("d.*")
