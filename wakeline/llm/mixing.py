"""Mixing of sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Every document of a source is to be taken rate = target / source size times. The whole part of that
is certain; the fraction is decided by pivots: of two undecided documents one hands the other as much
of its expected words as makes one of the two fractions 0 or 1, in the direction that a hash draws so
that expectations hold. Words are handed over one for one, so a source's expected words never change
and only its last undecided document is rounded. Pivots run within small groups first; what each
group leaves undecided goes up a reduction tree until one document of each source is left.

Rows equal in source, id, size and text are interchangeable: they are one entry with a count, the whole part of
their common expectation is certain, and at most one of them is undecided. So no group of copies meets in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.sources.scratch import materialise

#: Documents of one pivot group, on average, and the factor by which a level of the tree shrinks.
FAN_IN = 64
#: Rows (one a source) up to which source figures are broadcast; they are counted first.
BROADCAST_ROWS = 400_000
MAX_COPIES = 3
#: Equal rows that one task writes.
EQUAL_ROWS = 100_000

_WORD_BREAKS = r"[\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), _WORD_BREAKS), "")).cast("long")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """``sizes`` (source, source_size) with ``rank`` from 0 by code point, null last.

    Sorted over many tasks; a prefix sum over the parts' counts makes the local places global."""
    parts = (
        sizes.withColumn("_null", F.col("source").isNull())
        .repartitionByRange("_null", "source")
        .sortWithinPartitions("_null", "source")
        .select("source", "source_size", F.monotonically_increasing_id().alias("_id"))
    )
    placed = materialise(
        parts.select(
            "source",
            "source_size",
            F.shiftright("_id", 33).alias("_part"),
            F.col("_id").bitwiseAND((1 << 33) - 1).alias("_place"),
        ),
        "sources",
    )
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return placed.join(F.broadcast(before), "_part").select("source", "source_size", (F.col("_before") + F.col("_place")).alias("rank"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = MAX_COPIES) -> DataFrame:
    """source, source_size, target: all sizes shared by weight, at most ``most`` times a source's size.

    The excess is shared again by weight until no source is above its limit: each round is one
    aggregate that brings three numbers to the driver."""
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = materialise(ranked_sources(sizes).select("source", F.col("source_size"), weight.alias("w")), "weights")
    limit = F.col("source_size") * float(most)
    total = ranked.agg(F.sum("source_size")).first()[0] or 0

    def at(level: float) -> DataFrame:
        # The level is a value in a one-row table: every round runs the same generated code.
        given = sizes.sparkSession.createDataFrame([(1, level)], "one int, level double")
        return ranked.withColumn("one", F.lit(1)).join(F.broadcast(given), "one")

    level = 0.0
    while True:
        full = limit <= F.col("level") * F.col("w")
        used, open_w, n = (
            at(level).agg(F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("w"))), F.count(F.when(~full, 1))).first()
        )
        new = (total - (used or 0)) / open_w if n else level
        if new <= level:
            break
        level = new
    return at(level).select("source", "source_size", F.least(limit, F.col("level") * F.col("w")).alias("target"))


def _draw(*parts: Column) -> Column:
    """A number in [0, 1) that depends on its parts alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit("pivot"), *parts), 11) / float(1 << 53)


def _pivot(a: Column, b: Column) -> tuple[Column, Column]:
    """Fractions of ``a`` and ``b`` (doc, size, frac) after one transfer of words between them."""
    sa, sb, pa, pb = a["size"].cast("double"), b["size"].cast("double"), a["frac"], b["frac"]
    up = F.least((1 - pa) * sa, pb * sb)  # words from b to a
    down = F.least(pa * sa, (1 - pb) * sb)
    gain = F.when(_draw(a["doc"], b["doc"], pa, pb) * (up + down) < down, up).otherwise(-down)

    def snapped(p: Column, s: Column, words: Column) -> Column:
        moved = p + words / s
        return F.when(moved < 1e-9, 0.0).when(moved > 1 - 1e-9, 1.0).otherwise(moved)

    return snapped(pa, sa, gain), snapped(pb, sb, -gain)


_FIELDS = ("size", "doc", "frac", "tie", "n", "extra")


def _chain(items: Column, doc_type: str) -> Column:
    """Pivots along a sorted group: array of documents where at most one is undecided."""

    def with_frac(x: Column, p: Column) -> Column:
        return F.struct(*((p if name == "frac" else x[name]).alias(name) for name in _FIELDS))

    def settled(x: Column) -> Column:
        return (x["frac"] <= 0) | (x["frac"] >= 1)

    def step(acc: Column, x: Column) -> Column:
        held, x_frac = _pivot(acc["held"], x)
        moved = F.struct(with_frac(acc["held"], held).alias("h"), with_frac(x, x_frac).alias("x"))
        first = F.struct(x.alias("held"), acc["done"].alias("done"))
        # The settled one of the two is put down and the other goes on (either, if both are).
        chained = F.transform(
            F.array(moved),
            lambda m: F.when(settled(m["h"]), F.struct(m["x"].alias("held"), F.concat(acc["done"], F.array(m["h"])).alias("done"))).otherwise(
                F.struct(m["h"].alias("held"), F.concat(acc["done"], F.array(m["x"])).alias("done"))
            ),
        )[0]
        passed = F.struct(x.alias("held"), F.concat(acc["done"], F.array(acc["held"])).alias("done"))
        return F.when(acc["held"].isNull(), first).when(settled(acc["held"]), passed).otherwise(chained)

    entry = f"struct<size:bigint,doc:{doc_type},frac:double,tie:bigint,n:bigint,extra:bigint>"
    start = F.struct(F.lit(None).cast(entry).alias("held"), F.array().cast(f"array<{entry}>").alias("done"))
    return F.aggregate(items, start, step, lambda acc: F.concat(acc["done"], F.array(acc["held"])))


def _settle_largest(aimed: DataFrame) -> DataFrame:
    """One transfer between the largest document of each source and all others together, then the whole parts of equal rows.

    Single pivots with far smaller documents may never settle the largest. The fractions of the others are
    still equal here, so their share of the transfer is the same factor for each. The step is
    left out where the others cannot take what it needs. ``extra`` is how many of an entry's rows are certain to be taken
    once more, ``frac`` what is left to decide."""
    f, big = F.col("rate") - F.col("base"), F.col("largest")
    one = big["n"] * f - F.floor(big["n"] * f)
    rest = (F.col("source_size") - big["n"] * big["size"]).cast("double") * F.least(f, 1 - f)
    goes_up = _draw(F.lit("largest"), F.col("source"), big["doc"], big["tie"]) < one
    need = big["size"] * F.when(goes_up, 1 - one).otherwise(one)
    possible = (one > 0) & (rest > 0) & (big["size"] * F.greatest(one, 1 - one) <= rest)
    moved = F.least(f, 1 - f) * need / rest
    others = f + F.when(possible, F.when(goes_up, -moved).otherwise(moved)).otherwise(0.0)
    is_big = F.col("doc").eqNullSafe(big["doc"]) & (F.col("size") == big["size"]) & F.col("tie").eqNullSafe(big["tie"])
    total = F.col("n") * F.when(is_big, f).otherwise(others)
    # A document without words takes none, however often.
    total = F.when(F.col("size") > 0, total).otherwise(0.0)
    near = F.floor(total + 1e-9)
    left = F.when(total - near < 1e-9, 0.0).otherwise(total - near)
    own = F.when(is_big & possible, F.when(goes_up, 1.0).otherwise(0.0)).otherwise(left)
    own = F.when(F.col("size") > 0, own).otherwise(0.0)
    return aimed.withColumns({"extra": near.cast("long"), "frac": own}).drop("largest", "rate")


def _each_row(entries: DataFrame, most_equal: int) -> DataFrame:
    """One row for each of an entry's ``n`` equal rows, with its place ``at`` from 0."""
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / EQUAL_ROWS).cast("long"))
    cut = entries.withColumn("_part", F.explode(parts))
    if most_equal > EQUAL_ROWS:
        cut = cut.repartition(*entries.columns, "_part")
    size = F.least(F.lit(EQUAL_ROWS).cast("long"), F.col("n") - F.col("_part") * EQUAL_ROWS)
    return cut.withColumn("_own", F.explode(F.sequence(F.lit(0).cast("long"), size - 1))).withColumn(
        "at", F.col("_part") * EQUAL_ROWS + F.col("_own")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[float, ...] = (1, 2, 3),
    most: int = MAX_COPIES,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken (= copies * size) for each row of ``docs``.

    Weights repeat over the sources in code point order, null last. Documents without words are
    taken as often as the whole part of their source's rate says. Repeated rows and null ids are
    documents of their own: of n equal rows n times the rate are taken, rounded by one draw. The draw is a hash of ids, so a rerun
    gives the same. Sources without words have target 0. Other columns are not read; the id keeps its type. An empty table
    gives no rows.
    """
    entries = materialise(
        docs.select(
            F.col(f"`{id_col}`").alias("doc"),
            F.col(f"`{source}`").cast("string").alias("source"),
            size_of(F.col(f"`{text}`")).alias("size"),
            F.xxhash64(F.col(f"`{text}`").cast("string")).alias("tie"),
        )
        .groupBy("source", "doc", "size", "tie")
        .agg(F.count(F.lit(1)).alias("n")),
        "sizes",
    )
    doc_type = entries.schema["doc"].dataType.simpleString()
    sums = materialise(
        entries.groupBy("source").agg(
            F.sum(F.col("size") * F.col("n")).alias("source_size"),
            F.max(F.struct("size", "doc", "tie", "n")).alias("largest"),
            F.max("n").alias("most_equal"),
        ),
        "sums",
    )
    aims = targets(sums.select("source", "source_size"), weights, most).alias("t").join(sums.alias("s"), F.expr("t.source <=> s.source"))
    aims = materialise(aims.select("t.*", "s.largest", "s.most_equal"), "targets")
    sources, most_equal = aims.agg(F.count(F.lit(1)), F.max("most_equal")).first()
    small = sources <= BROADCAST_ROWS
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    aims = aims.select("source", "source_size", "target", "largest", rate.alias("rate"), F.floor(rate).cast("long").alias("base"))
    joined = entries.alias("x").join((F.broadcast(aims) if small else aims).alias("y"), F.expr("x.source <=> y.source"))
    aimed = _settle_largest(joined.select("x.*", "y.source_size", "y.target", "y.largest", "y.rate", "y.base"))
    # Figures of the source travel with each entry; the level of the tree is a value too, so that levels run the same code.
    stored = materialise(aimed.withColumn("level", F.lit(0)), "undecided")
    fixed = ["source", "source_size", "target", "base", "level"]
    settled = (F.col("frac") <= 0) | (F.col("frac") >= 1)
    decided, open_ = [stored.where(settled)], stored.where(~settled)
    while True:
        counted = open_.groupBy("source").agg(F.count(F.lit(1)).alias("entries"))
        most_open = counted.agg(F.max("entries")).first()[0] or 0
        if most_open <= 1:
            break
        groups = counted.select("source", F.ceil(F.col("entries") / fan_in).alias("groups"))
        dealt = open_.alias("x").join(F.broadcast(groups).alias("y") if small else groups.alias("y"), F.expr("x.source <=> y.source"))
        # Largest first: large documents settle each other, and what is left over is small.
        members = F.sort_array(F.collect_list(F.struct(*_FIELDS)), asc=False)
        solved = materialise(
            dealt.select("x.*", F.pmod(F.xxhash64("doc", "tie", "level"), F.col("groups")).alias("group"))
            .groupBy(*fixed, "group")
            .agg(members.alias("m"))
            .select(*fixed, F.explode(_chain(F.col("m"), doc_type)).alias("d"))
            .select(*[c for c in fixed if c != "level"], (F.col("level") + 1).alias("level"), "d.*"),
            "pivots",
        )
        decided.append(solved.where(settled))
        open_ = solved.where(~settled)
    last = F.when(_draw(F.col("doc"), F.col("size"), F.col("frac")) < F.col("frac"), 1.0).otherwise(0.0)
    every = reduce(DataFrame.unionByName, decided, open_.withColumn("frac", last))
    copies = F.col("base") + F.when(F.col("at") < F.col("extra") + F.col("frac"), 1).otherwise(0)
    return _each_row(every, most_equal or 0).select(
        F.col("doc").alias("doc_id"),
        "source",
        "size",
        "source_size",
        "target",
        copies.cast("long").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )
