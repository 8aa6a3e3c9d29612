"""Connected components by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.sources.scratch import materialise

_MAX_ROUNDS = 60


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node long, smallest long) for each node of the undirected ``links`` (a, b).

    Large-star and small-star rounds: every node hands its larger, then its smaller neighbours to
    the smallest one it knows, until nothing changes. Each round is written to the shared scratch
    folder, which cuts the lineage; two numbers a round reach the driver. The smallest neighbour is
    found by a partial aggregate and joined back, so a node with very many links is never gathered.
    Rows with a null end and links of a node to itself are left out.
    """
    a, b = F.col("a"), F.col("b")
    edges = materialise(
        links.where(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct(),
        "links",
    )
    before = None
    for _ in range(_MAX_ROUNDS):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("low", "a").alias("low"))
        large = both.join(low, "a").where(b > a).select(b.alias("a"), F.col("low").alias("b"))
        large = large.where(a != b).distinct()
        low2 = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(low2, "a")
            .select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(b.alias("a"), F.col("low").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where(a != b)
            .distinct()
        )
        edges = materialise(small, "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    else:
        raise RuntimeError("components did not settle")
    nodes = edges.select(a.alias("node"), b.alias("smallest"))
    return nodes.union(nodes.select(F.col("smallest").alias("node"), "smallest").distinct())
