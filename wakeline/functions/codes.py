"""Vessel type code -> vessel group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.schema import GROUP_COLOURS, GROUP_NAMES, SPEED_COLOURS, UNKNOWN, VESSEL_GROUPS


def vessel_group(code: Column) -> Column:
    """The group of highest priority; NULL code -> unknown, unmapped code -> NULL."""
    chain = F.when(code.isNull(), UNKNOWN)
    for name, codes in VESSEL_GROUPS.items():
        chain = chain.when(code.isin(codes), name)
    return chain


def vessel_groups(code: Column) -> Column:
    """Every group the code belongs to, as a short array (empty when unmapped)."""
    hits = [F.when(code.isin(codes), name) for name, codes in VESSEL_GROUPS.items()]
    return F.array_compact(F.array(*hits, F.when(code.isNull(), UNKNOWN)))


def in_group(code: Column, group: str) -> Column:
    """Membership test for one group; a code listed twice is in both groups."""
    if group == UNKNOWN:
        return code.isNull()
    return F.coalesce(code.isin(VESSEL_GROUPS[group]), F.lit(False))


def group_priority(group: Column) -> Column:
    """1 for the first group in the fixed order, and so on."""
    return F.array_position(F.array(*[F.lit(g) for g in GROUP_NAMES]), group).cast("int")


def group_map(spark: SparkSession) -> DataFrame:
    """(priority, vessel_group, code): one row per pair, at most 67 rows."""
    rows = [
        (rank, name, code)
        for rank, name in enumerate(GROUP_NAMES, start=1)
        for code in VESSEL_GROUPS.get(name, [None])
    ]
    return spark.createDataFrame(rows, "priority int, vessel_group string, code int")


def group_colour(group: Column) -> Column:
    chain = F.when(F.lit(False), F.lit(None))
    for name, colour in GROUP_COLOURS.items():
        chain = chain.when(group == name, colour)
    return chain


def speed_colour(speed_class: Column) -> Column:
    return F.get(F.array(*[F.lit(c) for c in SPEED_COLOURS]), speed_class)
