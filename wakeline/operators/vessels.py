"""Vessel metadata, groups, and the searchable vessel index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions.codes import group_colour, group_priority, in_group, vessel_group, vessel_groups
from wakeline.functions.ids import doc_id, has_term, missing_number_to_null, strip_doc_prefix
from wakeline.operators.motion import order_key
from wakeline.schema import FIRST_KNOWN_COLUMNS, GROUPED_METADATA, MEAN_COLUMNS, MISSING_NUMBER, UNKNOWN


def first_known(df: DataFrame, column: str) -> Column:
    """Aggregate: earliest non-NULL value of ``column``."""
    known = F.col(column).isNotNull()
    # A NULL ordering value is skipped, so rows without the attribute never win.
    return F.min_by(column, F.when(known, F.struct(*order_key(df))))


def vessel_metadata(
    ais: DataFrame, columns: tuple[str, ...] = (*FIRST_KNOWN_COLUMNS, *MEAN_COLUMNS)
) -> DataFrame:
    """One row per vessel: first known attributes, mean dimensions, as far as ``columns`` names
    them. Covers every message, inside the box or not."""
    return ais.groupBy("mmsi").agg(
        *[first_known(ais, c).alias(c) for c in FIRST_KNOWN_COLUMNS if c in columns],
        *[F.avg(missing_number_to_null(F.col(c).cast("double"))).alias(c) for c in MEAN_COLUMNS if c in columns],
    )


def with_vessel_group(meta: DataFrame, code: str = "vessel_type") -> DataFrame:
    return meta.withColumn("vessel_group", vessel_group(F.col(code)))


def group_memberships(meta: DataFrame, code: str = "vessel_type") -> DataFrame:
    """(mmsi, vessel_group): a row for every group a vessel belongs to."""
    return meta.select("mmsi", F.explode(vessel_groups(F.col(code))).alias("vessel_group"))


def tracks_in_group(tracks: DataFrame, meta: DataFrame, group: str) -> DataFrame:
    """Tracks (or messages) of the vessels whose type is in ``group``."""
    members = meta.where(in_group(F.col("vessel_type"), group)).select("mmsi")
    return tracks.join(members, "mmsi", "left_semi")


def in_any_group(messages: DataFrame, meta: DataFrame) -> DataFrame:
    """Messages of the vessels that are in some group: what is worth building tracks of."""
    return messages.join(group_memberships(meta).select("mmsi").distinct(), "mmsi", "left_semi")


def vessel(meta: DataFrame, mmsi: int) -> DataFrame:
    return meta.where(F.col("mmsi") == mmsi)


def sort_by_type(meta: DataFrame) -> DataFrame:
    """By vessel type, then id; missing types first."""
    return meta.orderBy(F.asc_nulls_first("vessel_type"), F.asc("mmsi"))


def group_sizes(meta: DataFrame) -> DataFrame:
    return meta.groupBy("vessel_group").agg(F.count(F.lit(1)).alias("n_vessels"))


def lookup_group(positions: DataFrame, meta: DataFrame) -> DataFrame:
    """Adds the vessel's group; NULL where the vessel is not in the metadata."""
    return positions.join(meta.select("mmsi", "vessel_group"), "mmsi", "left")


def grouped_metadata(meta: DataFrame) -> DataFrame:
    """Metadata with the group, under the names and in the order of the file that carries it."""
    grouped = with_vessel_group(meta).withColumnRenamed("vessel_type", "vessel_code")
    return grouped.select(*[f.name for f in GROUPED_METADATA.fields])


def coloured(rows: DataFrame, meta: DataFrame) -> DataFrame:
    """Positions, tracks or lines with the vessel's group and its display colour, for maps; a vessel
    that the metadata does not know has neither."""
    return with_group_colour(lookup_group(rows, meta))


def with_group_colour(df: DataFrame) -> DataFrame:
    return df.withColumn("colour", group_colour(F.col("vessel_group")))


# --- index ----------------------------------------------------------------------------


def index_documents(meta: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, vessel_group, length, width, draft) with sentinels for missing values, and the
    columns named in ``keep``."""

    def number(column):
        return F.coalesce(missing_number_to_null(F.col(column)), F.lit(MISSING_NUMBER))

    return meta.select(
        doc_id(F.col("mmsi")).alias("doc_id"),
        F.coalesce(F.col("vessel_group"), F.lit(UNKNOWN)).alias("vessel_group"),
        number("l").alias("length"),
        number("w").alias("width"),
        number("draft").alias("draft"),
        *keep,
    )


def upsert(documents: DataFrame, version: list[str], key: str = "doc_id") -> DataFrame:
    """The last version of each document. Aggregates before the shuffle, so a document
    rewritten very often does not pile up in one task."""
    rest = [c for c in documents.columns if c != key]
    latest = F.max_by(F.struct(*rest), F.struct(*version))
    return documents.groupBy(key).agg(latest.alias("_doc")).select(key, "_doc.*")


def term_search(documents: DataFrame, term: str) -> DataFrame:
    """Ids of the vessels whose group holds ``term`` as a word."""
    hits = documents.where(has_term(F.col("vessel_group"), term))
    return hits.select(strip_doc_prefix(F.col("doc_id")).cast("int").alias("mmsi"))


def number_range(documents: DataFrame, field: str, low: float, high: float) -> DataFrame:
    """Documents with ``field`` in ``[low, high]``; the sentinel never matches."""
    value = F.col(field)
    return documents.where(value.between(low, high) & (value != MISSING_NUMBER))


def ids_by_group(documents: DataFrame) -> DataFrame:
    """(vessel_group, mmsi) for all groups in one pass. Rows, not one list per group: a
    group can hold a large share of all vessels."""
    return documents.select("vessel_group", strip_doc_prefix(F.col("doc_id")).cast("int").alias("mmsi"))


def group_page(documents: DataFrame, group: str, after: int | None = None, size: int | None = None) -> DataFrame:
    """A group's ids in id order: all of them, or the first ``size`` beyond the id ``after`` (the last of
    the page before). A deep page reads no more than the first."""
    found = term_search(documents, group)
    if after is not None:
        found = found.where(F.col("mmsi") > after)
    found = found.orderBy("mmsi")
    return found if size is None else found.limit(size)


def group_of_id(memberships: DataFrame) -> DataFrame:
    """id -> group; of several groups the last in the fixed order stays."""
    last = F.max_by("vessel_group", group_priority(F.col("vessel_group")))
    return memberships.groupBy("mmsi").agg(last.alias("vessel_group"))
