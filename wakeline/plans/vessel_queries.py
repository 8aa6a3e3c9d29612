"""Registered queries on vessels: metadata, groups, index and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from wakeline.functions.codes import group_map, vessel_group
from wakeline.functions.ids import doc_id, strip_doc_prefix
from wakeline.operators.geosets import MOVING, geo_sets, members
from wakeline.operators.series import last_hour_lines
from wakeline.operators.tracks import build_tracks, track_points
from wakeline.operators.vessels import (
    coloured,
    first_known,
    group_memberships,
    group_of_id,
    group_page,
    group_sizes,
    ids_by_group,
    in_any_group,
    index_documents,
    lookup_group,
    number_range,
    sort_by_type,
    term_search,
    tracks_in_group,
    vessel,
    vessel_metadata,
    with_group_colour,
    with_vessel_group,
)
from wakeline.plans.message_queries import hour_rows, minute_rows, motion
from wakeline.plans.registry import (
    HOUR_SQL,
    CALENDAR_SQL,
    GROUP_MAP_SQL,
    MEMBERS_SQL,
    MINUTE_SQL,
    MOTION_SQL,
    SETS_SQL,
    group_case,
    on_ais,
    on_docs,
    on_meta,
    register,
)
from wakeline.plans.testbed import ais, ais_with_names
from wakeline.schema import GROUP_COLOURS, MEAN_COLUMNS, UNKNOWN, VESSEL_GROUPS
from wakeline.sources.messages import read_metadata_csv, write_metadata_csv
from wakeline.sources.scratch import scratch_path
from wakeline.sources.tables import read_group, read_table, upsert_stored, write_groups


def meta(spark, sf_dir):
    return with_vessel_group(vessel_metadata(ais_with_names(spark, sf_dir)))


def types(spark, sf_dir):
    """Vessel types alone, for queries that need no names."""
    return with_vessel_group(vessel_metadata(ais(spark, sf_dir), ("vessel_type",)))


def dimensions(spark, sf_dir):
    """Types and mean sizes, for the index."""
    return with_vessel_group(vessel_metadata(ais(spark, sf_dir), ("vessel_type", *MEAN_COLUMNS)))


def documents(spark, sf_dir):
    return index_documents(dimensions(spark, sf_dir))


def rounded(df, *columns, places=6):
    return df.withColumns({c: F.round(c, places) for c in columns})


META_ROW = (
    "mmsi, vessel_type, vessel_name, imo, call_sign, cargo, "
    "round(l, 6) AS l, round(w, 6) AS w, round(draft, 6) AS draft"
)


# --- metadata -------------------------------------------------------------------------


@register("a2_first_known_attributes", on_meta("SELECT mmsi, vessel_type, vessel_name, imo, call_sign, cargo FROM meta"))
def a2(spark, sf_dir):
    return vessel_metadata(ais_with_names(spark, sf_dir)).drop("l", "w", "draft")


@register(
    "a3_mean_dimensions",
    on_meta("SELECT mmsi, round(l, 6) AS l, round(w, 6) AS w, round(draft, 6) AS draft FROM meta"),
)
def a3(spark, sf_dir):
    return rounded(dimensions(spark, sf_dir).select("mmsi", "l", "w", "draft"), "l", "w", "draft")


@register(
    "x1_first_known_status",
    on_ais(
        "SELECT mmsi, first(status ORDER BY base_dt, seq) FILTER (WHERE status IS NOT NULL) AS status, "
        "first(heading ORDER BY base_dt, seq) FILTER (WHERE heading IS NOT NULL) AS heading FROM ais GROUP BY mmsi"
    ),
)
def x1(spark, sf_dir):
    rows = ais(spark, sf_dir)
    return rows.groupBy("mmsi").agg(*[first_known(rows, c).alias(c) for c in ("status", "heading")])


@register("o2_sort_by_type", on_meta("SELECT mmsi, vessel_type FROM meta ORDER BY vessel_type NULLS FIRST, mmsi"))
def o2(spark, sf_dir):
    return sort_by_type(types(spark, sf_dir)).select("mmsi", "vessel_type")


def _metadata_csv(spark, sf_dir, *order):
    path = scratch_path(spark, "metadata-csv")
    table = sort_by_type(vessel_metadata(ais_with_names(spark, sf_dir)))
    write_metadata_csv(table.select(*order) if order else table, path)
    return path


@register("s4_metadata_csv_scan", on_meta(f"SELECT {META_ROW} FROM meta"))
def s4(spark, sf_dir):
    order = ("mmsi", "vessel_type", "vessel_name", "imo", "call_sign", "l", "w", "draft", "cargo")
    return rounded(read_metadata_csv(spark, _metadata_csv(spark, sf_dir, *order)), "l", "w", "draft")


@register("s7_metadata_csv_sink", on_meta(f"SELECT {META_ROW} FROM meta"))
def s7(spark, sf_dir):
    return rounded(read_metadata_csv(spark, _metadata_csv(spark, sf_dir)), "l", "w", "draft")


@register(
    "p20_rename_columns",
    on_meta("SELECT mmsi, vessel_type AS vessel_code, call_sign, cargo, vessel_group FROM meta"),
)
def p20(spark, sf_dir):
    renamed = meta(spark, sf_dir).withColumnRenamed("vessel_type", "vessel_code")
    return renamed.select("mmsi", "vessel_code", "call_sign", "cargo", "vessel_group")


@register("p8_vessel_lookup", on_meta(f"SELECT {META_ROW}, vessel_group FROM meta WHERE mmsi = 366000007"))
def p8(spark, sf_dir):
    return rounded(vessel(meta(spark, sf_dir), 366000007), "l", "w", "draft")


# --- groups ---------------------------------------------------------------------------


@register(
    "p11_unknown_type",
    on_meta("SELECT mmsi, CASE WHEN vessel_type IS NULL THEN 'unknown' ELSE 'known' END AS kind FROM meta"),
)
def p11(spark, sf_dir):
    kind = F.when(F.col("vessel_type").isNull(), UNKNOWN).otherwise("known")
    return types(spark, sf_dir).select("mmsi", kind.alias("kind"))


@register("p15_vessel_group", on_meta("SELECT mmsi, vessel_type, vessel_group FROM meta"))
def p15(spark, sf_dir):
    return types(spark, sf_dir)


COLOUR_CASE = "CASE vessel_group " + " ".join(f"WHEN '{g}' THEN '{c}'" for g, c in GROUP_COLOURS.items()) + " END"


@register("p16_group_colour", on_meta(f"SELECT mmsi, vessel_group, {COLOUR_CASE} AS colour FROM meta"))
def p16(spark, sf_dir):
    return with_group_colour(types(spark, sf_dir)).select("mmsi", "vessel_group", "colour")


@register("a7_group_sizes", on_meta("SELECT vessel_group, count(*) AS n_vessels FROM meta GROUP BY vessel_group"))
def a7(spark, sf_dir):
    return group_sizes(types(spark, sf_dir))


@register(
    "a8_ids_per_group",
    on_meta("SELECT vessel_group, mmsi FROM memberships", GROUP_MAP_SQL, MEMBERS_SQL),
)
def a8(spark, sf_dir):
    return group_memberships(types(spark, sf_dir)).select("vessel_group", "mmsi")


@register(
    "a10_group_of_id",
    on_meta(
        "SELECT m.mmsi, last(m.vessel_group ORDER BY g.priority) AS vessel_group FROM memberships m "
        "LEFT JOIN (SELECT DISTINCT vessel_group, priority FROM group_map) g USING (vessel_group) GROUP BY m.mmsi",
        GROUP_MAP_SQL,
        MEMBERS_SQL,
    ),
)
def a10(spark, sf_dir):
    return group_of_id(group_memberships(types(spark, sf_dir)))


@register(
    "f21_code_ranges",
    on_ais(
        "SELECT g.vessel_group, g.code, count(*) AS n FROM ais JOIN group_map g ON ais.vessel_type = g.code GROUP BY ALL",
        GROUP_MAP_SQL,
    ),
)
def f21(spark, sf_dir):
    # The map has 67 rows whatever the data: the one side that is always small.
    codes = F.broadcast(group_map(spark).select("vessel_group", "code"))
    counts = ais(spark, sf_dir).groupBy(F.col("vessel_type").alias("code")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(codes, "code").select("vessel_group", "code", "n")


_TOWING = ", ".join(map(str, VESSEL_GROUPS["tugTow"]))


@register(
    "f23_code_membership",
    on_ais(f"SELECT seq, mmsi, vessel_type FROM ais WHERE vessel_type IN ({_TOWING})"),
)
def f23(spark, sf_dir):
    rows = ais(spark, sf_dir)
    return rows.where(F.col("vessel_type").isin(VESSEL_GROUPS["tugTow"])).select("seq", "mmsi", "vessel_type")


GROUP_POINTS = (
    "SELECT {group}m.mmsi, base_dt, seq, lat, lon FROM motion m JOIN memberships g ON m.mmsi = g.mmsi {where}"
)


@register(
    "j1_tracks_in_group",
    on_meta(
        GROUP_POINTS.format(group="", where="WHERE g.vessel_group = 'tugTow'"),
        MOTION_SQL, GROUP_MAP_SQL, MEMBERS_SQL,
    ),
)
def j1(spark, sf_dir):
    # The vessels are picked before their arrays are built.
    rows = tracks_in_group(motion(spark, sf_dir), types(spark, sf_dir), "tugTow")
    return track_points(build_tracks(rows)).select("mmsi", "base_dt", "seq", "lat", "lon")


@register(
    "j1_unknown_group",
    on_meta(
        GROUP_POINTS.format(group="", where="WHERE g.vessel_group = 'unknown'"),
        MOTION_SQL, GROUP_MAP_SQL, MEMBERS_SQL,
    ),
)
def j1_unknown(spark, sf_dir):
    rows = tracks_in_group(motion(spark, sf_dir), types(spark, sf_dir), UNKNOWN)
    return rows.select("mmsi", "base_dt", "seq", "lat", "lon")


@register(
    "s8_write_groups",
    on_meta(
        "SELECT vessel_group, count(DISTINCT m.mmsi) AS n_vessels, count(*) AS n_points "
        "FROM motion m JOIN memberships g ON m.mmsi = g.mmsi GROUP BY vessel_group",
        MOTION_SQL, GROUP_MAP_SQL, MEMBERS_SQL,
    ),
)
def s8(spark, sf_dir):
    path = scratch_path(spark, "groups")
    kinds = types(spark, sf_dir)
    rows = in_any_group(motion(spark, sf_dir), kinds)
    write_groups(build_tracks(rows), kinds, "3m", path)
    return (
        read_table(spark, path)
        .groupBy("vessel_group", "mmsi")
        .agg(F.sum(F.size("points")).alias("n"))
        .groupBy("vessel_group")
        .agg(F.count(F.lit(1)).alias("n_vessels"), F.sum("n").alias("n_points"))
    )


@register(
    "p9_group_and_period",
    on_meta(
        "SELECT '3y' AS period, g.vessel_group, m.mmsi, count(*) AS n_points FROM motion m "
        "JOIN memberships g ON m.mmsi = g.mmsi WHERE g.vessel_group = 'passenger' GROUP BY ALL",
        MOTION_SQL, GROUP_MAP_SQL, MEMBERS_SQL,
    ),
)
def p9(spark, sf_dir):
    path = scratch_path(spark, "groups")
    rows = motion(spark, sf_dir)
    moving_part = rows.where(F.col("sog") >= 4)
    write_groups(build_tracks(moving_part), types(spark, sf_dir), "3m", path)
    write_groups(build_tracks(rows), types(spark, sf_dir), "3y", path)
    return (
        read_group(spark, path, "passenger", "3y")
        .groupBy("period", "vessel_group", "mmsi")
        .agg(F.sum(F.size("points")).alias("n_points"))
    )


LOOKUP_TABLES = (MOTION_SQL, CALENDAR_SQL, MINUTE_SQL, SETS_SQL)


@register(
    "j2_lookup_group",
    on_meta(
        "SELECT s.mmsi, m.vessel_group FROM sets s LEFT JOIN "
        "(SELECT * FROM meta WHERE vessel_type IS NOT NULL) m ON s.mmsi = m.mmsi WHERE set_name = 'moving'",
        *LOOKUP_TABLES,
    ),
)
def j2(spark, sf_dir):
    moving = members(geo_sets(minute_rows(spark, sf_dir)), MOVING)
    known = types(spark, sf_dir).where(F.col("vessel_type").isNotNull())
    return lookup_group(moving, known).select("mmsi", "vessel_group")


@register(
    "j3_lookup_colour",
    on_meta(
        f"SELECT s.mmsi, m.vessel_group, {COLOUR_CASE} AS colour FROM sets s LEFT JOIN meta m ON s.mmsi = m.mmsi "
        "WHERE set_name = 'moving'",
        *LOOKUP_TABLES,
    ),
)
def j3(spark, sf_dir):
    moving = members(geo_sets(minute_rows(spark, sf_dir)), MOVING)
    return with_group_colour(lookup_group(moving, types(spark, sf_dir))).select("mmsi", "vessel_group", "colour")


@register(
    "j3_coloured_moving",
    on_meta(
        f"SELECT s.mmsi, s.lat, s.lon, s.sog, s.cog, m.vessel_group, {COLOUR_CASE} AS colour FROM sets s "
        "LEFT JOIN meta m ON s.mmsi = m.mmsi WHERE set_name = 'moving'",
        *LOOKUP_TABLES,
    ),
)
def j3_coloured(spark, sf_dir):
    moving = members(geo_sets(minute_rows(spark, sf_dir), keep=("sog", "cog")), MOVING)
    found = coloured(moving, types(spark, sf_dir))
    return found.select("mmsi", "lat", "lon", "sog", "cog", "vessel_group", "colour")


@register(
    "t6_coloured_lines",
    on_meta(
        f"SELECT h.mmsi, row_number() OVER (PARTITION BY h.mmsi ORDER BY h.base_dt, h.seq) - 1 AS idx, h.lat, h.lon, "
        f"m.vessel_group, {COLOUR_CASE} AS colour FROM hour_rows h JOIN (SELECT mmsi FROM sets WHERE set_name = 'moving') s "
        "ON h.mmsi = s.mmsi LEFT JOIN meta m ON h.mmsi = m.mmsi",
        *LOOKUP_TABLES,
        HOUR_SQL,
    ),
)
def t6_coloured(spark, sf_dir):
    moving = members(geo_sets(minute_rows(spark, sf_dir)), MOVING)
    lines = track_points(last_hour_lines(hour_rows(spark, sf_dir), moving))
    return coloured(lines, types(spark, sf_dir)).select("mmsi", "idx", "lat", "lon", "vessel_group", "colour")


# --- index ----------------------------------------------------------------------------

DOC_ROW = "doc_id, vessel_group, length, width, round(draft, 6) AS draft"


@register("p13_index_documents", on_docs(f"SELECT {DOC_ROW} FROM docs"))
def p13(spark, sf_dir):
    return rounded(documents(spark, sf_dir), "draft")


@register(
    "s11_upsert_documents",
    on_ais(
        "SELECT doc_id, vessel_group, length, width, draft FROM (SELECT concat('meta_', CAST(mmsi AS VARCHAR)) AS doc_id, "
        f"coalesce({group_case('vessel_type')}, 'unknown') AS vessel_group, coalesce(l, -999) AS length, coalesce(w, -999) AS width, "
        "coalesce(draft, -999) AS draft, row_number() OVER (PARTITION BY mmsi ORDER BY base_dt DESC, seq DESC) AS rn "
        "FROM ais) WHERE rn = 1"
    ),
)
def s11(spark, sf_dir):
    # A first load of the older messages, then an upsert of the newer ones over it.
    rows = ais(spark, sf_dir)
    docs = index_documents(
        rows.withColumn("vessel_group", vessel_group(F.col("vessel_type"))), keep=("base_dt", "seq")
    )
    path, cut = scratch_path(spark, "docs"), F.expr("TIMESTAMP_NTZ'2017-11-05 08:00:00'")
    for part in (docs.where(F.col("base_dt") < cut), docs.where(F.col("base_dt") >= cut)):
        upsert_stored(spark, path, part, ["base_dt", "seq"])
    return read_table(spark, path).select("doc_id", "vessel_group", "length", "width", "draft")


@register("t1_term_search", on_docs("SELECT CAST(substr(doc_id, 6) AS INT) AS mmsi FROM docs WHERE vessel_group = 'tugTow'"))
def t1(spark, sf_dir):
    return term_search(documents(spark, sf_dir), "TUGTOW")


@register("t2_ids_by_group", on_docs("SELECT vessel_group, CAST(substr(doc_id, 6) AS INT) AS mmsi FROM docs"))
def t2(spark, sf_dir):
    return ids_by_group(documents(spark, sf_dir))


@register(
    "t3_number_range",
    on_docs(f"SELECT {DOC_ROW} FROM docs WHERE length BETWEEN -1000 AND 120 AND length <> -999"),
)
def t3(spark, sf_dir):
    return rounded(number_range(documents(spark, sf_dir), "length", -1000, 120), "draft")


@register(
    "o5_group_page",
    on_docs(
        "SELECT CAST(substr(doc_id, 6) AS INT) AS mmsi FROM docs WHERE vessel_group = 'cargo' ORDER BY 1"
    ),
)
def o5(spark, sf_dir):
    return group_page(documents(spark, sf_dir), "cargo")


@register(
    "f18_doc_prefix",
    on_ais("SELECT seq, concat('meta_', CAST(mmsi AS VARCHAR)) AS doc_id, CAST(mmsi AS VARCHAR) AS name FROM ais"),
)
def f18(spark, sf_dir):
    rows = ais(spark, sf_dir).select("seq", doc_id(F.col("mmsi")).alias("doc_id"))
    return rows.withColumn("name", strip_doc_prefix(F.col("doc_id")))


@register("f19_id_casts", on_ais("SELECT seq, CAST(mmsi AS VARCHAR) AS name, mmsi FROM ais"))
def f19(spark, sf_dir):
    rows = ais(spark, sf_dir).select("seq", F.col("mmsi").cast("string").alias("name"))
    return rows.withColumn("mmsi", F.col("name").cast("int"))


@register(
    "f20_null_defaults",
    on_ais("SELECT seq, vessel_type IS NULL AS no_type, coalesce(draft, -999) AS draft FROM ais"),
)
def f20(spark, sf_dir):
    return ais(spark, sf_dir).select(
        "seq", F.col("vessel_type").isNull().alias("no_type"), F.coalesce("draft", F.lit(-999.0)).alias("draft")
    )
