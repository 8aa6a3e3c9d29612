"""Registered queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wakeline.plans.testbed import AIS_SQL, CALENDAR_SQL, MOTION_SQL, POLYGON_SQL
from wakeline.schema import VESSEL_GROUPS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Registers a query; ``sql`` None means that plain SQL cannot say it."""

    def keep(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return keep


def group_case(code: str) -> str:
    arms = " ".join(
        f"WHEN {code} IN ({', '.join(map(str, codes))}) THEN '{name}'" for name, codes in VESSEL_GROUPS.items()
    )
    return f"CASE WHEN {code} IS NULL THEN 'unknown' {arms} END"


GROUP_MAP_SQL = (
    "group_map AS (SELECT * FROM (VALUES "
    + ", ".join(
        f"({rank}, '{name}', {code})"
        for rank, (name, codes) in enumerate(VESSEL_GROUPS.items(), start=1)
        for code in codes
    )
    + ") AS t(priority, vessel_group, code))"
)


def _first(column: str) -> str:
    return f"first({column} ORDER BY base_dt, seq) FILTER (WHERE {column} IS NOT NULL) AS {column}"


META_SQL = f"""meta AS (
 SELECT *, {group_case('vessel_type')} AS vessel_group FROM (
  SELECT mmsi, {', '.join(_first(c) for c in ('vessel_type', 'vessel_name', 'imo', 'call_sign', 'cargo'))},
   avg(l) AS l, avg(w) AS w, avg(draft) AS draft FROM ais GROUP BY mmsi))"""

DOCS_SQL = """docs AS (
 SELECT concat('meta_', CAST(mmsi AS VARCHAR)) AS doc_id, coalesce(vessel_group, 'unknown') AS vessel_group,
  coalesce(l, -999) AS length, coalesce(w, -999) AS width, coalesce(draft, -999) AS draft FROM meta)"""

MEMBERS_SQL = """memberships AS (
 SELECT mmsi, 'unknown' AS vessel_group FROM meta WHERE vessel_type IS NULL
 UNION ALL SELECT m.mmsi, g.vessel_group FROM meta m JOIN group_map g ON m.vessel_type = g.code)"""

MINUTE_SQL = """minute_rows AS (SELECT * FROM cal
 WHERE localtime_ > TIMESTAMP '2017-11-04 23:59:30' AND localtime_ <= TIMESTAMP '2017-11-05 00:00:30')"""

HOUR_SQL = """hour_rows AS (SELECT * FROM cal
 WHERE localtime_ > TIMESTAMP '2017-11-05 00:20:00' AND localtime_ <= TIMESTAMP '2017-11-05 01:20:00')"""

SETS_SQL = """sets AS (
 SELECT set_name, mmsi, last(lat ORDER BY base_dt, seq) AS lat, last(lon ORDER BY base_dt, seq) AS lon,
  last(sog ORDER BY base_dt, seq) AS sog, last(cog ORDER BY base_dt, seq) AS cog
 FROM (SELECT 'all' AS set_name, * FROM minute_rows
  UNION ALL SELECT 'moving', * FROM minute_rows WHERE sog >= 4
  UNION ALL SELECT 'stationary', * FROM minute_rows WHERE sog < 4) GROUP BY set_name, mmsi)"""


def _spread(value: str, limit: str) -> str:
    cell = f"CAST(floor(({value} + {limit}) / (2 * {limit}) * 67108864) AS BIGINT)"
    return f"list_sum([(({cell} >> i) & 1) << (2 * i) for i in range(26)])"


def score_sql(lat: str = "lat", lon: str = "lon", limit: str = "85.05112878e0") -> str:
    return f"CAST({_spread(lat, limit)} + 2 * {_spread(lon, '180e0')} AS BIGINT)"


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"(2 * 3958.7613e0 * asin(sqrt(sin(radians({lat2} - {lat1}) / 2) ^ 2 + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * sin(radians({lon2} - {lon1}) / 2) ^ 2)))"
    )


SCORED_SQL = f"scored AS (SELECT *, {score_sql()} AS score FROM sets WHERE set_name = 'moving')"

QUINTILE_SQL = (
    "quintiles AS (SELECT mmsi, max(sog) AS max_sog, "
    "round(quantile_cont(sog, 0.5) FILTER (WHERE sog >= 1), 6) AS median_sog, "
    + ", ".join(
        f"round(quantile_cont(sog, {q / 100}) FILTER (WHERE sog >= 1), 6) AS q{q}" for q in (20, 40, 60, 80)
    )
    + " FROM motion WHERE sog IS NOT NULL GROUP BY mmsi)"
)

CLASSED_SQL = """classed AS (
 SELECT m.*, CASE WHEN sog < q20 THEN 0 WHEN sog < q40 THEN 1 WHEN sog < q60 THEN 2 WHEN sog < q80 THEN 3 ELSE 4 END
  AS speed_class FROM motion m JOIN quintiles q ON m.mmsi = q.mmsi WHERE sog >= 0 AND q20 IS NOT NULL)"""

SEGMENT_SQL = """flagged AS (
 SELECT *, coalesce(base_dt - lag(base_dt) OVER (PARTITION BY mmsi, speed_class ORDER BY base_dt, seq)
  > INTERVAL 2 MINUTE, false) AS gap FROM classed),
segments AS (
 SELECT *, CAST(sum(CASE WHEN gap THEN 1 ELSE 0 END) OVER (PARTITION BY mmsi, speed_class ORDER BY base_dt, seq
  ROWS UNBOUNDED PRECEDING) AS INT) AS segment FROM flagged)"""

SLOT_SQL = """slots AS (
 SELECT slot, mmsi, last(lat ORDER BY base_dt, seq) AS lat, last(lon ORDER BY base_dt, seq) AS lon
 FROM (SELECT *, make_timestamp(CAST(ceil(epoch_us(base_dt) / 60e6) * 60000000 AS BIGINT)) AS slot FROM motion) GROUP BY slot, mmsi)"""


def with_tables(body: str, *tables: str) -> str:
    return "WITH " + ",\n".join(tables) + "\n" + body


def on_ais(body: str, *tables: str) -> str:
    return with_tables(body, AIS_SQL, *tables)


def on_motion(body: str, *tables: str) -> str:
    return on_ais(body, MOTION_SQL, *tables)


def on_calendar(body: str, *tables: str) -> str:
    return on_motion(body, CALENDAR_SQL, *tables)


def on_minute(body: str, *tables: str) -> str:
    return on_calendar(body, MINUTE_SQL, *tables)


def on_sets(body: str, *tables: str) -> str:
    return on_minute(body, SETS_SQL, *tables)


def on_meta(body: str, *tables: str) -> str:
    return on_ais(body, META_SQL, *tables)


def on_docs(body: str, *tables: str) -> str:
    return on_meta(body, DOCS_SQL, *tables)


def on_segments(body: str, *tables: str) -> str:
    return on_motion(body, QUINTILE_SQL, CLASSED_SQL, SEGMENT_SQL, *tables)


def on_polygons(body: str) -> str:
    return with_tables(body, POLYGON_SQL)
