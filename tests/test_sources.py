import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.frames import track
from wakeline.operators.motion import near_place_and_time, snapshot, with_calendar
from wakeline.operators.polygons import lat_lon_rings, ring_points, with_polygon_class
from wakeline.operators.tracks import build_tracks
from wakeline.operators.vessels import with_vessel_group
from wakeline.plans import flows
from wakeline.schema import GROUPED_METADATA, MOTION_COLUMNS
from wakeline.sources.layers import read_polygons, unread, write_polygons
from wakeline.sources.messages import read_ais_csv, read_metadata_csv, write_metadata_csv
from wakeline.sources.scratch import SETTING, materialise, release, scratch_path
from wakeline.sources.tables import (
    read_day,
    read_group,
    register_table,
    upsert_stored,
    write_by_day,
    write_by_time,
    write_groups,
    write_if_absent,
)

HEADER = "MMSI,BaseDateTime,LAT,LON,SOG,COG,Heading,VesselName,IMO,CallSign,VesselType,Status,Length,Width,Draft,Cargo"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_csv_scan(spark, tmp_path):
    for month in (1, 2):
        (tmp_path / f"AIS_{month}.csv").write_text(
            HEADER + "\n"
            f'36600000{month},2017-11-0{month}T00:00:01,48.5,-122.5,4.1,90.0,511.0,"SEA, STAR",IMO1,WD1,70,under way,100.0,,5.0,70\n'
            "bad,2017-11-01T00:00:01,x,-122.5,4.1,90.0,511.0,,,,,,,,,\n"
        )
    df = read_ais_csv(spark, str(tmp_path / "AIS*"), keep_bad_records=True)
    good = df.where("bad_record IS NULL").orderBy("mmsi").collect()
    assert [r.mmsi for r in good] == [366000001, 366000002]
    assert (good[0].base_dt, good[0].vessel_name, good[0].w, good[0].cargo) == (datetime(2017, 11, 1, 0, 0, 1), "SEA, STAR", None, 70)
    bad = df.where("bad_record IS NOT NULL").collect()
    assert [(r.mmsi, r.lat, r.lon) for r in bad] == [(None, None, -122.5)] * 2


def test_metadata_round_trip_and_column_order(spark, tmp_path, rows):
    meta = spark.createDataFrame(
        [(1, 70, 'A, "B"', None, "WD", 71, 10.5, None, 2.0), (2, None, None, None, None, None, None, None, None)],
        "mmsi int, vessel_type int, vessel_name string, imo string, call_sign string, cargo int, l double, w double, draft double",
    )
    write_metadata_csv(meta, str(tmp_path / "a"))
    assert rows(read_metadata_csv(spark, str(tmp_path / "a"))) == rows(meta)
    other = ["mmsi", "vessel_type", "vessel_name", "imo", "call_sign", "l", "w", "draft", "cargo"]
    write_metadata_csv(meta.select(*other).withColumnRenamed("vessel_type", "vessel_code"), str(tmp_path / "b"))
    back = read_metadata_csv(spark, str(tmp_path / "b"), rename={"vessel_code": "vessel_type"})
    assert rows(back, *meta.columns) == rows(meta)


def test_day_layout_prunes_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "days")
    df = with_calendar(track(spark, 1, [(h * 3600, 5.0) for h in range(72)]))
    write_by_day(df, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_by_day(df, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 72
    assert read_day(spark, path, 2017, 11, 4).count() == 24
    at = datetime(2017, 11, 4, 0, 30, 0)
    near = snapshot(stored, at)
    text = plan(near)
    assert "PartitionFilters: [" in text and "PartitionFilters: []" not in text
    # Two local days are touched, one minute is kept.
    assert near.inputFiles() and rows(near.select(df.columns)) == rows(snapshot(df, at))
    assert "GreaterThanOrEqual(local_s," in text
    place = near_place_and_time(stored, datetime(2017, 11, 4, 7), datetime(2017, 11, 4, 9), 40.0, 50.0, -130.0, -120.0)
    assert "GreaterThanOrEqual(base_s," in plan(place) and place.count() == 3
    files = {f for f in near.inputFiles()}
    assert all("day=" in f for f in files)


def test_time_layout_and_skip_if_present(spark, tmp_path):
    path = str(tmp_path / "motion")
    df = track(spark, 1, [(s, 5.0) for s in range(500)])
    write_by_time(df.repartition(3), path)
    write_if_absent(df.limit(1), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 500
    spans = stored.groupBy(F.input_file_name()).agg(F.min("base_dt").alias("a"), F.max("base_dt").alias("b")).orderBy("a").collect()
    assert all(x.b < y.a for x, y in zip(spans, spans[1:]))


def test_group_folders(spark, tmp_path):
    path = str(tmp_path / "groups")
    meta = with_vessel_group(spark.createDataFrame([(1, 52), (2, None), (3, 33)], "mmsi int, vessel_type int"))
    df = track(spark, 1, [(0, 5.0)]).unionByName(track(spark, 2, [(0, 5.0)])).unionByName(track(spark, 3, [(0, 5.0)]))
    write_groups(build_tracks(df), meta, "3m", path)
    folders = sorted(p.name for p in (tmp_path / "groups" / "period=3m").iterdir() if p.is_dir())
    assert folders == ["vessel_group=publicService", "vessel_group=tugTow", "vessel_group=unknown"]
    tug = read_group(spark, path, "tugTow", "3m")
    assert [r.mmsi for r in tug.collect()] == [1]
    assert "PartitionFilters: [" in plan(tug) and "PartitionFilters: []" not in plan(tug)


def test_register_table(spark, tmp_path):
    path = str(tmp_path / "days")
    write_by_day(with_calendar(track(spark, 1, [(0, 5.0), (90000, 5.0)])), path)
    assert register_table(spark, "by_day_test", path).count() == 2
    assert register_table(spark, "by_day_test", path).where("day = 3").count() == 1
    plain = str(tmp_path / "plain")
    spark.range(3).write.parquet(plain)
    assert register_table(spark, "plain_test", plain).count() == 3


def _feature(i, objl, rings, kind="Polygon"):
    return {"type": "Feature", "id": i, "properties": {"OBJL": objl}, "geometry": {"type": kind, "coordinates": rings}}


RING = [[-123.0, 48.0], [-122.9, 48.0], [-122.9, 48.1], [-123.0, 48.0]]
HOLE = [[-122.95, 48.01], [-122.94, 48.01], [-122.94, 48.02], [-122.95, 48.01]]


def test_polygon_layers(spark, tmp_path, rows):
    features = [_feature(1, "96", [RING, HOLE]), _feature(2, "148", [RING]), _feature(3, "30", [RING])]
    (tmp_path / "c.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    (tmp_path / "l.json").write_text("\n".join(json.dumps(f) for f in features))
    whole = read_polygons(spark, str(tmp_path / "c.json"), collection=True)
    lines = read_polygons(spark, str(tmp_path / "l.json"))
    assert rows(whole) == rows(lines)
    kept = ring_points(lat_lon_rings(with_polygon_class(lines)))
    assert rows(kept.where("vtx = 1"), "feature_id", "polygon_class", "lat", "lon") == [
        ("1", "precautionary_area", 48.0, -122.9), ("2", "lane", 48.0, -122.9)
    ]
    assert kept.count() == 8
    write_polygons(lines, str(tmp_path / "out"))
    assert rows(read_polygons(spark, str(tmp_path / "out"))) == rows(lines)


def test_polygon_parts_and_odd_lines(spark, tmp_path, rows):
    features = [_feature("a7", "96", [[RING], [HOLE]], "MultiPolygon"), _feature("b", "96", [-123.0, 48.0], "Point")]
    path = tmp_path / "l.json"
    path.write_text("\n".join([*(json.dumps(f) for f in features), "{broken", ""]))
    assert rows(ring_points(read_polygons(spark, str(path))).groupBy("feature_id").count()) == [("a7", 8)]
    assert rows(unread(spark, str(path))) == [("{broken",)]


def test_group_folders_are_replaced(spark, tmp_path):
    path = str(tmp_path / "groups")
    meta = with_vessel_group(spark.createDataFrame([(1, 52), (2, None)], "mmsi int, vessel_type int"))
    df = track(spark, 1, [(0, 5.0)]).unionByName(track(spark, 2, [(0, 5.0)]))
    for period in ("3m", "3y", "3m"):
        write_groups(build_tracks(df), meta, period, path)
    assert {r.period: r["count"] for r in spark.read.parquet(path).groupBy("period").count().collect()} == {"3m": 3, "3y": 3}


def test_a_group_without_rows_is_emptied(spark, tmp_path):
    path = str(tmp_path / "groups")
    df = track(spark, 1, [(0, 5.0)]).unionByName(track(spark, 2, [(0, 5.0)]))
    for code in (30, 70):  # from fishing to cargo
        meta = with_vessel_group(spark.createDataFrame([(1, code), (2, 80)], "mmsi int, vessel_type int"))
        write_groups(build_tracks(df), meta, "3m", path)
    assert read_group(spark, path, "fishing", "3m").count() == 0
    assert [r.mmsi for r in read_group(spark, path, "cargo", "3m").collect()] == [1]


def test_a_name_stands_for_one_folder(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(3).write.parquet(a)
    spark.range(7).write.parquet(b)
    assert register_table(spark, "one_folder", a).count() == 3
    with pytest.raises(ValueError):
        register_table(spark, "one_folder", b)


def test_metadata_numbers_as_other_tools_write_them(spark, tmp_path):
    (tmp_path / "m.csv").write_text("mmsi,vessel_type,l\n1,36.0,12.5\n2,,x\n3,70,\n4,36.5,1\n")
    found = {r.mmsi: (r.vessel_type, r.l) for r in read_metadata_csv(spark, str(tmp_path / "m.csv")).collect()}
    assert found == {1: (36, 12.5), 2: (None, None), 3: (70, None), 4: (None, 1.0)}


def test_upsert_replaces_touched_folders_only(spark, tmp_path):
    path = str(tmp_path / "docs")
    schema = "doc_id string, v int, length double"
    first = spark.createDataFrame([(f"meta_{i}", 1, float(i)) for i in range(40)], schema)
    upsert_stored(spark, path, first, ["v"], buckets=8)
    times = {f: os.path.getmtime(f) for f in map(str, (tmp_path / "docs").rglob("*.parquet"))}
    fresh = spark.createDataFrame([("meta_3", 2, 99.0), ("meta_3", 0, 0.0), ("meta_new", 1, 5.0)], schema)
    upsert_stored(spark, path, fresh, ["v"], buckets=8)
    found = {r.doc_id: r.length for r in spark.read.parquet(path).collect()}
    assert len(found) == 41 and found["meta_3"] == 99.0 and found["meta_new"] == 5.0 and found["meta_4"] == 4.0
    kept = [f for f, t in times.items() if os.path.exists(f) and os.path.getmtime(f) == t]
    assert len(kept) >= len(times) - 2 > 0


def test_place_and_time_without_day_columns(spark):
    df = track(spark, 1, [(0, 5.0), (60, 5.0), (7200, 5.0)])
    box = (40.0, 50.0, -130.0, -120.0)
    assert near_place_and_time(df, datetime(2017, 11, 3, 17), datetime(2017, 11, 3, 18), *box).count() == 2


def test_released_tables_are_gone(spark):
    stored = materialise(spark.range(5), "numbers")
    path = stored.inputFiles()[0]
    assert release(spark) > 0 and not os.path.exists(path.removeprefix("file://"))


class _Cluster:
    """Looks like a session on a cluster."""

    class sparkContext:
        master = "yarn"

    def __init__(self, setting):
        self.conf = {SETTING: setting} if setting else {"spark.sql.warehouse.dir": "hdfs:///warehouse"}


def test_scratch_is_the_shared_folder(spark, tmp_path):
    assert scratch_path(spark, "x").startswith(spark.conf.get(SETTING))
    assert scratch_path(_Cluster("hdfs:///shared/"), "x").startswith("hdfs:///shared/wakeline/x-")
    assert scratch_path(_Cluster(None), "x").startswith("hdfs:///warehouse/wakeline/x-")


def test_materialise_reads_a_table(spark):
    stored = materialise(spark.range(5), "numbers")
    assert stored.count() == 5 and "FileScan parquet" in plan(stored)


def test_flows_end_to_end(spark, tmp_path):
    lines = [HEADER]
    for v, kind in ((1, 70), (2, 60), (3, "")):
        for s in range(0, 600, 30):
            lines.append(
                f"{v},2017-11-03T07:{s // 60:02d}:{s % 60:02d},{48.0 + v / 100},{-122.5 + s / 1e5},{10.0 if v < 3 else ''},45.0,,"
                f"Ship {v},,,{kind},,100.0,20.0,5.0,"
            )
    lines.append("4,2017-11-03T07:00:00,10.0,-122.5,5.0,0.0,,Far,,,80,,,,,")
    (tmp_path / "AIS_1.csv").write_text("\n".join(lines) + "\n")
    paths = flows.prepare(spark, str(tmp_path / "AIS*"), str(tmp_path / "out"))
    meta = with_vessel_group(read_metadata_csv(spark, paths["metadata"]))
    assert {r.mmsi: r.vessel_group for r in meta.collect()} == {1: "cargo", 2: "passenger", 3: "unknown", 4: "tanker"}
    assert spark.read.parquet(paths["tracks"]).count() == 3

    by_day = str(tmp_path / "by_day")
    flows.lay_out_by_day(spark, paths["motion"], by_day)
    assert sorted(p.name for p in (tmp_path / "by_day" / "year=2017" / "month=11").glob("day=*")) == ["day=3"]
    near, ahead = flows.moment(spark, by_day, datetime(2017, 11, 3, 0, 9, 0), 0)
    assert {r.mmsi for r in near.collect()} == {1, 2, 3}
    assert {r.mmsi for r in ahead.collect()} == {1, 2}

    lines = flows.group_and_segment(spark, paths["motion"], paths["tracks"], meta, "3m", str(tmp_path / "groups"))
    assert lines.agg(F.sum(F.size("points"))).first()[0] == 40
    assert read_group(spark, str(tmp_path / "groups"), "cargo", "3m").count() == 1


def test_sample_and_map(spark, tmp_path):
    ais = track(spark, 1, [(s, 10.0) for s in range(0, 7200, 60)]).unionByName(track(spark, 2, [(0, 1.0), (7100, 1.0)]))
    early = track(spark, 3, [(0, 5.0)], start=datetime(2017, 9, 1))
    extra = {c: F.lit(None).cast("string") for c in ("vessel_name", "imo", "call_sign")}
    numbers = {c: F.lit(None).cast("double") for c in ("l", "w", "draft")}
    ais = ais.unionByName(early).withColumns({**extra, **numbers, "vessel_type": F.when(F.col("mmsi") == 1, 70), "cargo": F.lit(70)})
    by_day = str(tmp_path / "by_day")
    write_by_day(with_calendar(ais.select(*MOTION_COLUMNS, "seq")), by_day)

    paths = flows.sample(spark, by_day, ais, str(tmp_path / "sample"))
    assert spark.read.parquet(paths["motion"]).count() == 122
    assert spark.read.parquet(paths["tracks"]).select("mmsi").distinct().count() == 2
    meta = read_metadata_csv(spark, paths["metadata"])
    assert meta.columns == [f.name for f in GROUPED_METADATA.fields] and dict(meta.dtypes)["vessel_code"] == "int"
    assert {r.mmsi: (r.vessel_code, r.vessel_group) for r in meta.collect()} == {1: (70, "cargo"), 2: (None, "unknown")}

    markers, lines = flows.moving_map(spark, by_day, datetime(2017, 11, 3, 11, 59, 0), meta)
    assert [(r.mmsi, r.vessel_group, r.colour) for r in markers.collect()] == [(1, "cargo", "#CF1C90")]
    assert {"south", "west", "north", "east", "cog"} <= set(markers.columns)
    assert {(r.vessel_group, r.colour) for r in lines.collect()} == {("cargo", "#CF1C90")} and lines.count() == 60
