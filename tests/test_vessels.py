import pytest
from pyspark.sql import functions as F

from tests.frames import START
from wakeline.functions.codes import group_map, speed_colour, vessel_group
from wakeline.operators.vessels import (
    group_memberships,
    group_of_id,
    group_page,
    group_sizes,
    index_documents,
    lookup_group,
    number_range,
    sort_by_type,
    term_search,
    tracks_in_group,
    upsert,
    vessel_metadata,
    with_group_colour,
    with_vessel_group,
)

ATTRIBUTES = (
    "seq int, mmsi int, base_dt timestamp_ntz, vessel_type int, vessel_name string, imo string, call_sign string, "
    "cargo int, l double, w double, draft double"
)


def types(spark, *pairs):
    return with_vessel_group(spark.createDataFrame(list(pairs), "mmsi int, vessel_type int"))


def test_first_known_value_in_time_order(spark):
    rows = [
        (2, 1, START, None, "Late, Name", None, None, None, 20.0, None, float("nan")),
        (1, 1, START, None, "Early", None, "WD1", 70, 10.0, None, 4.0),
        (3, 1, START, 36, None, None, "WD2", 71, None, None, None),
        (1, 2, START, None, None, None, None, None, None, None, None),
    ]
    meta = {r.mmsi: r for r in vessel_metadata(spark.createDataFrame(rows, ATTRIBUTES)).collect()}
    assert tuple(meta[1])[1:] == (36, "Early", None, "WD1", 70, 15.0, None, 4.0)
    assert tuple(meta[2])[1:] == (None,) * 8


def test_groups(spark, rows):
    meta = types(spark, (1, 52), (2, 33), (3, None), (4, 0), (5, 1024), (6, 60))
    assert rows(meta, "mmsi", "vessel_group") == [
        (1, "publicService"), (2, None), (3, "unknown"), (4, None), (5, "tanker"), (6, "passenger")
    ]
    assert rows(group_memberships(meta)) == [
        (1, "publicService"), (1, "tugTow"), (3, "unknown"), (5, "tanker"), (6, "passenger")
    ]
    assert rows(group_of_id(group_memberships(meta)))[0] == (1, "tugTow")
    assert dict(rows(group_sizes(meta)))[None] == 2


@pytest.mark.parametrize("group, want", [("tugTow", [1]), ("publicService", [1]), ("unknown", [3]), ("cargo", [])])
def test_tracks_in_group(spark, group, want):
    meta = types(spark, (1, 52), (2, 33), (3, None))
    tracks = spark.createDataFrame([(m,) for m in (1, 2, 3, 4)], "mmsi int")
    assert [r.mmsi for r in tracks_in_group(tracks, meta, group).collect()] == want


def test_group_map_agrees_with_the_expression(spark):
    mapped = group_map(spark).groupBy("code").agg(F.min_by("vessel_group", "priority").alias("g"))
    assert mapped.where(~F.col("g").eqNullSafe(vessel_group(F.col("code")))).count() == 0
    assert group_map(spark).count() == 67


def test_sort_puts_missing_types_first(spark):
    meta = types(spark, (3, 70), (2, None), (1, 70), (4, 30))
    assert [r.mmsi for r in sort_by_type(meta).collect()] == [2, 4, 1, 3]


def test_lookup_keeps_vessels_without_metadata(spark, rows):
    found = lookup_group(spark.createDataFrame([(1,), (9,)], "mmsi int"), types(spark, (1, 70)))
    assert rows(with_group_colour(found), "mmsi", "vessel_group", "colour") == [(1, "cargo", "#CF1C90"), (9, None, None)]


def index(spark):
    meta = types(spark, (11, 70), (12, 33), (13, 52))
    sizes = spark.createDataFrame([(11, 100.0, 20.0, 5.0), (12, None, None, None), (13, float("nan"), 5.0, 1.0)],
                                  "mmsi int, l double, w double, draft double")
    return index_documents(meta.join(sizes, "mmsi"))


def test_index_sentinels(spark, rows):
    assert rows(index(spark)) == [
        ("meta_11", "cargo", 100.0, 20.0, 5.0),
        ("meta_12", "unknown", -999.0, -999.0, -999.0),
        ("meta_13", "publicService", -999.0, 5.0, 1.0),
    ]
    assert rows(number_range(index(spark), "length", -1000, 1000), "doc_id") == [("meta_11",)]


def test_terms_match_whole_words_in_any_case(spark, rows):
    assert rows(term_search(index(spark), "CARGO")) == [(11,)]
    assert rows(term_search(index(spark), "car")) == []
    assert rows(group_page(index(spark), "unknown", size=1)) == [(12,)]
    assert rows(group_page(index(spark), "unknown", after=12, size=1)) == []


def test_upsert_keeps_the_last_version(spark, rows):
    docs = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("b", 1, "y"), ("a", 3, None)], "doc_id string, v int, t string")
    assert rows(upsert(docs, ["v"])) == [("a", 3, None), ("b", 1, "y")]


def test_speed_colours(spark):
    colours = spark.range(6).select(speed_colour(F.col("id").cast("int")).alias("c")).collect()
    assert [r.c for r in colours] == ["cyan", "orange", "green", "purple", "red", None]
