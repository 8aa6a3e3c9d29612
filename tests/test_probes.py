import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.frames import SCHEMA, START
from wakeline.operators import probes as probing
from wakeline.operators.motion import with_calendar
from wakeline.operators.probes import binned_probes, near_places_and_times
from wakeline.sources.tables import write_by_day

PROBES = "probe_id int, start timestamp_ntz, end timestamp_ntz, lat_min double, lat_max double, lon_min double, lon_max double"


def messages(n=1500):
    rng = random.Random(1)
    rows = [(i, rng.randint(1, 30), START + timedelta(seconds=rng.randint(0, 6 * 86400)), rng.uniform(-80, 80), rng.uniform(-180, 180), 1.0, 0.0, None, None) for i in range(n)]
    rows += [(n + i, 5, START + timedelta(hours=h), 48.0, -122.5, 1.0, 0.0, None, None) for i, h in enumerate(range(0, 140))]
    return rows + [(9000, 1, None, 48.0, -122.5, 1.0, 0.0, None, None), (9001, 1, START, None, -122.5, 1.0, 0.0, None, None)]


def asked():
    rng = random.Random(2)
    out = []
    for i in range(120):
        t, y, x = START + timedelta(seconds=rng.randint(-86400, 6 * 86400)), rng.uniform(-90, 80), rng.uniform(-180, 170)
        size = rng.choice([0.0, 0.04, 0.3, 4.0, 60.0])
        out.append((i, t, t + timedelta(seconds=rng.choice([0, 59, 3000, 80_000, 9 * 86400])), y, y + size, x, x + size))
    out += [(200, START, START + timedelta(hours=3), 48.0, 48.0, -122.5, -122.5), (200, START, START, 48.0, 48.0, -122.5, -122.5)]
    out += [(201, START + timedelta(hours=1), START, -90.0, 90.0, -180.0, 180.0), (202, None, START, -90.0, 90.0, -180.0, 180.0), (203, START, START, 9.0, 8.0, 0.0, 0.0)]
    return out + [(204, datetime(1900, 1, 1), datetime(2100, 1, 1), -90.0, 90.0, -180.0, 180.0)]


def brute():
    out = []
    for p, t0, t1, y0, y1, x0, x1 in asked():
        for seq, _, t, y, x, *_ in messages():
            if None not in (t0, t1, t, y, x) and t0 <= t <= t1 and y0 <= y <= y1 and x0 <= x <= x1:
                out.append((p, seq))
    return sorted(out, key=repr)


@pytest.mark.parametrize("broadcast", [1_000_000, -1])
def test_probes_equal_a_range_join(spark, rows, monkeypatch, tmp_path, broadcast):
    monkeypatch.setattr(probing, "BROADCAST_ROWS", broadcast)
    plain = spark.createDataFrame(messages(), SCHEMA)
    given = spark.createDataFrame(asked(), PROBES)
    assert rows(near_places_and_times(plain, given, keep=("seq",)), "probe_id", "seq") == brute()
    few = given.where("probe_id != 204")
    write_by_day(with_calendar(plain.where("base_dt IS NOT NULL")), str(tmp_path / "days"))
    dated = spark.read.parquet(str(tmp_path / "days"))
    found = near_places_and_times(dated, few, keep=("seq",))
    assert rows(found, "probe_id", "seq") == [r for r in brute() if r[0] != 204]


def test_day_folders_are_pruned_at_run_time(spark, tmp_path):
    write_by_day(with_calendar(spark.createDataFrame(messages(), SCHEMA).where("base_dt IS NOT NULL")), str(tmp_path / "days"))
    dated = spark.read.parquet(str(tmp_path / "days"))
    given = spark.createDataFrame([(1, START + timedelta(days=2), START + timedelta(days=2, hours=1), -90.0, 90.0, -180.0, 180.0)], PROBES)
    found = near_places_and_times(dated, given)
    assert found.count() > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    read = [m for m in _metrics(found._jdf.queryExecution().executedPlan()) if m[0] == "numPartitions"]
    days = dated.select("year", "month", "day").distinct().count()
    assert read and min(v for _, v in read) < days


def _metrics(node):
    """(name, value) of all scan metrics below a physical plan."""
    out = []
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _metrics(node.executedPlan())
    if name == "FileSourceScanExec":
        for key in ("numPartitions", "numFiles"):
            found = node.metrics().get(key)
            if found.isDefined():
                out.append((key, found.get().value()))
    children = node.children()
    for i in range(children.size()):
        out += _metrics(children.apply(i))
    if name.endswith("QueryStageExec"):
        out += _metrics(node.plan())
    return out


def test_a_probe_covers_few_bins(spark):
    most = binned_probes(spark.createDataFrame(asked(), PROBES)).groupBy("probe_id", "start").count().agg(F.max("count")).first()[0]
    assert most <= 8
    assert near_places_and_times(spark.createDataFrame(messages(5), SCHEMA), spark.createDataFrame([], PROBES)).count() == 0


def test_bins_hold_few_messages_outside_of_the_probe(spark):
    """Of the volume of a probe's bins, its box and interval fill more than a fifth on average."""
    rng = random.Random(3)
    given = []
    for i in range(300):
        t, y, x = START + timedelta(seconds=rng.randint(0, 86400)), rng.uniform(40, 50), rng.uniform(-130, -120)
        size = rng.choice([0.125, 0.8])
        given.append((i, t, t + timedelta(seconds=rng.choice([300, 900, 9000])), y, y + size, x, x + size))
    binned = binned_probes(spark.createDataFrame(given, PROBES), probing.PARTS)
    volume = binned.groupBy("probe_id").agg(F.count(F.lit(1)).alias("n"), F.first("_t").alias("t"), F.first("_p").alias("p")).collect()
    asked_for = {p: (t1 - t0).total_seconds() * (y1 - y0) * (x1 - x0) for p, t0, t1, y0, y1, x0, x1 in given}
    filled = [asked_for[r.probe_id] / (r.n * probing.TIME_BINS[r.t] * probing.PLACE_BINS[r.p] ** 2) for r in volume]
    assert len(filled) == 300 and sum(filled) / 300 > 0.2
    assert max(r.n for r in volume) <= (probing.PARTS + 1) ** 3


def test_crowded_bins_are_dealt(spark, rows, monkeypatch, tmp_path):
    monkeypatch.setattr(probing, "BROADCAST_ROWS", 500)
    monkeypatch.setattr(probing, "CELL_ROWS", 2)
    alike = [(300 + i, START + timedelta(hours=1), START + timedelta(hours=3), 47.9, 48.1, -122.6, -122.4) for i in range(7)]
    few = spark.createDataFrame(asked() + alike, PROBES).where("probe_id != 204")
    write_by_day(with_calendar(spark.createDataFrame(messages(), SCHEMA).where("base_dt IS NOT NULL")), str(tmp_path / "days"))
    found = near_places_and_times(spark.read.parquet(str(tmp_path / "days")), few, keep=("seq",))
    got = rows(found, "probe_id", "seq")
    assert [r for r in got if r[0] < 300] == [r for r in brute() if r[0] != 204]
    near = [r[1] for r in got if r[0] == 300]
    assert len(near) >= 3 and [r for r in got if r[0] >= 300] == [(300 + i, seq) for i in range(7) for seq in near]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_share" in plan
    assert "dynamicpruning" in plan  # too many bins to broadcast, yet only the days asked for
