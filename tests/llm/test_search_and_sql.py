"""Exact search, the pipeline, and the registered queries against their SQL."""

import glob
import os
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.test_dedup import brute_components, brute_fingerprint, brute_kept
from tests.llm.test_mixing_and_benchmark import brute, shares
from tools.check import SAME, bag
from wakeline.llm import queries, topk
from wakeline.sources.scratch import materialise

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_and_sql_agree(spark, name):
    db = duckdb.connect()
    for path in glob.glob(SF + "/*.parquet"):
        db.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df, want = queries.QUERIES[name](spark, SF), db.sql(queries.SQL[name])
    assert {f.name: SAME[f.dataType.simpleString()] for f in df.schema} == dict(zip(want.columns, map(str, want.types)))
    assert bag(df.columns, df.collect()) == bag(want.columns, want.fetchall())


def test_one_query_for_each_operator():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in contract.queries()


# --- search ---------------------------------------------------------------------------


def brute_top(rows, asked, k):
    """Every row but the query's own is a candidate; every query row has its own ranks."""
    usable = [(i, w) for i, v in rows if i is not None and (w := topk.whole(v)) is not None]
    limit = lambda s: min(max(s, 1 - 2**63), 2**63 - 1)
    out = []
    for at, (q, own) in enumerate(usable):
        if q not in asked:
            continue
        scored = [(-limit(sum(a * b for a, b in zip(own, v))), i) for n, (i, v) in enumerate(usable) if n != at and len(v) == len(own)]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_top_k(spark, rows, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 50)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    rng = np.random.default_rng(1)
    given = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    given += [(i, given[0][1]) for i in range(300, 320)]  # ties
    given += [(400, None), (450, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (500, [float("nan")] * 6), (550, [float("inf")] * 6), (600, [1.0, 2.0]), (650, []), (None, [1.0] * 6), (50, given[50][1]), (700, [1e12] * 6), (701, [1e20, -1e308, 1.7e308, 0.0, 1e-300, 2.0]), (750, [-1e308] * 6), (100, given[7][1]), *[(800, given[3][1])] * 9]
    df = spark.createDataFrame(given, "vec_id long, embedding array<double>")
    df = df.withColumns({c: F.lit("x") for c in ("vector", "dim", "part", "score", "rank", "rows")})
    asked = [i for i in range(0, 850, 50)]
    for k in (1, 5, 1000):
        found = topk.top_k(df.where("vec_id % 50 = 0"), df, k)
        assert rows(found, "query_id", "rank", "vec_id", "score") == sorted(brute_top(given, asked, k), key=repr)
    assert topk.top_k(df.limit(0), df, 5).count() == topk.top_k(df, df.limit(0), 5).count() == 0


def test_repeated_rows_and_ids_are_candidates(spark, rows):
    rng = np.random.default_rng(3)
    given = [(i % 40, rng.normal(size=4).tolist()) for i in range(120)]
    given = [*given, (100, [9.0] * 4), (100, [8.0] * 4), (0, given[0][1]), (1, [7.0] * 4), (1, [7.0] * 4), (200, [])]
    df = spark.createDataFrame(given, "vec_id long, embedding array<double>")
    db = duckdb.connect()
    db.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    db.executemany("INSERT INTO embeddings VALUES (?, ?)", given)
    found = rows(topk.top_k(df.where("vec_id % 50 = 0"), df, 5), "query_id", "rank", "vec_id", "score")
    assert found == sorted(db.sql(queries.SQL["op7_topk"]).fetchall(), key=repr)
    assert found == sorted(brute_top(given, (0, 50, 100, 200), 5), key=repr)
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 1.0]), (1, [3.0, 1.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in topk.top_k(few.where("vec_id = 0"), few, 5).orderBy("rank").collect()] == [1, 1, 3, 2]


def test_text_ids_are_searched(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 1.0]), ("c", [0.0, 1.0])], "vec_id string, embedding array<double>")
    assert [(r.query_id, r.vec_id) for r in topk.top_k(df.where("vec_id = 'a'"), df, 1).collect()] == [("a", "b")]


def test_search_stops_early_and_is_exact():
    rng = np.random.default_rng(2)
    centres = rng.integers(-200, 200, (20, 16))
    data = np.concatenate([c + rng.integers(-4, 5, (100, 16)) for c in centres])
    pivots = topk.choose_pivots(data.astype(float), 16)
    block = topk.Block(np.arange(len(data)), np.ones(len(data), int), data / 256, topk.distances(data.astype(float), pivots))
    asked = topk.Block(block.ids[:40], block.copies[:40], block.vectors[:40], block.pivots[:40])
    evaluated = 0
    for i, best, score, seen in topk.search_block(asked, block, 5):
        all_scores = data @ data[i]
        want = sorted((-s, j) for j, s in enumerate(all_scores) if j != i)[:5]
        assert list(zip((-score).tolist(), best.tolist())) == want
        evaluated += seen
    assert evaluated < 40 * len(data) / 2


def brute_block(vectors, ids, copies, asked, k):
    """For each asked row, places by score and id, as many as are needed for k rows but the query's own."""
    scores = np.array([topk.whole(v) for v in vectors.tolist()], object)
    out = []
    for i in asked:
        left = [j for j in range(len(ids)) if copies[j] > 1 or j != i]
        dots = {j: min(max(int(scores[j] @ scores[i]), 1 - 2**63), 2**63 - 1) for j in left}
        out.append([(dots[j], ids[j]) for j in sorted(left, key=lambda j: (-dots[j], ids[j]))[:k]])
    return out


@pytest.mark.parametrize("case", ["long", "equal", "mixed", "no pivots", "text ids"])
def test_search_of_a_block_is_exact(case, monkeypatch):
    rng = np.random.default_rng(4)
    dim, pivots, n = (48, 2, 700) if case == "long" else (6, 0 if case == "no pivots" else 5, 700)
    data = rng.normal(size=(n, dim)) * (1 if case != "long" else np.geomspace(1, 40, n)[:, None])
    if case == "equal":
        data[:] = data[0]
    if case == "mixed":
        data *= rng.choice([1.0, 1e4, 1e7], n)[:, None]
    ids, copies = rng.permutation(n), rng.integers(1, 3, n)
    if case == "text ids":
        ids = np.array([f"é{i}" for i in ids], object)
    whole = np.floor(data * 256)
    table = topk.distances(whole, topk.choose_pivots(whole, pivots) if pivots else whole[:0])
    block = topk.Block(ids, copies, data, table)
    asked = topk.Block(*(x[:30] for x in (ids, copies, data, table)))
    found = {i: (best, score, seen) for i, best, score, seen in topk.search_block(asked, block, 4)}
    for i, want in enumerate(brute_block(data, ids, copies, range(30), 4)):
        best, score, _ = found[i]
        assert [(s, ids[j]) for s, j in zip(score.tolist(), best)] == want
    if case == "long":  # rows have bounds of their own beside those of groups
        monkeypatch.setattr(topk, "BOUND_COST", 100)
        assert sum(f[2] for f in found.values()) < sum(f[3] for f in topk.search_block(asked, block, 4))


def test_pivots_are_chosen_without_bringing_rows_of_every_task_to_the_driver(spark):
    rng = np.random.default_rng(6)
    given = [(i, rng.normal(size=16).tolist()) for i in range(32_000)]
    df = materialise(spark.createDataFrame(given, "vec_id long, embedding array<float>").repartition(64), "given")
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.openCostInBytes": "128m"}
    before = {k: spark.conf.get(k) for k in settings}
    limits = spark.sparkContext._jsc.sc().conf()
    most = limits.get("spark.driver.maxResultSize", "1g")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        limits.set("spark.driver.maxResultSize", "2m")  # 64 tasks of 500 rows hold three times as much
        found = topk.top_k(df.where("vec_id < 3"), df, 2).collect()
    finally:
        limits.set("spark.driver.maxResultSize", most)
        for k, v in before.items():
            spark.conf.set(k, v)
    given = np.floor(np.array([v for _, v in given], np.float32).astype(float) * 256).astype(int)
    for q in range(3):
        scores = given @ given[q]
        want = sorted((-s, i) for i, s in enumerate(scores.tolist()) if i != q)[:2]
        assert [(-r.score, r.vec_id) for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] == want


def test_pivot_sample_is_the_rows_of_least_hash(spark, monkeypatch):
    monkeypatch.setattr(topk, "PIVOT_SAMPLE", 50)
    df = spark.range(0, 20_000, 1, 16).select((F.col("id") % 7).alias("vec_id"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vector"))
    want = sorted((r.h, tuple(r.vector)) for r in df.select(F.xxhash64("vec_id", "vector").alias("h"), "vector").collect())[:50]
    assert sorted(tuple(r.vector) for r in topk.pivot_sample(df, 20_000).collect()) == sorted(v for _, v in want)
    assert topk.pivot_sample(df.limit(30), 30).count() == 30


def test_cells_hold_what_a_task_can_and_copies_grow_no_faster_than_rows():
    for rows in (0, 1, 5_000, 50_000, 720_000, 4_000_000, 15_000_000):
        for queries in (0, 1, rows // 50, rows):
            for k in (1, 5, 1000):
                parts, parts_q = topk.grid(rows, queries, k)
                assert rows <= parts * topk.CELL_ROWS and queries <= parts_q * topk.CELL_ROWS
                assert -(-queries // parts_q) * k <= max(topk.CELL_RESULTS, topk.QUERY_ROWS * k)
                # Divided for more tasks only while the query rows that it copies are fewer than the candidates, or eight times.
                assert parts == max(1, -(-rows // topk.CELL_ROWS)) or (parts - 1) * queries <= max(rows, 8 * queries)


# --- pipeline -------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "substring_dedup", "decontamination", "mixing"]
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(materialise(stage(spark, frames[-1], SF), name))
    for frame in frames[1:-1]:
        assert frame.columns == docs.columns and dict(frame.dtypes) == dict(docs.dtypes)
    texts = [{r.doc_id: r.text for r in f.collect()} for f in frames[:-1]]

    gone = texts[0].keys() - texts[1].keys()
    assert sum(labels.get(i) == 0 for i in gone) <= 1 and sum(labels.get(i) == 1 for i in gone) >= 0.7 * sum(labels.values())
    ids = sorted(texts[1])
    tops = brute_components([brute_fingerprint(texts[1][i]) for i in ids])
    assert set(texts[2]) == {ids[t] for t in tops}
    ids = sorted(texts[2])
    assert texts[3] == {i: b[2] for i, b in zip(ids, brute_kept([texts[2][i] for i in ids]))}
    ids = sorted(texts[3])
    assert set(texts[4]) == {i for i, b in zip(ids, brute([texts[3][i] for i in ids], items)) if not b[3]}

    mixed = frames[-1].collect()
    assert Counter(r.doc_id for r in mixed) == Counter(list(texts[4]))
    sizes = {}
    for r in frames[4].collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    assert {r.source: r.target for r in mixed} == pytest.approx(shares(sizes, (1, 2, 3)))
    again = corpus_pipeline.run(spark, SF).collect()
    assert bag(frames[-1].columns, again) == bag(frames[-1].columns, mixed)


def test_pipeline_of_no_documents(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        frame = materialise(stage(spark, frame, SF), name)
        assert frame.count() == 0
