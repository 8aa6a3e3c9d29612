"""Exact top-k inner product search with a pivot table.

Vectors become whole numbers. A pivot table holds each vector's distances to many pivots; the largest
difference between a query's and a candidate's distances bounds their distance from below, and with
the two lengths that bounds their inner product from above. Candidates that lie together are a group with one bound,
from the least and the largest of their distances to each pivot. Groups are evaluated in the order of that bound, each as one
matrix product, until the k-th best score exceeds every bound that is left; in a group the rows' own bounds are used where
vectors are so long that a bound costs less than a product.

Rows equal in id and vector are one entry with a count. Entries are packed in blocks together with their row of the pivot
table, which is computed once. Blocks are dealt over a grid: a cell holds a part of the queries and a part of the candidates,
is one task's work, and keeps k entries a query. Nothing that grows with the tables comes to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, FloatType

from wakeline.sources.scratch import materialise

PIVOTS = 32
#: Rows that the pivots are chosen from (those with the least hash of id and vector).
PIVOT_SAMPLE = 2000
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
#: Rows of a cell of the grid, on either side, and results that a cell may have: what a task holds.
CELL_ROWS = 131_072
CELL_RESULTS = 500_000
#: Pairs from which a cell is divided, while there are fewer than ``CELLS``.
CELL_PAIRS = 2**28
CELLS = 64
#: Rows of a group of candidates at most, and queries that are evaluated together.
GROUP_ROWS = 512
#: A row's own bound costs as much as a product of so many components for each pivot.
BOUND_COST = 8
_EXACT_32 = 2.0**24
_EXACT = 2.0**53
_MOST = 2**63 - 1


def whole(vector: list[float] | None, scale: int = 256) -> list[int] | None:
    """floor(scale * x) of each component; None for a null vector or one with a null or non-finite component."""
    if vector is None or any(x is None or not np.isfinite(x) for x in vector):
        return None
    return [math.floor(Fraction(x) * scale) for x in vector]


def kinds(vectors: np.ndarray) -> np.ndarray:
    """0 for rows whose inner products with each other are exact in 32-bit floats of floor(256 x), 1 for those that need 64, 2 beyond."""
    with np.errstate(over="ignore"):
        most = np.floor(np.abs(vectors).max(1, initial=0).astype(np.float64) * 256) + 1
        most = most * most * max(1, vectors.shape[1])
    return (most >= _EXACT_32).astype(np.int8) + (most >= _EXACT)


def integers(vectors: np.ndarray, kind: int, scale: int = 256) -> np.ndarray:
    """floor(scale * x) of rows of one of ``kinds``: as 32-bit floats, 64-bit floats or Python integers."""
    if kind == 2:
        return np.array([whole(row, scale) for row in vectors.tolist()], object).reshape(vectors.shape)
    return np.floor(vectors * vectors.dtype.type(scale)).astype(np.float64 if kind else np.float32)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of ``integers``: whole floats where these are exact, beyond from Python integers; they stop at 64 bits."""
    if a.dtype != object and b.dtype != object:
        return a @ b.T
    a, b = (x if x.dtype == object else x.astype(np.int64).astype(object) for x in (a, b))
    return np.clip(a @ b.T, -_MOST, _MOST).astype(np.int64)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of floats to the pivots; NaN where they are beyond the range of floats."""
    with np.errstate(over="ignore", invalid="ignore"):
        square = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * (x @ pivots.T)
        return np.sqrt(np.maximum(square, 0))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first: each pivot is the row farthest from those chosen before."""
    if not len(sample):
        return sample
    chosen = [0]
    near = distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(count, len(sample)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


@dataclass
class Block:
    """Entries of one dimension: ids, how many rows each is, vectors, and their rows of the pivot table."""

    ids: np.ndarray
    copies: np.ndarray
    vectors: np.ndarray
    pivots: np.ndarray


def lengths(vectors: np.ndarray) -> np.ndarray:
    """Squared lengths of floor(256 x)."""
    with np.errstate(over="ignore"):
        x = np.floor(vectors.astype(np.float64) * 256)
        return (x * x).sum(1)


#: Share of itself and of the two lengths by which a distance in 32 bits may be off.
_OFF = 3e-7


@dataclass
class Group:
    """Rows of a block that are of one kind and near one pivot: places, whole numbers, and what bounds their products."""

    places: np.ndarray
    whole: np.ndarray
    pivots: np.ndarray
    length: np.ndarray
    off: np.ndarray

    @property
    def as_one(self) -> Group:
        """Least and largest distances to the pivots (2 rows), the greatest length and offset."""
        ends = np.stack((self.pivots.min(0, initial=np.inf), self.pivots.max(0, initial=0))) if self.pivots.shape[1] else self.pivots[:2]
        return Group(self.places, self.whole, ends, self.length.max(keepdims=True), self.off.max(keepdims=True))


def groups(block: Block, size: int) -> Iterator[Group]:
    """All rows of a block in groups of at most ``size``, by nearest pivot and the distance to it."""
    length = lengths(block.vectors)
    with np.errstate(over="ignore", invalid="ignore"):
        pivots = block.pivots.astype(np.float32)
        off = _OFF * (pivots.max(1, initial=0).astype(np.float64) + np.sqrt(length))
    kind, rows = kinds(block.vectors), np.arange(len(pivots))
    near = pivots.argmin(1) if pivots.shape[1] else np.zeros(len(rows), int)
    order = np.lexsort((pivots[rows, near], near, kind)) if pivots.shape[1] else np.argsort(kind, kind="stable")
    for one in range(3):
        some = order[kind[order] == one]
        for at in range(0, len(some), size):
            part = some[at : at + size]
            yield Group(part, integers(block.vectors[part], one), pivots[part], length[part], off[part])


def bounds(query: Group, low: np.ndarray, high: np.ndarray, length: np.ndarray, off: np.ndarray) -> np.ndarray:
    """No inner product of a query (row) with a vector that is between ``low`` and ``high`` from the pivots (a row a pivot), of at most
    this squared length, is above these; infinite where floats cannot tell."""
    apart = np.zeros((len(query.places), len(length)), np.float32)
    with np.errstate(over="ignore", invalid="ignore"):
        for p in range(len(low)):
            own = query.pivots[:, p, None]
            np.maximum(apart, low[p] - own, out=apart)
            np.maximum(apart, own - high[p], out=apart)
        apart = np.maximum(apart - (query.off[:, None] + off), 0)
        both = query.length[:, None] + length
        # Scores stop at 64 bits, from below as well.
        bound = np.maximum((both - apart * apart) / 2 + 1e-9 * both + 1e-6, -(2.0**63))
    return np.where(np.isfinite(bound), bound, np.inf)


class Best:
    """The k best entries of each query of a group so far, by score and then by the id's place among all ids."""

    def __init__(self, k: int, queries: int) -> None:
        self.k, self.limit, self.last = k, np.full(queries, -np.inf), np.full(queries, -1)
        self.least = np.full(queries, -_MOST - 1)
        self.held = [np.zeros((4, 0), np.int64)]
        self.more = 0

    def add(self, asker: np.ndarray, place: np.ndarray, score: np.ndarray, code: np.ndarray) -> None:
        """Of equal scores the smaller id: an entry as good as the last of ``k`` is in only before that one."""
        some = (score > self.least[asker]) | (code < self.last[asker]) | np.isneginf(self.limit[asker])
        self.held.append(np.stack((asker[some], place[some], score[some], code[some])))
        self.more += int(some.sum())
        if self.more > self.k * len(self.limit):
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Askers, places and scores that are left, in order."""
        every = np.concatenate(self.held, 1)
        asker, _, score, code = every = every[:, np.lexsort((every[3], -every[2], every[0]))]
        rank = np.arange(len(asker)) - np.searchsorted(asker, asker)
        self.held, self.more = [every[:, rank < self.k]], 0
        kth = rank == self.k - 1
        self.least[asker[kth]], self.last[asker[kth]], self.limit[asker[kth]] = score[kth], code[kth], score[kth]
        return tuple(self.held[0][:3])


def search(query: Block, rows: Block, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(places of some queries, how many candidates of each were evaluated; and for each of their best entries the query's place,
    the candidate's place and the score): those that make ``k`` rows without the query's own; of equal scores the smaller id."""
    if not len(query.ids) or not len(rows.ids):
        return
    _, code = np.unique(np.concatenate((rows.ids, query.ids)), return_inverse=True)
    code, code_q = code[: len(rows.ids)], code[len(rows.ids) :]
    candidates = list(groups(rows, min(GROUP_ROWS, max(32, len(rows.ids) // 32))))
    ends = [g.as_one for g in candidates]
    low, high = (np.ascontiguousarray(np.stack([e.pivots[n] for e in ends]).T) if rows.pivots.shape[1] else np.zeros((0, len(ends))) for n in (0, 1))
    length, off = (np.concatenate(x) for x in ([e.length for e in ends], [e.off for e in ends]))
    by_row = rows.vectors.shape[1] > BOUND_COST * rows.pivots.shape[1] > 0

    for asked in groups(query, GROUP_ROWS):
        best, seen = Best(k, len(asked.places)), np.zeros(len(asked.places), np.int64)
        bound = bounds(asked, low, high, length, off)
        most = bound.max(0)
        for n in np.argsort(-most, kind="stable"):
            if most[n] < best.limit.min():
                break
            group = candidates[n]
            asks = np.flatnonzero(bound[:, n] >= best.limit)
            if not len(asks):
                continue
            places, numbers = group.places, group.whole
            if by_row:
                own = Group(asked.places[asks], asked.whole, asked.pivots[asks], asked.length[asks], asked.off[asks])
                left = bounds(own, group.pivots.T, group.pivots.T, group.length, group.off) >= best.limit[asks, None]
                asks, some = asks[left.any(1)], left.any(0)
                places, numbers = places[some], numbers[some]
                if not len(asks):
                    continue
            seen[asks] += len(places)
            score = products(asked.whole if len(asks) == len(asked.places) else asked.whole[asks], numbers)
            least = best.limit[asks]
            if len(places) > k + 1 and np.isneginf(least).any():
                # One more than k, for one may be the query's own.
                least = np.maximum(least, np.partition(score, len(places) - k - 1, 1)[:, len(places) - k - 1])
            if score.dtype == np.float32:  # as all scores here are exact, the limit need be no larger than these can be
                least = np.clip(least, -_EXACT_32, _EXACT_32).astype(np.float32)
            reach = score.max(1) >= least
            asks, score, least = asks[reach], score[reach], least[reach]
            if not len(asks):
                continue
            hits = np.flatnonzero(score >= least[:, None])
            asker, place = np.divmod(hits, len(places))
            asker, place, score = asks[asker], places[place], score.ravel()[hits].astype(np.int64)
            same = np.flatnonzero(code[place] == code_q[asked.places[asker]])
            own = (rows.vectors[place[same]] == query.vectors[asked.places[asker[same]]]).all(1) & (rows.copies[place[same]] == 1)
            if own.any():
                asker, place, score = (np.delete(x, same[own]) for x in (asker, place, score))
            best.add(asker, place, score, code[place])
        asker, place, score = best.cut()
        yield asked.places, seen, asked.places[asker], place, score


def search_block(query: Block, rows: Block, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """``search`` by query: (its place, candidates' places, scores, how many were evaluated)."""
    for places, seen, asker, best, score in search(query, rows, k):
        for i, n in zip(places.tolist(), seen.tolist()):
            of = asker == i
            yield i, best[of], score[of], n


_BLOCK = "dim int, ids array<{kind}>, copies array<long>, vectors binary, table binary"


def _pack(rows: int, pivots: dict[int, np.ndarray]):
    """Entries of one length to blocks: a block's vectors (in 32 bits if these hold them) and pivot distances are binary values."""

    def block(dim: int, parts: list[tuple]) -> pa.RecordBatch:
        ids, copies, vectors = (pa.concat_arrays([p[n] for p in parts]) if n < 2 else np.concatenate([p[2] for p in parts]) for n in range(3))
        with np.errstate(over="ignore"):
            table = distances(np.floor(vectors.astype(np.float64) * 256), pivots.get(dim, np.zeros((0, dim)))).astype(np.float32)
            short = vectors.astype(np.float32)
            vectors = short if (short == vectors).all() else vectors

        def listed(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        return pa.RecordBatch.from_arrays(
            [
                pa.array([dim], pa.int32()),
                listed(ids),
                listed(copies),
                pa.array([vectors.tobytes()], pa.binary()),
                pa.array([table.tobytes()], pa.binary()),
            ],
            names=["dim", "ids", "copies", "vectors", "table"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            vectors = batch.column("vector")
            sizes = np.asarray(pc.list_value_length(vectors))
            for dim in np.unique(sizes).tolist():
                some = pa.array(np.flatnonzero(sizes == dim))
                flat = vectors.take(some).flatten().to_numpy(zero_copy_only=False).reshape(len(some), dim)
                for at in range(0, len(some), rows):
                    part = some.slice(at, rows)
                    held.setdefault(dim, []).append((batch.column("vec_id").take(part), batch.column("n").take(part), flat[at : at + rows]))
                    if sum(len(p[0]) for p in held[dim]) >= rows:
                        yield block(dim, held.pop(dim))
        for dim, parts in held.items():
            yield block(dim, parts)

    return run


def _meet(k: int, id_type: pa.DataType):
    def unpacked(cell: pa.Table, dim: int) -> tuple[Block, pa.Array]:
        """All blocks of a side of a cell as one."""
        sizes = np.asarray(pc.list_value_length(cell["ids"]))

        def matrix(name: str) -> np.ndarray:
            packed = [np.frombuffer(v.as_buffer(), np.uint8) for v in cell[name]]
            if name == "table":
                return np.concatenate([x.view(np.float32).reshape(n, -1) for x, n in zip(packed, sizes)])
            return np.concatenate([x.view(np.float32 if len(x) == 4 * n * dim else np.float64).reshape(n, dim) for x, n in zip(packed, sizes)])

        ids, copies = (pc.list_flatten(cell[name]).combine_chunks() for name in ("ids", "copies"))
        return Block(ids.to_numpy(zero_copy_only=False), copies.to_numpy(zero_copy_only=False), matrix("vectors"), matrix("table")), ids

    def run(candidates: pa.Table, asking: pa.Table) -> pa.Table:
        names = ["block_q", "place_q", "query_id", "asked", "vec_id", "n", "score"]
        types = [pa.int64(), pa.int64(), id_type, pa.int64(), id_type, pa.int64(), pa.int64()]
        if not candidates.num_rows or not asking.num_rows:
            return pa.table([pa.array([], t) for t in types], names)
        dim = asking["dim"][0].as_py()
        (query, ids_q), (rows, ids) = unpacked(asking, dim), unpacked(candidates, dim)
        sizes = np.asarray(pc.list_value_length(asking["ids"]))
        block_q = np.repeat(asking["block_q"].to_numpy(), sizes)
        place_q = np.concatenate([np.arange(n) for n in sizes])
        found = [x[2:] for x in search(query, rows, k)]
        asker, place, score = (np.concatenate([x[n] for x in found]) for n in range(3))
        same = np.flatnonzero(rows.ids[place] == query.ids[asker])
        own = np.zeros(len(place), np.int64)
        own[same] = (rows.vectors[place[same]] == query.vectors[asker[same]]).all(1)
        columns = [block_q[asker], place_q[asker], ids_q.take(pa.array(asker)), query.copies[asker], ids.take(pa.array(place)), rows.copies[place] - own, score]
        return pa.table([pa.array(x, t) if isinstance(x, np.ndarray) else x.cast(t) for x, t in zip(columns, types)], names)

    return run


def grid(rows: int, queries: int, k: int) -> tuple[int, int]:
    """Into how many parts candidates and queries are dealt. Cells are as large as a task can hold, so that copies of rows grow no faster
    than that makes them; smaller ones, for more tasks at a time, do not copy more query rows than there are candidates."""
    most = max(1, min(CELL_ROWS, max(QUERY_ROWS, CELL_RESULTS // k)))
    of_queries = max(1, -(-queries // most))
    cells = max(8, min(CELLS, -(-rows * queries // CELL_PAIRS)))
    wanted = min(-(-cells // of_queries), max(8, -(-rows // max(1, queries))), -(-rows // BLOCK_ROWS))
    return max(1, -(-rows // CELL_ROWS), wanted), of_queries


def pivot_sample(rows: DataFrame, count: int) -> DataFrame:
    """The ``PIVOT_SAMPLE`` entries, of ``count`` different ones, with the least hash. A sort for so few takes as many from each task, all to
    the driver, so only hashes below a limit are sorted, twice the number that is wanted."""
    hashed = rows.select("vec_id", "vector", F.xxhash64("vec_id", "vector").alias("hash"))
    share = 2 * PIVOT_SAMPLE / max(1, count)
    if share < 1:
        hashed = hashed.where(F.col("hash") < int(2**64 * share) - 2**63)
    return hashed.orderBy("hash", "vec_id", "vector").limit(PIVOT_SAMPLE).select("vector")


def top_k(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector: str = "embedding",
    pivots: int = PIVOTS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` largest integer inner products of each query row.

    A query meets every row of its length but its own: of rows equal in id and vector one is the query's, all others are candidates
    like any other, and each query row has ranks of its own. Ties go to the smaller vec_id. Rows with
    a null id, or a vector that is null or holds null or non-finite components, take no part; finite components of any size do.
    Scores beyond 64 bits stop at the limit. Fewer rows than ``k`` are all returned; empty tables give no rows. Ids keep
    their type. Other columns are not read.
    """
    if k < 1:
        raise ValueError("k must be positive")

    def entries(df: DataFrame) -> DataFrame:
        named = df.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
        if named.schema["vector"].dataType != ArrayType(FloatType()):  # which half of the bytes hold
            named = named.withColumn("vector", F.col("vector").cast("array<double>"))
        usable = named.where(
            F.col("vec_id").isNotNull()
            & F.col("vector").isNotNull()
            & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        )
        return usable.groupBy("vec_id", "vector").agg(F.count(F.lit(1)).alias("n"))

    rows, asked = materialise(entries(vectors), "vectors"), materialise(entries(queries), "queries")
    kind = rows.schema["vec_id"].dataType
    n_rows, n_asked = rows.count(), asked.count()
    by_dim: dict[int, list[list[float]]] = {}
    for r in pivot_sample(rows, n_rows).collect():
        by_dim.setdefault(len(r.vector), []).append(r.vector)
    with np.errstate(over="ignore"):
        samples = {dim: np.floor(np.array(v, np.float64).reshape(len(v), dim) * 256) for dim, v in by_dim.items()}
    table = {dim: choose_pivots(x[np.isfinite(x).all(1)], pivots) for dim, x in samples.items()}
    parts, parts_q = grid(n_rows, n_asked, k)

    def packed(df: DataFrame, size: int) -> DataFrame:
        blocks = df.mapInArrow(_pack(size, table), _BLOCK.format(kind=kind.simpleString()))
        return blocks.withColumn("block", F.monotonically_increasing_id())

    def dealt(parts: int) -> Column:
        """The blocks of a partition go to one part after the other."""
        partition, place = F.shiftright("block", 33), F.col("block").bitwiseAND(2**33 - 1)
        return F.pmod(F.xxhash64(partition) % parts + place, F.lit(parts))

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))

    given = packed(rows, BLOCK_ROWS).withColumn("part", dealt(parts)).withColumn("part_q", every(parts_q))
    asking = materialise(packed(asked, QUERY_ROWS), "query-blocks")
    asking = asking.withColumn("part_q", dealt(parts_q)).withColumn("part", every(parts)).withColumnRenamed("block", "block_q")
    id_name = kind.simpleString()
    cell = ["part", "part_q", "dim"]
    found = (
        given.groupBy(*cell)
        .cogroup(asking.groupBy(*cell))
        .applyInArrow(
            _meet(k, to_arrow_type(kind)),
            f"block_q long, place_q long, query_id {id_name}, asked long, vec_id {id_name}, n long, score long",
        )
    )
    # Of the best entries of all cells, k; then as many rows as each has, up to k in all.
    by_query = Window.partitionBy("block_q", "place_q").orderBy(F.desc("score"), "vec_id", "n")
    first = found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    before = F.coalesce(F.sum("n").over(by_query.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = first.withColumn("before", before).where(F.col("before") < k)
    last = F.least(F.lit(k), F.col("before") + F.col("n"))
    each = ranked.withColumn("rank", F.explode(F.sequence(F.col("before") + 1, last)))
    return each.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("asked")))).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
