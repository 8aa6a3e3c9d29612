"""SimHash near-duplicates through a self-join of a binary trie.

Fingerprints are made where the text is; only (fingerprint, doc_id) moves on. Four differing bits
cannot touch all five blocks of 64 bits, so a pair of linked fingerprints agrees in one block at
least: each different fingerprint goes to five places, one a block, and the rows that agree in it
form one trie over the other bits. Pairs of trie nodes are walked together, all of one depth at
once; a pair is dropped as soon as its differing bits exceed the budget. What a walk finds is
reduced to a spanning forest on the spot, so a dense group never leaves all of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from wakeline.llm.components import smallest_reachable
from wakeline.sources.scratch import materialise

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SHINGLES_AT_ONCE = 1 << 18
#: Pairs of trie nodes that are walked together; more are put aside and walked later.
_FRONTIER = 1 << 19
#: Fingerprints that one walk takes, unless a single block value has more.
_AT_ONCE = 1 << 16
_LEAF = 4
#: Fingerprints of one block value from which on the value is divided by further bits.
CROWDED = 200_000
#: Crowded values that may be broadcast; they are counted first.
BROADCAST_ROWS = 400_000


def fingerprint(text: str | None, size: int = 4, seed: int = 42) -> int:
    """SimHash of the A-Z lower-cased text over ``size``-word shingles; 0 without words."""
    flat = b" ".join((text or "").encode().translate(_LOWER).split())
    if not flat:
        return 0
    gaps = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32)
    count = len(gaps) + 1
    if count <= size:
        return xxh64_intdigest(flat, seed)
    starts = np.concatenate(([0], gaps + 1))[: count - size + 1].tolist()
    ends = np.concatenate((gaps, [len(flat)]))[size - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _SHINGLES_AT_ONCE):
        some = slice(at, at + _SHINGLES_AT_ONCE)
        hashes = np.array([xxh64_intdigest(flat[a:z], seed) for a, z in zip(starts[some], ends[some])], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(starts))
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 4) -> DataFrame:
    """doc_id, key1, key2, fingerprint (long, the 64 bits as a signed number) for each row of ``docs``. The keys
    are 128 bits that name the id together with the text."""
    names = ["doc_id", "key1", "key2"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t.as_py(), size) for t in batch.column("text")], np.uint64)
            columns = [*(batch.column(c) for c in names), pa.array(made.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "fingerprint"])

    slim = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), *row_key(F.col(f"`{id_col}`"), F.col(f"`{text}`")), F.col(f"`{text}`").cast("string").alias("text")
    )
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(rows, f"doc_id {kind}, key1 long, key2 long, fingerprint long")


def row_key(id_col: Column, text: Column) -> tuple[Column, Column]:
    """128 bits that name an id (null is one too) together with a text."""
    known = F.concat(id_col.isNull().cast("string"), text.isNull().cast("string"))
    return F.xxhash64(known, id_col, text).alias("key1"), F.xxhash64(F.lit("second"), text, known, id_col).alias("key2")


def blocks(budget: int, bits: int = 64) -> list[tuple[int, int]]:
    """Begin and width of budget + 1 blocks that make up ``bits`` bits."""
    edges = [round(i * bits / (budget + 1)) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


class _Forest:
    """Labels of the rows of one walk: each row ends at the first row of its component."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while len(a):
            x, y = label[a], label[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label[:] = up


def trie_join(keys: np.ndarray, fixed: np.ndarray, depth0: int, budget: int) -> np.ndarray:
    """Label of each key's component. ``keys``: sorted, distinct, 64-bit; ``fixed``: their first
    ``depth0`` bits, in which linked keys must agree."""
    forest = _Forest(len(keys))
    first = np.flatnonzero(np.concatenate(([True], fixed[1:] != fixed[:-1])))
    last = np.concatenate((first[1:], [len(keys)]))
    start = np.stack([first, last, first, last, np.zeros_like(first)])
    work = [(depth0, start[:, last - first > 1])]
    ones: dict[int, np.ndarray] = {}
    while work:
        depth, pairs = work.pop()
        while pairs.shape[1]:
            if pairs.shape[1] > _FRONTIER:
                half = pairs.shape[1] // 2
                work.append((depth, pairs[:, half:]))
                pairs = pairs[:, :half]
                continue
            size_a, size_b = pairs[1] - pairs[0], pairs[3] - pairs[2]
            # All that is left is compared bit by bit at small nodes, or when the bits are used up.
            leaf = (size_a * size_b <= _LEAF) | (depth == 64)
            if leaf.any():
                _compare(keys, pairs[:, leaf], budget, forest)
                pairs = pairs[:, ~leaf]
                if not pairs.shape[1]:
                    break
            if depth not in ones:
                bit = (keys >> np.uint64(63 - depth)) & np.uint64(1)
                ones[depth] = np.concatenate(([0], np.cumsum(bit.astype(np.int64))))
            o = ones[depth]
            mid_a = pairs[1] - (o[pairs[1]] - o[pairs[0]])
            mid_b = pairs[3] - (o[pairs[3]] - o[pairs[2]])
            a0, a1, b0, b1, err = pairs
            same = (a0 == b0) & (a1 == b1)
            kids = [
                np.stack([a0, mid_a, b0, mid_b, err]),
                np.stack([mid_a, a1, mid_b, b1, err]),
                np.stack([a0, mid_a, mid_b, b1, err + 1]),
                np.stack([mid_a, a1, b0, mid_b, err + 1])[:, ~same],
            ]
            pairs = np.concatenate(kids, axis=1)
            alone = (pairs[0] == pairs[2]) & (pairs[1] == pairs[3]) & (pairs[1] - pairs[0] < 2)
            pairs = pairs[:, (pairs[4] <= budget) & (pairs[0] < pairs[1]) & (pairs[2] < pairs[3]) & ~alone]
            depth += 1
    return forest.label


def _compare(keys: np.ndarray, pairs: np.ndarray, budget: int, forest: _Forest) -> None:
    a0, a1, b0, b1, _ = pairs
    count = (a1 - a0) * (b1 - b0)
    row = np.repeat(np.arange(len(count)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    wide = (b1 - b0)[row]
    i, j = a0[row] + step // wide, b0[row] + step % wide
    near = (i != j) & (_popcount(keys[i] ^ keys[j]) <= budget)
    forest.add(i[near], j[near])


def _front(prints: np.ndarray, places: list[int]) -> np.ndarray:
    """The fingerprints with their bits in the order of ``places`` (from the highest bit down)."""
    out = np.zeros_like(prints)
    for at, place in enumerate(places):
        out |= ((prints >> np.uint64(place)) & np.uint64(1)) << np.uint64(63 - at)
    return out


def _order(budget: int, block: int, sub: int) -> tuple[list[int], int]:
    """Bit places with those first in which the rows of (block, sub) agree, and their number."""
    shift, width = blocks(budget)[block]
    first = list(range(shift + width - 1, shift - 1, -1))
    rest = [p for p in range(63, -1, -1) if p not in first]
    if sub >= 0:
        inner, size = blocks(budget, len(rest))[sub]
        first += rest[inner : inner + size]
        rest = [p for p in rest if p not in first]
    return first + rest, len(first)


def _walk(budget: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = []
        held = 0

        def joined(which: np.ndarray) -> Iterator[pa.RecordBatch]:
            for block, sub in sorted({(int(b), int(u)) for b, u in np.unique(which[:, [0, 1]], axis=0)}):
                own = which[(which[:, 0] == block) & (which[:, 1] == sub), 3].view(np.uint64)
                places, depth = _order(budget, block, sub)
                keys = _front(own, places)
                order = np.argsort(keys)
                own, keys = own[order], keys[order]
                label = trie_join(keys, keys >> np.uint64(64 - depth) if depth else keys * np.uint64(0), depth, budget)
                linked = np.flatnonzero(label != np.arange(len(keys)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[linked].view(np.int64)), pa.array(own[label[linked]].view(np.int64))], names=["a", "b"]
                )

        for batch in batches:
            rest.append(np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("block", "sub", "value", "fingerprint")], axis=1))
            held += batch.num_rows
            if held < _AT_ONCE:
                continue
            which = np.concatenate(rest)
            # Rows come in order of (block, sub, value): the last group may go on in the next batch.
            change = np.flatnonzero((which[1:, :3] != which[:-1, :3]).any(1)) + 1
            cut = change[-1] if len(change) else 0
            if cut:
                yield from joined(which[:cut])
            rest, held = [which[cut:]], len(which) - cut
        if held:
            yield from joined(np.concatenate(rest))

    return rows


def _bits(budget: int, sub: int) -> Column:
    """The bits in which the rows of a group agree, as one number, for each block."""
    value = F.lit(None).cast("long")
    for block in range(budget + 1):
        places, depth = _order(budget, block, sub)
        own = F.lit(0).cast("long")
        for i, place in enumerate(places[:depth]):
            own = own.bitwiseOR(F.shiftleft(F.shiftright("fingerprint", place).bitwiseAND(F.lit(1)), depth - 1 - i))
        value = F.when(F.col("block") == block, own).otherwise(value)
    return value


def near_links(prints: DataFrame, budget: int = 4) -> DataFrame:
    """Links (a, b) between different values of ``fingerprint``: a spanning forest for each group.

    A block value with more than ``CROWDED`` fingerprints is divided once more: the other bits make
    budget + 1 blocks as well, and a linked pair agrees in one of those too. So no group of a dense
    cluster has to be walked by one task."""
    if not 0 <= budget < 32:
        raise ValueError("budget must be from 0 to 31")
    each = prints.select("fingerprint", F.explode(F.array(*(F.lit(i) for i in range(budget + 1)))).alias("block"))
    each = each.withColumn("value", _bits(budget, -1))
    crowded = materialise(each.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWDED).drop("n"), "crowded")
    n = crowded.count()
    groups = each.select("fingerprint", "block", F.lit(-1).alias("sub"), "value")
    if n:
        side = F.broadcast(crowded) if n <= BROADCAST_ROWS else crowded
        parted = each.join(side, ["block", "value"]).drop("value")
        divided = [parted.select("fingerprint", "block", F.lit(u).alias("sub"), _bits(budget, u).alias("value")) for u in range(budget + 1)]
        plain = each.join(side, ["block", "value"], "left_anti").select("fingerprint", "block", F.lit(-1).alias("sub"), "value")
        groups = reduce(DataFrame.unionAll, divided, plain)
    return (
        groups.repartition("block", "sub", "value")
        .sortWithinPartitions("block", "sub", "value")
        .mapInArrow(_walk(budget), "a long, b long")
    )


def near_groups(prints: DataFrame, budget: int = 4) -> DataFrame:
    """fingerprint, root for each row of ``prints`` (different fingerprints): linked fingerprints have one root."""
    nodes = smallest_reachable(near_links(prints.select("fingerprint"), budget))
    return prints.join(nodes, prints["fingerprint"] == nodes["node"], "left").select(
        *prints.columns, F.coalesce("smallest", "fingerprint").alias("root")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 4, budget: int = 4) -> DataFrame:
    """doc_id, fingerprint (long), component_id for each row of ``docs``.

    Documents whose fingerprints differ in ``budget`` bits or less are linked; component_id is the
    smallest doc_id that links reach, the own one included. A text of fewer words than ``size`` is
    one shingle; null and wordless texts have fingerprint 0 and link like any other. Null ids get
    the component of their fingerprint (null if no document in it has an id). Repeated rows come
    back as often; ids keep their type. Other columns are not read. An empty table gives no rows.
    """
    marked = materialise(fingerprints(docs, id_col, text, size).select("doc_id", "fingerprint"), "prints")
    owners = materialise(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("owner")), "owners")
    grouped = near_groups(owners, budget)
    least = grouped.groupBy("root").agg(F.min("owner").alias("component_id"))
    by_print = grouped.join(least, "root").select("fingerprint", "component_id")
    return marked.join(by_print, "fingerprint").select("doc_id", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 4, budget: int = 4) -> DataFrame:
    """One row of each component of ``docs``: the one of the smallest id (rows without id come last), of different texts under
    that id the one whose key is smallest, of rows equal in both one.

    Every text without near copies stays, whatever its id: repeated and null ids decide nothing. Null and wordless texts are
    one component. An empty table gives no rows.
    """
    marked = fingerprints(docs, id_col, text, size)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key1", "key2"))
    owners = materialise(marked.groupBy("fingerprint").agg(first.alias("owner")), "owners")
    stay = near_groups(owners, budget).groupBy("root").agg(F.min("owner").alias("owner")).select("owner.key1", "owner.key2")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *row_key(F.col(f"`{id_col}`"), F.col(f"`{text}`")))
    # Equal rows are one before they are shuffled; the join then finds them where they are.
    others = [c for c in docs.columns if c not in (id_col, text)]
    one = rows.groupBy("key1", "key2").agg(F.min_by("row", F.xxhash64(F.lit(0), *(F.col(f"row.`{c}`") for c in others))).alias("row"))
    return one.join(stay, ["key1", "key2"], "left_semi").select("row.*")
