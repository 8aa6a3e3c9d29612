"""Whitening against exact fractions, numpy and symbolic cases."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.llm import queries, whitening

SF = "/root/testdata/sf0.01"


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string, n string")


def brute(vectors):
    """n, scatter and deviations in Python integers."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    m = [[n * sum(r[i] * r[j] for r in x) - s[i] * s[j] for j in range(d)] for i in range(d)]
    return n, s, m, [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x]


def determinant(m):
    m = [[Fraction(v) for v in r] for r in m]
    out = Fraction(1)
    for k in range(len(m)):
        pivot = next((i for i in range(k, len(m)) if m[i][k]), None)
        if pivot is None:
            return 0
        if pivot != k:
            m[k], m[pivot], out = m[pivot], m[k], -out
        out *= m[k][k]
        for i in range(k + 1, len(m)):
            f = m[i][k] / m[k][k]
            m[i] = [a - f * b for a, b in zip(m[i], m[k])]
    return out


def polynomial(m):
    """Coefficients of det(z - m) through its values at 0 to d."""
    d = len(m)
    points = [Fraction(determinant([[(z if i == j else 0) - m[i][j] for j in range(d)] for i in range(d)])) for z in range(d + 1)]
    out = [Fraction(0)] * (d + 1)
    for z, value in enumerate(points):
        basis = [Fraction(1)]
        for other in range(d + 1):
            if other != z:
                basis = [(a - b * other) / (z - other) for a, b in zip([0, *basis], [*basis, 0])]
        out = [a + value * b for a, b in zip(out, basis)]
    return [int(v) for v in out]


def test_limbs_and_large_entries_add_up_exactly(spark, monkeypatch):
    monkeypatch.setattr(whitening, "_ROWS", 3)
    monkeypatch.setattr(whitening, "_FLUSH", 2)
    rng = np.random.default_rng(3)
    vectors = [(rng.normal(size=3) * s).tolist() for s in (1, 1, 30, 1e6, 1e10, 3e15) for _ in range(4)]
    rows = whitening.usable(frame(spark, [(i, v, "", "") for i, v in enumerate(vectors)]), "vec_id", "embedding")
    n, s, m = whitening.exact_scatter(rows.repartition(3), 3)
    want = brute(vectors)
    assert (n, m) == (want[0], want[2])
    assert [a + n * 1_000_000 for a in s] == want[1]


def test_characteristic_polynomial(spark):
    rng = np.random.default_rng(0)
    for d in (1, 2, 3, 5, 8):
        base = rng.integers(-50, 50, (d, max(1, d - d // 4)))
        m = (base @ base.T).tolist()
        assert whitening.characteristic(spark, m) == polynomial(m)


def test_polynomial_modulo_a_prime_meets_zero_pivots():
    m = [[0, 0, 1], [0, 2, 0], [1, 0, 0]]
    assert whitening.polynomial_mod(m, 101).tolist() == [v % 101 for v in polynomial(m)]


def test_primes():
    sieve = [n for n in range(2, 2000) if all(n % k for k in range(2, int(n**0.5) + 1))]
    assert [n for n in range(2000) if whitening.is_prime(n)] == sieve
    assert math.prod(whitening.primes_for(10**50)) > 10**50


def test_roots_are_counted_and_isolated_with_multiplicity():
    poly = [1]
    for root in (0, 0, 1, 2, 2, 2, 7, 1000, 1001):
        poly = [a - root * b for a, b in zip([0, *poly], [*poly, 0])]
    assert [whitening.roots_above(poly, a, 0) for a in (0, 1, 2, 6, 1000, 1001)] == [7, 6, 3, 3, 1, 0]
    assert whitening.roots_above(poly, 3, 1) == 6  # above 1.5
    found = whitening.isolate(poly, 9)
    assert [(i.above, i.count) for i in found] == [(0, 1), (1, 1), (2, 1), (3, 3), (6, 1)]
    values = [Fraction(i.high, 1 << i.bits) for i in (whitening.refine(poly, i) if i.count == 1 else i for i in found)]
    assert all(abs(v - w) < Fraction(1, 2**140) for v, w in zip(values, (1001, 1000, 7, 2, 1)))
    assert [i.above for i in whitening.isolate(poly, 2)] == [0, 1]


def test_equal_and_nearly_equal_roots_have_orthonormal_components():
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.normal(size=(6, 6)))
    m = [[4, 0, 0, 0], [0, 4, 0, 0], [0, 0, 9, 0], [0, 0, 0, 9 + 1]]
    poly = polynomial(m)
    vectors = [v for i in whitening.isolate(poly, 4) for v in whitening.null_space(m, whitening.refine(poly, i) if i.count == 1 else i)[1]]
    v = np.array([[float(x) for x in r] for r in vectors])
    assert np.allclose(v @ v.T, np.eye(4), atol=1e-15)
    assert np.allclose(v @ np.array(m) @ v.T, np.diag([10, 9, 4, 4]), atol=1e-13)
    del q


def check(spark, vectors, rows, components=32):
    n, s, m, deviation = brute(vectors)
    v = np.array(m, float) / n**2
    values = np.linalg.eigvalsh(v)[::-1]
    positive = sum(values > 1e-9 * max(values[0], 1e-300))
    found = whitening.whiten(rows, components=components).collect()
    keep = min(components, positive)
    assert len(found) == len(vectors) * keep
    by = {}
    for r in found:
        by.setdefault(r.component, []).append(r)
        assert r.n == n and r.identity_error <= 1e-9
    assert sorted(by) == list(range(1, keep + 1))
    for c, some in by.items():
        assert sorted(int(r.deviation) for r in some) == sorted(deviation)
        assert some[0].explained == pytest.approx(values[c - 1] / np.trace(v), rel=1e-9)
    return by


def test_whitened_rows(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(60, 5)) @ rng.normal(size=(5, 5))).tolist()
    vectors += vectors[:7]  # repeated rows
    rows = [(i % 50, v, "x", "y") for i, v in enumerate(vectors)]
    odd = [(900, None, "", ""), (901, [None] * 5, "", ""), (902, [float("nan")] * 5, "", ""), (903, [1.0, 2.0, float("inf"), 0.0, 0.0], "", "")]
    by = check(spark, vectors, frame(spark, rows + odd).repartition(4))
    n, s, m, _ = brute(vectors)
    w, u = np.linalg.eigh(np.array(m, float) / n**2)
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]) - np.array([float(Fraction(t, n)) for t in s])
    want = x @ u[:, ::-1] / np.sqrt(w[::-1])
    for c, some in by.items():
        got, ideal = np.sort([r.whitened for r in some]), want[:, c - 1]
        assert np.allclose(got, np.sort(ideal), atol=1e-9) or np.allclose(got, np.sort(-ideal), atol=1e-9)


def test_few_components_ties_and_flat_directions(spark):
    square = [[1.0, 0.0, 3.0], [-1.0, 0.0, 3.0], [0.0, 1.0, 3.0], [0.0, -1.0, 3.0]]  # two equal roots and one of zero
    rows = frame(spark, [(i, v, "", "") for i, v in enumerate(square)])
    assert sorted(check(spark, square, rows)) == [1, 2]
    assert sorted(check(spark, square, rows, 1)) == [1]


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None, "", "")], [(1, [], "", "")], [(1, [0.5, 0.25], "", "")], [(i, [0.5, 0.25], "", "") for i in range(5)]):
        found = whitening.whiten(frame(spark, rows))
        assert found.count() == 0 and found.columns[:2] == ["vec_id", "component"]


def test_short_vectors_end_with_zeros_and_null_ids_stay(spark):
    given = [[1.0, 2.0, 0.5], [0.5], [], [3.0, 1.0, 1.0], [0.25, 0.75]]
    padded = [v + [0.0] * (3 - len(v)) for v in given]
    check(spark, padded, frame(spark, [(None if i == 1 else i, v, "", "") for i, v in enumerate(given)]))


def test_huge_entries_do_not_end_the_job(spark):
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(12, 3)).tolist()
    rows = [(i, v, "", "") for i, v in enumerate([*vectors, [1e300, 0.0, 1.0], [3e38, 1.0, -3e38]])]
    found = whitening.whiten(frame(spark, rows)).collect()
    assert len(found) == 14 * 3 and all(r.identity_error < 1e-4 for r in found)
    assert sorted({r.component for r in found}) == [1, 2, 3]


def test_registered_query(spark):
    found = queries.QUERIES["op12_whitening"](spark, SF)
    n = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    assert dict(found.dtypes)["deviation"] == "bigint" and dict(found.dtypes)["component"] == "int"
    one = found.agg(F.count("*"), F.max("identity_error"), F.countDistinct("component"), F.min("n"), F.sum(F.isnull("deviation").cast("int"))).first()
    assert one[0] == n * 32 and one[1] <= 1e-9 and one[2] == 32 and one[3] == n and one[4] == 0
    shares = [r.explained for r in found.select("component", "explained").distinct().orderBy("component").collect()]
    assert shares == sorted(shares, reverse=True) and sum(shares) < 1
