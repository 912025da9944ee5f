import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgrid.llm import whitening
from quillgrid.llm.queries import QUERIES
from quillgrid.llm.whitening import (
    characteristic_polynomial, fit, largest_roots, null_space, polynomial_modulo, roots_above, whiten,
)

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in enumerate(rows)], SCHEMA)


def gaussian(seed, n, d):
    r = random.Random(seed)
    return [[r.gauss(0, 0.2) * (1 + j / 3) for j in range(d)] for _ in range(n)]


def by_numpy(rows, components=16):
    """The contract with floating point and LAPACK: deviations, |whitened|, shares by row."""
    good = [v for v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(64 * np.array(good, np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit_list = np.unique(x, axis=0)
    n, s = len(fit_list), fit_list.sum(axis=0)
    centred = (fit_list * n - s) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    made = ((x * n - s) / n) @ basis / np.sqrt(values)
    return n, ((x * n - s) ** 2).sum(axis=1), made, values / np.trace(centred.T @ centred / n)


def check(found, rows):
    n, deviation, made, shares = by_numpy(rows)
    kept = [i for i, v in enumerate(rows) if v and all(c is not None and np.isfinite(c) for c in v)]
    assert len(found) == len(kept) * len(shares)
    signs = {}
    for r in found:
        at, c = kept.index(r.vec_id), r.component - 1
        assert r.n == n and r.deviation == deviation[at] and r.identity_error < 1e-9
        assert r.explained == pytest.approx(shares[c], rel=1e-9)
        assert abs(r.whitened) == pytest.approx(abs(made[at, c]), abs=1e-8)
        if abs(r.whitened) > 1e-3:
            signs.setdefault(c, set()).add(np.sign(r.whitened) == np.sign(made[at, c]))
    assert all(len(s) == 1 for s in signs.values())  # one sign for all rows


def test_against_lapack_with_rows_that_repeat_or_drop_out(spark):
    rows = gaussian(1, 150, 20)
    rows[3:3] = [None, [], [0.1] * 19 + [None], [float("nan")] + [0.0] * 19, [float("inf")] * 20, rows[0], rows[0]]
    df = vectors(spark, rows).withColumn("component", F.lit("mine")).withColumn("y", F.lit(1))
    check(whiten(df, fit(df)).collect(), rows)


def test_fewer_dimensions_than_components_and_low_rank(spark):
    rows = gaussian(2, 40, 5)
    check(whiten(vectors(spark, rows), fit(vectors(spark, rows))).collect(), rows)
    flat = [[a, b, 0.5, a] for a, b in ((0.0, 0.0), (0.5, 0.25), (1.0, 0.0), (0.25, 1.0))]  # rank 2
    model = fit(vectors(spark, flat))
    assert len(model.values) == 2 and model.identity_error < 1e-12 and sum(model.shares) == pytest.approx(1)


def test_nothing_to_learn_from(spark):
    for rows in ([], [None, []], [[1.0, 2.0]] * 3):
        df = vectors(spark, rows)
        found = whiten(df, fit(df))
        assert found.count() == 0 and found.columns[0] == "vec_id"


def test_vectors_of_another_size_are_not_used(spark):
    rows = gaussian(3, 30, 4)
    model = fit(vectors(spark, [*rows, [1.0, 2.0], [0.5] * 7]))
    assert model.size == 4 and model.n == 30
    assert whiten(vectors(spark, [*rows, [1.0, 2.0]]), model).select("vec_id").distinct().count() == 30


def test_repeated_roots_have_orthogonal_components(spark):
    rows = [[float(s) if i == j else 0.0 for j in range(4)] for i in range(4) for s in (1, -1)]  # scatter 2 * 64**2 * 8 * identity
    model = fit(vectors(spark, rows))
    v = np.array(model.vectors)
    assert np.allclose(v @ v.T, np.eye(4), atol=1e-14) and len(set(model.values)) == 1 and model.identity_error < 1e-12


def test_large_levels_stay_exact(spark):
    rows = [[2.0**30, 1.0], [-(2.0**30), 0.5], [2.0**29, 0.0], [2.0**35, 0.0]]
    found = {r.vec_id: r for r in whiten(vectors(spark, rows), fit(vectors(spark, rows))).where("component = 1").collect()}
    y = [[64 * int(a), int(64 * b)] for a, b in rows[:3]]
    s = [sum(c) for c in zip(*y)]
    assert found.keys() == {0, 1, 2}
    for i, v in enumerate(y):
        exact = sum((3 * a - b) ** 2 for a, b in zip(v, s))
        assert found[i].deviation == (exact if exact < 2**63 else None)


def test_polynomial_against_its_roots(spark):
    r = random.Random(4)
    half = [[r.randint(-9, 9) for _ in range(6)] for _ in range(6)]
    a = [[sum(x * y for x, y in zip(u, v)) for v in half] for u in half]
    poly = characteristic_polynomial(spark, a)
    assert np.allclose(poly[::-1], np.poly(np.array(a, float)), rtol=1e-9) and poly[-1] == 1
    p = 1_000_003
    assert polynomial_modulo(np.array(a, dtype=object), p) == [c % p for c in poly]
    values = np.linalg.eigvalsh(np.array(a, float))[::-1]
    roots = largest_roots(poly, 6)
    assert [t / 2**k for t, k, _ in roots] == pytest.approx(list(values), rel=1e-6, abs=1e-6)
    assert [roots_above(poly, int(v * 16), 4) for v in values] == [
        sum(x > int(v * 16) / 16 for x in values) for v in values
    ]
    found = np.array(null_space(a, whitening.Decimal(roots[0][0]) / 2 ** roots[0][1], 1, 0)[0])
    assert np.allclose(np.array(a, float) @ found, values[0] * found, rtol=1e-9)


def test_whole_roots_and_repeated_roots():
    poly = [16, -32, 24, -8, 1]  # (x - 2)**4
    assert [(t / 2**k, times) for t, k, times in largest_roots(poly, 4)] == [(pytest.approx(2.0, rel=1e-15), 4)]
    poly = [0, 6, -5, 1]  # x (x - 2) (x - 3)
    assert [(t / 2**k, times) for t, k, times in largest_roots(poly, 3)] == [(3.0, 1), (2.0, 1)]


def test_the_query_as_registered(spark, tmp_path):
    rows = gaussian(5, 60, 18)
    rows[7], rows[9] = None, rows[8]
    vectors(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    found = QUERIES["op11_whitening"](spark, str(tmp_path))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(found.collect(), rows)
