"""Whitening against numpy's eigenvalues and exact whole-number sums."""

import numpy as np
import pytest

import __spark_entry__ as entry
from runlens.llm import whitening
from runlens.llm.whitening import leading_eigenpairs, negative_pivots

ROWS = "vec_id long, embedding array<double>, whitened string, v int, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "own", 1, 2) for i, v in rows], ROWS).repartition(3)


def by_hand(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64).astype(object) + 100_000
    n, s = len(x), x.sum(axis=0)
    y = (x * n - s).astype(np.float64) / n
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return ((n * x - s) ** 2).sum(axis=1), y @ axes / np.sqrt(values), values / np.trace(y.T @ y / n)


def check(df, rows, k=8, atol=1e-8):
    model = whitening.fit(df, k)
    got = {r.vec_id: r for r in whitening.transform(df, model).collect()}
    deviation, white, explained = by_hand([v for _, v in rows], k)
    assert sorted(got) == sorted(i for i, _ in rows)
    assert [got[i].deviation for i, _ in rows] == [min(d, 2**63 - 1) for d in deviation]
    mine = np.array([got[i].whitened for i, _ in rows])
    np.testing.assert_allclose(mine * np.sign((mine * white).sum(axis=0)), white, atol=atol)
    np.testing.assert_allclose(model.values / model.trace, explained, rtol=1e-10)
    assert model.identity_error < 1e-9
    return model


@pytest.mark.parametrize("scale", [1.0, 500.0])
def test_whitening_equals_eigenvectors(spark, scale):
    chance = np.random.default_rng(1)
    mixing = chance.normal(size=(12, 12))
    rows = [(i, v.tolist()) for i, v in enumerate(scale * (chance.normal(size=(400, 12)) @ mixing + 3))]
    check(table(spark, rows), rows)


def test_rows_that_take_no_part(spark):
    chance = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(chance.normal(size=(50, 5)))]
    rows += [(90, rows[3][1]), (91, rows[3][1])]
    nan, inf = float("nan"), float("inf")
    odd = [(None, None), (51, None), (52, []), (53, [1.0, None, 2.0, 3.0, 4.0]), (54, [nan] * 5), (55, [1.0, 2.0, 3.0, 4.0, inf]),
           (56, [1.0, 2.0])]
    model = check(table(spark, rows + odd), rows)
    assert model.rows == 52 and len(model.values) == 5


def test_few_rows_span_few_components(spark):
    rows = [(1, [0.5, 0.25, 1.0]), (2, [0.25, 0.5, 1.0]), (None, [0.5, 0.25, 1.0])]
    model = whitening.fit(table(spark, rows))
    assert len(model.values) == 1
    got = whitening.transform(table(spark, rows), model).collect()
    assert sorted((r.vec_id is None, abs(round(r.whitened[0], 6))) for r in got) == [
        (False, 0.707107), (False, 1.414214), (True, 0.707107)]
    one = whitening.fit(table(spark, rows[:1]))
    assert len(one.values) == 0 and whitening.transform(table(spark, rows[:1]), one).first().whitened == []
    assert whitening.fit(table(spark, [])) is None
    assert whitening.fit(table(spark, [(1, None)])) is None


def test_huge_entries_are_held_and_sums_stay_exact(spark):
    rows = [(i, [1e300, -1e300, float(i), 2.0**30 * i]) for i in range(9)]
    model = whitening.fit(table(spark, rows))
    got = whitening.transform(table(spark, rows), model).collect()
    assert len(got) == 9 and max(r.deviation for r in got) == 2**63 - 1
    assert model.identity_error < 1e-6


def test_counts_of_negative_pivots():
    chance = np.random.default_rng(3)
    for n in (1, 2, 5, 20):
        for _ in range(30):
            a = chance.integers(-3, 4, (n, n)).astype(float)
            a = a + a.T + np.eye(n) * 0.1234
            assert negative_pivots(a) == (np.linalg.eigvalsh(a) < 0).sum()
    assert negative_pivots(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1


@pytest.mark.parametrize("values", [
    [9, 8, 7, 6, 5, 4, 3, 2, 1], [5, 5, 5, 2, 2, 1, 1, 1, 1], [1e6, 1e6 - 1e-3, 10, 1, 1e-3, 0, 0, 0, 0], [4] * 9, [3] + [0] * 8])
def test_eigenpairs_of_clusters_and_gaps(values):
    chance = np.random.default_rng(4)
    axes = np.linalg.qr(chance.normal(size=(9, 9)))[0]
    matrix = axes @ np.diag(np.array(values, float)) @ axes.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = leading_eigenpairs(matrix, 8)
    want = [v for v in values if v][:8]
    np.testing.assert_allclose(found, want, rtol=1e-9, atol=1e-9 * max(values))
    np.testing.assert_allclose(vectors @ vectors.T, np.eye(len(want)), atol=1e-9)
    np.testing.assert_allclose(matrix @ vectors.T, vectors.T * found, atol=1e-8 * max(values))


def test_registered_query(spark, sf_dir):
    got = entry.queries()["op12_whitening"](spark, sf_dir).toPandas()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    deviation, white, explained = by_hand([v for _, v in rows])
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[[i for i, _ in rows]].to_numpy()
    np.testing.assert_allclose(wide * np.sign((wide * white).sum(axis=0)), white, atol=1e-8)
    by_id = got.drop_duplicates("vec_id").set_index("vec_id").deviation
    assert by_id.loc[[i for i, _ in rows]].tolist() == [min(d, 2**63 - 1) for d in deviation]
    np.testing.assert_allclose(got.groupby("component").explained.first(), explained)
    assert set(got.n) == {len(rows)} and got.identity_error.max() < 1e-9
