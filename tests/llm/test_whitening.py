import math

import numpy as np
import pytest

from orderflow.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, x string, id string"


def brute(vectors):
    """(x, n x - S in whole numbers, eigenvalues, eigenvectors as columns) of sound vectors."""
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    wide = n * x - s
    y = wide.astype(float) / n
    e, v = np.linalg.eigh(y.T @ y / n)
    return wide, e[::-1], v[:, ::-1]


def rows_of(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["vec_id"], {})[r["component"]] = r
    return out


def sample(rng, n, d, spread):
    return rng.normal(size=(n, d)) * np.geomspace(1, spread, d) @ np.linalg.qr(rng.normal(size=(d, d)))[0]


@pytest.mark.parametrize("n,d,spread", [(300, 40, 0.05), (50, 5, 1e-1), (3, 6, 1.0)])
def test_equals_eigenvectors(llm_spark, n, d, spread):
    vectors = sample(np.random.default_rng(n), n, d, spread) * 10 + 3000
    df = llm_spark.createDataFrame([(i, v.tolist(), None, "z") for i, v in enumerate(vectors)], SCHEMA).repartition(5)
    got = rows_of(W.whiten(df))
    wide, e, axes = brute(vectors)
    rank = int((e > 1e-9 * e[0]).sum())
    assert set(got) == set(range(n)) and all(sorted(g) == list(range(1, min(32, rank) + 1)) for g in got.values())
    for k in range(min(32, rank)):
        want = wide.astype(float) / n @ axes[:, k] / math.sqrt(e[k])
        have = np.array([got[i][k + 1]["whitened"] for i in range(n)])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-6
        assert got[0][k + 1]["explained"] == pytest.approx(e[k] / e.sum(), rel=1e-9)
    for i in range(n):
        assert {r["deviation"] for r in got[i].values()} == {int((wide[i] ** 2).sum())}
        assert all(r["n"] == n and 0 <= r["identity_error"] < 1e-9 for r in got[i].values())


def test_rows_that_are_no_vectors(llm_spark):
    sound = sample(np.random.default_rng(1), 30, 4, 0.5).astype(np.float32).tolist()
    rows = [(i, v, "a", None) for i, v in enumerate(sound)] + [(3, sound[3], None, None), (None, sound[4], None, None)]
    junk = [(100, None, None, None), (101, [], None, None), (102, [1.0, None, 2.0, 3.0], None, None),
            (103, [1.0, float("nan"), 2.0, 3.0], None, None), (104, [1.0, float("inf"), 2.0, 3.0], None, None),
            (105, [1.0, 2.0], None, None)]
    got = W.whiten(llm_spark.createDataFrame(rows + junk, SCHEMA)).collect()
    assert len(got) == 32 * 4 and {r["n"] for r in got} == {32}
    assert {r["vec_id"] for r in got} == {None, *range(30)}
    wide, e, _ = brute([r[1] for r in rows])
    assert {r["deviation"] for r in got if r["vec_id"] is None} == {int((wide[31] ** 2).sum())}


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], None, None)], [(i, [1.0, 2.0], None, None) for i in range(9)], [(1, None, None, None)]])
def test_nothing_to_whiten(llm_spark, rows):
    got = W.whiten(llm_spark.createDataFrame(rows, SCHEMA))
    assert got.collect() == []
    assert got.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"),
                          ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]


def test_less_than_full_rank(llm_spark):
    """Constant, repeated and summed entries give no component of their own."""
    rng = np.random.default_rng(5)
    a, b, c = np.floor(rng.normal(size=(3, 200)) * 100)
    vectors = np.stack((a, b, a, np.full(200, 7.0), a + b, c), axis=1)
    got = rows_of(W.whiten(llm_spark.createDataFrame([(i, v.tolist(), None, None) for i, v in enumerate(vectors)], SCHEMA)))
    wide, e, axes = brute(vectors)
    assert all(sorted(g) == [1, 2, 3] for g in got.values())
    assert got[0][1]["identity_error"] < 1e-9
    assert [got[0][k]["explained"] for k in (1, 2, 3)] == pytest.approx((e / e.sum())[:3].tolist())


def test_ill_conditioned_rows_need_the_passes(llm_spark):
    """Deviations that differ by 10^6: the Gram matrix alone would leave few digits of the least."""
    rng = np.random.default_rng(8)
    vectors = np.floor(rng.normal(size=(400, 6)) * [2e6, 1e4, 1e3, 50, 5, 2]) @ np.array(
        [[1, 1, 1, 1, 1, 1], [0, 1, 0, 0, 0, 0], [0, 0, 1, 0, 0, 0], [0, 0, 0, 1, 0, 0], [0, 0, 0, 0, 1, 0], [0, 0, 0, 0, 0, 1]])
    rows = llm_spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    model = W.fit(W.whole_vectors(rows, "vec_id", "embedding"))
    assert model.passes >= 3 and model.components.shape == (6, 6) and model.identity_error < 1e-9
    assert model.components.T @ model.components == pytest.approx(np.eye(6), abs=1e-12)


def test_triangular_solve_and_far_values(llm_spark):
    rng = np.random.default_rng(2)
    r1, r2 = (np.triu(rng.normal(size=(5, 5))) + 4 * np.eye(5) for _ in range(2))
    y = rng.normal(size=(9, 5))
    assert W.solve_rows(y, [r1, r2]) @ r2 @ r1 == pytest.approx(y)
    rows = [(i, [1e30 * (-1) ** i, float(i)]) for i in range(6)]
    got = W.whiten(llm_spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["deviation"] for r in got} == {None}  # more than 64 bits


def test_registered_query_equals_eigenvectors(llm_spark):
    from orderflow.llm.queries import QUERIES
    vectors = {r["vec_id"]: r["embedding"] for r in llm_spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()}
    got = rows_of(QUERIES["op12_whitening"](llm_spark, "/root/testdata/sf0.001"))
    ids = sorted(i for i, v in vectors.items() if v and all(c is not None and math.isfinite(c) for c in v))
    wide, e, axes = brute([vectors[i] for i in ids])
    assert sorted(got) == ids
    for k in (0, 1, 31):
        want = wide.astype(float) / len(ids) @ axes[:, k] / math.sqrt(e[k])
        have = np.array([got[i][k + 1]["whitened"] for i in ids])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-6
