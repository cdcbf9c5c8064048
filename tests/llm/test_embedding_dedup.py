import numpy as np
import pytest
from llm_brute import components

from orderflow.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<double>, label int, n_links string"


def brute(rows, threshold=0.93):
    """{id: (n_links, component, kept)}"""
    good = {}
    for i, v, label, *_ in rows:
        if label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v) / np.abs(v).max()
            good[i] = (label, x / np.sqrt((x * x).sum()))
    links = [(a, b) for a, (la, x) in good.items() for b, (lb, y) in good.items()
             if a != b and la == lb and len(x) == len(y) and float(x @ y) >= threshold]
    found = components([r[0] for r in rows], links)
    return {i: (sum(a == i for a, _ in links), found[i], found[i] == i) for i in found}


def case(seed, n, dims=6, groups=9):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(groups, dims))
    rows = []
    for i in range(n):
        v = middle[rng.integers(groups)] * rng.uniform(0.1, 9) + rng.normal(size=dims) * rng.choice([0.05, 0.3, 0.6])
        rows.append((i, [float(x) for x in v], int(rng.integers(3)), "c"))
    rows += [(n + k, rows[k][1], rows[k][2], "c") for k in range(20)]  # exact copies
    rows += [(n + 50 + k, [2 * x for x in rows[k][1]], rows[k][2], "c") for k in range(5)]
    order = rng.permutation(len(rows))
    return [rows[i] for i in order]


@pytest.mark.parametrize(("seed", "n", "block"), [(1, 300, 1000), (2, 400, 16), (3, 300, 3)])
def test_same_as_brute_force(llm_spark, monkeypatch, seed, n, block):
    monkeypatch.setattr(E, "CELLS", (12,))
    rows = case(seed, n)
    got = {r["vec_id"]: tuple(r)[1:] for r in E.near_duplicates(llm_spark.createDataFrame(rows, SCHEMA), block=block).collect()}
    assert got == brute(rows)


def test_every_near_pair_meets_once_in_a_cell():
    rng = np.random.default_rng(4)
    x = E.unit_rows(list(np.repeat(rng.normal(size=(40, 5)), 10, axis=0) + rng.normal(size=(400, 5)) * 0.2))
    homes, guests = E.cells_of(x, E.spherical_k_means(x, 12), 0.93)
    near = np.argwhere(x @ x.T >= 0.93)
    for a, b in near[near[:, 0] < near[:, 1]]:
        both = ({homes[a], *guests[a]} & {homes[b], *guests[b]}) & {homes[a], homes[b]}
        assert min(homes[a], homes[b]) in both and len(both) == 1


def test_cells_follow_the_data():
    """Clustered vectors get many cells, evenly spread ones the fewest."""
    rng = np.random.default_rng(6)
    middle = rng.normal(size=(300, 24))
    clustered = E.unit_rows(list(middle[rng.integers(300, size=3000)] + rng.normal(size=(3000, 24)) * 0.03))
    even = E.unit_rows(list(rng.normal(size=(3000, 24))))
    assert len(E.choose_cells(clustered, 10_000_000, 0.93)) >= 64
    assert len(E.choose_cells(even, 10_000, 0.93)) == 4
    assert len(E.choose_cells(even[:1], 1, 0.93)) == 1


def test_one_row_for_each_row(llm_spark):
    rows = [(1, [1.0, 2.0], 1, "c")] * 3 + [(2, [1.0, 2.0], 1, "c"), (3, None, 1, "c"), (3, None, 1, "c")]
    got = sorted(tuple(r) for r in E.near_duplicates(llm_spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(1, 1, 1, True)] * 3 + [(2, 1, 1, False)] + [(3, 0, 3, True)] * 2
    kept = E.representatives(llm_spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, _kept string")).collect()
    assert sorted(r["vec_id"] for r in kept) == [1, 1, 1, 3, 3]


def test_vectors_that_link_with_nothing(llm_spark):
    v = [1.0, 2.0]
    rows = [(1, None, 1, "c"), (2, [], 1, "c"), (3, [0.0, 0.0], 1, "c"), (4, [1.0, float("nan")], 1, "c"), (5, [1.0, None], 1, "c"),
            (6, [float("inf"), 1.0], 1, "c"), (7, v, None, "c"), (8, v, 1, "c"), (9, v, 1, "c"), (9, v, 1, "c"), (10, v, 2, "c"),
            (11, [1.0, 2.0, 0.0], 1, "c"), (12, [1e300, 2e300], 1, "c"), (13, [1e-300, 2e-300], 1, "c"), (None, v, 1, "c")]
    got = {r["vec_id"]: tuple(r)[1:] for r in E.near_duplicates(llm_spark.createDataFrame(rows, SCHEMA)).collect()}
    alone = {i: (0, i, True) for i in (1, 2, 3, 4, 5, 6, 7, 10, 11)}
    assert got == alone | {8: (3, 8, True), **{i: (3, 8, False) for i in (9, 12, 13)}, None: (0, None, True)}


def test_empty_table_and_representatives(llm_spark):
    df = llm_spark.createDataFrame(case(5, 60), SCHEMA)
    assert E.near_duplicates(df.limit(0)).count() == 0
    kept = {i for i, (_, _, k) in brute([tuple(r) for r in df.collect()]).items() if k}
    assert {r["vec_id"] for r in E.representatives(df).collect()} == kept
