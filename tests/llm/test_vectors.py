from __future__ import annotations

import numpy as np
import pytest

from starmart.llm import vectors
from starmart.llm.vectors import near_vectors


def brute(rows, least=0.95):
    usable = [
        i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    unit = {i: np.array(rows[i][1], dtype=float) / np.linalg.norm(np.array(rows[i][1], dtype=float)) for i in usable}
    group, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in usable:
        for j in usable:
            if j < i and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= least:
                links[i] += 1
                links[j] += 1
                group[root(i)] = root(j)
    first = {}
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            first[root(i)] = min(first.get(root(i), vec_id), vec_id)
    return [(r[0], links[i], first.get(root(i)), r[0] is not None and r[0] == first.get(root(i))) for i, r in enumerate(rows)]


def table(spark, rows):
    return spark.createDataFrame([(*r, "c", 1) for r in rows], "vec_id long, embedding array<float>, cls string, n int")


@pytest.mark.parametrize("shelf", [16_384, 7, 1])
def test_against_brute_force(spark, monkeypatch, shelf):
    """Clusters of near copies, a hot exact group, and vectors that can't be compared; shelves whole and cut into chunks."""
    monkeypatch.setattr(vectors, "SHELF", shelf)
    rng = np.random.default_rng(5)
    found = [rng.normal(size=16) for _ in range(150)]
    for base in list(found[:20]):
        found += [base + rng.normal(size=16) * 0.05 for _ in range(6)]
    chain = found[30]
    for _ in range(10):
        chain = chain + rng.normal(size=16) * 0.15
        found.append(chain)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(found)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)] + [(2000, [x * 2 for x in rows[3][1]]), (3, rows[3][1])]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 16), (3003, [1.0, None] * 8), (3004, [float("nan")] * 16)]
    rows += [(3005, [float("inf")] * 16), (3006, [1.0, 2.0]), (3007, [2.0, 4.0]), (3008, [5.0]), (3009, [1.0]), (None, rows[4][1])]
    got = near_vectors(table(spark, rows).repartition(4))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(key, got.collect())) == sorted(map(key, brute(rows)))


def test_recall_on_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    rows = [tuple(r) for r in df.collect()]
    wanted, got = brute(rows), near_vectors(df).collect()
    assert sum(r["n_links"] for r in got) >= 0.9 * sum(r[1] for r in wanted)
    assert near_vectors(df.limit(0)).count() == 0 and near_vectors(df.limit(1)).count() == 1


def test_recall_at_the_threshold():
    """The hardest pairs: random directions, exactly at the threshold, in random data without clusters."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(4000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = vectors.MultiIndex.fit(x, len(x), 0.95, 0.995)
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    y = 0.951 * x + np.sqrt(1 - 0.951**2) * noise / np.linalg.norm(noise, axis=1, keepdims=True)
    i, j = index.cells(y)
    cell = i * len(index.right) + j
    seen = [c in set(v.tolist()) for c, v in zip(cell, index.visits(index.over(x)), strict=True)]
    assert np.mean(seen) > 0.98


def test_visits_are_all_cells_up_to_the_excess_in_order():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = vectors.MultiIndex.fit(x, 2000, 0.95, 0.995)
    over = index.over(x)
    for left, right, seen in zip(*over, index.visits(over), strict=True):
        sums = (left[:, None] + right[None, :]).reshape(-1)
        assert sorted(seen.tolist()) == np.flatnonzero(sums <= index.excess).tolist()
        assert (np.diff(sums[seen]) >= 0).all() and sums[seen[0]] == 0


def test_shelves_hold_neighbouring_cells_of_one_left_code():
    counts = np.array([5, 0, 3, 9, 0, 0, 0, 0, 1, 100, 0, 2])
    made = vectors.Shelves.of(counts, 4, 8)
    assert made.of_cell.tolist() == [0, -1, 0, 1, -1, -1, -1, -1, 2, 2, -1, 3]
    assert made.chunks.tolist() == [1, 1, 7, 1]


def test_components_beyond_single_precision_are_kept():
    rows = [np.array([1.0, 0.1]), np.array([0.5, 0.25]), np.array([1e40, 1.0])]
    data = [vectors.packed(r) for r in rows]
    assert [len(d) for d in data] == [16, 8, 16]
    assert np.array_equal(vectors.unit(data, 2), np.array([r / np.linalg.norm(r[None], axis=1) for r in rows]))
