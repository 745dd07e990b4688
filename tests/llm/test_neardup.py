"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest

from thicket.llm import neardup


def families(seed, n, dim=16):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        centre = rng.standard_normal(dim)
        for _ in range(rng.integers(1, 12)):
            out.append((centre + rng.standard_normal(dim) * rng.choice([0, 0.02, 0.2])).astype(np.float32).astype(float).tolist())
    return [out[i] for i in rng.permutation(len(out))]


def unit(v):
    if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
        return None
    v = np.array(v) / max(map(abs, v))
    return v / np.sqrt(v @ v)


def brute(rows, threshold=0.9):
    units = [unit(v) for _, v in rows]
    n = [sum(u is not None and w is not None and i != j and len(u) == len(w) and float(u @ w) >= threshold for j, w in enumerate(units)) for i, u in enumerate(units)]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, u in enumerate(units):
        for j in range(i):
            if u is not None and units[j] is not None and len(u) == len(units[j]) and float(u @ units[j]) >= threshold:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted((rows[i][0], n[i], rows[find(i)][0], find(i) == i) for i in range(len(rows)))


def test_whole_windows_find_all_pairs(spark):
    vectors = families(1, 60)
    rows = [(i + 5, v) for i, v in enumerate(vectors)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, links string").repartition(3)
    got = neardup.near_duplicates(df, window=100, block=100).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_small_windows_link_only_true_pairs(spark):
    rows = list(enumerate(families(2, 60)))
    got = sorted(map(tuple, neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), window=8, block=32).collect()))
    want = brute(rows)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(g[1] for g in got) >= 0.9 * sum(w[1] for w in want)


def test_edge_cases(spark):
    schema = "vec_id long, embedding array<double>"
    assert neardup.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    inf, nan = float("inf"), float("nan")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [inf, 1.0]), (6, [nan, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [5.0, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [1e200, 1e-200]), (None, [1.0, 0.0]), (None, [0.0, 1.0])]
    got = {r["vec_id"]: tuple(r)[1:] for r in neardup.near_duplicates(spark.createDataFrame(rows, schema)).collect() if r["vec_id"]}
    assert {k: got[k] for k in (1, 2, 3, 4, 5, 6, 10)} == {k: (0, k, True) for k in (1, 2, 3, 4, 5, 6, 10)}
    assert {k: got[k] for k in (7, 8, 9, 11)} == {7: (4, 7, True), 8: (4, 7, False), 9: (4, 7, False), 11: (4, 7, False)}


def test_passes_grow_with_the_rows(spark):
    same = 1 - np.arccos(0.9) / np.pi
    for n in (10**3, 10**5, 10**6, 10**7, 10**8):
        assert 1 - (1 - same ** np.log2(n / 256)) ** neardup.passes_for(n, 0.9, 256) >= 0.99
    assert neardup.passes_for(100, 0.9, 256) == neardup.PASSES
    # pairs at the threshold, among many vectors for their window
    rng = np.random.default_rng(3)
    rows = []
    for i in range(3000):
        a, b = np.linalg.qr(rng.standard_normal((32, 2)))[0].T
        rows += [(2 * i, a.tolist()), (2 * i + 1, (0.901 * a + (1 - 0.901**2) ** 0.5 * b).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [near.filter("n_links = 1").count() / len(rows) for near in (neardup.near_duplicates(df, window=1, passes=p) for p in (None, neardup.PASSES))]
    assert found[0] >= 0.97 > found[1]


def one_family(n, size, dim=64, seed=11):
    """n vectors, of which size are one family of different vectors with a mean cosine of about 0.92, some pairs below 0.9."""
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal(dim)
    v = rng.standard_normal((n, dim))
    spread = rng.uniform(0.2, 0.36, (size, 1))
    v[:size] = centre / np.linalg.norm(centre) * np.sqrt(dim) + spread * rng.standard_normal((size, dim))
    v = v[rng.permutation(n)].astype(np.float32).astype(float)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = np.concatenate([(u[i : i + 500] @ u.T >= 0.9).sum(1) - 1 for i in range(0, n, 500)])
    return v, want


@pytest.mark.parametrize("n, size, window, tile", [(20_000, 10_000, 256, 4096), (5_000, 1_250, 64, 500)])
def test_links_in_families_larger_than_a_window(spark, n, size, window, tile):
    v, want = one_family(n, size)
    assert 0.5 * size < want.max() and want[want > 0].min() < size - 1
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(4)
    got = np.zeros(n, np.int64)
    for r in neardup.near_duplicates(df, window=window, block=max(window, 1024), tile=tile).select("vec_id", "n_links").collect():
        got[r[0]] = r[1]
    assert (got <= want).all() and got.sum() >= 0.99 * want.sum()
    many = want >= 2 * window
    assert (got[many] == want[many]).mean() > 0.99


def test_classes_of_many_rows_weigh_in_dense_families(spark):
    v, _ = one_family(300, 200, seed=12)
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(500)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), window=16, block=64, tile=50).collect()
    want = brute(rows)
    assert sum(g["n_links"] for g in got) >= 0.99 * sum(w[1] for w in want) and all(g[1] <= w[1] for g, w in zip(sorted(map(tuple, got)), want, strict=True))
