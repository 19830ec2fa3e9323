import numpy as np

from tessera.llm import hilbert


def _brute(ids, v, k, every):
    out = set()
    for q in np.flatnonzero(ids % every == 0):
        s = (v[q] * v).sum(1)
        best = sorted((-s[j], ids[j]) for j in range(len(ids)) if j != q)[:k]
        out |= {(int(ids[q]), r + 1, int(i), -x) for r, (x, i) in enumerate(best)}
    return out


def test_hilbert_curve_is_a_path():
    for d, b in ((2, 3), (3, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << b)] * d, indexing="ij"), -1).reshape(-1, d)
        key = hilbert.hilbert(grid, b)
        order = np.argsort(key)
        assert sorted(key) == list(range(len(grid))) and (np.abs(np.diff(grid[order], axis=0)).sum(1) == 1).all()


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    v = rng.standard_normal((700, 16)).astype(np.float32).astype(np.float64) * rng.choice([0.5, 1, 3], 700)[:, None]
    v[100:140] = v[100]  # ties
    ids = rng.permutation(700) + 3
    rows = [(int(i), [float(c) for c in x], "x") for i, x in zip(ids, v, strict=True)]
    rows += [(1000, None, ""), (1020, [0.0] * 16, ""), (1040, [None] * 16, ""), (1060, [float("nan")] * 16, ""), (1080, [1.0], ""), (None, [1.0] * 16, ""), (1100, [], "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    got = {tuple(r) for r in hilbert.neighbours(df, k=7, every=20).collect()}
    assert got == _brute(ids, v, 7, 20)


def test_windows_alone_find_neighbours_where_there_is_structure(spark):
    rng = np.random.default_rng(6)
    v = np.column_stack((rng.standard_normal((3000, 2)), np.zeros((3000, 6))))
    v /= np.linalg.norm(v, axis=1)[:, None]
    df = spark.createDataFrame([(i, [float(c) for c in x]) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {tuple(r) for r in hilbert.neighbours(df, k=10, every=20, complete=False).collect()}
    want = _brute(np.arange(3000), v, 10, 20)
    assert len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want}) >= 0.9 * len(want)


def test_edges(spark):
    df = spark.createDataFrame([(20, [1.0, 0.0]), (21, [0.5, 0.5]), (20, [2.0, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in hilbert.neighbours(df).collect()] == [(20, 1, 21, 0.5)]
    assert hilbert.neighbours(df.filter("false")).count() == 0
    assert hilbert.neighbours(df.filter("vec_id = 21")).count() == 0
