"""Nearest neighbours: recall and exactness against brute force."""

import numpy as np

from rentlens.llm import nearest_neighbours as N

VEC = "vec_id long, embedding array<double>, i int"


def brute(ids, x, q, own, k):
    s = (x * q).sum(axis=1)
    keep = ids != own
    order = np.lexsort((ids[keep], -s[keep]))[:k]
    return list(zip(ids[keep][order].tolist(), s[keep][order].tolist()))


def test_recall_and_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = {}
    for r in N.nearest(df, row_block=600, query_block=40).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hit = total = 0
    assert set(got) == set(ids[ids % 20 == 0].tolist())
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        want = brute(ids, x, x[ids == q][0], q, 20)
        hit += len({f[1] for f in found} & {w[0] for w in want})
        total += 20
        exact = dict(zip(ids.tolist(), (x * x[ids == q][0]).sum(axis=1).tolist()))
        assert all(f[2] == exact[f[1]] for f in found)
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
    assert hit / total >= 0.9


def test_lengths_differ_ties_and_copies(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 6)) * rng.uniform(0.1, 4, size=(400, 1))
    x[100:180] = x[40]
    x[200:230] = 2 * x[40]
    ids = np.arange(400)
    df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x)], VEC)
    hit = total = 0
    for row_block in (1000, 90):
        got = {}
        for r in N.nearest(df, row_block=row_block, query_block=7).collect():
            got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
        for q in range(0, 400, 20):
            want = brute(ids, x, x[q], q, 20)
            found = [got[q][k + 1] for k in range(20)]
            hit += len({f[0] for f in found} & {w[0] for w in want})
            total += 20
        assert [f[0] for f in [got[40][k] for k in range(1, 21)]] == list(range(200, 220))
    assert hit / total >= 0.9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (7, [1.0]),
            (8, [0.5, 0.5]), (None, [1.0, 1.0]), (9, [-1.0, 0.0]), (9, [-1.0, 0.0]), (20, None), (40, [2.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], VEC)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in N.nearest(df).collect())
    assert got == [(0, 1, 40, 2.0), (0, 2, 8, 0.5), (0, 3, 9, -1.0), (0, 4, 9, -1.0),
                   (40, 1, 0, 2.0), (40, 2, 8, 1.0), (40, 3, 9, -2.0), (40, 4, 9, -2.0)]
    assert N.nearest(df.limit(0)).count() == 0 and N.nearest(df.filter("vec_id = 1")).count() == 0


def unequal_lengths():
    """Rows of one full block whose lengths differ, three ways."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(N.ROW_BLOCK, 64))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    one = x.copy()
    one[17] *= 4
    return {"uniform": unit * rng.uniform(0.1, 4, size=(len(x), 1)), "lognormal": unit * rng.lognormal(size=(len(x), 1)), "one long": one}


def test_recall_in_a_full_block_of_unequal_lengths(spark):
    for name, x in unequal_lengths().items():
        ids = np.arange(len(x))
        df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x)], VEC)
        got = {}
        for r in N.nearest(df, query_mod=200).collect():
            got.setdefault(r.query_id, set()).add(r.vec_id)
        hits = [len(got[q] & {w[0] for w in brute(ids, x, x[q], q, 20)}) for q in ids[::200].tolist()]
        assert sum(hits) / (20 * len(hits)) >= 0.98, name


def test_any_finite_size_ends_and_gives_numbers(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(120, 5))
    for name, size in {"tiny": 1e-170, "huge": 1e200, "least": 5e-324, "mixed": None}.items():
        rows = x * (np.where(np.arange(120) % 2, 1e-170, 1e180)[:, None] if size is None else size)
        rows[np.abs(rows).max(axis=1) == 0] = size
        got = {}
        df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in enumerate(rows)], VEC)
        for r in N.nearest(df, k=5).collect():
            got.setdefault(r.query_id, []).append(r.score)
        assert set(got) == set(range(0, 120, 20)) and all(len(s) == 5 and not any(map(np.isnan, s)) for s in got.values()), name


def test_clustered_rows_are_filtered(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(100, 64))
    x = np.repeat(centres, 40, axis=0) + 0.02 * rng.normal(size=(4000, 64))
    lines, ids = N.projections(64, N.PROJECTIONS), np.arange(4000)
    block, factor = N.Block(ids, x, lines), N.reach_factor(64, N.PROJECTIONS, 24)
    hit = verified = 0
    for own in range(0, 4000, 100):
        found = block.search(own, x[own], lines, 20, 24, factor)
        hit += len({i for _, i in found} & {i for i, _ in brute(ids, x, x[own], own, 20)})
        verified += block.verified
    assert hit / (40 * 20) >= 0.9 and verified / (40 * 4000) < 0.5, (hit, verified)


def test_only_rows_near_the_best_are_multiplied_exactly(monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 16))
    x[1000:1010] = x[0]  # ties at the top
    lines = N.projections(16, N.PROJECTIONS)
    block, need = N.Block(np.arange(3000), x, lines), N.PROJECTIONS // 2
    factor = N.reach_factor(16, N.PROJECTIONS, need)
    multiplied, exact = [], block._products
    monkeypatch.setattr(block, "_products", lambda rows, q: multiplied.append(len(rows)) or exact(rows, q))
    got = block.search(0, x[0], lines, 20, need, factor)
    assert block.verified > 300 and sum(multiplied) < 60
    scores = (x * x[0]).sum(axis=1)
    assert [i for _, i in got if 1000 <= i < 1010] == [*range(1000, 1010)]
    assert all(s == scores[i] for s, i in got) and got == sorted(got, key=lambda g: (-g[0], g[1]))


def test_short_vectors_lie_in_larger_blocks():
    assert [N.rows_of_a_block(d) for d in (1, 64, 128, 256, 4096)] == [32768, 32768, 16384, 8192, 8192]
