import numpy as np
import pytest

from sparkrank.llm import itq as I


def brute(rows, cosine=0.9):
    """``{row index: (n_links, component)}`` by comparing everything with everything."""
    n = len(rows)
    good = [i for i, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = [[] for _ in range(n)]
    x = np.array([rows[i][1] for i in good], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for a, i in enumerate(good):
        links[i] = [good[b] for b in np.nonzero(x @ x[a] >= cosine)[0] if b != a]
    root = list(range(n))
    for i in range(n):
        todo, seen = [i], {i}
        while todo:
            k = todo.pop()
            todo += [j for j in links[k] if j not in seen]
            seen |= set(links[k])
        root[i] = min(rows[k][0] for k in seen)
    return [(rows[i][0], len(links[i]), root[i]) for i in range(n)], sum(map(len, links)) // 2


def check(spark, rows, least=0.9):
    got = I.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    rows = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    want, links = brute(rows)
    assert len(got) == len(rows)
    found = sum(r.n_links for r in got) / 2
    assert found <= links and found >= least * links
    by = {i: (n, c) for i, n, c in want}
    assert all(r.n_links <= by[r.vec_id][0] and r.component_id >= by[r.vec_id][1] and r.kept == (r.vec_id == r.component_id) for r in got)
    return got, want, found / max(1, links)


def test_recall_on_pairs_at_the_threshold(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=base.shape)
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    c = rng.uniform(0.901, 0.93, size=(1500, 1))  # the hardest pairs there are
    near = c * base + np.sqrt(1 - c**2) * side
    rows = list(enumerate(np.concatenate([base, near]).tolist()))
    _, _, recall = check(spark, rows)
    assert recall >= 0.93


def test_query_gives_every_row_no_wrong_link(spark):
    """The given vectors hold no pair at the cosine, so this says nothing about recall."""
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, _ = brute(rows)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in I.q_op2_itq(spark, sf).collect()) == sorted(want)


def test_edges(spark):
    v = np.random.default_rng(2).normal(size=(6, 8)).tolist()
    rows = [(5, v[0]), (9, v[0]), (2, [2 * c for c in v[0]]), (7, v[1]), (11, None), (12, []), (13, [0.0] * 8), (14, [*v[2][:7], None])]
    rows += [(15, [*v[2][:7], float("nan")]), (16, [*v[2][:7], float("inf")]), (17, [1.0, 2.0]), (18, v[3]), (19, [-0.0 if c > 0 else c for c in v[4]]), (20, v[5])]
    got = I.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' as key", "1 as cid", "2 as n")).collect()
    by = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert len(got) == len(rows) and by[5] == by[9] == (2, 2, False) and by[2] == (2, 2, True)
    assert all(by[i] == (0, i, True) for i in (7, 11, 12, 13, 14, 15, 16, 17, 18, 20))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 0.0])], [(4, [1.0, 0.0]), (4, [1.0, 0.0]), (None, [1.0, 0.0])]])
def test_small_tables(spark, rows):
    got = I.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == len(rows)
    if len(rows) == 3:
        assert all(r.n_links == 2 and r.component_id == 4 for r in got)


@pytest.mark.parametrize("dim, share", [(64, 0.6), (64, 0.7), (160, 0.6)])
def test_recall_with_a_common_direction(spark, dim, share):
    """Vectors around one direction: centred, pairs at cosine 0.9 are far wider apart."""
    rng = np.random.default_rng(3)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    base = unit(rng.normal(size=(1500, dim)) / np.sqrt(dim) * np.sqrt(1 - share) + np.eye(dim)[0] * np.sqrt(share))
    side = rng.normal(size=base.shape)
    side = unit(side - (side * base).sum(axis=1, keepdims=True) * base)
    c = rng.uniform(0.901, 0.91, size=(1500, 1))
    rows = list(enumerate(np.concatenate([base, c * base + np.sqrt(1 - c**2) * side]).tolist()))
    _, _, recall = check(spark, rows)
    assert recall >= 0.93


def test_every_dimension_is_linked(spark):
    """Minor dimensions are compared too, and only with themselves."""
    rng = np.random.default_rng(7)
    rows, at = [], 0
    for dim, n in ((64, 300), (16, 120), (3, 40), (2, 30), (1, 4)):
        for v in rng.normal(size=(n, dim)):
            rows.append((at, v.tolist()))
            rows.append((at + 1, (v + 0.05 * np.linalg.norm(v) * rng.normal(size=dim) / np.sqrt(dim)).tolist()))
            at += 2
    by_dim = {}
    for i, v in rows:
        by_dim.setdefault(len(v), []).append((i, v))
    got = {r.vec_id: r for r in I.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert len(got) == len(rows)
    for some in by_dim.values():
        want, links = brute(some)
        found = sum(got[i].n_links for i, _ in some) / 2
        assert links and 0.95 * links <= found <= links
        assert all(got[i].n_links <= n and got[i].component_id >= c for i, n, c in want)


def test_plan_narrows_segments_instead_of_comparing_all():
    hard = [np.full(100, 0.45)]
    width, rotations = I.plan_tables(100_000, 64, hard)
    assert width < 19 and rotations <= I.MAX_ROTATIONS
    assert I.plan_tables(2, 1, [np.full(10, 0.5)]) == (1, 1)
