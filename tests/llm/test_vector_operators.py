import random

import numpy as np
import pytest

from verdance.llm import neardup, topk

VEC = "vec_id long, embedding array<float>, label int, id int, dims int, n int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], None, 3, 4, 5) for i, v in vectors], VEC)


def brute_top(vectors, k=20, every=20):
    ok = {i: [int(np.floor(64 * float(np.float32(c)))) for c in v] for i, v in vectors if v is not None and i is not None and all(c is not None and np.isfinite(c) for c in v)}
    out = []
    for q, x in ok.items():
        if q % every == 0:
            s = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ok.items() if i != q and len(y) == len(x))[:k]
            out += [(q, r + 1, i, -p) for r, (p, i) in enumerate(s)]
    return sorted(out)


def odd_vectors(rng):
    out = [(i, rng.normal(size=8) * rng.choice([0.1, 1, 3])) for i in range(400)]
    out += [(1000 + i, out[0][1]) for i in range(30)]  # equal vectors: ties
    out += [(2000, None), (2001, [np.nan] * 8), (2002, [None] + [0.0] * 7), (2003, [np.inf] * 8), (2004, [0.0] * 8), (2005, [0.5, 0.5]), (2020, [1.0, 2.0]), (None, [0.0] * 8), (2040, [])]
    return out + [out[20], out[20]]  # repeated rows


@pytest.mark.parametrize("tree, batch, first", [(32 << 20, 64 << 20, 8), (3000, 4000, 2)])
def test_top_products_are_brute_force(spark, tree, batch, first):
    vectors = odd_vectors(np.random.default_rng(1))
    got = sorted(tuple(r) for r in topk.top_products(frame(spark, vectors), tree_bytes=tree, batch_bytes=batch, trees_first=first).collect())
    assert got == brute_top(dict(reversed([v for v in vectors if v[0] is not None])).items())


def test_huge_components_are_exact(spark):
    """Some vectors beyond what doubles and 64 bits hold, among usual ones: the order is that of whole numbers."""
    rng = np.random.default_rng(2)
    vectors = [(i, rng.normal(size=6)) for i in range(300)] + [(300 + i, rng.normal(size=6) * 10.0 ** rng.integers(5, 30)) for i in range(41)]
    vectors += [(400, vectors[340][1]), (401, -vectors[340][1]), (402, [0.0] * 6)]
    got = sorted(tuple(r) for r in topk.top_products(frame(spark, vectors)).collect())
    cut = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    assert got == [(q, r, i, cut(s)) for q, r, i, s in brute_top(vectors)]
    assert topk.top_products(frame(spark, [])).count() == 0 and topk.top_products(frame(spark, [(20, [1.0])])).count() == 0


def test_one_huge_vector_leaves_the_trees_alone():
    """Few products are computed, with or without it."""
    x = np.floor(64 * np.random.default_rng(4).normal(size=(6000, 8)))
    t, seen = topk.Tree.build(topk.shrunk(x, topk.norms(x).max())), []
    q = np.floor(64 * np.random.default_rng(5).normal(size=(50, 8)))
    q[0] *= 1e30
    i, j = t.search(topk.shrunk(q, topk.norms(q)), np.arange(6000), 5, 1e-12, np.full(50, -np.inf))
    for n in range(1, 50):
        seen += [set(np.argsort(-(x @ q[n]), kind="stable")[:5].tolist()) <= set(j[i == n].tolist())]
    assert all(seen) and len(i) <= 50 * 8


def test_copies_are_searched_once(spark):
    """A third of the rows are one vector; every query has its own 20 best all the same."""
    rng = np.random.default_rng(6)
    one = rng.normal(size=5)
    vectors = [(i, one if i % 3 == 0 else rng.normal(size=5)) for i in range(900)]
    assert sorted(tuple(r) for r in topk.top_products(frame(spark, vectors)).collect()) == brute_top(vectors)


def test_tree_keeps_its_bounds():
    x = np.floor(np.random.default_rng(3).normal(size=(3000, 6)) * 20)
    t = topk.Tree.build(topk.shrunk(x, topk.norms(x).max()))
    assert sorted(np.concatenate(t.entries).tolist()) == list(range(3000))

    def rows(n):
        return t.entries[n] if not len(t.children[n]) else np.concatenate([rows(c) for c in t.children[n]])

    for n in range(len(t.router)):
        assert t.between(t.router[n], rows(n)).max() <= t.radius[n] + 1e-9
        for c in t.children[n]:
            assert abs(t.between(t.router[n], t.router[c : c + 1])[0] - t.parent[c]) < 1e-9


def clusters(rng, n=60, dims=32):
    out, i = [], 0
    for _ in range(n):
        c = rng.normal(size=dims)
        for _ in range(rng.integers(1, 8)):
            out.append((i, c + rng.normal(size=dims) * rng.choice([0.0, 0.1, 0.3, 0.45])))
            i += 1
    return out


def test_near_duplicates_are_brute_force(spark):
    rng = np.random.default_rng(7)
    vectors = clusters(rng, 250)
    extra = [(9000, None), (9001, [0.0] * 32), (9002, [np.nan] * 32), (9003, [None] * 32), (9004, [1.0, 2.0]), (9005, [2.0, 4.0]), (9006, []), (None, vectors[0][1]), (9007, [1e-30] * 32), (9008, [1e30] * 32)]
    rows = frame(spark, vectors + extra + [vectors[3]])
    got = neardup.near_duplicates(rows).collect()
    assert len(got) == len(vectors) + len(extra) + 1
    by = {r.vec_id: r for r in got if r.vec_id is not None}
    ids = [i for i, _ in vectors]
    u = np.array([np.float32(v).astype(float) for _, v in vectors])
    u /= np.linalg.norm(u, axis=1)[:, None]
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    found = sum(by[i].n_links for i in ids)
    assert all(by[i].n_links <= link[k].sum() for k, i in enumerate(ids))
    assert found >= 0.98 * link.sum()
    assert by[9004].n_links == by[9005].n_links == 1 and by[9005].component_id == 9004 and not by[9005].kept
    assert by[9007].n_links == 1 and by[9008].component_id == 9007
    for i in (9000, 9001, 9002, 9003, 9006):
        assert by[i].n_links == 0 and by[i].component_id == i and by[i].kept
    assert neardup.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("dims, m", [(8, 1024), (64, 1024), (64, 4096), (256, 2048), (64, 16_384)])
def test_recall_is_calibrated(dims, m):
    """At the threshold itself, where pairs are hardest to find."""
    rng, pairs = np.random.default_rng(11), 600
    n, width, count = neardup.calibrate(0.9, m, dims)
    a = rng.normal(size=(pairs, dims))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=(pairs, dims))
    b -= (a * b).sum(axis=1)[:, None] * a
    b = 0.9 * a + np.sqrt(0.19) * b / np.linalg.norm(b, axis=1)[:, None]
    (la, xa), (lb, xb) = neardup.entries(a, m, n), neardup.entries(b, m, n)
    found = 0
    for i in range(pairs):
        own = dict(zip(la[i].tolist(), xa[i].tolist()))
        found += sum(k in own and abs(own[k] - x) <= width for k, x in zip(lb[i].tolist(), xb[i].tolist())) >= count
    assert found >= 0.985 * pairs


def linked(x):
    u = x / np.linalg.norm(x, axis=1)[:, None]
    out = u @ u.T >= 0.9
    np.fill_diagonal(out, False)
    return out


@pytest.mark.parametrize("shift", [0, 1, 2])
def test_a_common_mean_fills_no_list(spark, monkeypatch, shift):
    """The candidates stay well under all pairs where the vectors have a mean in common, and few links are lost."""
    rng, n = np.random.default_rng(3), 1500
    x = rng.normal(size=(n, 64)) + shift
    for i in range(300):
        r = rng.normal(size=64)
        r -= (r @ x[i]) / (x[i] @ x[i]) * x[i]
        c = rng.uniform(0.9, 0.93)
        x[1000 + i] = 8 * (c * x[i] / np.linalg.norm(x[i]) + np.sqrt(1 - c * c) * r / np.linalg.norm(r))
    x = np.float32(x).astype(float)
    seen = {}
    whole = neardup.materialize
    monkeypatch.setattr(neardup, "materialize", lambda df, name: seen.setdefault(name, whole(df, name)))
    got = {r.vec_id: r.n_links for r in neardup.near_duplicates(frame(spark, enumerate(x))).collect()}
    want = linked(x).sum(axis=1)
    assert all(got[i] <= want[i] for i in range(n)) and sum(got.values()) >= [0.985, 0.985, 0.97][shift] * want.sum()
    assert seen["candidates"].count() <= [0.02, 0.05, 0.4][shift] * n * n / 2


def test_dense_groups_go_by_representatives(spark, monkeypatch):
    """Links of a group of near copies are counted whole, though few pairs are compared; some lie between balls."""
    rng = np.random.default_rng(5)
    c = rng.normal(size=(2, 64))
    c[1] = c[0] + 0.55 * c[1]
    x = np.concatenate([c[0] + 0.1 * rng.normal(size=(300, 64)), c[1] + 0.12 * rng.normal(size=(200, 64)), rng.normal(size=(300, 64))])
    x = np.float32(x).astype(float)
    seen = {}
    whole = neardup.materialize
    monkeypatch.setattr(neardup, "materialize", lambda df, name: seen.setdefault(name, whole(df, name)))
    got = {r.vec_id: r for r in neardup.near_duplicates(frame(spark, enumerate(x))).collect()}
    want = linked(x)
    assert [got[i].n_links for i in range(len(x))] == want.sum(axis=1).tolist()
    assert seen["ball-pairs"].count() <= 0.05 * want.sum()
    assert {got[i].component_id for i in range(300)} == {0}


def test_equal_vectors_are_one_class(spark):
    rng = random.Random(1)
    v = [rng.random() for _ in range(16)]
    got = neardup.near_duplicates(frame(spark, [(i, v) for i in range(50)])).collect()
    assert all(r.n_links == 49 and r.component_id == 0 for r in got) and sum(r.kept for r in got) == 1
