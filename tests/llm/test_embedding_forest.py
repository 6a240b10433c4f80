import numpy as np
import pytest

from linkrank.llm import embedding_forest
from linkrank.llm.embedding_forest import Tree, leaf_links

SCHEMA = "vec_id long, embedding array<double>, label int, key string, node string, n string, leaf string"


def plain(ids, vectors, least=0.95):
    """Links of each row and the smallest id reachable, by comparing all pairs."""
    good = [v is not None and len(v) == 16 and None not in v and bool(np.isfinite(v).all()) and any(v) and i is not None for i, v in zip(ids, vectors, strict=True)]
    x = np.array([v if g else [0.0] * 16 for v, g in zip(vectors, good, strict=True)], float)
    norm = np.sqrt((x * x).sum(1))
    near = (x @ x.T >= least * np.outer(norm, norm)) & np.outer(good, good)
    np.fill_diagonal(near, False)
    links, label = near.sum(1), np.arange(len(ids))
    while True:
        new = np.array([min([label[k], *label[near[k]]]) for k in range(len(ids))])
        if (new == label).all():
            break
        label = new
    of = [min((ids[k] for k in np.flatnonzero(label == label[i]) if ids[k] is not None), default=None) if good[i] else ids[i] for i in range(len(ids))]
    return sorted(repr((i, int(n), c, i is not None and i == c)) for i, n, c in zip(ids, links, of, strict=True))


def run(spark, ids, vectors, **options):
    rows = [(i, v, 1, "x", "x", "x", "x") for i, v in zip(ids, vectors, strict=True)]
    found = embedding_forest.near_duplicates(spark.createDataFrame(rows, SCHEMA), **options).collect()
    return sorted(repr((r.vec_id, r.n_links, r.component_id, r.kept)) for r in found)


def cloud(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 16))
    x[50:130] = x[50] + 0.08 * rng.standard_normal((80, 16))  # a crowd
    for k in range(130, 200, 2):
        x[k + 1] = x[k] + 0.1 * rng.standard_normal(16)
    x[200:230] = x[200]  # copies
    x[230:240] = 3 * x[230]  # longer ones
    return [list(map(float, v)) for v in x]


@pytest.mark.parametrize("options", [{}, {"leaf_rows": 60}, {"leaf_rows": 40, "sample_rows": 100}])
def test_links_of_all_pairs(spark, options):
    vectors = cloud()
    assert run(spark, range(400), vectors, **options) == plain(range(400), vectors)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [0.0] * 16, [1.0, None] * 8, [nan] * 16, [inf] * 16, [], [1.0] * 5, [1.0] * 16, [2.0] * 16, [1.0] * 16, [1e300] * 16, [1e-300] * 16]
    ids = [*range(20, 27), 5, 4, None, 3, 6]
    assert run(spark, ids, vectors) == plain(ids, [v if v is None or len(v) < 16 or abs(v[0]) in (0, 1, 2, inf) or v[0] != v[0] else [1.0] * 16 for v in vectors])
    assert run(spark, [], []) == []
    assert run(spark, [1, 2], [None, None]) == sorted(repr((i, 0, i, True)) for i in (1, 2))


def test_leaf_counts_pairs_of_earlier_leaves_once():
    x = np.ones((4, 2)) / np.sqrt(2)
    member = [np.array([1, 7]), np.array([1, 7]), np.array([3, 7]), np.array([7])]
    links, label = leaf_links(x, np.array([1, 1, 5, 1]), member, 7, 0.95)
    assert links.tolist() == [6, 6, 3, 7] and label.tolist() == [0, 0, 0, 0]


def test_recall_with_many_small_leaves():
    """One tree of many levels with spill, then the chance that all trees part a pair."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4000, 64))
    x[1::2] = x[::2] + np.sqrt(2 / 0.96 - 2) * rng.standard_normal((2000, 64)) * 0.7
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x[::2] * x[1::2]).sum(1) >= 0.95
    met = np.zeros(2000, bool)
    for seed in range(8):
        row, leaf = Tree(x[:1000], 64, 2, 0.5 * np.sqrt(0.1) / 8, seed).leaves_of(x)
        of = [set() for _ in x]
        for r, f in zip(row, leaf, strict=True):
            of[r].add(int(f))
        assert all(of)
        met |= np.array([bool(of[2 * k] & of[2 * k + 1]) for k in range(2000)])
    assert near.sum() > 500 and met[near].mean() > 0.99


def test_crowd_is_one_leaf_of_a_tree():
    """A third of the vectors lie within the margin of each other; cuts through them would send all of them both ways."""
    rng = np.random.default_rng(7)
    x = rng.standard_normal((6000, 64))
    x[:2000] = x[0] + 0.03 * rng.standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = Tree(x[::3], 16, 0, 0.5 * np.sqrt(0.1) / 8, 3)
    row, _ = tree.leaves_of(x)
    assert np.bincount(row, minlength=6000)[:2000].mean() < 8
    assert all(np.bincount(row, minlength=6000) > 0)


def test_crowd_dealt_as_pairs_of_blocks(spark):
    vectors = cloud()
    assert run(spark, range(400), vectors, leaf_rows=60, leaf_block=25) == plain(range(400), vectors)
