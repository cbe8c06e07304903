import numpy as np
import pytest

from acerto.llm import near_vectors as nv


def brute(vectors, ids):
    x = np.array(vectors, float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    first, second = np.nonzero(linked)
    return linked.sum(axis=1), np.array(ids)[nv._spanning(len(x), first, second)]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((60, 32))
    near = [c + rng.standard_normal(32) * s for c in centres for s in (0.1, 0.15, 0.2, 0.25, 0.3)]
    hot = [centres[0] + rng.standard_normal(32) * 0.12 for _ in range(150)]
    return [list(map(float, v)) for v in [*near, *hot, *rng.standard_normal((150, 32)), *near[:20], *near[:20]]]


@pytest.mark.parametrize("options", [{}, {"bucket": 16, "block": 32}, {"bucket": 64, "block": 16}])
def test_same_as_brute_force(spark, vectors, options):
    ids = list(range(5, 5 + len(vectors)))
    rows = spark.createDataFrame(list(zip(ids, vectors)), "vec_id long, embedding array<double>")
    found = sorted(nv.near_vectors(rows, **options).collect())
    links, roots = brute(vectors, ids)
    assert sum(r.n_links for r in found) >= 0.99 * links.sum()
    assert all(r.n_links <= n for r, n in zip(found, links))
    if not options:
        assert [r.n_links for r in found] == list(links)
        assert [r.component_id for r in found] == list(roots)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    x, y = rng.standard_normal(64), rng.standard_normal(64)
    x, y = x / np.linalg.norm(x), y / np.linalg.norm(y)
    errors = []
    for seed in range(300):
        turn = nv.rotation(64, seed)
        code = np.sign(turn @ x)
        factor = np.abs(turn @ x).sum() / 8
        found, bound = nv.estimates(code[None], np.array([factor]), (turn @ y)[None], 4.0)
        errors.append(found[0, 0] - x @ y)
        assert abs(errors[-1]) <= bound[0]
    assert abs(np.mean(errors)) < 4 * np.std(errors) / np.sqrt(len(errors))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = spark.createDataFrame(
        [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [nan, 1.0], 0), (5, [None, 1.0], 0), (6, [inf, 1.0], 0), (7, [1.0, 0.0], 0),
         (8, [2.0, 0.0], 0), (9, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (10, [1.0, 0.0, 0.0], 0), (11, [1e300, 1e299], 0), (9, [1.0, 0.0], 0)],
        "vec_id long, embedding array<double>, class int")
    found = {}
    for r in nv.near_vectors(rows).collect():
        found.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert all(found[i] == [(0, i, True)] for i in (1, 2, 3, 4, 5, 6, 10))
    assert found[7] == [(5, 7, True)] and found[8] == [(5, 7, False)] and found[9] == [(5, 7, False)] * 2
    assert found[None] == [(5, 7, False)] and found[11][0][1] == 7
    assert nv.near_vectors(rows.limit(0)).count() == 0


def test_one_id_with_several_vectors(spark):
    a, b = [1.0, 0, 0, 0], [0.0, 1, 0, 0]
    rows = [(1, a), (1, b), (2, [1.0, 0.01, 0, 0]), (0, [0.0, 1, 0.01, 0]), (0, [0.0, 0, 0, 1]), (None, a)]
    rows = [(i, list(map(float, v))) for i, v in rows]
    found = nv.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(1, 2, 1, True), (1, 1, 0, False), (2, 2, 1, False), (0, 1, 0, True), (0, 0, 0, True), (None, 2, 1, False)], key=str)


def test_ids_may_be_text(spark, vectors):
    rows = spark.createDataFrame([(f"v{i:04}", v) for i, v in enumerate(vectors[:120])], "vec_id string, embedding array<double>")
    links, roots = brute(vectors[:120], [f"v{i:04}" for i in range(120)])
    found = sorted(nv.near_vectors(rows).collect())
    assert [(r.n_links, r.component_id) for r in found] == list(zip(links, roots))
