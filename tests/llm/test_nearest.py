import numpy as np
import pytest

from ebbwatch.llm.nearest import BLOCK_ROWS, nearest, search_block


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS id", "1 AS rank", "2 AS score")


def test_recall_and_order(spark):
    rng = np.random.default_rng(2)
    points = rng.standard_normal((3000, 24)).astype(np.float32)
    points[100:160] = points[7]  # ties
    vectors = table(spark, [(i, p.tolist()) for i, p in enumerate(points)])
    got = nearest(vectors, vectors.where("vec_id % 20 = 0"), block_rows=1000).toPandas()
    wide = points.astype(np.float64)
    hits = 0
    for query, part in got.groupby("query_id"):
        part = part.sort_values("rank")
        scores = (wide * wide[query]).sum(axis=1)
        assert part["rank"].tolist() == list(range(1, 21)) and query not in set(part.vec_id)
        assert np.array_equal(part.score, scores[part.vec_id])
        assert list(zip(-part.score, part.vec_id)) == sorted(zip(-part.score, part.vec_id))
        order = np.lexsort((np.arange(3000), -scores))
        hits += len({*order[order != query][:20]} & {*part.vec_id})
    assert got.query_id.nunique() == 150 and hits >= 0.9 * 20 * 150


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
        (7, [2.0, 1.0]), (8, [2.0, 5.0]), (None, [9.0, 9.0]), (9, [1.0, 1.0, 1.0]), (20, [3.0, 3.0, 3.0]), (40, [0.5]),
    ]
    vectors = table(spark, rows)
    got = nearest(vectors, vectors.where("vec_id % 20 = 0")).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [(0, 1, 7, 2.0), (0, 2, 8, 2.0), (20, 1, 9, 9.0)]
    assert nearest(vectors.limit(0), vectors.limit(0)).count() == 0


def clouds(rng, kind, n, dims):
    points = rng.standard_normal((n, dims))
    if kind == "unit":
        points /= np.linalg.norm(points, axis=1, keepdims=True)
    if kind == "log-normal":
        points *= rng.lognormal(size=(n, 1))
    if kind == "clusters":
        centers = rng.standard_normal((n // 60, dims)) * 4
        points = centers[rng.integers(0, len(centers), n)] + 0.5 * points
    return points


@pytest.mark.parametrize("dims", [64, 128, 384])
@pytest.mark.parametrize("kind", ["unit", "gaussian", "log-normal", "clusters"])
def test_recall_of_a_registered_block(kind, dims):
    """A block of the registered size against brute force; the shares are those that README gives."""
    points = clouds(np.random.default_rng(dims), kind, BLOCK_ROWS, dims)
    ids = np.arange(BLOCK_ROWS) * 3
    asked = np.arange(0, BLOCK_ROWS, 80)
    scored = []
    found = {}
    for query, i, _ in search_block(ids, points, ids[asked], points[asked], 20, scored):
        found.setdefault(query, []).append(i)
    scores = points[asked] @ points.T
    scores[np.arange(len(asked)), asked] = -np.inf
    truth = np.argsort(-scores, axis=1)[:, :20] * 3
    recall = np.mean([len({*t} & {*found[q]}) / 20 for q, t in zip(ids[asked], truth)])
    share = sum(scored) / len(asked) / BLOCK_ROWS
    print(f"{kind} {dims}: recall {recall:.3f}, share scored {share:.2f}")
    assert recall >= 0.9
    if kind == "clusters":
        assert share < 0.3
