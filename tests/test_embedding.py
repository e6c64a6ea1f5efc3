import numpy as np
import pytest

from tallywell.operators.embedding import embed_cells, embed_graph, neighbour_graph, residuals


def cells(spark, groups, size, parts=3, dim=12):
    rng = np.random.default_rng(8)
    v = np.concatenate([rng.normal(size=dim) * 6 + rng.normal(size=(size, dim)) for _ in range(groups)])
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    return v, spark.createDataFrame(rows, "cell_id long, vector array<double>").repartition(parts)


@pytest.mark.parametrize("parts", [1, 6])
def test_neighbours(spark, parts):
    v, frame = cells(spark, 3, 60, parts)
    got = {}
    for r in neighbour_graph(frame, k=5, bucket_rows=32).collect():
        assert r.distance2 == pytest.approx(((v[r.i] - v[r.j]) ** 2).sum()) and r.i != r.j
        got.setdefault(r.i, set()).add(r.j)
    want = {i: set(np.argsort(((v - v[i]) ** 2).sum(1), kind="stable")[1:6].tolist()) for i in range(180)}
    assert all(len(own) == 5 for own in got.values())
    assert np.mean([len(got[i] & want[i]) / 5 for i in want]) >= 0.9


def test_components_are_leading_eigenvectors(spark):
    ring = [(i, (i + s) % 40, 1.0) for i in range(40) for s in (1, 2)] + [(i, i + 40, 1.0) for i in range(3)] + [(40, 41, 1.0), (41, 42, 1.0)]
    graph = spark.createDataFrame(ring, "i long, j long, distance2 double").repartition(4)
    placed, values = embed_graph(graph, dims=2, rounds=45)
    a = np.zeros((43, 43))
    for i, j, _ in ring:
        a[i, j] = a[j, i] = 1
    d = a.sum(1)
    exact = np.sort(np.linalg.eigvalsh((np.eye(43) + a / np.sqrt(np.outer(d, d))) / 2))[::-1]
    assert values == pytest.approx(exact[1:3], abs=1e-4)
    assert max(residuals(graph, placed, values)) < 0.02
    x = np.array([[r.component_1, r.component_2] for r in sorted(placed.collect())])
    assert np.allclose(x.T @ (d[:, None] * x), np.eye(2), atol=1e-6) and np.allclose(d @ x, 0, atol=1e-6)


def test_like_cells_lie_together(spark):
    _, frame = cells(spark, 2, 50)
    extra = spark.createDataFrame([(900, None)], "cell_id long, vector array<double>")
    rows = {r.cell_id: (r.component_1, r.component_2) for r in embed_cells(frame.unionByName(extra), k=6, rounds=12).collect()}
    assert rows[900] == (None, None) and len(rows) == 101
    first = np.array([rows[i][0] for i in range(100)])
    assert np.abs(first[:50].mean() - first[50:].mean()) > 5 * (first[:50].std() + first[50:].std())


def test_no_cells(spark):
    none = spark.createDataFrame([], "cell_id long, vector array<double>")
    assert embed_cells(none).count() == 0
    graph = spark.createDataFrame([], "i long, j long, distance2 double")
    placed, values = embed_graph(graph)
    assert placed.count() == 0 and len(values) == 0


def test_vectors_move_once_they_are_needed(spark, monkeypatch):
    """Floats are kept as floats, and the stored visits of the search hold no vectors; the graph is that of doubles."""
    from tallywell.operators import embedding, nearest_lsh
    from tallywell.storage import materialize

    stored = {}

    def noted(df, label="table"):
        stored[label] = dict(df.dtypes)
        return materialize(df, label)

    monkeypatch.setattr(embedding, "materialize", noted)
    monkeypatch.setattr(nearest_lsh, "materialize", noted)
    _, frame = cells(spark, 3, 60)
    floats = frame.selectExpr("cell_id", "cast(vector AS array<float>) AS vector")
    got = sorted(tuple(r) for r in neighbour_graph(floats, k=5, bucket_rows=32).collect())
    assert stored["cells"]["v"] == "array<float>" and not any("array" in t for t in stored["visits"].values())
    doubles = floats.selectExpr("cell_id", "cast(vector AS array<double>) AS vector")
    assert got == sorted(tuple(r) for r in neighbour_graph(doubles, k=5, bucket_rows=32).collect())
    assert stored["cells"]["v"] == "array<double>"
