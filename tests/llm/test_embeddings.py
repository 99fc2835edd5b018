import numpy as np
from pyspark.sql import functions as F

from tidewell.llm.embeddings import MultiIndex, fit, near_vectors, op10_multi_index


def brute(rows):
    x = {i: None for i, _ in rows}
    links = {i: set() for i, _ in rows}
    good = {i: np.array(v, float) / np.linalg.norm(v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v) and np.linalg.norm(v) > 0}
    for i in good:
        links[i] = {j for j in good if j != i and len(good[i]) == len(good[j]) and good[i] @ good[j] >= 0.95}
    for i in sorted(x):
        if x[i] is None:
            todo, x[i] = [i], i
            while todo:
                for j in links[todo.pop()]:
                    if x[j] is None:
                        x[j] = i
                        todo.append(j)
    return {i: (len(links[i]), x[i], x[i] == i) for i in x}


def test_against_all_pairs(spark):
    rng = np.random.default_rng(8)
    vectors = [(rng.normal(size=16) * 3).tolist() for _ in range(300)]
    for v in vectors[:40]:
        vectors += [(np.array(v) + rng.normal(size=16) * s).tolist() for s in (0.1, 0.4, 0.7)]
    vectors += [vectors[0]] * 25 + [None, [], [0.0] * 16, [None] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1e200] * 16, [1e-200] * 16, [1.0, 2.0], [2.0, 4.0]]
    rows = list(enumerate(vectors))
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, n_links int")
    for how in (MultiIndex(), MultiIndex(block=16)):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df, how=how).collect()}
        scaled = {1e200: 1.0, 1e-200: 1.0}
        want = brute([(i, [scaled[v[0]]] * 16 if v and v[0] in scaled else v) for i, v in rows])
        assert set(got) == set(want)
        found, real = sum(g[0] for g in got.values()), sum(w[0] for w in want.values())
        assert all(got[i][0] <= want[i][0] for i in want) and found >= 0.97 * real
        if found == real:
            assert got == want
    assert near_vectors(df.where(F.lit(False))).count() == 0


def test_query_on_linked_vectors(spark, tmp_path):
    """The registered query against all pairs, on vectors of which many are linked, with hot groups and cells joined without a broadcast."""
    rng = np.random.default_rng(10)
    centres = rng.normal(size=(60, 24))
    vectors = [(centres[k % 60] + rng.normal(size=24) * (0.02 if k < 400 else 0.3)).tolist() for k in range(900)] + [centres[0].tolist()] * 60
    spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    want = brute(list(enumerate(vectors)))
    real = sum(w[0] for w in want.values())
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in op10_multi_index(spark, str(tmp_path)).collect()}
    assert set(got) == set(want) and all(got[i][0] <= want[i][0] for i in want) and sum(g[0] for g in got.values()) >= 0.97 * real > 3000
    near_pairs = sum(got[i][1] == want[i][1] for i in want)
    assert near_pairs >= 0.97 * len(want)


def test_traversal_visits_the_nearest_cells_in_order():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(200, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    books = fit(x, 5000, MultiIndex())
    d1, d2 = books.distances(x)
    for a, b, cells in zip(d1, d2, books.visits(d1, d2)):
        total = (a[:, None] + b[None]).ravel()
        assert set(cells.tolist()) == set(np.flatnonzero(total <= total.min() + books.reach + 1e-12).tolist())
        assert (np.diff(total[cells]) >= -1e-9).all()
