import numpy as np
from pyspark.sql import functions as F

from layerwell.llm.neighbours import encode, estimate, rotation, search

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def frame(spark, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x") for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def brute(vectors, k=20):
    v = np.array([x for _, x in vectors], np.float32).astype(np.float64)
    ids = np.array([i for i, _ in vectors])
    out = {}
    for i, q in zip(ids, v):
        if i % 20 == 0:
            score = (v * q).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 48))
    vectors = [(i, centres[i % 8] * 0.7 + rng.normal(size=48)) for i in range(1500)]
    vectors += [(2000 + i, vectors[0][1]) for i in range(300)]  # one very common vector
    vectors = [(i, v.astype(np.float32)) for i, v in vectors]
    got, want = found(search(frame(spark, vectors), F.col("vec_id") % 20 == 0)), brute(vectors)
    assert got.keys() == want.keys()
    hits = sum(len({x for x, _ in got[q]} & {x for x, _ in want[q]}) for q in want)
    assert hits >= 0.99 * 20 * len(want)
    exact = {q: dict(want[q]) for q in want}
    assert all(s == exact[q].get(v, s) for q in got for v, s in got[q])


def test_vectors_that_take_no_part(spark):
    good = [(0, [1, 2, 3]), (1, [1, 2, 3]), (2, [3, 2, 1]), (20, [0, 0, 1]), (41, [-1, 0, 0])]
    bad = [(40, None), (60, [0, 0, 0]), (3, [1, None, 1]), (4, [1, float("nan"), 1]), (5, [1, float("inf"), 1]), (6, [1, 1]), (None, [1, 1, 1]), (7, [])]
    got = found(search(frame(spark, good + bad + good[:1]), F.col("vec_id") % 20 == 0))
    assert got == brute([(i, np.array(v, np.float32)) for i, v in good])


def test_no_rows_no_queries_and_one_dimension(spark):
    assert search(frame(spark, []), F.col("vec_id") % 20 == 0).collect() == []
    assert search(frame(spark, [(1, [1, 2])]), F.col("vec_id") % 20 == 0).collect() == []
    line = [(20 * i, np.array([i + 1], np.float32)) for i in range(30)]
    assert found(search(frame(spark, line), F.col("vec_id") % 20 == 0)) == brute(line)


def test_bounds_hold():
    rng = np.random.default_rng(5)
    vectors, queries = rng.normal(size=(3000, 64)), rng.normal(size=(40, 64))
    centre, turn = vectors.mean(axis=0), rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    about, bound = estimate(*encode(vectors, centre, turn), queries, centre, turn)
    assert (np.abs(about - queries @ vectors.T) <= bound).mean() > 0.999
