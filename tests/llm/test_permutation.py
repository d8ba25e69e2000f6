import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.llm import permutation

SCHEMA = "vec_id bigint, embedding array<float>, label int, shard string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA)


def brute(rows, every, k):
    good = {}
    for i, v in sorted((r for r in rows if r[0] is not None and r[1]), key=lambda r: r[0]):
        if all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.setdefault(i, np.array(v, np.float32).astype(float))
    out = {}
    for q, a in good.items():
        if q % every == 0:
            all_ = sorted((float(np.sqrt(((a - b) ** 2).sum())), i) for i, b in good.items()
                          if i != q and len(b) == len(a))
            out[q] = [(i, s) for s, i in all_[:k]]
    return out


def test_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    expected = brute(rows, 20, 10)
    got = permutation.neighbours(frame(spark, rows), every=20, shard_rows=500).collect()
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, []).append(r)
    assert set(by_query) == set(expected)
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    hits = 0
    for q, found in by_query.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in found] == sorted((r.score, r.vec_id) for r in found)
        for r in found:
            assert r.score == pytest.approx(np.linalg.norm(vectors[q] - vectors[r.vec_id]), abs=1e-12)
        hits += len({r.vec_id for r in found} & {i for i, _ in expected[q]})
    assert hits >= 0.9 * 10 * len(expected)


def test_many_copies_take_no_place_from_others(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(900)]
    rows += [(i, rows[5][1]) for i in range(900, 1500)]
    got = permutation.neighbours(frame(spark, rows), every=20, shard_rows=400).collect()
    expected = brute(rows, 20, 10)
    by_query = {q: {r.vec_id for r in got if r.query_id == q} for q in expected}
    hits = sum(len(by_query[q] & {i for i, _ in found}) for q, found in expected.items())
    assert hits >= 0.95 * 10 * len(expected)
    assert all(by_query[q] == {i for i, _ in expected[q]} for q in expected if q >= 900)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (9, [1.0, 2.0, 3.0]), (100, [1.0, 2.0, 4.0]),
            (200, [5.0]), (10, [0.0, 1.0]), (10, [0.0, 1.0])]
    got = permutation.neighbours(frame(spark, rows)).collect()
    found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)
    assert found == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 10, 2 ** 0.5), (100, 1, 9, 1.0)]
    assert permutation.neighbours(frame(spark, [])).count() == 0


def test_small_tables_are_searched_whole(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)]
    got = permutation.neighbours(frame(spark, rows), every=7, k=5).collect()
    expected = brute(rows, 7, 5)
    assert {(r.query_id, r["rank"], r.vec_id) for r in got} == {
        (q, n + 1, i) for q, found in expected.items() for n, (i, _) in enumerate(found)}


def test_pivot_sample_is_the_first_by_hash_and_shuffles_little(spark):
    rows = [(i, [float(i), 1.0]) for i in range(3_000)] + [(7, [float(i), 2.0]) for i in range(900)]
    rows += [(i, [1.0, 2.0, float(i)]) for i in range(30)]
    lengths = permutation.usable(frame(spark, rows)).withColumn("length", F.size("embedding"))
    order = [F.xxhash64("vec_id"), "vec_id", "embedding"]
    for wanted in (5, 100, 2_500):
        sample = permutation.first_by_hash(lengths, {2: 3_900, 3: 30}, wanted)
        got = [tuple(r) for r in sample.orderBy("length", "at").select("length", "vec_id", "embedding").collect()]
        expected = [tuple(r) for n in (2, 3) for r in lengths.filter(F.col("length") == n).orderBy(*order).limit(wanted)
                    .select("length", "vec_id", "embedding").collect()]
        assert got == expected
    plan = permutation.first_by_hash(lengths, {2: 3_900, 3: 30}, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "bound" in plan.split("Window")[-1]


def test_repeated_ids_are_candidates_with_each_vector(spark):
    rows = [(1, [0.0, 1.0]), (1, [5.0, 5.0]), (2, [5.0, 5.5]), (100, [5.0, 5.0]), (1, [5.0, 5.0])]
    got = [(r["rank"], r.vec_id, r.score) for r in permutation.neighbours(frame(spark, rows)).orderBy("rank").collect()]
    assert got == [(1, 1, 0.0), (2, 2, 0.5), (3, 1, 41 ** 0.5)]
