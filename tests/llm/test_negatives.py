import math
import random

import numpy as np
import pytest

from emberline.llm import negatives

SCHEMA = "vec_id bigint, embedding array<double>, label int, key string, copies int, code string, anchor int, size int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "k", 1, "c", 2, 3) for i, v, label in rows], SCHEMA)


def brute(rows, every=50, positives=5, few=3):
    good = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    order = lambda found: sorted(found, key=lambda f: (-f[0], f[1] is None, f[1]))
    for at, (anchor, own, label) in enumerate(good):
        if anchor is None or anchor % every:
            continue
        scored = [(sum(a * b for a, b in zip(own, code)), i, other) for n, (i, code, other) in enumerate(good)
                  if n != at and len(code) == len(own)]
        for score, positive, _ in order([s for s in scored if s[2] == label])[:positives]:
            hard = order([s for s in scored if s[2] != label and 50 * score <= 100 * s[0] <= 95 * score])[:few]
            out += [(anchor, positive, n + 1, i, score, s) for n, (s, i, _) in enumerate(hard)]
    return out


def key(row):
    return tuple((value is not None, value) for value in row)


def check(got, expected):
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("width,size", [(1, 3), (5, 10 ** 4), (64, 10 ** 6), (2_500, 300), (1_500, 2 ** 24)])
def test_residue_products_are_exact(width, size):
    rng = np.random.default_rng(width)
    left, right = rng.integers(-size, size + 1, (7, width)), rng.integers(-size, size + 1, (9, width))
    left[0], right[0], right[1] = size, size, -size
    bound = int(max((left.astype(object) ** 2).sum(1).max(), (right.astype(object) ** 2).sum(1).max()))
    primes = negatives.primes_for(bound)
    got = negatives.scores(negatives.residues(left, primes), negatives.residues(right, primes), primes)
    assert (got == left.astype(object) @ right.T.astype(object)).all()


def test_primes_are_prime_and_enough():
    assert all(p % d for p in negatives.PRIMES for d in range(2, p))
    assert len(negatives.primes_for(0)) == 1 and len(negatives.primes_for(2 ** 61)) == len(negatives.PRIMES)
    assert negatives.SLAB * (max(negatives.PRIMES) // 2) ** 2 < 2 ** 24
    with pytest.raises(ValueError):
        negatives.primes_for(2 ** 63)


@pytest.mark.parametrize("cells", [(8192, 8192), (40, 3)])
def test_against_brute_force(spark, cells):
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(6, 12))
    rows = [(i, (middles[i % 6] + rng.normal(size=12) * 0.6).tolist(), int(rng.integers(0, 3))) for i in range(500)]
    expected = brute(rows, every=20)
    assert len(expected) > 200
    check(negatives.mine(frame(spark, rows), every=20, cell_rows=cells[0], cell_anchors=cells[1]), expected)


def test_ties_repeats_nulls_and_odd_vectors(spark):
    rng, nan = random.Random(5), float("nan")
    rows = [(i, [rng.choice([0.0, 0.5, 1.0, -0.25]) for _ in range(3)], rng.choice([1, 2, None])) for i in range(120)]
    rows += [(50, [1.0, 0.5, 0.5], 1)] * 3 + [(50, [1.0, 1.0, 1.0], 1), (50, [1.0, 0.5, 0.5], 2), (51, [1.0, 0.5, 0.5], 1)]
    rows += [(None, [1.0, 0.5, 0.5], 1), (None, [0.5, 0.5, 0.5], 2), (None, [0.5, 0.5, 0.5], 2), (100, None, 1)]
    rows += [(200, [1.0, None], 1), (200, [nan, 1.0], 1), (200, [float("inf"), 1.0], 1), (250, [], 1), (251, [], 1)]
    rows += [(252, [], 2), (300, [0.0, 0.0], 1), (301, [0.0, 0.0], 1), (302, [0.0, 1.0], 2), (350, [3.0], 1)]
    rows += [(400 + i, [1.0, 0.25, 0.25], 7) for i in range(40)] + [(500 + i, [0.9, 0.1, 0.2], 8) for i in range(40)]
    for cells in ((8192, 8192), (16, 2)):
        check(negatives.mine(frame(spark, rows), cell_rows=cells[0], cell_anchors=cells[1]), brute(rows))


def test_hot_label_and_many_labels(spark):
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=4).tolist(), 1 if i % 2 else 1_000 + i // 3) for i in range(400)]
    check(negatives.mine(frame(spark, rows), every=5, cell_rows=25, cell_anchors=7), brute(rows, every=5))


def test_vectors_too_long_for_longs_take_no_part(spark):
    rows = [(50, [1e300, 1.0], 1), (51, [1e9, 1.0], 1), (100, [3.0, 4.0], 1), (101, [4.0, 4.0], 1), (102, [2.0, 3.0], 2)]
    check(negatives.mine(frame(spark, rows)), brute(rows[2:]))
    large = [(50, [4e6, 1.0], 1), (51, [3e6, -5.0], 1), (52, [2e6, 7.0], 2), (53, [-2e6, 7.0], 2)]
    check(negatives.mine(frame(spark, large)), brute(large))


def test_empty_table(spark):
    assert negatives.mine(frame(spark, [])).count() == 0
    assert negatives.mine(frame(spark, [(1, [1.0], 1)])).count() == 0


def test_labels_are_shifted(spark):
    rows = frame(spark, [(7, [1.0], 9), (8, [1.0], 9), (14, [1.0], None), (None, [1.0], 3)])
    assert [r.label for r in negatives.shifted(rows).collect()] == [0, 9, None, 3]
