import re
from collections import defaultdict

import numpy as np
import pytest

from emberline.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Water filling by hand: source -> target."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    free, left, out = set(sizes), 1.5 * sum(sizes.values()), {}
    while free:
        ratio = left / sum(weight[s] for s in free)
        over = [s for s in free if ratio * weight[s] > 2 * sizes[s]]
        if not over:
            out.update({s: ratio * weight[s] for s in free})
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            free.remove(s)
    return out


def check(rows, docs, **options):
    got = mixing.mix(docs, **options).collect()
    size = lambda t: len(WORD.findall(t or ""))
    assert sorted((str(r.doc_id), str(r.source), r.size) for r in got) == sorted(
        (str(d), str(s), size(t)) for d, t, s in rows)
    sums, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for d, t, s in rows:
        sums[s] += size(t)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and (not r.size or r.taken % r.size == 0)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s, target in targets(sums).items():
        one = next(r for r in got if r.source == s)
        assert one.source_size == sums[s] and one.target == pytest.approx(target, rel=1e-9)
        assert abs(taken[s] - target) <= max(largest[s], 1e-6) * options.get("slack", 1)
    return got


def rows_of(documents):
    return [(r.doc_id, r.text, r.source) for r in documents.select("doc_id", "text", "source").collect()]


def test_documents_come_near_their_targets(documents):
    rows = rows_of(documents)
    first = check(rows, documents, bucket_rows=7)
    assert sorted(first) == sorted(mixing.mix(documents.repartition(5), bucket_rows=7).collect())


def test_awkward_rows(make):
    rows = [(1, "a b c", "x"), (2, None, "x"), (3, "", "y"), (None, "a b", None), (5, "w " * 5000, "z"),
            (6, "a b c", "x"), (7, "q", "𝄞"), (8, "q r", "￿"), (9, "only", "")]
    check(rows, make(rows))
    assert mixing.mix(make([])).count() == 0
    twice = [(1, "a b c", "x")] * 2 + [(i, "a b c d", "y") for i in range(10, 40)]
    got = mixing.mix(make(twice)).filter("doc_id = 1").collect()
    assert len(got) == 2 and got[0].taken == got[1].taken


def test_fold_keeps_expectation():
    sizes, parts = np.array([3.0, 5.0, 2.0, 7.0, 4.0]), np.array([0.25, 0.5, 0.75, 0.4, 0.6])
    total, runs = np.zeros(5), 4000
    for seed in range(runs):
        out, held = mixing.fold(sizes, parts.copy(), np.random.default_rng(seed))
        assert abs((out * sizes).sum() - (parts * sizes).sum()) < 1e-9
        assert all(x in (0.0, 1.0) for i, x in enumerate(out) if i != held)
        total += out
    assert np.abs(total / runs - parts).max() < 0.03


def test_apply_repeats_rows(make):
    rows = [(i, "w " * (i % 9 + 1), "ab"[i % 3 == 0]) for i in range(60)]
    docs = make(rows)
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    out = mixing.apply(docs)
    assert out.columns == docs.columns
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id] += 1
        assert r.text == rows[r.doc_id][1] and r["size"] == "s"
    assert got == {d: c for d, c in copies.items() if c}


@pytest.mark.parametrize("doc_id", [7, None])
def test_repeated_rows_come_near_the_target(make, doc_id):
    rows = [(doc_id, "w " * 100, "a")] * 200 + [(1000 + i, "v " * 100, "b") for i in range(100)]
    got = check(rows, make(rows))
    copies = sorted(r.copies for r in got if r.source == "a")
    assert copies[-1] - copies[0] == 1
    out = defaultdict(int)
    for r in mixing.apply(make(rows)).collect():
        out[r.source] += 100
    assert out == {s: sum(r.taken for r in got if r.source == s) for s in "ab"}


def test_apply_takes_some_of_rows_that_differ_elsewhere(spark):
    rows = [(1, "a b c", "x", i % 3, "c", "n") for i in range(30)] + [(i, "a b c", "y", 0, "c", "n") for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, copies int, _copy string, _n string")
    mixed = mixing.mix(docs).collect()
    out = mixing.apply(docs)
    assert out.columns == docs.columns
    got = defaultdict(int)
    for r in out.collect():
        got[r.source] += 1
    assert got == {s: sum(r.copies for r in mixed if r.source == s) for s in "xy"}
    assert sorted(out.collect()) == sorted(mixing.apply(docs.repartition(3)).collect())


def test_long_lists_of_copies(make, monkeypatch):
    monkeypatch.setattr(mixing, "LISTED", 7)
    rows = [(1, "a b", "x")] * 50 + [(2, "a b c", "y")] * 15
    assert len(check(rows, make(rows))) == 65
