import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emberline.llm import periodic

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute_runs(words, least_words=6, least_periods=4):
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    known, out = np.array([names[w] for w in words], int), []
    for period in range(1, len(words) // least_periods + 1):
        same = np.concatenate([[False], known[:-period] == known[period:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = end - start + period
            if length >= max(least_words, least_periods * period):
                stretch = known[start:start + length]
                if not any((stretch[d:] == stretch[:-d]).all() for d in range(1, period)):
                    out.append((start, length, period))
    return sorted(out)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text, rewrite=True):
    words = WORD.findall(text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if rewrite and h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + math.floor((n - a) / (3 + g % 8))
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    return (doc_id, len(runs), start, length, period, 1000 * length // period if runs else None,
            digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def key(row):
    return tuple((value is not None, value) for value in row)


def check(spark_rows, expected):
    assert sorted(map(tuple, spark_rows), key=key) == sorted(expected, key=key)


words = st.lists(st.integers(0, 2), max_size=50)


@settings(max_examples=300, deadline=None)
@given(words, st.integers(1, 8), st.sampled_from([(6, 4), (2, 2), (6, 3), (9, 4)]))
def test_automaton_against_brute_force(head, repeat, least):
    for sequence in (head, head * repeat, head + head[:5] * repeat + head[::-1]):
        assert periodic.runs_of(sequence, *least) == brute_runs(sequence, *least)


@pytest.mark.parametrize("least", [(6, 4), (4, 2), (6, 3), (9, 4), (3, 5)])
def test_stretches_lose_no_run(spark, make, least):
    rng = random.Random(7)
    rows = []
    for i in range(150):
        text = [rng.choice("abc") * 2 for _ in range(rng.randrange(12))]
        for _ in range(rng.randrange(5)):
            text += [rng.choice("abcd") for _ in range(rng.randrange(1, 6))] * rng.randrange(1, 7)
        rows.append((i, " ".join(text)))
    got = {r.doc_id: [tuple(x) for x in r.runs]
           for r in periodic.find(make(rows), least_words=least[0], least_periods=least[1]).collect()}
    assert got == {i: brute_runs(t.split(), *least) for i, t in rows}


TEXTS = [
    None, "", " \t\n", "one", "a a a a a", "a a a a a a", "x y x y x y x y", "x y x y x y x", "b c " * 9,
    "  " * 8 + "end", "one two three " * 7 + "one two four " * 4 + "four four four four four four",
    "a a a b " * 6 + "a a a a a a a", "é ß\x0b𝄞\r\n" * 5, "p " * 9_000 + "q r s " * 3_000 + "long tail of words",
    "w" * 300_000 + " z" * 6,
]


def test_awkward_texts_match_brute_force(make):
    rows = list(enumerate(TEXTS)) + [(i + 100, t) for i, t in enumerate(TEXTS[:-2])]
    rows += [(10, TEXTS[10]), (10, TEXTS[10]), (None, TEXTS[10]), (None, TEXTS[10]), (None, None), (10, "other " * 6)]
    check(periodic.summary(periodic.find(make(rows), periodic.looped)).collect(), [brute(*row) for row in rows])
    check(periodic.summary(periodic.find(make(rows))).collect(), [brute(*row, rewrite=False) for row in rows])


def test_documents_match_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect() if len(r.text or "") < 20_000]
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)
    short = documents.filter("text is null or length(text) < 20000")
    check(periodic.summary(periodic.find(short, periodic.looped)).collect(), [brute(*row) for row in rows])


def test_collapsed_text(make):
    got = periodic.collapse(make([(1, "say it " + "again and " * 4 + "again stop")])).first()
    assert got.text == "say it again and stop"


def test_empty_table_and_clashing_columns(spark, make):
    assert periodic.summary(periodic.find(make([]), periodic.looped)).count() == 0
    rows = spark.createDataFrame([(3, "a " * 6, "x", 1, "y", 2)],
                                 "doc_id bigint, text string, runs string, start int, collapsed string, best int")
    assert periodic.summary(periodic.find(rows)).first().n_runs == 1


def test_one_period_is_no_run(make):
    with pytest.raises(ValueError):
        periodic.find(make([]), least_periods=1)
