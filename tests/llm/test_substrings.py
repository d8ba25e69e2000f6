import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from emberline.llm import fmindex, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size=35):
    starts = defaultdict(int)
    texts = [WORD.findall(t or "") for _, t in rows]
    for words in texts:
        for i in range(len(words) - size + 1):
            starts[tuple(words[i:i + size])] += 1
    out = []
    for (doc, _), words in zip(rows, texts):
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            if starts[tuple(words[i:i + size])] > 1:
                gone[i:i + size] = [True] * size
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def passages():
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(5000)}"
    shared = [[word() for _ in range(n)] for n in (34, 35, 36, 60, 120)]
    texts = []
    for i in range(120):
        words = [word() for _ in range(rng.randrange(0, 150))]
        for _ in range(rng.randrange(0, 3)):
            piece = rng.choice(shared)
            at, cut = rng.randrange(0, len(words) + 1), rng.randrange(0, 8)
            words[at:at] = piece[cut:] if rng.random() < 0.5 else piece[:len(piece) - cut]
        texts.append(words)
        if i % 9 == 0:
            copy = list(words)
            for _ in range(len(copy) // 50):
                copy[rng.randrange(len(copy))] = word()
            texts.append(copy)
    texts += [["a"] * 34, ["a"] * 35, ["a"] * 36, ["b"] * 400, ["x", "y"] * 100, texts[3], shared[3] * 3]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def deduped(docs):
    return sorted(map(tuple, substrings.dedup(docs).collect()), key=str)


@pytest.mark.parametrize("hot", [2000, 3])
def test_passages(make, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT_PLACES", hot)
    rows = passages()
    assert deduped(make(rows).repartition(4)) == brute(rows)


def test_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert deduped(documents) == brute(rows)


def test_awkward_rows(make):
    words = " ".join(f"k{i}" for i in range(50))
    rows = [(1, None), (2, ""), (3, " \t"), (4, words), (4, words), (None, words + " tail"), (None, None), (5, "É " * 40),
            (6, "É " * 40 + "é"), (7, "long text here " * 20_000), (8, words.replace(" ", "\n")), (9, words.upper())]
    assert deduped(make(rows)) == brute(rows)
    assert substrings.dedup(make([])).count() == 0


def test_index_counts_every_pattern():
    rng = np.random.default_rng(3)
    text = np.concatenate([rng.integers(1, 6, 400), [0]])
    index = fmindex.FMIndex(text, 6)
    for _ in range(300):
        size, at = int(rng.integers(1, 9)), int(rng.integers(0, 390))
        pattern = text[at:at + size] if rng.random() < 0.7 else rng.integers(1, 6, size)
        low, high = np.array([0]), np.array([len(text)])
        for symbol in pattern[::-1]:
            low, high = index.extend(np.array([symbol]), low, high)
        expected = sum((text[i:i + len(pattern)] == pattern).all() for i in range(len(text) - len(pattern) + 1))
        assert high[0] - low[0] == expected


@pytest.mark.parametrize("window", [3, 7, 35])
def test_backward_search_finds_all_repeats(window):
    rng = np.random.default_rng(window)
    parts, lengths = [], []
    base = rng.integers(1, 40, 300)
    for _ in range(40):
        own = rng.integers(1, 40, int(rng.integers(1, 120)))
        a = int(rng.integers(0, 200))
        own = np.concatenate([own, base[a:a + int(rng.integers(0, 100))], own[:5]])
        parts += [own, [0]]
        lengths.append(len(own))
    text = np.concatenate(parts)
    starts = np.cumsum(np.array(lengths) + 1) - np.array(lengths) - 1
    index = fmindex.FMIndex(text, 40)
    got = np.zeros(len(text), bool)
    for s, a, b in zip(*fmindex.repeated(index, starts, np.array(lengths), window)):
        got[starts[s] + a:starts[s] + b] = True
    windows = [(s + i, tuple(text[s + i:s + i + window])) for s, n in zip(starts, lengths) for i in range(n - window + 1)]
    counts, expected = Counter(w for _, w in windows), np.zeros(len(text), bool)
    for at, w in windows:
        if counts[w] > 1:
            expected[at:at + window] = True
    assert (got == expected).all()
