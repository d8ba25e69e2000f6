import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from emberline.llm import katz

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return WORD.findall((text or "").translate(LOWER)) + ["</s>"]


class Brute:
    """The model by plain dictionaries, with recursion per token."""

    def __init__(self, texts, order):
        self.order = order
        self.counts = {k: Counter() for k in range(1, order + 1)}
        for text in texts:
            words = ["</s>"] + tokens(text)
            for k in self.counts:
                for i in range(1, len(words)):
                    if i - k + 1 >= 0:
                        self.counts[k][tuple(words[i - k + 1:i + 1])] += 1
        self.total = sum(self.counts[1].values())
        self.discounts = {}
        for k, counts in self.counts.items():
            of = Counter(counts.values())
            self.discounts[k] = katz.Discounts(np.array([of[r] for r in range(katz.LARGE + 2)], float),
                                               sum(counts.values()))
        self.lost = sum(c - self.kept(1, c) for c in self.counts[1].values())
        self.after = defaultdict(list)
        for k in range(2, order + 1):
            for gram in self.counts[k]:
                self.after[gram[:-1]].append(gram)
        self.memo = {}

    def kept(self, k, count):
        return float(self.discounts[k].kept(np.array([count]))[0])

    def chance(self, gram):
        if gram not in self.memo:
            self.memo[gram] = self._chance(gram)
        return self.memo[gram]

    def _chance(self, gram):
        k, count = len(gram), self.counts[len(gram)][gram]
        if k == 1:
            lost = self.lost
            whole = self.total if lost > 0 else self.total + 1
            return self.kept(1, count) / whole if count else (lost if lost > 0 else 1.0) / whole
        followers = self.after[gram[:-1]]
        total = sum(self.counts[k][g] for g in followers)
        if not total:
            return self.chance(gram[1:])
        lost = sum(self.counts[k][g] - self.kept(k, self.counts[k][g]) for g in followers)
        seen = sum(self.chance(g[1:]) for g in followers)
        whole, spare = (total, lost) if lost > 0 else (total + 1, 1.0)
        if 1 - seen <= 1e-12:
            return self.kept(k, count) / (total - lost) if count else 0.0
        return self.kept(k, count) / whole if count else spare / whole / (1 - seen) * self.chance(gram[1:])

    def score(self, text):
        words = ["</s>"] + tokens(text)
        return sum(math.log10(self.chance(tuple(words[max(0, i - self.order + 1):i + 1]))) for i in range(1, len(words)))


def is_held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def check(rows, docs, order):
    model = Brute([t for d, t in rows if not is_held(d)], order)
    got = sorted(katz.score(docs, katz.one_in_seven(), order=order).collect(), key=str)
    base, v = model.counts[1], len(model.counts[1])
    expected = sorted(((d, is_held(d), len(tokens(t)), sum(base[(w,)] > 0 for w in tokens(t)), model.total,
                        sum(math.log10((base[(w,)] + 1) / (model.total + v + 1)) for w in tokens(t)), model.score(t))
                       for d, t in rows), key=str)
    assert len(got) == len(expected)
    by = lambda rows: sorted(rows, key=lambda r: (str(r[0]), r[2], round(r[5], 6), round(r[6], 6)))
    for g, e in zip(by(map(tuple, got)), by(expected)):
        assert g[:5] == e[:5] and g[5:] == pytest.approx(e[5:], rel=1e-9, abs=1e-9)
    return model


@pytest.mark.parametrize("order", [2, 3])
def test_documents(documents, order):
    some = documents.filter("doc_id % 3 = 0")
    rows = [(r.doc_id, r.text) for r in some.collect()]
    model = check(rows, some.repartition(3), order)
    vocabulary = [w for (w,) in model.counts[1]] + ["never-seen"]
    for context in [("the",), ("</s>",), ("of", "the")][:max(0, 2 * order - 2)]:
        if len(context) < order:
            assert sum(model.chance(context + (w,)) for w in vocabulary) == pytest.approx(1, abs=1e-9)


def test_blocks_make_no_difference(documents, monkeypatch):
    rows = sorted(map(tuple, katz.score(documents, katz.one_in_seven()).collect()))
    monkeypatch.setattr(katz, "SHARD_KEYS", 5_000)
    again = sorted(map(tuple, katz.score(documents.repartition(7), katz.one_in_seven()).collect()))
    for a, b in zip(rows, again):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_awkward_rows(make):
    rows = [(1, None), (2, ""), (3, "a b a b"), (4, "A B"), (4, "A B"), (None, "c c c"), (5, "é x " * 3000),
            (6, "a " * 20_000), (7, "zz top"), (25, "b a b"), (39, "only here")]
    check(rows, make(rows), 2)
    assert katz.score(make([]), katz.one_in_seven()).count() == 0
    none = katz.score(make([(1, "a b")]), katz.F.lit(True)).collect()
    assert (none[0].score, none[0].base_score, none[0].train_tokens, none[0].n_known) == (0.0, 0.0, 0, 0)


def test_discounts_fall_back():
    for of in ([0, 5, 0, 0, 0, 0, 0], [0, 0, 4, 1, 0, 0, 0], [0, 3, 9, 1, 7, 0, 2], [0] * 7, [0, 100, 40, 20, 12, 8, 5]):
        ratio = katz.Discounts(np.array(of, float), 50).ratio
        assert ((ratio > 0) & (ratio <= 1)).all()
