import math
import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.llm import katz, quality, text

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Brute:
    """Interpolated modified Kneser-Ney by plain dictionaries, order 3."""

    def __init__(self, texts):
        raw = {k: Counter() for k in (2, 3)}
        for text in texts:
            words = ["<s>"] + WORD.findall(text or "") + ["</s>"]
            for i in range(1, len(words)):
                raw[2][tuple(words[i - 1:i + 1])] += 1
                if i > 1:
                    raw[3][tuple(words[i - 2:i + 1])] += 1
        before = Counter(g[1:] for g in raw[3])
        two = {g: c if g[0] == "<s>" else before[g] or 1 for g, c in raw[2].items()}
        one = Counter((g[1],) for g in two)
        self.counts = {1: dict(one), 2: two, 3: dict(raw[3])}
        self.lost = {k: self.discounts(c.values()) for k, c in self.counts.items()}
        self.context = {k: defaultdict(list) for k in self.counts}
        for k, counts in self.counts.items():
            for g, c in counts.items():
                self.context[k][g[:-1]].append(c)

    @staticmethod
    def discounts(values):
        n = Counter(values)
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        out = []
        for r in (1, 2, 3):
            value = r - (r + 1) * y * n[r + 1] / n[r] if n[r] else y
            out.append(value if 0 < value < r else y)
        return out

    def chance(self, gram):
        if not gram:
            return 1 / (len(self.counts[1]) + 1)
        k = len(gram)
        followers = self.context[k].get(gram[:-1])
        if not followers:
            return self.chance(gram[1:])
        lost, total, count = self.lost[k], sum(followers), self.counts[k].get(gram, 0)
        own = (count - lost[min(count, 3) - 1]) / total if count else 0.0
        return own + sum(lost[min(c, 3) - 1] for c in followers) / total * self.chance(gram[1:])

    def perplexity(self, text):
        words = ["<s>"] + WORD.findall(text or "") + ["</s>"]
        total = sum(math.log(self.chance(tuple(words[max(0, i - 2):i + 1]))) for i in range(1, len(words)))
        return len(words) - 1, math.exp(-total / (len(words) - 1))


def check(train, rows, make):
    # the marker for a document's start is also its end, so no text can contain it
    model, unseen = quality.fit(make(train))
    got = sorted(map(tuple, quality.perplexity(make(rows), model, unseen).collect()), key=str)
    brute = Brute([t for _, t in train])
    expected = sorted(((d, *brute.perplexity(t)) for d, t in rows), key=str)
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert [g[2] for g in got] == pytest.approx([e[2] for e in expected], rel=1e-9)
    return brute


def test_documents_equal_brute_force(documents, make):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    brute = check(rows[:50], rows[30:90], make)
    words = [w for (w,) in brute.counts[1]] + ["never-seen"]
    for context in [(), ("the",), ("of", "the"), ("<s>",)]:
        assert sum(brute.chance(context + (w,)) for w in words) == pytest.approx(1, abs=1e-9)


def test_awkward_rows(make, spark):
    rows = [(1, None), (2, ""), (3, "a b a b"), (3, "a b a b"), (None, "q"), (4, "a " * 30_000), (5, "É b")]
    check([(1, "a b a"), (2, None), (3, "b b a b a b")], rows, make)
    check([(1, "")], rows, make)
    labels = spark.createDataFrame([(3, 1, None), (4, 1, 0), (5, 0, 1), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        got = quality.classify(make(rows), some).collect()
        assert len(got) == len(rows) and {type(r.keep) for r in got} == {bool}
        assert some is labels or all(r.keep for r in got)
    assert quality.classify(make([]), labels).count() == 0


def test_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    known = labels.filter("toxic = 0").select("doc_id", "quality")
    got = quality.classify(docs, labels).join(known, "doc_id").groupBy("quality").agg(
        F.avg(F.col("keep").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in got}
    assert kept[1] > 0.98 and kept[0] < 0.5


def test_long_trusted_texts_train(make, spark):
    text = " ".join(f"w{i}" for i in range(2_500))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(6)], "doc_id bigint, quality int, toxic int")
    got = quality.classify(make([(i, text) for i in range(6)]), labels).collect()
    expected = Brute([text] * 3).perplexity(text)[1]
    assert [r.perplexity for r in got] == pytest.approx([expected] * 6, rel=1e-9)


def test_quantiles_are_exact_in_every_group(spark):
    rng = np.random.default_rng(3)
    groups = {"a": rng.lognormal(5, 2, 3_000), "b": np.repeat([1.0, 7.0], 400), None: rng.normal(size=250), "c": [4.0]}
    groups["d"] = np.concatenate([np.full(900, 2.0), rng.random(101)])
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("a", None), ("e", None)]
    frame = spark.createDataFrame(rows, "group string, value double").repartition(5)
    for share in (0.99, 0.5, 1.0):
        for direct in (20, 10_000):
            got = {r.group: (r.n, r.quantile) for r in quality.grouped_quantile(frame, share, direct).collect()}
            assert set(got) == set(groups)
            for g, values in groups.items():
                assert got[g] == (len(values), pytest.approx(np.quantile(values, share), rel=1e-12))


def test_all_trusted_documents_give_the_threshold_and_rare_languages_stay(spark):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.5, 4 + i % 9) % 500), "en") for i in range(9_000)]
    rows += [(9_000 + i, " ".join(f"z{int(x)}" for x in rng.integers(0, 900, 6)), "xx") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(9_006)], "doc_id bigint, quality int, toxic int")
    got = quality.classify(docs, labels, train_docs=50).collect()
    assert all(r.keep and r.threshold == float("inf") for r in got if r.lang == "xx")
    order = [r.doc_id for r in labels.orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    held = set(order[50:])
    en = [r for r in got if r.lang == "en"]
    limit = np.quantile([r.perplexity for r in en if r.doc_id in held], 0.99)
    assert [r.threshold for r in en] == pytest.approx([limit] * len(en), rel=1e-12)


def test_rows_keep_their_own_language(spark):
    rng = np.random.default_rng(8)
    text = lambda: " ".join(f"w{int(x)}" for x in rng.integers(0, 40, 6))
    rows = [(i, text(), ["en", "fr", None][i % 3], "_", 0) for i in range(900)]
    rows += [(None, text(), lang, "_", 0) for lang in ("en", "fr", None, "de")] + [(7, text(), "fr", "_", 0)] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, perplexity string, threshold int")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(890)] + [(7, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = quality.classify(docs, labels, train_docs=60).collect()
    assert Counter((r.doc_id, r.lang) for r in got) == Counter((i, lang) for i, _, lang, *_ in rows)
    limits = {lang: {r.threshold for r in got if r.lang == lang} for lang in ("en", "fr", None, "de")}
    assert all(len(v) == 1 for v in limits.values()) and limits["de"] == {float("inf")} and math.inf not in limits["fr"]
    held = {r.doc_id for r in labels.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").collect()[60:]}
    fr = [r.perplexity for r in got if r.lang == "fr" and r.doc_id in held]
    assert limits["fr"].pop() == pytest.approx(np.quantile(fr, 0.99), rel=1e-12)


def test_half_of_all_trusted_documents_train_in_slices_and_shards(spark, make, monkeypatch):
    monkeypatch.setattr(quality, "SLICE_TOKENS", 20_000)
    monkeypatch.setattr(quality, "SHARD_TOKENS", 5_000)
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.integers(0, 40 + i // 8, 3 + i % 3))) for i in range(8_400)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(8_400)], "doc_id bigint, quality int, toxic int")
    order = [r.doc_id for r in labels.orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    brute = Brute([rows[i][1] for i in order[:4_200]])
    got = {r.doc_id: r for r in quality.classify(make(rows), labels).collect()}
    assert len(got) == 8_400
    for i in range(0, 8_400, 400):
        assert got[i].perplexity == pytest.approx(brute.perplexity(rows[i][1])[1], rel=1e-9)


def test_ngrams_of_a_block_without_a_stable_sort(monkeypatch):
    """The same n-grams, shards and places as by ``np.unique``; the words are those found when the block was made."""
    rng = np.random.default_rng(5)
    sizes = np.array([1, 40, 2, 300, 1])
    words, tokens = np.unique(rng.integers(1, 60, sizes.sum()).astype(np.uint64) * np.uint64(1 << 57), return_inverse=True)
    tokens[np.cumsum(sizes) - 1] = len(words)
    words = np.append(words, katz.END)
    order = np.argsort(words)
    words, tokens = words[order], np.argsort(order)[tokens]
    row = SimpleNamespace(block=3, doc_ids=[1, 2, 3, 4, 5], sizes=sizes.tobytes(), held=np.zeros(5, bool).tobytes(),
                          words=words.tobytes(), tokens=tokens.astype(np.int32).tobytes())
    block = katz.Block(row, 4)
    unique = np.unique

    def refused(*args, **options):
        raise AssertionError("a stable sort")

    for order in (1, 2, 3):
        at, grams = block.grams(order)
        expected = sorted(unique(grams).tolist(), key=lambda k: (int(text.mix(np.array([k], np.uint64))[0]) % 4, k))
        monkeypatch.setattr(np, "unique", refused)
        keys, cuts, which = quality._by_token(block, order)
        asked, asked_cuts = quality._keys(block, order)
        monkeypatch.setattr(np, "unique", unique)
        assert keys.tolist() == asked.tolist() == expected and cuts.tolist() == asked_cuts.tolist()
        assert [int(text.mix(keys[a:b])[0] % np.uint64(4)) for a, b in zip(cuts, cuts[1:]) if b > a] == [
            k for k in range(4) if cuts[k + 1] > cuts[k]]
        assert keys[which[at]].tolist() == grams.tolist() and (np.delete(which, at) == -1).all()
        first = unique(grams, return_index=True)[1]
        assert sorted(block.asked(order)[2].tolist()) == sorted(at[first].tolist())


def test_the_corpus_is_counted_once(documents, spark, sf_dir, monkeypatch):
    counted = []
    tokens = quality._tokens
    monkeypatch.setattr(quality, "_tokens", lambda docs: counted.append(docs) or tokens(docs))
    quality.classify(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert len(counted) == 1
