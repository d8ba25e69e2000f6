import random
import re

import numpy as np

from emberline.llm import jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(rows):
    """(doc_id, size, least doc_id of the component) per row."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 9 * len(a & b) >= 4 * (len(a) + len(b)):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            r = find(i)
            least[r] = min(least.get(r, doc), doc)
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def joined(docs):
    return sorted(map(tuple, jaccard.join(docs).collect()), key=str)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
    return " ".join(words)


def near_copies():
    """Groups of near copies on both sides of the threshold, chains, and a passage that many share."""
    rng = random.Random(4)
    texts, passage = [], [f"p{i}" for i in range(40)]
    for group in range(12):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([30, 80, 200]))]
        for copy in range(rng.choice([2, 5, 30])):
            texts.append(edited(rng, words, rng.randrange(0, 1 + len(words) // 25)))
            if copy % 3 == 0:
                words = edited(rng, words, max(1, len(words) // 50)).split()
    texts += [" ".join(passage + [f"u{rng.randrange(10 ** 6)}" for _ in range(25)]) for _ in range(40)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_near_copies(make):
    rows = near_copies()
    assert joined(make(rows)) == brute(rows)


def test_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert joined(documents) == brute(rows)
    kept = {r.doc_id for r in jaccard.keep_one(documents).collect()}
    assert kept == {c for _, _, c in brute(rows)}


def test_awkward_rows(make):
    a, four = "one two three four five six", "a b c d"
    rows = [(5, a), (3, a.upper()), (4, a), (9, None), (8, ""), (7, " \t"), (6, four), (2, four + " "), (1, "a b c"),
            (None, a), (None, "nobody else"), (10, "y " * 30_000), (11, "y " * 29_000), (5, a), (12, "a b c d e"),
            (13, "É b c d e"), (14, "é b c d e")]
    got = joined(make(rows))
    assert got == brute(rows)
    assert jaccard.join(make([])).count() == 0 and jaccard.keep_one(make([])).count() == 0


def test_tree_loses_no_pair():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 60, (20, 300), dtype=np.uint64)
    sets = []
    for i in range(400):
        own = base[i % 20].copy()
        change = rng.integers(0, 300, rng.integers(0, 50))
        own[change] = rng.integers(0, 1 << 60, len(change), dtype=np.uint64)
        sets.append(np.unique(own))
    points = np.stack([jaccard.count_vector(s) for s in sets])
    sizes, parts = np.array([len(s) for s in sets]), np.arange(400)
    tree = jaccard.CountTree(points, sizes, parts)
    found = set()
    for a, b in tree.candidates(spanning=False):
        ok, _ = jaccard.passing(points, sizes, a, b)
        found |= {(min(p), max(p)) for p in zip(a[ok].tolist(), b[ok].tolist())}
    linked = {(i, j) for j in range(400) for i in range(j)
              if 9 * len(np.intersect1d(sets[i], sets[j])) >= 4 * (len(sets[i]) + len(sets[j]))}
    assert linked and linked <= found and len(found) < 400 * 399 / 4


def test_tree_of_two_components_that_cannot_link():
    rng = np.random.default_rng(8)
    points, parts = np.zeros((40, jaccard.GROUPS), np.uint16), np.repeat([0, 1], 20)
    points[:20, :128], points[20:, 128:] = rng.integers(3, 5, (20, 128)), rng.integers(3, 5, (20, 128))
    tree = jaccard.CountTree(points, points.sum(1, dtype=np.int64), parts)
    assert len(tree.levels) == 3 and tree.meeting_leaves() == [] and not list(tree.candidates(spanning=False))


def test_clashing_columns_stay(spark):
    text = " ".join(f"w{i}" for i in range(40))
    columns = ["_gone", "id", "row", "cid", "slot", "one", "n"]
    docs = spark.createDataFrame([(i, t, *columns) for i, t in ((5, text), (3, text), (None, text), (9, "other"))],
                                 "doc_id bigint, text string, " + ", ".join(f"`{c}` string" for c in columns))
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r._gone, r.row) for r in kept.collect()) == [
        ("3", "_gone", "row"), ("9", "_gone", "row"), ("None", "_gone", "row")]


def test_stages_have_one_python_step(make, monkeypatch):
    """A stage with several would have as many workers per task, which stay with their memory; rows from the driver start others."""
    session, plans = type(make([]).sparkSession), []

    def listed(self, data, *args, **options):
        raise AssertionError("rows of the driver")

    def noted(df, label):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return stored(df, label)

    docs = make(near_copies())
    stored = jaccard.stored
    monkeypatch.setattr(session, "createDataFrame", listed)
    monkeypatch.setattr(jaccard, "stored", noted)
    assert jaccard.join(docs).count() == docs.count()
    steps = re.compile(r"MapInArrow|MapInPandas|GroupsInPandas")
    chained = [p for p in plans if len(steps.findall(p)) > 1 and "Groups" not in p]
    assert plans and not chained
