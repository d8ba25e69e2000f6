import numpy as np
import pytest

from emberline.llm import toxicity

LARGE = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{LARGE}/documents.parquet"), spark.read.parquet(f"{LARGE}/labels.parquet")


def test_held_out_accuracy(tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels.filter("doc_id % 4 <> 0"))
    held = labels.filter("doc_id % 4 = 0").withColumnRenamed("toxic", "truth")
    rows = toxicity.severity(docs, model).join(held, "doc_id").collect()
    toxic, clean = [r for r in rows if r.truth], [r for r in rows if not r.truth]
    assert np.mean([r.toxic for r in toxic]) > 0.9 and np.mean([r.toxic for r in clean]) < 0.01
    assert np.mean([r.severity for r in toxic]) > 1 > 10 * np.mean([r.severity for r in clean])
    assert (np.diff(model.thresholds) > 0).all()


def test_rows_equal_brute_force(documents, tables, make):
    """Scores from whole words and word starts, counted one by one."""
    model = toxicity.fit(*tables)
    texts = [r.text for r in documents.limit(40).collect()] + ["", None, "Idiot idiot, IDIOT! trash", "x " * 20_000]
    rows = list(enumerate(texts)) + [(None, "idiot"), (3, texts[3])]
    got = toxicity.severity(make(rows), model).collect()
    kept = dict(zip(model.features.tolist(), model.weights))
    import pyarrow as pa
    from emberline.llm.text import PLAIN, chunks
    for (doc, text), r in zip(rows, got):
        chunk, = chunks(pa.array([(text or "").lower()]), inside=PLAIN)
        counts: dict = {}
        for f in toxicity._occurrences(chunk)[1].tolist():
            counts[f] = counts.get(f, 0) + 1
        score = sum(kept[f] * np.log1p(c) for f, c in counts.items() if f in kept)
        chance = model.grades(np.array([score]))[0]
        assert r.doc_id == doc and r.severity == pytest.approx(chance @ np.arange(4), abs=1e-9)
        assert r.toxicity == pytest.approx(1 - chance[0], abs=1e-9)
    assert got[42].toxic and not got[40].toxic and not got[41].toxic
    kept = toxicity.clean(make(rows), model)
    assert kept.columns == make(rows).columns
    assert [(r.doc_id, r.text) for r in kept.collect()] == [row for row, r in zip(rows, got) if not r.toxic]


def test_ordinal_fit_recovers_order():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 2))
    score = x @ np.array([2.0, -1.0])
    grades = np.searchsorted([-1.0, 1.0, 3.0], score + rng.logistic(size=3000))
    rows, columns = np.repeat(np.arange(3000), 2), np.tile([0, 1], 3000)
    weights, thresholds = toxicity.fit_ordinal(rows, columns, x.ravel(), grades, 2)
    assert weights == pytest.approx([2, -1], abs=0.2) and thresholds == pytest.approx([-1, 1, 3], abs=0.25)


def test_without_labels_nothing_is_toxic(spark, make):
    docs = make([(1, "a b"), (2, None)])
    labels = spark.createDataFrame([(1, 1, None), (None, 0, 1), (2, 0, 0)], "doc_id bigint, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        rows = toxicity.severity(docs, toxicity.fit(docs, some)).collect()
        assert len(rows) == 2 and not any(r.toxic for r in rows)
    model = toxicity.fit(make([]), labels)
    assert toxicity.severity(make([]), model).count() == 0


def test_limit_spares_other_documents_where_classes_overlap(spark, make):
    docs = make([(i, "the same words for all") for i in range(40)])
    labels = spark.createDataFrame([(i, 1, int(i < 30)) for i in range(40)], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    rows = toxicity.severity(docs, model).collect()
    assert model.limit > 0.5 and not any(r.toxic for r in rows if r.doc_id >= 30)
