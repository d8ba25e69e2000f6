from collections import Counter

import pytest

import __spark_entry__
import corpus_pipeline
from emberline.llm import toxicity
from test_jaccard import brute
from test_secret_scan import base_spans

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf_dir, tmp_path_factory):
    """The rows before and after each stage, each stored and read again."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, function in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name.replace(" ", "-"))
        function(spark, docs, sf_dir).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs, after)
        docs = after
    return out


def rows(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_order_and_columns(steps):
    assert list(steps) == ["toxicity", "near copies", "secrets", "mixing", "packing"]
    assert all(after.columns == COLUMNS for name, (_, after) in steps.items() if name != "packing")


def test_toxic_documents_go(spark, sf_dir, steps):
    before, after = steps["toxicity"]
    model = toxicity.fit(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    clean = {r.doc_id for r in toxicity.severity(before, model).collect() if not r.toxic}
    assert sorted(rows(after)) == sorted(r for r in rows(before) if r[0] in clean)


def test_one_of_each_group_stays(steps):
    before, after = steps["near copies"]
    stays = {doc for doc, _, least in brute([r[:2] for r in rows(before)]) if doc == least}
    assert sorted(rows(after)) == sorted(r for r in rows(before) if r[0] in stays)


def test_secrets_are_replaced(steps):
    before, after = (dict((r[0], r) for r in rows(df)) for df in steps["secrets"])
    assert set(before) == set(after)
    for doc, row in after.items():
        spans = base_spans(before[doc][1])
        assert not base_spans(row[1]) and row[4] == len(row[1])
        assert spans or "[SECRET]" in row[1] or row == before[doc]


def test_mix_repeats_documents(steps):
    before, after = (Counter(rows(df)) for df in steps["mixing"])
    assert set(after) <= set(before) and max(after.values()) <= 2
    assert abs(sum(len(r[1].split()) * n for r, n in after.items())
               - 1.5 * sum(len(r[1].split()) for r in before)) < 20 * max(len(r[1].split()) for r in before)


def test_windows_hold_what_is_left(steps):
    from tokenizers import Tokenizer
    before, after = steps["packing"]
    once = {r[0]: r[1] for r in rows(before)}
    tokenizer = Tokenizer.from_file(corpus_pipeline.VOCABULARY)
    pieces = after.collect()
    copies = Counter(r[0] for r in rows(before))
    tokens = {doc: len(tokenizer.encode(text, add_special_tokens=False).ids) + 1 for doc, text in once.items()}
    assert sum(p.length for p in pieces) == sum(n * tokens[doc] for doc, n in copies.items())
    assert {p.doc_id for p in pieces} == set(once)
    single = [p for p in pieces if copies[p.doc_id] == 1]
    assert all(p.doc_tokens == tokens[p.doc_id] for p in single)


def test_run_is_registered(spark, sf_dir, steps):
    got = __spark_entry__.queries()["pipeline"](spark, sf_dir)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, steps["packing"][1].collect()))
    assert "pipeline" not in __spark_entry__.oracle_sql() and corpus_pipeline.ORACLE_SQL is None


def test_stages_take_awkward_rows(spark, sf_dir, make):
    docs = make([(1, None), (2, ""), (None, "a b"), (3, "token=abcdefgh " * 3, None), (3, "token=abcdefgh " * 3, None)])
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, sf_dir)
        assert out.count() >= 0
        assert name == "packing" or out.columns == docs.columns
    empty = make([])
    assert all(function(spark, empty, sf_dir).count() == 0 for _, function in corpus_pipeline.STAGES)
