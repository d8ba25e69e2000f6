import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kinds string, `order` int, size string"


@pytest.fixture(scope="session")
def make(spark):
    """documents rows from (doc_id, text[, source]), with more columns that could clash."""
    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1]), "k", 1, "s")
                for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return build


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
