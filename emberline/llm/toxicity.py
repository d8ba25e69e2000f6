"""Toxicity as an ordinal regression with cumulative links.

Features are lower-case words and their first letters, by hash. Of the labelled sample those that tell toxic
from other documents best are kept. Labelled toxic documents have a grade from 1 to 3 by
how often such features occur in them, the others grade 0. One weight vector serves all
thresholds: P(grade <= k) = sigmoid(threshold k - weights * features). The expected grade is the severity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.components import frees_shuffles
from emberline.llm.text import PLAIN, Chunk, chunks
from emberline.session import scratch_path

#: Bounds of the fit: labelled documents of each kind (first by hash of their id), and features kept.
SAMPLE_TOXIC = 4_000
SAMPLE_OTHER = 8_000
FEATURES = 4_096
LEAST_DOCS = 5
#: Standard errors by which a feature's share among toxic documents is above that among others, and how many times.
LEAST_SCORE = 4.0
LEAST_ODDS = 4.0
TELLING_ODDS = 10.0
GRADES = 3
TABLE_BITS = 20
PREFIXES = (4, 5, 6, 8)
STEPS = 1500
#: The share of the sample's other documents that may lie above the limit for rejection.
CLEAN_LOSS = 0.002
SEEN = "doc_id bigint, toxic int, features array<bigint>, counts array<int>"


def _occurrences(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every word and word start of a chunk."""
    row = chunk.rows_of_words()
    rows, hashes = [row], [chunk.hashes()]
    for words, prefix in chunk.prefixes(PREFIXES):
        rows.append(row[words])
        hashes.append(prefix)
    return np.concatenate(rows), (np.concatenate(hashes) >> np.uint64(1)).astype(np.int64)


def _lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column, ""))


def _counted(rows: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each (row, feature) once, by row, with its number."""
    order = np.lexsort((features, rows))
    rows, features = rows[order], features[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (features[1:] != features[:-1])
    first = np.flatnonzero(new)
    return rows[first], features[first], np.diff(first, append=len(rows))


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(_lower(batch.column(1)), inside=PLAIN):
            rows, features, counts = _counted(*_occurrences(chunk))
            offsets = pa.array(np.searchsorted(rows, np.arange(chunk.last - chunk.first + 1)), pa.int32())
            part = slice(chunk.first, chunk.last)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[part], batch.column(2)[part],
                 pa.ListArray.from_arrays(offsets, pa.array(features, pa.int64())),
                 pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32()))],
                [field.split()[0] for field in SEEN.split(", ")])


@dataclass
class Model:
    """The kept features' hashes in order, their weights, rising thresholds, and the limit for rejection."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    limit: float = 0.5

    def places(self, features: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the features are kept ones, and where those are; the table of low bits sorts out most."""
        maybe = np.flatnonzero(table[features & ((1 << TABLE_BITS) - 1)])
        place = np.searchsorted(self.features, features[maybe])
        place[place == len(self.features)] = 0
        same = self.features[place] == features[maybe] if len(self.features) else np.zeros(len(maybe), bool)
        return maybe[same], place[same]

    def table(self) -> np.ndarray:
        table = np.zeros(1 << TABLE_BITS, bool)
        table[self.features & ((1 << TABLE_BITS) - 1)] = True
        return table

    def grades(self, scores: np.ndarray) -> np.ndarray:
        """Probability of each grade per document."""
        below = _sigmoid(self.thresholds[None] - scores[:, None])
        edges = np.hstack([np.zeros((len(scores), 1)), below, np.ones((len(scores), 1))])
        return np.diff(edges, axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, width: int,
                penalty: float = 1e-5, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of least penalised loss, by gradient steps with moments (Adam)."""
    most = int(grades.max())
    raw = np.concatenate([np.zeros(width), [1.0], np.zeros(most - 1)])
    first, second = np.zeros_like(raw), np.zeros_like(raw)
    at = np.arange(len(grades))
    for step in range(1, steps + 1):
        weights, thresholds = raw[:width], raw[width] + np.concatenate([[0], np.cumsum(np.exp(raw[width + 1:]))])
        scores = np.bincount(rows, values * weights[columns], len(grades))
        below = np.hstack([np.zeros((len(grades), 1)), _sigmoid(thresholds[None] - scores[:, None]),
                           np.ones((len(grades), 1))])
        chance = np.maximum(below[at, grades + 1] - below[at, grades], 1e-12)
        slope = below * (1 - below)
        upper, lower = slope[at, grades + 1] / chance, slope[at, grades] / chance
        by_score = (upper - lower) / len(grades)
        by_threshold = np.array([(np.where(grades == k, -upper, 0) + np.where(grades == k + 1, lower, 0)).mean()
                                 for k in range(most)])
        change = np.empty_like(raw)
        change[:width] = np.bincount(columns, values * by_score[rows], width) + penalty * weights
        change[width] = by_threshold.sum()
        for k in range(1, most):
            change[width + k] = by_threshold[k:].sum() * np.exp(raw[width + k])
        first = 0.9 * first + 0.1 * change
        second = 0.99 * second + 0.01 * change ** 2
        raw = raw - 0.1 * first / (1 - 0.9 ** step) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return raw[:width], raw[width] + np.concatenate([[0], np.cumsum(np.exp(raw[width + 1:]))])


@frees_shuffles
def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample of the labelled documents; without both kinds, nothing is toxic."""
    spark = docs.sparkSession
    path = scratch_path(spark, "toxic-sample")
    known = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("_toxic"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    known.filter("_toxic = 1").orderBy(*order).limit(SAMPLE_TOXIC).union(
        known.filter("_toxic = 0").orderBy(*order).limit(SAMPLE_OTHER)).write.parquet(path)
    sample = docs.select("doc_id", "text").join(spark.read.parquet(path), "doc_id").select("doc_id", "text", "_toxic")
    path = scratch_path(spark, "toxic-features")
    sample.mapInArrow(_seen, SEEN).write.parquet(path)
    seen = spark.read.parquet(path)
    toxic, other = seen.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    if not toxic or not other:
        return Model(np.empty(0, np.int64), np.empty(0), 40.0 + np.arange(GRADES))
    by_feature = seen.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("o"))
    share = (F.col("t") + F.col("o")) / (toxic + other)
    gap = F.col("t") / toxic - F.col("o") / other
    score = gap / F.sqrt(share * (1 - share) * (1 / toxic + 1 / other) + 1e-12)
    odds = (F.col("t") / toxic) / ((F.col("o") + 0.5) / other)
    kept = by_feature.filter(F.col("t") + F.col("o") >= LEAST_DOCS).withColumn("score", score).filter(
        (F.col("score") >= LEAST_SCORE) & (odds >= LEAST_ODDS)).orderBy(F.col("score").desc(), "feature").limit(FEATURES)
    chosen = kept.select("feature", odds.alias("odds")).collect()
    features = np.sort(np.array([r.feature for r in chosen], np.int64))
    telling = {r.feature for r in chosen if r.odds >= TELLING_ODDS}
    held = spark.sparkContext.broadcast((frozenset(features.tolist()), frozenset(telling)))

    def kept_only(batches):
        mine, signs = held.value
        for pdf in batches:
            out = []
            for t, fs, cs in zip(pdf["toxic"], pdf["features"], pdf["counts"]):
                pairs = [(f, c) for f, c in zip(fs, cs) if f in mine]
                out.append((t, sum(c for f, c in pairs if f in signs), [f for f, _ in pairs], [c for _, c in pairs]))
            yield type(pdf)(out, columns=["toxic", "telling", "features", "counts"])

    # at most SAMPLE_TOXIC + SAMPLE_OTHER rows of at most FEATURES entries
    rows = seen.mapInPandas(kept_only, "toxic int, telling bigint, features array<bigint>, counts array<int>").collect()
    place = {f: i for i, f in enumerate(features.tolist())}
    tells = np.array([r.telling for r in rows])
    is_toxic = np.array([r.toxic for r in rows]) == 1
    cuts = np.quantile(tells[is_toxic], np.arange(1, GRADES) / GRADES)
    grades = np.where(is_toxic, 1 + np.searchsorted(cuts, tells, "left"), 0)
    at = np.repeat(np.arange(len(rows)), [len(r.features) for r in rows])
    columns = np.array([place[f] for r in rows for f in r.features], np.int64)
    values = np.log1p(np.array([c for r in rows for c in r.counts], float))
    weights, thresholds = fit_ordinal(at, columns, values, grades, len(features))
    model = Model(features, weights, thresholds)
    clean = 1 - model.grades(np.bincount(at, values * weights[columns], len(rows)))[~is_toxic, 0]
    model.limit = float(max(np.quantile(clean, 1 - CLEAN_LOSS), 0.1))
    return model


def _chances(model: Model, table: np.ndarray, column: pa.Array) -> np.ndarray:
    """Probability of each grade per text."""
    found = [np.empty((0, len(model.thresholds) + 1))]
    for chunk in chunks(_lower(column), inside=PLAIN):
        rows, features = _occurrences(chunk)
        hit, place = model.places(features, table)
        rows, place, counts = _counted(rows[hit], place)
        scores = np.bincount(rows, np.log1p(counts) * model.weights[place], chunk.last - chunk.first)
        found.append(model.grades(scores))
    return np.concatenate(found)


def severity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, severity (expected grade), toxicity (probability of a grade above 0) and toxic, per row.

    A text without any kept feature, null and empty ones too, gets the thresholds' own
    probabilities; rows that repeat give the same each time, an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value.table()
        for batch in batches:
            chances = _chances(held.value, table, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(chances @ np.arange(chances.shape[1])), pa.array(1 - chances[:, 0])],
                ["doc_id", "severity", "toxicity"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, severity double, toxicity double").withColumn(
        "toxic", F.col("toxicity") > model.limit)


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not toxic, in one pass and without a join."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value.table()
        for batch in batches:
            chances = _chances(held.value, table, batch.column(text))
            yield batch.filter(pa.array(1 - chances[:, 0] <= held.value.limit))

    return docs.mapInArrow(run, docs.schema)
