"""Nearest neighbours over a permutation index.

A vector is described by the order of its ``posted`` nearest pivots. In a shard of some thousand
vectors there is an inverted file per pivot: the place the pivot has in each vector's order. A
query adds up, over its own nearest pivots, how far the two places lie apart (Spearman's footrule;
a pivot that is not posted counts as placed last), and the share ``rerank`` of the shard
with the least sums is measured exactly. Each shard gives its best ``k`` per query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The pivots are the only sample: far-apart vectors out of SAMPLED times as many rows, the first by hash of their id.
PIVOTS = 256
SAMPLED = 8
POSTED = 128
RERANK = 0.12
SHARD_ROWS = 8192
_FOUND = "query_id bigint, vec_id bigint, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of rows with an id and a finite vector other than zero."""
    values = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists("embedding", lambda x: x != 0)
    return vectors.select("vec_id", values.alias("embedding")).filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & nonzero)


def spread_out(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows taken one by one, each the farthest from those taken; a crowd of near copies gives one."""
    chosen, far = [0], ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(sample)):
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


class Shard:
    """Vectors of one length with their inverted files, one row of places per pivot. Equal vectors are one entry."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, posted: int):
        self.vectors, entry = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, entry))
        self.ids, self.starts = ids[order], np.searchsorted(entry[order], np.arange(len(self.vectors) + 1))
        self.pivots, self.posted = pivots, min(posted, len(pivots))
        self.places = np.full((len(pivots), len(self.vectors)), self.posted, np.int16)
        order = self.order(self.vectors)
        self.places[order, np.arange(len(self.vectors))[:, None]] = np.arange(self.posted, dtype=np.int16)

    def order(self, vectors: np.ndarray) -> np.ndarray:
        """Nearest pivots of each vector, nearest first."""
        square = (self.pivots ** 2).sum(1)[None] - 2 * vectors @ self.pivots.T
        return np.argsort(square, axis=1, kind="stable")[:, :self.posted]

    def search(self, query_id: int, query: np.ndarray, order: np.ndarray, k: int, rerank: float):
        own = np.arange(self.posted, dtype=np.int16)[:, None]
        footrule = np.abs(self.places[order] - own).sum(0, dtype=np.int32)
        wanted = min(len(self.vectors), max(8 * k, math.ceil(rerank * len(self.vectors))))
        # all that tie with the last one wanted are measured too
        near = np.flatnonzero(footrule <= np.partition(footrule, wanted - 1)[wanted - 1])
        score = np.sqrt(((self.vectors[near] - query) ** 2).sum(1))
        last = min(k, len(near) - 1)
        close = np.flatnonzero(score <= np.partition(score, last)[last])
        # of equal vectors, the first ids are enough (one may be the query's own)
        size = np.minimum(np.diff(self.starts)[near[close]], k + 1)
        at = np.repeat(self.starts[near[close]] - np.cumsum(size) + size, size) + np.arange(size.sum())
        ids, score = self.ids[at], np.repeat(score[close], size)
        ids, score = ids[ids != query_id], score[ids != query_id]
        best = np.lexsort((ids, score))[:k]
        return ids[best], score[best]


def _search(pivots, k: int, posted: int, rerank: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by shard, its vectors first, then the queries."""
        key, ids, rows, shard = None, [], [], None
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(i).to_pylist() for i in range(3)]
            values = batch.column(3)
            for at, (where, asks, vec_id) in enumerate(zip(*columns)):
                row = np.asarray(values[at].values.to_numpy(zero_copy_only=False), float)
                own = (where, len(row))
                if own != key:
                    key, ids, rows, shard = own, [], [], None
                if not asks:
                    # rows come by id, then by vector: equal ones follow each other
                    if not ids or ids[-1] != vec_id or not np.array_equal(rows[-1], row):
                        ids.append(vec_id)
                        rows.append(row)
                    continue
                if shard is None:
                    if not ids:
                        continue
                    shard = Shard(np.array(ids), np.array(rows), pivots.value[len(row)], posted)
                    rows = []
                found, score = shard.search(vec_id, row, shard.order(row[None])[0], k, rerank)
                out.extend((vec_id, *pair) for pair in zip(found.tolist(), score.tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))],
                ["query_id", "vec_id", "score"])

    return run


def first_by_hash(lengths: DataFrame, many: dict[int, int], wanted: int) -> DataFrame:
    """The first ``wanted`` rows of each length by hash of the id, with their place ``at``.

    Only rows below a bound on the hash are shuffled, about four times as many as are wanted; where too few lie below it,
    as when an id repeats, it is raised.
    """
    spark, shares = lengths.sparkSession, {length: 4 * wanted / n for length, n in many.items()}
    chosen = Window.partitionBy("length").orderBy("hash", "vec_id", "embedding")
    hashed = lengths.withColumn("hash", F.xxhash64("vec_id"))
    while True:
        bounds = spark.createDataFrame([(length, min(2 ** 63 - 1, int(share * 2 ** 64) - 2 ** 63))
                                        for length, share in shares.items()], "length int, bound bigint")
        below = hashed.join(F.broadcast(bounds), "length").filter("hash <= bound")
        found = {r.length: r["count"] for r in below.groupBy("length").count().collect()}
        short = [length for length, share in shares.items() if share < 1 and found.get(length, 0) < wanted]
        if not short:
            return below.withColumn("at", F.row_number().over(chosen)).filter(F.col("at") <= wanted)
        for length in short:
            shares[length] *= 8


def neighbours(vectors: DataFrame, every: int = 100, k: int = 10, pivots: int = PIVOTS, posted: int = POSTED,
               rerank: float = RERANK, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest found for each row whose vec_id ``every`` divides.

    Needs vec_id and embedding. Rows without an id, and vectors that are null, zero or hold null or
    non-finite numbers, take no part; vectors are compared with those of their own length. Where
    a vec_id repeats, each of its different vectors is a candidate, equal ones are one, and a query asks with the first in
    array order for rows of other ids. Ties go to the smaller vec_id, a query with
    fewer than ``k`` others gets all, an empty table gives no rows, and other columns take no part, whatever their names.
    """
    good = usable(vectors)
    lengths = good.withColumn("length", F.size("embedding"))
    many = {r.length: r["count"] for r in lengths.groupBy("length").count().collect()}
    sample = first_by_hash(lengths, many, SAMPLED * pivots)
    by_length: dict[int, dict] = {}
    for row in sample.orderBy("at").select("length", "embedding").collect():
        by_length.setdefault(row.length, {}).setdefault(tuple(row.embedding))
    held = vectors.sparkSession.sparkContext.broadcast(
        {length: spread_out(np.array(list(rows)), pivots) for length, rows in by_length.items()})
    shards = max(1, math.ceil(sum(many.values()) / shard_rows))
    placed = good.select(F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(shards)).alias("shard"),
                         F.lit(False).alias("asks"), "vec_id", "embedding")
    asked = (good.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
             .select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard"),
                     F.lit(True).alias("asks"), "vec_id", "embedding"))
    rows = (placed.union(asked).repartition("shard")
            .sortWithinPartitions("shard", F.size("embedding"), "asks", "vec_id", "embedding"))
    found = rows.mapInArrow(_search(held, k, posted, rerank), _FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
