"""Hard negatives by exact integer scores, multiplied out in a residue number system.

Integer vectors are taken modulo several small primes, with residues around zero, so that a product of
two float32 matrices of residues is exact as long as a slab of it adds up at most ``SLAB`` terms. What the products
are modulo each prime gives the score back by the Chinese remainder theorem, signed and exact: as many primes are taken as the
largest squared length asks for, which bounds every score.

Anchors and rows meet in the cells of a grid, so many rows by so many anchors at a time, whatever the
table's size: first with rows of their own label for their positives, then with all rows for the negatives
in the window below each positive's score. Cells give their best few, which are ranked again per anchor.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.llm.components import frees_shuffles, stored

PRIMES = (251, 241, 239, 233, 229, 227, 223, 211)
#: Terms of residues up to 125 that float32 adds up exactly: 1,024 * 125 ** 2 < 2 ** 24.
SLAB = 1024
#: Above this squared length, scores might not fit into a long.
LONGEST = 2.0 ** 61
CELL_ROWS = 8192
CELL_ANCHORS = 8192
BLOCK = 256
_NONE = np.iinfo(np.int64).min
_FOUND = "anchor bigint, key bigint, positive_score bigint, vec_id bigint, score bigint, copies bigint"
_FOUND_NAMES = [field.split()[0] for field in _FOUND.split(", ")]


# ------------------------------------------------------------------ residue numbers

def primes_for(bound: int) -> tuple[int, ...]:
    """The first primes whose product tells apart all numbers from ``-bound`` to ``bound``."""
    for count in range(1, len(PRIMES) + 1):
        if math.prod(PRIMES[:count]) > 2 * bound + 1:
            return PRIMES[:count]
    raise ValueError("scores beyond the range of the primes")


def _centred(values: np.ndarray, prime: int) -> np.ndarray:
    """What is left modulo the prime, around zero, of whole float32 numbers."""
    return values - np.float32(prime) * np.rint(values / np.float32(prime))


def residues(codes: np.ndarray, primes: Sequence[int]) -> list[np.ndarray]:
    """A float32 matrix per prime."""
    return [((codes + prime // 2) % prime - prime // 2).astype(np.float32) for prime in primes]


def _product(left: np.ndarray, right: np.ndarray, prime: int) -> np.ndarray:
    total = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, left.shape[1], SLAB):
        part = _centred(left[:, first:first + SLAB] @ right[:, first:first + SLAB].T, prime)
        total = _centred(total + part, prime)
    # a quotient of many digits may have been rounded to the next number; a small one is not
    return _centred(total, prime)


def scores(left: Sequence[np.ndarray], right: Sequence[np.ndarray], primes: Sequence[int]) -> np.ndarray:
    """Inner products of two sets of residue matrices, by mixed-radix digits around zero."""
    digits: list[np.ndarray] = []
    for at, prime in enumerate(primes):
        digit = _product(left[at], right[at], prime)
        for lower, known in zip(digits, primes):
            inverse = pow(known, -1, prime)
            inverse -= prime * (inverse > prime // 2)
            digit = _centred((digit - lower) * np.float32(inverse), prime)
        digits.append(digit)
    value = digits[-1].astype(np.int64)
    for digit, prime in zip(digits[-2::-1], primes[-2::-1]):
        value *= prime
        value += digit.astype(np.int64)
    return value


# ------------------------------------------------------------------ a cell of the grid

def best(row: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Of the places ``at`` those of the ``k`` greatest, ties to the first places."""
    if len(at) <= k:
        return at
    values = row[at]
    last = np.partition(values, len(values) - k)[len(values) - k]
    above = at[values > last]
    return np.concatenate([above, at[values == last][:k - len(above)]])


class Cell:
    """Rows of one vector length, by label, then by id (unknown last)."""

    def __init__(self, rows: pa.Table, primes: Sequence[int]):
        ids, labels = rows["vec_id"], rows["label"].to_numpy()
        missing = ids.is_null().to_numpy()
        known = ids.fill_null(0).to_numpy()
        order = np.lexsort((known, missing, labels))
        self.ids, self.missing, self.labels = known[order], missing[order], labels[order]
        self.keys, self.copies = rows["key"].to_numpy()[order], rows["copies"].to_numpy()[order]
        self.codes, self.primes = residues(_codes(rows)[order], primes), primes

    def span(self, label: int) -> slice:
        return slice(*np.searchsorted(self.labels, [label, label + 1]))

    def score(self, anchors: Sequence[np.ndarray], part: slice) -> np.ndarray:
        return scores(anchors, [codes[part] for codes in self.codes], self.primes)


def _codes(rows: pa.Table) -> np.ndarray:
    flat = rows["code"].combine_chunks().flatten().to_numpy().astype(np.int64)
    return flat.reshape(rows.num_rows, -1)


def _blocks(anchors: pa.Table, primes: Sequence[int]) -> Iterator[tuple]:
    """Anchors of one label at a time, at most ``BLOCK`` of them, with their residues."""
    labels = anchors["label"].to_numpy()
    order = np.argsort(labels, kind="stable")
    codes = _codes(anchors)
    for label in np.unique(labels):
        own = order[slice(*np.searchsorted(labels[order], [label, label + 1]))]
        for first in range(0, len(own), BLOCK):
            block = own[first:first + BLOCK]
            yield int(label), block, residues(codes[block], primes)


def _table(found: list[tuple], cell: Cell | None) -> pa.Table:
    """From (anchor, key, positive score, place in the cell, score, copies) rows."""
    columns = [np.array(c, np.int64) for c in zip(*found)] or [np.empty(0, np.int64)] * 6
    ids = pa.array(cell.ids[columns[3]], pa.int64(), mask=cell.missing[columns[3]]) if found else pa.array([], pa.int64())
    return pa.table([*map(pa.array, columns[:3]), ids, *map(pa.array, columns[4:])], _FOUND_NAMES)


def _find_positives(primes: Sequence[int], k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        """The best ``k`` of the anchor's own label, less one copy of itself."""
        if not rows.num_rows or not anchors.num_rows:
            return _table([], None)
        cell, found = Cell(rows, primes), []
        names, keys = anchors["vec_id"].to_numpy(), anchors["key"].to_numpy()
        for label, block, codes in _blocks(anchors, primes):
            part = cell.span(label)
            places = np.arange(part.stop - part.start)
            for anchor, row in zip(block, cell.score(codes, part)):
                own = (cell.keys[part] == keys[anchor]) & (cell.ids[part] == names[anchor]) & ~cell.missing[part]
                copies = cell.copies[part] - own
                for at in best(row, places[copies > 0] if own.any() else places, k):
                    found.append((names[anchor], keys[anchor], 0, part.start + at, row[at], copies[at]))
        return _table(found, cell)

    return run


def _find_negatives(primes: Sequence[int], k: int, window: tuple[int, int]):
    lowest, highest = window

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        """Per positive score of an anchor the best ``k`` rows of other labels in the window below it."""
        if not rows.num_rows or not anchors.num_rows:
            return _table([], None)
        cell, found = Cell(rows, primes), []
        names, keys, wanted = anchors["vec_id"].to_numpy(), anchors["key"].to_numpy(), anchors["wanted"].to_pylist()
        everything = slice(0, len(cell.ids))
        for label, block, codes in _blocks(anchors, primes):
            own = cell.span(label)
            for anchor, row in zip(block, cell.score(codes, everything)):
                row[own] = _NONE
                for positive in wanted[anchor]:
                    low, high = -(-lowest * positive // 100), highest * positive // 100
                    for at in best(row, np.flatnonzero((row >= low) & (row <= high)), k):
                        found.append((names[anchor], keys[anchor], positive, at, row[at], cell.copies[at]))
        return _table(found, cell)

    return run


# ------------------------------------------------------------------ the grid

def usable(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label, code (whole numbers), key and copies of the different rows that take part."""
    real = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.pow(F.abs(x.cast("double")) * scale + 1, F.lit(2)))
    good = vectors.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite & (square < LONGEST))
    rows = good.select("vec_id", F.col("label").cast("bigint").alias("label"), real.cast("array<int>").alias("code"))
    return rows.groupBy("vec_id", "label", "code").agg(F.count(F.lit(1)).alias("copies")).withColumn(
        "key", F.xxhash64("label", "code"))


def _spread(seed: int, parts: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), "vec_id", "key"), parts)


def _up_to(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), parts.cast("bigint") - 1))


def in_cells(rows: DataFrame, anchors: DataFrame, run) -> DataFrame:
    """Cogroups rows and anchors, both with columns ``bucket``, ``shards`` and ``blocks``: every row meets every anchor of its bucket and length."""
    cell = ["bucket", "shard", "block", "size"]
    held = rows.withColumn("shard", _spread(1, F.col("shards"))).withColumn("block", _up_to(F.col("blocks")))
    asked = anchors.withColumn("block", _spread(2, F.col("blocks"))).withColumn("shard", _up_to(F.col("shards")))
    held, asked = [side.drop("shards", "blocks").withColumn("size", F.size("code")) for side in (held, asked)]
    # the anchors are rows as well: under new names, the two sides can be told apart
    return held.groupBy(*cell).cogroup(asked.toDF(*asked.columns).groupBy(*cell)).applyInArrow(run, _FOUND)


def _first(found: DataFrame, k: int, *per: str) -> DataFrame:
    """The first ``k`` per anchor, by score, then id; copies count one by one."""
    place = Window.partitionBy("anchor", "key", *per).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    few = found.withColumn("_place", F.row_number().over(place)).filter(F.col("_place") <= k)
    each = few.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("copies", F.lit(k)))))
    rank = Window.partitionBy("anchor", "key", *per).orderBy("_place", "_copy")
    return each.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).drop("_place", "_copy", "copies")


def shifted(vectors: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """The rows with the next label, round, where ``every`` divides vec_id."""
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % every == 0, (label + 1) % labels).otherwise(label)
    return vectors.select("vec_id", "embedding", moved.alias("label"))


@frees_shuffles
def mine(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, window: tuple[int, int] = (50, 95),
         scale: int = 256, cell_rows: int = CELL_ROWS, cell_anchors: int = CELL_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Needs vec_id, embedding and label. Components are floor(scale * x); a score is an inner product of two
    vectors of one length. Anchors are rows whose vec_id ``every`` divides; positives the best other rows of
    their label, negatives the best rows of other labels with a score from ``window[0]`` to ``window[1]`` percent of the
    positive's. Ties go to the smaller vec_id, an unknown one last. Rows with a null label or vector, or a
    null or non-finite component, take no part, nor do vectors so long that a score might not be a long (a squared length,
    components scaled, of 2 ** 61 or more). Zero and empty vectors score 0. Rows without an id are no anchors but may be
    found, by a null id. Equal rows are one entry that counts as often as it occurs: a copy of the anchor is another row, and
    an anchor that repeats gives its rows each time. Anchors without positives or negatives, and an empty table, give no rows.
    """
    entries = stored(usable(vectors, scale), "entries")
    asks = F.col("vec_id") % every == 0
    square = F.aggregate("code", F.lit(0).cast("bigint"), lambda s, x: s + x.cast("bigint") * x)
    rows, asked, longest = entries.agg(F.count(F.lit(1)), F.count_if(asks), F.max(square)).first()
    primes = primes_for(int(longest or 0))
    anchors = entries.filter(asks)

    # a label's rows are many cells, small labels share one
    bucket = F.pmod(F.xxhash64("label", F.size("code")), F.lit(max(1, math.ceil(rows / cell_rows))))
    sizes = stored(entries.groupBy(bucket.alias("bucket")).agg(
        F.ceil(F.count(F.lit(1)) / cell_rows).alias("shards"), F.ceil(F.count_if(asks) / cell_anchors).alias("blocks")
    ).filter("blocks > 0"), "buckets")
    near = in_cells(entries.withColumn("bucket", bucket).join(sizes, "bucket"),
                    anchors.withColumn("bucket", bucket).join(sizes, "bucket"), _find_positives(primes, positives))
    near = stored(_first(near, positives).select("anchor", "key", F.col("vec_id").alias("positive_id"),
                                                 F.col("score").alias("positive_score")), "positives")

    wanted = near.groupBy("anchor", "key").agg(F.collect_set("positive_score").alias("wanted"))
    grid = {"bucket": F.lit(0), "shards": F.lit(max(1, math.ceil(rows / cell_rows))),
            "blocks": F.lit(max(1, math.ceil(asked / cell_anchors)))}
    waiting = anchors.join(wanted.withColumnRenamed("anchor", "vec_id"), ["vec_id", "key"])
    far = in_cells(entries.withColumns(grid), waiting.withColumns(grid), _find_negatives(primes, negatives, window))
    far = stored(_first(far, negatives, "positive_score"), "negatives")

    copies = anchors.select(F.col("vec_id").alias("anchor"), "key", "copies")
    pairs = near.join(far, ["anchor", "key", "positive_score"]).join(copies, ["anchor", "key"])
    return pairs.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
