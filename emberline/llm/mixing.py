"""Mixing sources to target weights by pivotal dependent rounding.

A source's documents are all wanted ``target / size`` times. The whole part is taken for
certain, and of equal rows as many more copies as their probabilities add up to; what is left, a probability
per different document, is rounded in pairs: the
mass (words times probability) of a pair moves at random from one to the other, without
bias, until one probability is 0 or 1. A fold over a bucket of documents leaves
one unsettled document per source, and those of many buckets are folded again, level by
level, until one is left per source. The words taken from a source thus
miss its target by less than one document.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberline.llm.text import WORD, release_memory
from emberline.session import scratch_path

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
BUCKET_ROWS = 20_000
FAN_IN = 64
#: Copies of a row that one array lists.
LISTED = 1_000
_FOLD = ("id bigint, known boolean, source string, size bigint, digest bigint, rows bigint, source_size bigint, target double, "
         "whole bigint, more bigint, part double, order bigint, node bigint, settled boolean")
#: What rows that are rounded together have in common.
_UNIT = ("doc_id", "source", "size", "digest")


def word_count(text: str = "text") -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(items: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """source, source_size and target per source.

    Weights repeat over the sources by code point, null last. A target above ``most``
    times its source's size stops there, and the excess goes to the others by weight.
    """
    sizes = items.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    sizes = _written(sizes, "sources")
    # one row per source, never per document
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    sizes = _written(sizes.withColumn("weight", weight), "weights")
    wanted = share * (sizes.agg(F.sum("source_size")).first()[0] or 0)
    limit = F.col("source_size") * most
    ratio, stopped = 0.0, -1
    while True:
        over = F.col("weight") * ratio > limit
        taken, free, count = sizes.agg(
            F.coalesce(F.sum(F.when(over, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)), F.count_if(over)).first()
        if count == stopped or not free:
            break
        ratio, stopped = (wanted - taken) / free, count
    return sizes.select("source", "source_size",
                        F.least(F.col("weight") * ratio, limit).cast("double").alias("target"))


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def fold(sizes: np.ndarray, parts: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """Round parts pair by pair; returns them and the place of the unsettled one (or -1)."""
    mass, held = sizes * parts, -1
    draws = rng.random(len(sizes))
    for i in np.flatnonzero((mass > 0) & (mass < sizes)):
        if held < 0:
            held = i
            continue
        forth = min(sizes[i] - mass[i], mass[held])
        back = min(mass[i], sizes[held] - mass[held])
        # the odds are against the larger transfer, so that neither gains on average
        forward = draws[i] * (forth + back) < back
        giver, taker, moved = (held, i, forth) if forward else (i, held, back)
        room, stock = sizes[taker] - mass[taker], mass[giver]
        mass[taker] = sizes[taker] if room <= stock else mass[taker] + moved
        mass[giver] = 0.0 if stock <= room else stock - moved
        if stock == room:
            held = -1
        elif 0 < mass[i] < sizes[i]:
            held = i
    return np.divide(mass, sizes, out=np.zeros(len(sizes)), where=sizes > 0), held


def _folder(seed: int, level: int, last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["order", "known", "id", "size", "digest"], kind="stable").reset_index(drop=True)
        rng = np.random.default_rng([seed, level, int(rows["node"].iloc[0])])
        part, settled = rows["part"].to_numpy(float).copy(), np.ones(len(rows), bool)
        words = rows["size"].to_numpy(float)
        by_source = rows.groupby("source", dropna=False, sort=True).ngroup().to_numpy()
        for source in range(by_source.max() + 1):
            places = np.flatnonzero(by_source == source)
            rounded, held = fold(words[places], part[places], rng)
            if held >= 0 and last:
                rounded[held] = float(rng.random() < rounded[held])
            elif held >= 0:
                settled[places[held]] = False
            part[places] = rounded
        release_memory()
        return rows.assign(part=part, settled=settled)[[field.split()[0] for field in _FOLD.split(", ")]]

    return run


def _keyed() -> list[F.Column]:
    digest = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("digest")
    return [F.col("doc_id"), F.col("source"), word_count().alias("size"), digest]


def units(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
          seed: int = 17, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, source, size, digest, rows, source_size, target, whole and more, per different id, source and text.

    Every one of the ``rows`` is taken ``whole`` times, and ``more`` of them once more.
    """
    items = _written(docs.select(*_keyed()).groupBy(*_UNIT).agg(F.count(F.lit(1)).alias("rows")), "items")
    targets = source_targets(items, weights, share, most)
    buckets = max(1, math.ceil(items.count() / bucket_rows))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    wanted = (ratio - F.floor(ratio)) * F.col("rows")
    order = F.xxhash64(F.lit(seed), "doc_id", "size", "digest")
    level = items.alias("i").join(targets.alias("t"), F.col("i.source").eqNullSafe(F.col("t.source"))).select(
        F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNotNull().alias("known"), "i.source", "size", "digest",
        "rows", "source_size", "target", F.floor(ratio).alias("whole"), F.floor(wanted).alias("more"),
        (wanted - F.floor(wanted)).alias("part"), order.alias("order"), F.pmod(order, F.lit(buckets)).alias("node"))
    settled, depth = None, 0
    while True:
        last = buckets == 1
        folded = _written(level.groupBy("node").applyInPandas(_folder(seed, depth, last), _FOLD), f"fold{depth}")
        done = folded.filter("settled")
        settled = done if settled is None else settled.union(done)
        if last:
            break
        buckets, depth = math.ceil(buckets / FAN_IN), depth + 1
        level = folded.filter("not settled").withColumn("node", F.floor(F.col("node") / FAN_IN))
    some = F.col("size") > 0
    return settled.select(
        F.when(F.col("known"), F.col("id")).alias("doc_id"), "source", "size", "digest", "rows", "source_size", "target",
        F.when(some, F.col("whole")).otherwise(0).alias("whole"),
        F.when(some, F.col("more") + F.rint("part").cast("bigint")).otherwise(0).alias("more"))


def _repeated(rows: DataFrame, times: str) -> DataFrame:
    """Each row as often as its column says (dropped then), which is at least once; no array holds them all."""
    lists = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(times) - 1) / LISTED))
    left = F.least(F.lit(LISTED).cast("bigint"), F.col(times) - F.col("_list") * LISTED)
    return (rows.withColumn("_list", F.explode(lists)).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), left)))
            .drop("_list", "_copy", times))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
        seed: int = 17, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (words) per row of ``docs``.

    Needs doc_id, text and source. Null and empty texts have size 0 and are taken 0 times, a null
    source is a source of its own. Rows equal in doc_id (null too), source and text are rounded one by one: the words they
    take together miss their share by less than one document, whichever of them is taken once more. Buckets come
    from ids and texts alone, so reruns agree. Texts are counted whole, whatever their length, other columns take no
    part, whatever their names, and an empty table gives no rows.
    """
    each = units(docs, weights, share, most, seed, bucket_rows)
    parts = F.explode(F.array(*[F.struct(n.alias("n"), c.alias("copies")) for n, c in (
        (F.col("more"), F.col("whole") + 1), (F.col("rows") - F.col("more"), F.col("whole")))])).alias("part")
    kept = ("doc_id", "source", "size", "source_size", "target")
    counted = each.select(*kept, parts).select(*kept, "part.copies", F.col("part.n").alias("_n")).filter("_n > 0")
    return _repeated(counted, "_n").withColumn("taken", F.col("copies") * F.col("size"))


def apply(docs: DataFrame, seed: int = 17, **options) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it.

    Of rows equal in doc_id, source and text, those with the first other columns by hash are taken once more.
    """
    taken = units(docs, seed=seed, **options).filter("whole > 0 or more > 0").select(*_UNIT, "rows", "whole", "more")
    # the row travels as one struct, so that no column of it can clash
    rows = docs.select(F.struct("*").alias("_doc"), *_keyed())
    same = F.lit(True)
    for name in _UNIT:
        same = same & F.col(f"d.{name}").eqNullSafe(F.col(f"m.{name}"))
    met = rows.alias("d").join(taken.alias("m"), same).select("_doc", *[f"m.{n}" for n in (*_UNIT, "rows", "whole", "more")])
    alike = (F.col("more") == 0) | (F.col("more") == F.col("rows"))
    simple = met.filter(alike).select("_doc", (F.col("whole") + (F.col("more") > 0).cast("bigint")).alias("_n"))
    # equal rows are counted before they are put in order
    groups = met.filter(~alike).withColumn("_key", F.xxhash64(F.to_json("_doc"))).groupBy(*_UNIT, "_key").agg(
        F.first("_doc").alias("_doc"), F.count(F.lit(1)).alias("_same"), F.first("whole").alias("whole"),
        F.first("more").alias("more"))
    before = F.sum("_same").over(Window.partitionBy(*_UNIT).orderBy("_key")) - F.col("_same")
    extra = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("_same"), F.col("more") - before))
    partly = groups.select("_doc", (F.col("_same") * F.col("whole") + extra).alias("_n"))
    return _repeated(simple.union(partly).filter("_n > 0"), "_n").select("_doc.*")
