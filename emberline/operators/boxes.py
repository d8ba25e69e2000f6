"""First-match lookup of points in bounding boxes (inclusive bounds)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline import lookups
from emberline.functions.scalars import literal
from emberline.session import scratch_path


def box_label(boxes: Sequence[tuple], default: str, latitude: str = "latitude",
              longitude: str = "longitude") -> Column:
    """A CASE chain in list order: row-local, no join, for short box lists; for long ones there is ``locate``."""
    if not boxes:
        return F.lit(default)
    lat, lon = f"cast({latitude} as double)", f"cast({longitude} as double)"
    whens = " ".join(
        f"when {lat} between {literal(lat_min)} and {literal(lat_max)} "
        f"and {lon} between {literal(lon_min)} and {literal(lon_max)} then {literal(name)}"
        for name, lat_min, lat_max, lon_min, lon_max in boxes)
    return F.expr(f"case {whens} else {literal(default)} end")


def state_label() -> Column:
    return box_label(lookups.STATE_BOXES, lookups.UNKNOWN_STATE)


def biome_label() -> Column:
    return box_label(lookups.BIOME_BOXES, lookups.UNKNOWN_BIOME)


def tag_places(df: DataFrame) -> DataFrame:
    return df.withColumns({"estado": state_label(), "bioma": biome_label()})


#: Boxes a cell may list before it is split, and how often the whole can be halved.
CELL_BOXES = 32
CELL_LEVELS = 14
_BOUNDS = ("lat_min", "lat_max", "lon_min", "lon_max")


def box_cells(boxes: DataFrame, most: int = CELL_BOXES, levels: int = CELL_LEVELS) -> DataFrame:
    """_level, _row, _col and _size of square cells that do not overlap, with the boxes (nome, prioridade, bounds) in each.

    A cell with more than ``most`` boxes is split into four, ``levels`` times at most. Boxes behind one that covers the whole cell
    cannot be first there and leave its list, so where boxes lie upon each other lists get short soon.
    """
    spark, least = boxes.sparkSession, F.min_by("nome", F.struct("prioridade", "nome"))
    # of equal boxes only the first can be a match
    kept = boxes.select("nome", "prioridade", *[F.col(c).cast("double").alias(c) for c in _BOUNDS]).filter(
        "lat_min <= lat_max and lon_min <= lon_max").groupBy(*_BOUNDS).agg(
            least.alias("nome"), F.min("prioridade").alias("prioridade"))
    path = scratch_path(spark, "boxes")
    kept.write.parquet(f"{path}/boxes")
    kept = spark.read.parquet(f"{path}/boxes")
    extent = kept.agg(F.max(F.greatest(*[F.abs(c) for c in _BOUNDS]))).first()[0] or 1.0
    size = 2.0 ** math.ceil(math.log2(extent + 1))
    cell = lambda name: F.floor(F.col(name) / size).cast("bigint")
    open_cells = kept.withColumn("_row", F.explode(F.sequence(cell("lat_min"), cell("lat_max")))).withColumn(
        "_col", F.explode(F.sequence(cell("lon_min"), cell("lon_max"))))
    done = None
    for level in range(levels + 1):
        south, west = F.col("_row") * size, F.col("_col") * size
        covers = ((F.col("lat_min") <= south) & (F.col("lat_max") >= south + size)
                  & (F.col("lon_min") <= west) & (F.col("lon_max") >= west + size))
        cover = open_cells.withColumn("_covers", covers).groupBy("_row", "_col").agg(
            F.min(F.when(F.col("_covers"), F.col("prioridade"))).alias("_cover"))
        listed = open_cells.join(cover, ["_row", "_col"]).filter(
            F.col("_cover").isNull() | (F.col("prioridade") <= F.col("_cover"))).drop("_cover")
        sizes = listed.groupBy("_row", "_col").agg(F.count(F.lit(1)).alias("_boxes"))
        listed.join(sizes, ["_row", "_col"]).write.parquet(f"{path}/{level}")
        listed = spark.read.parquet(f"{path}/{level}")
        crowded = (F.col("_boxes") > most) & F.lit(level < levels)
        own = listed.filter(~crowded).drop("_boxes").withColumns({"_level": F.lit(level), "_size": F.lit(size)})
        done = own if done is None else done.unionByName(own)
        split = listed.filter(crowded).drop("_boxes")
        if level == levels or split.isEmpty():
            break
        size /= 2
        quarter = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
        south, west = F.col("_row") * size, F.col("_col") * size
        open_cells = split.withColumn("_q", quarter).withColumns(
            {"_row": F.col("_row") * 2 + F.col("_q.i"), "_col": F.col("_col") * 2 + F.col("_q.j")}).drop("_q").filter(
                (F.col("lat_min") < south + size) & (F.col("lat_max") >= south)
                & (F.col("lon_min") < west + size) & (F.col("lon_max") >= west))
    return done


def locate(df: DataFrame, boxes: DataFrame, key: str, target: str, default: str) -> DataFrame:
    """First match by ``prioridade`` in a box table of any size.

    Boxes come as ``nome, lat_min, lat_max, lon_min, lon_max, prioridade`` and are filed by ``box_cells``. A point
    looks up its one cell per level in use: an equi-join that finds the one cell it is in, and the range check
    runs inside the join. ``key`` identifies the points.
    """
    filed = box_cells(boxes)
    # at most CELL_LEVELS + 1, whatever the number of boxes
    levels = filed.select("_level", "_size").distinct().collect()
    if not levels:
        return df.withColumn(target, F.lit(default))
    level = F.explode(F.array(*[F.struct(F.lit(n).alias("_level"), F.lit(size).alias("_size")) for n, size in sorted(levels)]))
    cell = lambda name: F.floor(F.col(name) / F.col("_size")).cast("bigint")
    points = (
        df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .select(key, F.col("latitude").cast("double").alias("_lat"), F.col("longitude").cast("double").alias("_lon"),
                level.alias("_at"))
        .select(key, "_lat", "_lon", "_at.*")
        .select(key, "_lat", "_lon", "_level", cell("_lat").alias("_row"), cell("_lon").alias("_col"))
    )
    hits = points.join(filed.drop("_size"), ["_level", "_row", "_col"]).filter(
        F.col("_lat").between(F.col("lat_min"), F.col("lat_max"))
        & F.col("_lon").between(F.col("lon_min"), F.col("lon_max")))
    first = hits.groupBy(key).agg(F.min_by("nome", "prioridade").alias(target))
    return df.join(first, key, "left").withColumn(target, F.coalesce(F.col(target), F.lit(default)))
