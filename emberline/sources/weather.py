"""Weather payloads landed as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.functions import scalars as s
from emberline.operators.ordered import number_rows

_READING = "temperature_2m double, relative_humidity_2m double, wind_speed_10m double, precipitation double"
_SINGLE = "main struct<temp: double, humidity: double>, wind struct<speed: double>, rain struct<`1h`: double>"


def assign_batches(detections: DataFrame, size: int = 100, order: str = "ordinal") -> DataFrame:
    """Consecutive rows in chunks of ``size``: adds ``posicao`` and ``lote``."""
    return number_rows(detections, order).withColumn("lote", F.floor(F.col("posicao") / size))


def build_batches(detections: DataFrame, size: int = 100, order: str = "ordinal") -> DataFrame:
    """One row per batch, ids and coordinates in order (at most ``size`` each)."""
    member = F.struct("posicao", "id_externo", "latitude", "longitude")
    return (
        assign_batches(detections, size, order)
        .groupBy("lote").agg(F.sort_array(F.collect_list(member)).alias("m"))
        .select("lote", F.col("m.id_externo").alias("ids"),
                F.concat_ws(",", F.col("m.latitude").cast("array<string>")).alias("latitudes"),
                F.concat_ws(",", F.col("m.longitude").cast("array<string>")).alias("longitudes"))
    )


def parse_batches(landed: DataFrame) -> DataFrame:
    """``(lote, ids, corpo)`` to one weather row per id.

    Replies match ids by position; a bare object counts as a list of one; a reply
    without ``current`` and an unreadable body give no rows; missing rain is 0.
    ``ordinal`` is the order of arrival: batch, then position in it.
    """
    replies = F.from_json("corpo", "array<struct<current: string>>")
    pairs = landed.select("lote", F.posexplode(
        F.arrays_zip(F.col("ids").alias("id"), replies.alias("reply"))).alias("posicao", "p"))
    current = F.col("p.reply.current")
    reading = (
        pairs.filter(F.col("p.id").isNotNull() & current.isNotNull() & ~current.isin("{}", "null", ""))
        .select(F.col("p.id").alias("id_externo"), F.from_json(current, _READING).alias("r"),
                F.struct("lote", "posicao").alias("ordinal"))
    )
    return reading.select(
        "id_externo",
        F.col("r.temperature_2m").alias("temperatura"),
        F.col("r.relative_humidity_2m").alias("umidade"),
        F.col("r.wind_speed_10m").alias("vento"),
        F.coalesce("r.precipitation", F.lit(0.0)).alias("precipitacao"),
        "ordinal",
    )


def parse_single(landed: DataFrame) -> DataFrame:
    """``(id_externo, corpo)`` of the per-row provider, wind in m/s.

    Rows without temperature or humidity are unusable and dropped. ``ordinal`` is that of
    ``landed``; without one, replies for the same row are ordered by their text.
    """
    order = "ordinal" if "ordinal" in landed.columns else "corpo"
    read = landed.select("id_externo", F.from_json("corpo", _SINGLE).alias("r"), F.col(order).alias("ordinal"))
    return read.filter("r.main.temp is not null and r.main.humidity is not null").select(
        "id_externo",
        F.col("r.main.temp").alias("temperatura"),
        F.col("r.main.humidity").alias("umidade"),
        s.ms_to_kmh("coalesce(r.wind.speed, 0.0D)").alias("vento"),
        F.coalesce(F.col("r.rain.1h"), F.lit(0.0)).alias("precipitacao"),
        "ordinal",
    )
