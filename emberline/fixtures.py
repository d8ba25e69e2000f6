"""Projection of the ``events`` table into detections, weather and images.

Deterministic arithmetic on ``event_id``; see FIXTURES.md for the rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.functions import scalars as s
from emberline.plans.treatment import detections_table, transform
from emberline.plans.warehouse import bind_detections, bind_weather
from emberline.sources.detections import standardise

AS_OF = "2024-02-04"

_LATITUDE = "cast(cast(-340000 + (event_id * 7919) % 400000 as double) / 10000 as decimal(9,4))"
_LONGITUDE = "cast(cast(-740000 + (event_id * 104729) % 400000 as double) / 10000 as decimal(9,4))"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def raw_detections(source: DataFrame) -> DataFrame:
    """Source-named rows; every 29th event is delivered a second time, later."""
    copies = source.selectExpr(
        "event_id", "ts", "event_type", "value",
        "explode(if(event_id % 29 = 0, array(0, 1), array(0))) as copy")
    return copies.selectExpr(
        f"cast({_LATITUDE} as double) as latitude",
        f"cast({_LONGITUDE} as double) as longitude",
        """if(copy = 1, 300.0D, cast(cast(cast(2900 + (event_id * 31) % 800 as double) / 10
           as decimal(7,1)) as double)) as bright_ti4""",
        "cast(cast(ts as date) as string) as acq_date",
        "date_format(ts, 'HHmm') as acq_time",
        "event_type as satellite",
        """case when copy = 1 then 'n' else case event_id % 5 when 0 then 'l' when 1 then 'n' when 2 then 'h'
           when 3 then cast(event_id % 101 as string) else ' N ' end end as confidence""",
        "if(copy = 1, 0.0D, cast(cast(value as decimal(8,1)) as double)) as frp",
        "event_id + if(copy = 1, 1000000000L, 0L) as ordinal",
        "event_id as seq",
    )


def originals(source: DataFrame) -> DataFrame:
    """First deliveries with their key."""
    rows = source.selectExpr(
        "event_id as seq", f"{_LATITUDE} as latitude", f"{_LONGITUDE} as longitude",
        "cast(cast(ts as date) as string) as data", "date_format(ts, 'HHmm') as hora",
        "event_id as ordinal")
    return rows.withColumn("id_externo", s.natural_key("latitude", "longitude", "data", "hora"))


_READINGS = [
    "cast(200 + (seq * 13) % 220 as double) / 10 as temperatura",
    "cast(100 + (seq * 17) % 800 as double) / 10 as umidade",
    "cast((seq * 7) % 450 as double) / 10 as vento",
    "case when seq % 2 = 0 then 0.0D else cast((seq * 3) % 300 as double) / 10 end as precipitacao",
]


def weather(source: DataFrame) -> DataFrame:
    """One reading per event; every third batch of a hundred has none."""
    return originals(source).filter("(seq div 100) % 3 <> 0").selectExpr(
        "id_externo", *_READINGS, "ordinal", "seq")


def all_weather(source: DataFrame) -> DataFrame:
    return originals(source).selectExpr("id_externo", *_READINGS, "ordinal", "seq")


def images(source: DataFrame) -> DataFrame:
    """No, one or two images per event."""
    rows = originals(source).selectExpr(
        "id_externo", "seq",
        "explode(case when seq % 8 = 0 then array(0, 1) when seq % 4 = 0 then array(0) else array() end) as n",
        "case seq % 3 when 0 then 'fogo' when 1 then 'nao_fogo' end as classificacao")
    return rows.selectExpr(
        "id_externo", "concat('tile/', seq, '/', n) as url_tile", "'10m' as resolucao", "classificacao",
        "cast(50 + seq % 50 as decimal(5,1)) as confianca_cnn", "seq")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised raw detections."""
    return standardise(raw_detections(events(spark, sf_dir)))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind_detections(detections_table(detections(spark, sf_dir)))


def treated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform(detections(spark, sf_dir), weather(events(spark, sf_dir)))


def weather_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind_weather(treated(spark, sf_dir))
