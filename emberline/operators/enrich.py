"""Weather enrichment of detections and median imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.functions import scalars as s
from emberline.operators.clean import keep_first
from emberline.operators.order_stats import medians
from emberline.schemas import KEY, WEATHER_COLUMNS
from emberline.session import scratch_path
from emberline.sources.stage import read_stage, write_stage


def stage_join(detections: DataFrame, weather: DataFrame,
               order: Sequence[Column | str] = ("ordinal",)) -> DataFrame:
    """Left join by key for the stage between extraction and treatment.

    Only the first weather row per key goes in. Later steps keep just that one,
    so nothing is lost, and repeated keys on both sides do not multiply.
    """
    columns = [c for c in WEATHER_COLUMNS if c in weather.columns]
    return detections.join(keep_first(weather, KEY, order).select(KEY, *columns), KEY, "left")


def fan_out(detections: DataFrame, weather: DataFrame) -> DataFrame:
    """Rows per key a plain left join would have, without joining row to row."""
    left = detections.groupBy(KEY).agg(F.count(F.lit(1)).alias("focos"))
    right = weather.groupBy(KEY).agg(F.count(F.lit(1)).alias("climas"))
    climates = F.coalesce(F.col("climas"), F.lit(0))
    return left.join(right, KEY, "left").select(
        KEY, (F.col("focos") * F.greatest(climates, F.lit(1))).alias("linhas"),
        (F.col("focos") * climates).alias("com_clima"))


def coerce_weather(weather: DataFrame, columns: Sequence[str] = WEATHER_COLUMNS) -> DataFrame:
    return weather.withColumns({c: s.number_in(weather, c) for c in columns if c in weather.columns})


def join_weather(detections: DataFrame, weather: DataFrame,
                 order: Sequence[Column | str] = ("ordinal",)) -> DataFrame:
    """Left join with the first weather row per key."""
    first = keep_first(weather, KEY, order)
    columns = [c for c in WEATHER_COLUMNS if c in weather.columns]
    return detections.join(coerce_weather(first).select(KEY, *columns), KEY, "left")


def fill_missing(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    """Replace NULLs by fitted values; a column fitted as None stays as it is."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(float(v))) for c, v in values.items() if v is not None})


def weather_medians(detections: DataFrame, weather: DataFrame,
                    order: Sequence[Column | str] = ("ordinal",)) -> dict[str, float | None]:
    """Medians over the rows the left join would fill.

    A detection matches one weather row at most, and NULLs do not count: these
    are the medians over the first weather rows whose key was detected. The
    semi join needs the detections' key column only.
    """
    columns = [c for c in WEATHER_COLUMNS if c in weather.columns]
    matched = keep_first(weather, KEY, order).join(detections.select(KEY), KEY, "left_semi")
    return medians(coerce_weather(matched), columns)


def enrich(detections: DataFrame, weather: DataFrame | None,
           order: Sequence[Column | str] = ("ordinal",)) -> DataFrame:
    """Detections with imputed weather and dry flag.

    Without weather the columns are absent and the flag is 0 throughout. The joined
    rows are stored once; medians and filling both read them from there.
    """
    if weather is None:
        return detections.withColumn("estacao_seca", F.lit(0))
    spark = detections.sparkSession
    joined = read_stage(spark, write_stage(join_weather(detections, weather, order), scratch_path(spark, "joined")))
    columns = [c for c in WEATHER_COLUMNS if c in joined.columns]
    filled = fill_missing(joined, medians(joined, columns, keep=False))
    if {"umidade", "precipitacao"} <= set(filled.columns):
        return filled.withColumn("estacao_seca", s.dry_flag())
    return filled.withColumn("estacao_seca", F.lit(0))
