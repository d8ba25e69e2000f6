"""Row filters and keep-first deduplication of detections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.functions import scalars as s
from emberline.schemas import KEY


def keep_first(df: DataFrame, keys: str | Sequence[str] = KEY,
               order: Sequence[Column | str] = ("ordinal",)) -> DataFrame:
    """The first row per key in arrival order.

    ``row_number() = 1`` plans a WindowGroupLimit below the exchange: every
    map task forwards one row per key, so a key with very many copies reaches
    its reducer as one row per map task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def with_coordinates(df: DataFrame) -> DataFrame:
    return df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def parse_day(df: DataFrame, source: str = "data", target: str = "data_foco") -> DataFrame:
    """Add the date; NULL where the text is none. Without the column, no change."""
    if source not in df.columns:
        return df
    return df.withColumn(target, F.col(source).cast("string").try_cast("date"))


def with_valid_day(df: DataFrame, target: str = "data_foco") -> DataFrame:
    return df.filter(F.col(target).isNotNull()) if target in df.columns else df


def normalise_confidence(df: DataFrame, name: str = "confianca") -> DataFrame:
    return df.withColumn(name, s.confidence_percent(name)) if name in df.columns else df


def with_confidence(df: DataFrame, name: str = "confianca") -> DataFrame:
    return df.filter(s.confident(name)) if name in df.columns else df


def clean_detections(raw: DataFrame) -> DataFrame:
    """Coordinates, then date, then confidence, then keep-first by key."""
    parsed = normalise_confidence(parse_day(with_coordinates(raw)))
    return keep_first(with_confidence(with_valid_day(parsed)))


def funnel(raw: DataFrame) -> DataFrame:
    """Rows left after each cleaning step, as one row, in one pass.

    The last count needs distinct keys; the first aggregate, by key, is
    combined map-side, so a hot key does not travel row by row.
    """
    parsed = normalise_confidence(parse_day(raw))
    placed = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    dated = placed & F.col("data_foco").isNotNull() if "data_foco" in parsed.columns else placed
    sure = dated & s.confident("confianca") if "confianca" in parsed.columns else dated
    per_key = parsed.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(placed).alias("placed"),
        F.count_if(dated).alias("dated"),
        F.count_if(sure).alias("sure"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return per_key.agg(
        total("n").alias("linhas_brutas"),
        total("placed").alias("com_coordenadas"),
        total("dated").alias("com_data"),
        total("sure").alias("com_confianca"),
        F.count_if(F.col("sure") > 0).cast("bigint").alias("sem_duplicatas"),
    )


def split_stage(stage: DataFrame, weather_columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Separate a staged join into detections and (fully deduplicated) weather."""
    present = [c for c in weather_columns if c in stage.columns]
    weather = stage.select(KEY, *present).dropDuplicates()
    return stage.drop(*present), weather
