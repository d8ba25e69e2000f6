"""The analytical queries over the star schema.

Means of decimals are taken as double sum over count, then rounded half-up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.functions import scalars as s
from emberline.schemas import KEY


def mean(name: str, places: int = 1) -> Column:
    return F.round(F.sum(name).cast("double") / F.count(name), places)


def _rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def state_ranking(detections: DataFrame, as_of: str) -> DataFrame:
    """Detections and mean power per state over the last month, busiest first."""
    recent = detections.filter(s.month_recency("data_foco", as_of))
    return (recent.groupBy("estado").agg(_rows("total_focos"), mean("frp").alias("frp_medio"))
            .orderBy(F.desc("total_focos"), "estado"))


def daily_evolution(detections: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Detections per day; days without any do not appear."""
    recent = detections.filter(s.day_recency("data_foco", as_of, days))
    return recent.groupBy(F.col("data_foco").alias("dia")).agg(_rows("focos_no_dia")).orderBy("dia")


def daily_evolution_filled(detections: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """The same with a zero for every day without detections."""
    spark = detections.sparkSession
    today = F.lit(as_of).cast("date")
    calendar = spark.range(1).select(
        F.explode(F.sequence(F.date_sub(today, days), today)).alias("dia"))
    return (calendar.join(daily_evolution(detections, as_of, days), "dia", "left")
            .select("dia", F.coalesce("focos_no_dia", F.lit(0)).alias("focos_no_dia")).orderBy("dia"))


def weather_by_biome(detections: DataFrame, weather: DataFrame) -> DataFrame:
    joined = detections.select(KEY, "bioma").join(weather, KEY)
    return (joined.groupBy("bioma").agg(
        _rows("qtd_focos"), mean("temperatura").alias("temp_media"), mean("umidade").alias("umidade_media"),
        mean("vento").alias("vento_medio"), F.sum("estacao_seca").cast("bigint").alias("focos_em_seca"))
        .orderBy(F.desc("qtd_focos"), "bioma"))


def strongest(detections: DataFrame, n: int = 10) -> DataFrame:
    """Top detections by power. NULLs go last: they are no measurement."""
    return (detections.select(KEY, "estado", "bioma", "frp", "brilho", "data_foco")
            .orderBy(F.desc_nulls_last("frp"), KEY).limit(n))


def satellite_statistics(detections: DataFrame) -> DataFrame:
    return (detections.groupBy("satelite").agg(
        _rows("qtd"), F.min("frp").alias("frp_min"), mean("frp").alias("frp_medio"),
        F.max("frp").alias("frp_max"), mean("confianca").alias("confianca_media"))
        .filter("qtd > 0").orderBy(F.desc_nulls_last("frp_medio"), "satelite"))


def critical_rows(detections: DataFrame, weather: DataFrame, images: DataFrame) -> DataFrame:
    """Strong detections per image that says fire or nothing, or without image.

    A left join with the class filter after it, written as its two halves: the
    inner half can be split when one detection has very many images (an outer
    join cannot, on that side), and the other half needs distinct keys only.
    """
    base = _strong(detections, weather)
    matched = base.join(images.select(KEY, "classificacao").filter(_FIRE_OR_UNKNOWN), KEY)
    unmatched = base.join(images.select(KEY).distinct(), KEY, "left_anti")
    return matched.unionByName(unmatched.withColumn("classificacao", F.lit(None).cast("string")))


_FIRE_OR_UNKNOWN = "classificacao = 'fogo' or classificacao is null"


def _strong(detections: DataFrame, weather: DataFrame) -> DataFrame:
    strong = detections.filter("frp > 50").select(KEY, "estado", "bioma", "frp")
    return strong.join(weather.select(KEY, "umidade"), KEY)


def _with_image_count(detections: DataFrame, weather: DataFrame, images: DataFrame) -> DataFrame:
    """One row per critical detection, with the number of its critical rows.

    Images are counted per key before the join, so none of them is shuffled
    beyond that count; a detection without images counts once.
    """
    per_key = images.groupBy(KEY).agg(F.count_if(F.expr(_FIRE_OR_UNKNOWN)).alias("_n"))
    joined = _strong(detections, weather).join(per_key, KEY, "left")
    return joined.withColumn("_n", F.coalesce("_n", F.lit(1))).filter("_n > 0")


def _weighted_mean(name: str, places: int = 1) -> Column:
    total = F.sum(F.col(name) * F.col("_n")).cast("double")
    return F.round(total / F.sum(F.when(F.col(name).isNotNull(), F.col("_n"))), places)


def critical_hotspots(detections: DataFrame, weather: DataFrame, images: DataFrame) -> DataFrame:
    """Critical rows by state and biome; one row per image is counted."""
    return (_with_image_count(detections, weather, images).groupBy("estado", "bioma").agg(
        F.sum("_n").alias("focos_criticos"), _weighted_mean("frp").alias("frp_medio"),
        _weighted_mean("umidade").alias("umidade_media"), F.round(F.max("frp"), 1).alias("frp_max"))
        .orderBy(F.desc("focos_criticos"), "estado", "bioma"))


def critical_hotspots_distinct(detections: DataFrame, weather: DataFrame, images: DataFrame) -> DataFrame:
    """The same counting each detection once, whatever its images."""
    return (_with_image_count(detections, weather, images).groupBy("estado", "bioma").agg(
        _rows("focos_criticos"), mean("frp").alias("frp_medio"), mean("umidade").alias("umidade_media"),
        F.max("frp").alias("frp_max"))
        .orderBy(F.desc("focos_criticos"), "estado", "bioma"))


def group_counts(df: DataFrame, group: str, top: int | None = None) -> DataFrame:
    """Rows with a key per non-null group, largest first."""
    counts = (df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.count(KEY).alias("total"))
              .orderBy(F.desc("total"), group))
    return counts.limit(top) if top else counts


def column_means(df: DataFrame, columns: Sequence[str] = ("frp", "temperatura", "umidade", "vento", "precipitacao"),
                 flag: str = "estacao_seca", places: int = 2) -> DataFrame:
    """Means over what reads as a number, and the share of flagged rows, as one row."""
    aggregates = [_rows("total")]
    aggregates += [F.round(F.avg(s.number_in(df, c)), places).alias(f"media_{c}") for c in columns if c in df.columns]
    if flag in df.columns:
        aggregates.append(F.round(F.avg(F.col(flag).cast("double")) * 100, 1).alias(f"pct_{flag}"))
    return df.agg(*aggregates)


def value_shares(df: DataFrame, name: str) -> DataFrame:
    """Absolute and relative frequency per value."""
    counts = df.groupBy(name).agg(_rows("total"))
    everything = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("fracao", F.round(F.col("total") / everything, 6)).orderBy(F.desc("total"), name)


def dataset_profile(df: DataFrame, label: str = "alto_risco") -> DataFrame:
    return df.agg(_rows("linhas"), F.lit(len(df.columns) - 1).cast("bigint").alias("colunas"),
                  F.round(F.avg(F.col(label).cast("double")) * 100, 1).alias("pct_positivo"))


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """First rows of a result, in the order the result already has."""
    return df.limit(n)
