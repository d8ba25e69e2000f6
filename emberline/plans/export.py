"""Snapshot of the star schema as the flat table the risk model reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.functions import random as r
from emberline.functions import scalars as s
from emberline.schemas import KEY, MODEL_COLUMNS


def snapshot(detections: DataFrame, weather: DataFrame) -> DataFrame:
    """Inner join, renamed to the model's column names; keeps the key."""
    facts = detections.select(KEY, "confianca", "brilho", "frp", "estado", "bioma")
    return facts.join(weather, KEY).withColumnsRenamed(
        {"vento": "velocidade_vento", "precipitacao": "precipitacao_mm"})


def slope_proxy(key: str = KEY, seed: int = 42):
    """No elevation model: N(10, 5) within 0..60, one decimal, by row key."""
    return F.round(s.clip(r.normal(key, "declividade", 10, 5, seed), 0.0, 60.0), 1)


def derive(flat: DataFrame, seed: int = 42, noise: float = 0.4) -> DataFrame:
    """The derived columns and the label; ``noise=0`` gives the bare rule."""
    jitter = r.normal(KEY, "alto_risco", 0, noise, seed) if noise else None
    return flat.withColumns({
        "dias_sem_chuva": s.days_without_rain(),
        "ndvi": s.ndvi_of("bioma"),
        "declividade": slope_proxy(seed=seed),
        "estacao_seca": F.coalesce(F.col("estacao_seca").cast("int"), F.lit(0)),
        "vento_forte": s.strong_wind(),
        "alto_risco": s.observed_risk(jitter),
    })


def model_table(detections: DataFrame, weather: DataFrame, seed: int = 42, noise: float = 0.4,
                keep_key: bool = False) -> DataFrame:
    """The fifteen model columns in order, optionally after the row key."""
    columns = [KEY, *MODEL_COLUMNS] if keep_key else MODEL_COLUMNS
    return derive(snapshot(detections, weather), seed, noise).select(*columns)
