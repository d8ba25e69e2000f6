"""Synthetic fallbacks: detections, weather, training rows, missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline import lookups
from emberline.functions import random as r
from emberline.functions import scalars as s
from emberline.operators.order_stats import count_values, kth_values


def synthetic_detections(keys: DataFrame, as_of: str, key: str = "id", seed: int = 42) -> DataFrame:
    """One detection per (unique, numeric) key, e.g. of ``spark.range(n)``."""
    day = F.date_sub(F.lit(as_of).cast("date"), r.randint(key, "day", 0, 29, seed))
    clock = F.concat(F.lpad(r.randint(key, "hour", 0, 23, seed).cast("string"), 2, "0"),
                     F.lpad(r.randint(key, "minute", 0, 59, seed).cast("string"), 2, "0"))
    return keys.select(
        F.concat(F.lit("SYN"), s.zero_fill(key, 6)).alias("id_externo"),
        F.round(r.uniform(key, "lat", -33, 5, seed), 4).alias("latitude"),
        F.round(r.uniform(key, "lon", -73, -34, seed), 4).alias("longitude"),
        day.cast("string").alias("data"),
        clock.alias("hora"),
        r.choice(key, "sat", lookups.SYNTHETIC_SATELLITES, seed).alias("satelite"),
        F.round(r.uniform(key, "conf", 40, 100, seed), 1).alias("confianca"),
        F.round(r.uniform(key, "bright", 300, 380, seed), 1).alias("brilho"),
        F.round(r.uniform(key, "frp", 1, 500, seed), 1).alias("frp"),
        F.col(key).cast("bigint").alias("ordinal"),
    )


def synthetic_weather(detections: DataFrame, key: str = "id_externo", seed: int = 42) -> DataFrame:
    draw = lambda name, low, high: F.round(r.uniform(key, name, low, high, seed), 1).alias(name)
    order = "ordinal" if "ordinal" in detections.columns else key
    return detections.select(key, draw("temperatura", 20, 42), draw("umidade", 10, 90), draw("vento", 0, 45),
                             draw("precipitacao", 0, 30), F.col(order).alias("ordinal"))


MISSING_COLUMNS = ("umidade", "velocidade_vento", "ndvi")


def synthetic_dataset(keys: DataFrame, key: str = "id", seed: int = 42) -> DataFrame:
    """Training rows as delivered: two in a hundred lack humidity, wind or vegetation index."""
    return inject_nulls(synthetic_training(keys, key, seed), "id", MISSING_COLUMNS, 0.02, seed)


def synthetic_training(keys: DataFrame, key: str = "id", seed: int = 42, noise: float = 0.9) -> DataFrame:
    """Training rows with twelve inputs and a label, one per key."""
    bounded = lambda draw, low, high: F.round(s.clip(draw, float(low), float(high)), 1)
    # Distributions and bounds
    table = keys.select(
        F.col(key).alias("id"),
        bounded(r.normal(key, "temp", 31, 5, seed), 15, 48).alias("temperatura"),
        bounded(r.normal(key, "hum", 45, 18, seed), 8, 100).alias("umidade"),
        bounded(r.gamma(key, "wind", 2.0, 6, seed), 0, 60).alias("velocidade_vento"),
        bounded(r.gamma(key, "rain", 1.2, 3, seed), 0, 80).alias("precipitacao_mm"),
        s.clip(r.poisson(key, "dry", 8, seed), 0, 60).alias("dias_sem_chuva"),
        bounded(r.normal(key, "bright", 320, 18, seed), 280, 400).alias("brilho"),
        bounded(r.gamma(key, "frp", 2.0, 25, seed), 1, 600).alias("frp"),
        F.round(r.uniform(key, "conf", 40, 100, seed), 1).alias("confianca"),
        F.round(r.uniform(key, "ndvi", 0.1, 0.9, seed), 3).alias("ndvi"),
        bounded(r.gamma(key, "slope", 1.5, 8, seed), 0, 60).alias("declividade"),
        r.choice(key, "biome", lookups.SYNTHETIC_BIOMES, seed).alias("bioma"),
        r.choice(key, "state", lookups.SYNTHETIC_STATES, seed).alias("estado"),
    )
    jitter = r.normal("id", "risk", 0, noise, seed) if noise else None
    return table.withColumn("alto_risco", s.simulated_risk(jitter))


def inject_nulls(df: DataFrame, key: str, columns: Sequence[str], share: float = 0.02,
                 seed: int = 42) -> DataFrame:
    """Blank exactly ``int(share * n)`` rows per column, chosen by key hash.

    The row with the last chosen hash rank gives a threshold per column, so the
    change itself is row-local. Keys must be unique.
    """
    draws = {c: r.hash53(key, f"null.{c}", seed) for c in columns}
    counts = count_values(df, draws)
    wanted = {c: int(share * counts[c]) for c in columns}
    some = [c for c in columns if wanted[c]]
    if not some:
        return df
    found = kth_values(df, {c: draws[c] for c in some}, {c: [wanted[c] - 1] for c in some}, counts)
    return df.withColumns({
        c: F.when(draws[c] > F.lit(int(found[c, wanted[c] - 1])), F.col(c)) for c in some})
