"""Feature engineering and preparation for the risk model.

The steps are functions over fitted values; ``RiskPrep`` fits them all and its
model applies them, in training and when scoring alike.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.functions import scalars as s
from emberline.operators.order_stats import medians, most_frequent, quantiles
from emberline.schemas import CATEGORICAL, CONTINUOUS, FLAGS

Bounds = dict[str, tuple[float, float]]


def engineer(df: DataFrame, humidity_median: float | None) -> DataFrame:
    """Dryness index and flags. The model's dry season replaces the stored flag."""
    return df.withColumns({
        "indice_secura": s.dryness_index(humidity_median),
        "estacao_seca": s.dry_season(),
        "vento_forte": s.strong_wind(),
    })


def bounds_from_quartiles(quartiles: Mapping[str, Sequence[float | None]], factor: float = 1.5) -> Bounds:
    bounds = {}
    for name, values in quartiles.items():
        q1, q3 = values[0], values[-1]
        if q1 is not None and q3 is not None:
            bounds[name] = (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    return bounds


def iqr_bounds(df: DataFrame, columns: Sequence[str], factor: float = 1.5, **options) -> Bounds:
    """Clip bounds per column; a column without values has none."""
    present = [c for c in columns if c in df.columns]
    return bounds_from_quartiles(quantiles(df, present, [0.25, 0.75], **options), factor)


def iqr_clip(df: DataFrame, bounds: Bounds) -> DataFrame:
    return df.withColumns({c: s.clip(f"cast({c} as double)", low, high) for c, (low, high) in bounds.items()})


def scale_statistics(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation; a constant column scales by 1."""
    aggregates = []
    for c in columns:
        value = F.col(c).cast("double")
        aggregates += [F.avg(value), F.stddev_pop(value)]
    row = df.agg(*aggregates).first()
    return {c: (row[2 * i] or 0.0, row[2 * i + 1] or 1.0) for i, c in enumerate(columns)}


def scale(df: DataFrame, statistics: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c).cast("double") - mean) / std for c, (mean, std) in statistics.items()})


def _floats(parent: str, name: str, doc: str) -> Param:
    return Param(parent, name, doc, TypeConverters.toListFloat)


class _PrepParams(Params):
    factor = Param(Params._dummy(), "factor", "width of the clip bounds in quartile distances",
                   TypeConverters.toFloat)


class RiskPrep(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits humidity median, clip bounds, medians, scaling and modes.

    Clipping never moves a median, so one search serves quartiles and medians.
    """

    @keyword_only
    def __init__(self, *, factor: float = 1.5):
        super().__init__()
        self._setDefault(factor=1.5)
        self._set(factor=factor)

    def _fit(self, df: DataFrame) -> "RiskPrepModel":
        humidity = medians(df, ["umidade"])["umidade"]
        humidity = 0.0 if humidity is None else humidity
        table = engineer(df, humidity)
        found = quantiles(table, {c: F.col(c).cast("double") for c in CONTINUOUS}, [0.25, 0.5, 0.75])
        bounds = bounds_from_quartiles(found, self.getOrDefault(self.factor))
        middle = {c: 0.0 if found[c][1] is None else found[c][1] for c in CONTINUOUS}
        filled = iqr_clip(table, bounds).withColumns({
            c: F.coalesce(F.col(c).cast("double"), F.lit(middle[c])) for c in CONTINUOUS})
        statistics = scale_statistics(filled, CONTINUOUS)
        modes = [most_frequent(df, c) for c in CATEGORICAL]
        model = RiskPrepModel()
        model._set(
            humidityMedian=humidity,
            lower=[bounds.get(c, (0.0, 0.0))[0] for c in CONTINUOUS],
            upper=[bounds.get(c, (0.0, 0.0))[1] for c in CONTINUOUS],
            medians=[middle[c] for c in CONTINUOUS],
            means=[statistics[c][0] for c in CONTINUOUS],
            deviations=[statistics[c][1] for c in CONTINUOUS],
            modes=["" if mode is None else str(mode) for mode in modes],
        )
        return model


class RiskPrepModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``x_<column>`` for every model input, NULL-free, as expressions."""

    humidityMedian = Param(Params._dummy(), "humidityMedian", "fitted humidity median", TypeConverters.toFloat)
    lower = _floats(Params._dummy(), "lower", "lower clip bounds")
    upper = _floats(Params._dummy(), "upper", "upper clip bounds")
    medians = _floats(Params._dummy(), "medians", "values for missing numbers")
    means = _floats(Params._dummy(), "means", "means after clip and imputation")
    deviations = _floats(Params._dummy(), "deviations", "population deviations")
    modes = Param(Params._dummy(), "modes", "values for missing categories", TypeConverters.toListString)

    def _transform(self, df: DataFrame) -> DataFrame:
        get = self.getOrDefault
        table = engineer(df, get(self.humidityMedian))
        inputs = {}
        for i, c in enumerate(CONTINUOUS):
            filled = F.coalesce(
                s.clip(f"cast({c} as double)", get(self.lower)[i], get(self.upper)[i]),
                F.lit(get(self.medians)[i]))
            inputs[f"x_{c}"] = (filled - get(self.means)[i]) / get(self.deviations)[i]
        for i, c in enumerate(CATEGORICAL):
            inputs[f"x_{c}"] = F.coalesce(F.col(c), F.lit(get(self.modes)[i]))
        for c in FLAGS:
            inputs[f"x_{c}"] = F.col(c).cast("double")
        return table.withColumns(inputs)
