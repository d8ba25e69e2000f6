"""Column expressions: coercion, keys, flags, proxies. Everything stays JVM-side.

Arguments are column names unless said otherwise; bodies are SQL text, which
builds in one step where long chains of Column calls take many.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline import lookups


def literal(value: str | float) -> str:
    """A SQL literal; numbers as doubles."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"double('{value!r}')"


def to_number(name: str) -> Column:
    """Double, or NULL for whatever is no number (NaN included)."""
    return F.expr(f"nullif(try_cast({name} as double), double('NaN'))")


def _text_number(name: str) -> str:
    """For free text: a trailing Java ``d``/``f`` is no number."""
    end = f"lower(rtrim(cast({name} as string)))"
    suffixed = f"endswith({end}, 'd') or endswith({end}, 'f') and not endswith({end}, 'inf')"
    return f"if({suffixed}, null, nullif(try_cast({name} as double), double('NaN')))"


def text_to_number(name: str) -> Column:
    return F.expr(_text_number(name))


def number_in(df: DataFrame, name: str) -> Column:
    """The column of ``df`` as a number, by the rule for its type."""
    return text_to_number(name) if df.schema[name].dataType == T.StringType() else to_number(name)


def _zero_filled(value: str, width: int) -> str:
    text = f"cast({value} as string)"
    return f"if(length({text}) >= {width}, {text}, lpad({text}, {width}, '0'))"


def zero_fill(value: str, width: int = 4) -> Column:
    """Left-pad with zeros; longer text stays whole (``lpad`` alone cuts it)."""
    return F.expr(_zero_filled(value, width))


def _coordinate(name: str) -> str:
    """Four-decimal coordinate without trailing zeros, one decimal at least."""
    text = f"rtrim('0', cast(cast({name} as decimal(9,4)) as string))"
    return f"if(endswith({text}, '.'), concat({text}, '0'), {text})"


def natural_key(latitude: str, longitude: str, day: str, time: str) -> Column:
    return F.expr(f"concat_ws('|', {_coordinate(latitude)}, {_coordinate(longitude)}, "
                  f"cast({day} as string), {_zero_filled(time, 4)})")


def confidence_percent(name: str) -> Column:
    """Letter codes by table, numeric text as is, anything else NULL.

    Codes come first: trying to read a letter as a number is slow.
    """
    codes = " ".join(f"when {literal(code)} then {literal(percent)}"
                     for code, percent in lookups.CONFIDENCE_CODES.items())
    return F.expr(f"case lower(trim(cast({name} as string))) {codes} else {_text_number(name)} end")


def confident(name: str, minimum: float = lookups.MIN_CONFIDENCE) -> Column:
    return F.expr(f"coalesce({name}, 0) >= {minimum}")


def clip(value: Column | str, low: float, high: float) -> Column:
    """Bound a value; NULL stays NULL (``greatest``/``least`` skip NULLs)."""
    if isinstance(value, str):
        bounded = f"least(greatest({value}, {literal(low)}), {literal(high)})"
        return F.expr(f"if({value} is null, null, {bounded})")
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def _lookup(name: str, table: Mapping[str, float], default: float) -> str:
    whens = " ".join(f"when {literal(key)} then {literal(value)}" for key, value in table.items())
    return f"(case {name} {whens} else {literal(default)} end)"


def ndvi_of(biome: str) -> Column:
    return F.expr(_lookup(biome, lookups.NDVI_BY_BIOME, lookups.DEFAULT_NDVI))


def dryness_of(biome: str) -> Column:
    return F.expr(_lookup(biome, lookups.DRYNESS_BY_BIOME, lookups.DEFAULT_DRYNESS))


def dry_flag(humidity: str = "umidade", rain: str = "precipitacao") -> Column:
    return F.expr(f"cast(coalesce({humidity} < 30 and {rain} < 1, false) as int)")


def days_without_rain(rain: str = "precipitacao_mm") -> Column:
    """Rain proxy: 30 minus the rain, half-even to whole days."""
    bounded = f"least(greatest(cast({rain} as double), 0.0D), 30.0D)"
    return F.expr(f"if({rain} is null, null, cast(bround(30.0D - {bounded}) as int))")


def strong_wind(wind: str = "velocidade_vento") -> Column:
    return F.expr(f"cast(coalesce(cast({wind} as double), 0.0D) >= 20 as int)")


def dry_season(days: str = "dias_sem_chuva") -> Column:
    return F.expr(f"cast(coalesce({days} >= 10, false) as int)")


def dryness_index(humidity_median: float | None, temperature: str = "temperatura",
                  humidity: str = "umidade") -> Column:
    fill = "null" if humidity_median is None else literal(float(humidity_median))
    return F.expr(f"cast({temperature} as double) / (coalesce(cast({humidity} as double), {fill}) + 1)")


def ms_to_kmh(speed: str) -> Column:
    return F.expr(f"{speed} * 3.6D")


def _risk(score: str, noise: Column | None) -> Column:
    """1 where the sigmoid of the score exceeds one half, 0 also for NULL."""
    total = F.expr(score) if noise is None else F.expr(score) + noise
    return F.coalesce(1 / (1 + F.exp(-total)) > 0.5, F.lit(False)).cast("int")


# The coefficients of both labels
def observed_risk(noise: Column | None = None) -> Column:
    """Label from satellite readings and biome dryness."""
    dryness = _lookup("bioma", lookups.DRYNESS_BY_BIOME, lookups.DEFAULT_DRYNESS)
    return _risk(f"2.5D * ({dryness} - 0.7D) + 0.025D * (cast(frp as double) - 30)"
                 " + 0.030D * (cast(brilho as double) - 335)", noise)


def simulated_risk(noise: Column | None = None) -> Column:
    """Label from weather, terrain and vegetation."""
    dryness = _lookup("bioma", lookups.DRYNESS_BY_BIOME, lookups.DEFAULT_DRYNESS)
    return _risk("0.16D * (temperatura - 30) - 0.07D * (umidade - 45) + 0.13D * (velocidade_vento - 12)"
                 " - 0.10D * precipitacao_mm + 0.14D * (dias_sem_chuva - 8) + 0.012D * (frp - 50)"
                 f" + 1.6D * ({dryness} - 0.8D) + 1.8D * (ndvi - 0.5D)", noise)


def alert_tier(probability: str = "probabilidade") -> Column:
    return F.expr(f"case when {probability} >= 0.7D then 'alto' when {probability} >= 0.4D then 'moderado' "
                  "else 'baixo' end")


def month_recency(day: str, as_of: str, months: int = 1) -> Column:
    """``day`` within the last ``months``; a month's last day maps to a last day."""
    today = f"date'{as_of}'"
    back = f"add_months({today}, -{months})"
    return F.expr(f"{day} >= if({today} = last_day({today}), last_day({back}), {back})")


def day_recency(day: str, as_of: str, days: int = 30) -> Column:
    return F.expr(f"{day} >= date_sub(date'{as_of}', {days})")
