"""Exact order statistics without gathering the values anywhere.

``percentile`` and ``median`` keep a map of all distinct values on one task, and
sketches of all tasks meet in one. Here each round costs one scan: the span of values around the wanted
rank is cut into equal steps, rows are counted per step (combined on the map
side, so a task sends a bounded number of rows), and the search goes on between the least
and the greatest value of the step that holds the rank. The ends of a span are steps of their own, so
a value held by very many rows ends the search. Only when at most ``direct``
values are left are they sorted in one aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.functions.scalars import literal

DIRECT = 100_000
STEPS = 1024
_LARGEST = 1.7976931348623157e308


@dataclass
class _Span:
    """The ``size`` values of a column from ``least`` to ``most``, and the ranks sought there.

    ``targets`` maps each rank in the whole column to the rank in the span.
    """

    name: str
    size: int
    targets: dict[int, int]
    least: float
    most: float

    def inside(self) -> str:
        return f"{self.name} between {literal(self.least)} and {literal(self.most)}"

    def step(self) -> str:
        """0 and STEPS - 1 for the ends, those between for what lies between, in order."""
        low, high = (literal(min(max(x, -_LARGEST), _LARGEST) / 2) for x in (self.least, self.most))
        place = f"floor(nanvl(({self.name} / 2 - {low}) / ({high} - {low}), 0) * {STEPS})"
        between = f"cast(least(greatest({place}, 1), {STEPS - 2}) as int)"
        return (f"case {self.name} when {literal(self.least)} then 0 when {literal(self.most)} then {STEPS - 1} "
                f"else {between} end")


@contextmanager
def _narrow_table(df: DataFrame, values: Mapping[str, Column], keep: bool) -> Iterator[DataFrame]:
    """The searched columns alone, kept while the rounds scan them."""
    table = df.select(*[expr.cast("double").alias(name) for name, expr in values.items()])
    if not keep:
        yield table
        return
    table = table.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield table
    finally:
        table.unpersist()


def kth_values(df: DataFrame, values: Mapping[str, Column], ranks: Mapping[str, Sequence[int]],
               counts: Mapping[str, int], keep: bool = True, **options) -> dict[tuple[str, int], float]:
    """Exact k-th smallest values (0-based ranks), all columns at once.

    ``keep=False`` scans ``df`` anew each round: better for plain file scans.
    """
    with _narrow_table(df, values, keep) as table:
        return _search(table, ranks, counts, **options)


def _search(table: DataFrame, ranks: Mapping[str, Sequence[int]], counts: Mapping[str, int],
            direct: int = DIRECT) -> dict[tuple[str, int], float]:
    for name, wanted in ranks.items():
        for rank in wanted:
            if not 0 <= rank < counts[name]:
                raise IndexError(f"rank {rank} outside the {counts[name]} values of {name}")
    found: dict[tuple[str, int], float] = {}
    spans = []
    for name, (least, most) in _ends(table, [name for name, wanted in ranks.items() if wanted]).items():
        spans.append(_Span(name, counts[name], {rank: rank for rank in ranks[name]}, least, most))
    while large := [x for x in spans if x.size > direct]:
        small = [x for x in spans if x.size <= direct]
        spans = small + _narrow(table, large, found)
    _pick(table, spans, found)
    return found


def _ends(table: DataFrame, names: Sequence[str]) -> dict[str, tuple[float, float]]:
    if not names:
        return {}
    row = table.agg(*[F.min(n).alias(f"least{i}") for i, n in enumerate(names)],
                    *[F.max(n).alias(f"most{i}") for i, n in enumerate(names)]).first()
    return {n: (row[i], row[len(names) + i]) for i, n in enumerate(names)}


def count_values(df: DataFrame, values: Mapping[str, Column]) -> dict[str, int]:
    row = df.agg(*[F.count(expr.cast("double")).alias(name) for name, expr in values.items()]).first()
    return row.asDict()


def _histograms(table: DataFrame, spans: Sequence[_Span]) -> list[list[tuple[int, float, float]]]:
    """Per span (rows, least, greatest) of its steps, in order."""
    members = ", ".join(f"if({x.inside()}, named_struct('span', {i}, 'step', {x.step()}, 'value', {x.name}), null)"
                        for i, x in enumerate(spans))
    rows = table.select(F.explode(F.expr(f"filter(array({members}), x -> x is not null)")).alias("x")).select("x.*")
    counted = rows.groupBy("span", "step").agg(F.count(F.lit(1)).alias("n"), F.min("value"), F.max("value"))
    steps: list[list] = [[] for _ in spans]
    for span, step, *rest in counted.collect():  # at most STEPS rows per span
        steps[span].append((step, tuple(rest)))
    return [[rest for _, rest in sorted(found)] for found in steps]


def _narrow(table: DataFrame, spans: list[_Span], found: dict[tuple[str, int], float]) -> list[_Span]:
    """One round: the step of each wanted rank is its next span."""
    narrowed: list[_Span] = []
    for span, steps in zip(spans, _histograms(table, spans)):
        before, inner = 0, {}
        for rank, place in sorted(span.targets.items()):
            while place >= before + steps[0][0]:
                before += steps.pop(0)[0]
            size, least, most = steps[0]
            if least == most or size == 1:
                found[span.name, rank] = least
            else:
                inner.setdefault(before, _Span(span.name, size, {}, least, most)).targets[rank] = place - before
        narrowed += inner.values()
    return narrowed


#: Steps an open span is cut into per row range it should give, and the least number.
FINENESS = 4
LEAST_STEPS = 16


def _steps_of(table: DataFrame, spans: Sequence[tuple[int, float, float]], rows: int) -> list[tuple[int, float, float]]:
    """(rows, least, greatest) of the steps of all (size, least, most) spans, which lie apart and in order.

    A row finds its span by binary search among the ends of all, and the span's own ends by a join; no
    expression grows with the number of spans.
    """
    spark = table.sparkSession
    ends = sorted({end for _, least, most in spans for end in (least, math.nextafter(most, math.inf))} - {math.inf})
    opens = {least: (least, most, min(STEPS * STEPS, max(LEAST_STEPS, math.ceil(FINENESS * size / rows))))
             for size, least, most in spans}
    bounds = spark.createDataFrame([(float(i), *map(float, opens[end][:2]), opens[end][2]) for i, end in enumerate(ends)
                                    if end in opens], "_span double, _least double, _most double, _steps int")
    if len(ends) > 1:
        splits = [*ends, math.inf] if ends[0] == -math.inf else [-math.inf, *ends, math.inf]
        placed = Bucketizer(splits=splits, inputCol="v", outputCol="_span").transform(table)
        placed = placed.withColumn("_span", F.col("_span") - float(ends[0] != -math.inf))
    else:
        placed = table.withColumn("_span", F.lit(0.0))
    low, high = (f"greatest(least({end}, {_LARGEST}D), -{_LARGEST}D) / 2" for end in ("_least", "_most"))
    between = f"floor(nanvl((v / 2 - {low}) / ({high} - {low}), 0) * _steps)"
    step = F.expr(f"case when v = _least then 0 when v = _most then _steps - 1 "
                  f"else cast(least(greatest({between}, 1), _steps - 2) as int) end")
    # as many rows as row ranges, times a constant
    counted = placed.join(bounds, "_span").groupBy("_span", step.alias("_step")).agg(
        F.count(F.lit(1)), F.min("v"), F.max("v"))
    return [tuple(row)[2:] for row in counted.collect()]


def cut_points(df: DataFrame, order: str, rows: int, ranges: int = 1) -> list[float]:
    """Values that cut a column into at least about ``ranges`` ranges of at most ``rows`` rows, single values apart;
    the first and last range are open."""
    table = df.select(F.col(order).cast("double").alias("v")).filter("v is not null")
    total, least, most = table.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
    rows = max(1, min(rows, math.ceil(total / ranges)))
    if total <= rows or least == most:
        return []
    spans, steps = [(total, least, most)], []
    while spans:
        found = _steps_of(table, spans, rows)
        spans = sorted((step for step in found if step[0] > rows and step[1] < step[2]), key=lambda step: step[1])
        steps += [step for step in found if step[0] <= rows or step[1] == step[2]]
    cuts, size = [], 0
    for count, low, _ in sorted(steps, key=lambda step: step[1]):
        if size and size + count > rows:
            cuts.append(low)
            size = 0
        size += count
    return cuts


def _pick(table: DataFrame, intervals: list[_Span], found: dict[tuple[str, int], float]) -> None:
    """Sort the few values left (at most ``direct`` per interval) and take each rank."""
    if not intervals:
        return
    left = table.agg(*[F.expr(f"sort_array(collect_list(if({x.inside()}, {x.name}, null))) as v{i}")
                       for i, x in enumerate(intervals)])
    row = left.select(*[F.expr(f"array({', '.join(f'get(v{i}, {place})' for place in x.targets.values())}) as p{i}")
                        for i, x in enumerate(intervals)]).first()
    for i, interval in enumerate(intervals):
        for rank, value in zip(interval.targets, row[i]):
            found[interval.name, rank] = value


def quantiles(df: DataFrame, values: Mapping[str, Column] | Sequence[str], shares: Sequence[float],
              keep: bool = True, **options) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation between neighbours.

    NULLs are ignored; a column without values gives ``None`` throughout.
    """
    if not isinstance(values, Mapping):
        values = {name: F.col(name) for name in values}
    with _narrow_table(df, values, keep) as table:
        counts = count_values(table, {name: F.col(name) for name in values})
        ranks = {}
        for name, n in counts.items():
            positions = [share * (n - 1) for share in shares] if n else []
            ranks[name] = sorted({f(p) for p in positions for f in (math.floor, math.ceil)})
        found = _search(table, ranks, counts, **options)
    result: dict[str, list[float | None]] = {}
    for name, n in counts.items():
        if not n:
            result[name] = [None] * len(shares)
            continue
        row = []
        for share in shares:
            position = share * (n - 1)
            low, high = found[name, math.floor(position)], found[name, math.ceil(position)]
            row.append(low + (high - low) * (position - math.floor(position)))
        result[name] = row
    return result


def medians(df: DataFrame, values: Mapping[str, Column] | Sequence[str], **options) -> dict[str, float | None]:
    return {name: row[0] for name, row in quantiles(df, values, [0.5], **options).items()}


def most_frequent(df: DataFrame, name: str):
    """Most frequent non-null value; the smallest one on a tie, None if empty."""
    top = (df.filter(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
           .orderBy(F.desc("_n"), F.asc(name)).first())
    return top[0] if top else None
