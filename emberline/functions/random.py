"""Random columns keyed by row.

Each draw hashes (row key, stream name, seed), so a row gets the same value
whatever the partitioning, and a recomputed task repeats its draws exactly.
Keys are column names or SQL text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_53 = float(2 ** 53)


def _hash(key: str, stream: str, seed: int) -> str:
    return f"shiftrightunsigned(xxhash64({key}, '{stream}', {seed}), 11)"


def _unit(key: str, stream: str, seed: int) -> str:
    return f"((cast({_hash(key, stream, seed)} as double) + 0.5D) / double('{_TWO_53!r}'))"


def _normal(key: str, stream: str, seed: int) -> str:
    """Box-Muller."""
    angle = f"{2 * math.pi!r}D * {_unit(key, stream + '.a', seed)}"
    return f"(sqrt(-2.0D * ln({_unit(key, stream + '.r', seed)})) * cos({angle}))"


def hash53(key: str, stream: str, seed: int = 42) -> Column:
    """53 hash bits as a non-negative long (exact as a double)."""
    return F.expr(_hash(key, stream, seed))


def uniform(key: str, stream: str, low: float = 0.0, high: float = 1.0, seed: int = 42) -> Column:
    return F.expr(f"{_unit(key, stream, seed)} * double('{high - low!r}') + double('{low!r}')")


def normal(key: str, stream: str, mean: float = 0.0, std: float = 1.0, seed: int = 42) -> Column:
    return F.expr(f"{_normal(key, stream, seed)} * double('{std!r}') + double('{mean!r}')")


#: Halvings of the interval, and terms of the series, that leave nothing to double precision.
_HALVINGS = 80
_TERMS = 400


def _gamma_inverse(unit: str, shape: float) -> str:
    """The value at which the distribution function of a unit-scale gamma is ``unit``, by halving an interval.

    The function is its power series x^a e^-x / Gamma(a + 1) * (1 + x / (a + 1) + x^2 / ((a + 1) (a + 2)) + ...).
    """
    series = (f"aggregate(sequence(1, {_TERMS}), named_struct('t', 1.0D, 's', 1.0D), (p, n) -> named_struct("
              f"'t', p.t * m / ({shape!r}D + n), 's', p.s + p.t * m / ({shape!r}D + n)), p -> p.s)")
    below = f"{series} * exp({shape!r}D * ln(m) - m - {math.lgamma(shape + 1.0)!r}D) < {unit}"
    # the middle as a variable: the only element of an array
    halves = (f"element_at(transform(array((i.l + i.h) / 2.0D), m -> if({below}, named_struct('l', m, 'h', i.h), "
              "named_struct('l', i.l, 'h', m))), 1)")
    return (f"aggregate(sequence(1, {_HALVINGS}), named_struct('l', 0.0D, 'h', {3.0 * shape + 60.0!r}D), "
            f"(i, k) -> {halves}, i -> (i.l + i.h) / 2.0D)")


def gamma(key: str, stream: str, shape: float, scale: float, seed: int = 42, tries: int = 8) -> Column:
    """Marsaglia-Tsang for shape >= 1, the first accepted of ``tries`` proposals.

    A proposal is accepted with probability above 0.95, so that all tries fail
    for about one row in 10^10; such a row's value comes from the inverted distribution function.
    """
    d = shape - 1.0 / 3.0
    c = 1.0 / math.sqrt(9.0 * d)

    def proposal(i: int) -> str:
        x = _normal(key, f"{stream}.n{i}", seed)
        v = f"pow(1.0D + {c!r}D * {x}, 3.0D)"
        bound = f"0.5D * {x} * {x} + {d!r}D - {d!r}D * {v} + {d!r}D * ln({v})"
        return f"if({v} > 0 and ln({_unit(key, f'{stream}.u{i}', seed)}) < {bound}, {d!r}D * {v}, null)"

    last = _gamma_inverse(_unit(key, f"{stream}.last", seed), shape)
    proposals = ", ".join([*(proposal(i) for i in range(tries)), last])
    return F.expr(f"coalesce({proposals}) * {float(scale)!r}D")


def poisson(key: str, stream: str, mean: float, seed: int = 42) -> Column:
    """Inverse transform: how many cumulative probabilities the draw exceeds."""
    term, total, cumulative = math.exp(-mean), 0.0, []
    k = 0
    while total + term > total or k < mean:
        total += term
        cumulative.append(total)
        k += 1
        term *= mean / k
    # what rounding leaves out belongs to the last value
    cumulative[-1] = 1.0
    table = ", ".join(f"double('{p!r}')" for p in cumulative)
    return F.expr(f"size(filter(array({table}), p -> p < {_unit(key, stream, seed)}))")


def choice(key: str, stream: str, options: list[str], seed: int = 42) -> Column:
    table = ", ".join(f"'{option}'" for option in options)
    return F.expr(f"element_at(array({table}), cast(floor({_unit(key, stream, seed)} * {len(options)}) as int) + 1)")


def randint(key: str, stream: str, low: int, high: int, seed: int = 42) -> Column:
    """Whole number in ``[low, high]``."""
    return F.expr(f"cast(floor({_unit(key, stream, seed)} * {high + 1 - low}) as int) + {low}")
