"""Rounding, and means as aggregates and from partial sums that do not depend on the order of rows.

Every value is cut into five whole numbers, its limbs: the integer part in pieces of 24, 20 and 20 bits, and ten decimals
of the rest in pieces of 17 bits. Limbs are added up as bigints, so any split of the rows into partitions, days or runs,
merged in any order, gives the same sums bit for bit, and the mean follows from them by one decimal division. Sums of limbs fit
for some 10^12 values in a group. Only values that have no place on this grid (NaN, infinities, magnitudes from
2^63 - 1024 on) are added up as doubles, beside the limbs.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def round2(value: Column) -> Column:
    """Two decimals, half up on the decimal text of the double (1.005 becomes 1.01)."""
    return F.round(value, 2)


def numeric2(value: Column) -> Column:
    """Cast to an exact numeric, round to two decimals, back to double.

    NaN, infinities and magnitudes beyond 28 digits have no such numeric and stay as they are.
    """
    exact = F.round(value.try_cast("decimal(38,10)"), 2).cast("double")
    return F.coalesce(exact, value)


_ON_GRID = 9.223372036854774e18  # the largest double below 2^63
_DECIMALS = 10
# Limb -> its worth, as a decimal for whole numbers and in units of the last decimal for the rest.
_WHOLE = {"w2": 1 << 40, "w1": 1 << 20, "w0": 1}
_REST = {"r1": 1 << 17, "r0": 1}
PARTS = (*_WHOLE, *_REST, "off", "n")


def _limbs(value: Column) -> dict[str, Column]:
    """The limbs of one value; shifts round down, so all but the highest are never negative."""
    on_grid = F.when(value.between(-_ON_GRID, _ON_GRID), value)
    whole = F.floor(on_grid)
    rest = F.rint((on_grid - whole).cast("double") * 10**_DECIMALS).cast("bigint")
    return {
        "w2": F.shiftright(whole, 40),
        "w1": F.shiftright(whole, 20).bitwiseAND((1 << 20) - 1),
        "w0": whole.bitwiseAND((1 << 20) - 1),
        "r1": F.shiftright(rest, 17),
        "r0": rest.bitwiseAND((1 << 17) - 1),
    }


def _sums(metric: str) -> dict[str, Column]:
    """Aggregates of one double or bigint metric: sums of its limbs, of what is off the grid, and the count."""
    value = F.col(metric)
    off = F.when(~value.between(-_ON_GRID, _ON_GRID), value.cast("double"))
    return {name: F.sum(limb) for name, limb in _limbs(value).items()} | {"off": F.sum(off), "n": F.count(value)}


def _quotient(sums: dict[str, Column]) -> Column:
    """The mean from the sums, rounded once: whole part and rest are divided as exact numbers."""

    def total(worth: dict[str, int]) -> Column:
        """Sum of limbs times their worth. NULL sums, of a group without a value on the grid, count as zero."""
        parts = [F.coalesce(sums[name], F.lit(0)).cast("decimal(19,0)") * F.lit(factor).cast("decimal(13,0)") for name, factor in worth.items()]
        return sum(parts[1:], parts[0])

    count = F.nullif(sums["n"], F.lit(0))
    whole = total(_WHOLE)
    quotient = F.call_function("div", whole, count)
    left = (whole - quotient * count.cast("decimal(19,0)")).cast("decimal(19,0)")
    rest = (left * F.lit(10**_DECIMALS).cast("decimal(11,0)") + total(_REST)).cast("decimal(32,0)") / count.cast("decimal(13,0)")
    mean = quotient.cast("double") + rest.cast("double") / 10**_DECIMALS
    return mean + F.coalesce(sums["off"] / count, F.lit(0.0))


def mean(metric: str) -> Column:
    """Aggregate: the mean of a metric, NULL without values; the same for every order and split of the rows."""
    return _quotient(_sums(metric))


def partial_sum(metric: str) -> list[Column]:
    """Aggregates <metric>_<part> of one double or bigint metric, from which the mean follows."""
    return [total.alias(f"{metric}_{part}") for part, total in _sums(metric).items()]


def merged_sum(metric: str, over: WindowSpec | None = None) -> list[Column]:
    """The same columns added up over partial rows, as aggregates or over a window."""
    totals = {part: F.sum(f"{metric}_{part}") for part in PARTS}
    return [(total.over(over) if over else total).alias(f"{metric}_{part}") for part, total in totals.items()]


def partial_mean(metric: str) -> Column:
    """Mean from these columns."""
    return _quotient({part: F.col(f"{metric}_{part}") for part in PARTS})
