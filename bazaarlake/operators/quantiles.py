"""Exact quantiles of number columns by radix narrowing.

Values are counted map-side in bins that keep their order: first by sign, binary exponent
and ten bits of fraction, then, inside each bin that holds a wanted rank, in 2**21 equal
steps between its least and its greatest value. A bin of the first histogram spans 2**42
doubles, so two more histograms reach single values. What is shuffled are bins and their
counts, whose number does not grow with the rows; every step reads the columns anew, and
only those, with the asked ranges as filters.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_FRACTION = 1 << 10
_STEPS = 1 << 21
_BIAS = 1024  # above any negated exponent


def number(column: str) -> Column:
    """A column as a finite double; what is not a number, or infinite, counts as missing."""
    value = F.col(f"`{column}`").try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def order_image(value: Column) -> Column:
    """A whole number that grows with the value: sign, exponent, leading fraction bits.

    Rounding of the logarithm moves a value beside a power of two to the end of the
    neighbouring exponent's range, which is the same number.
    """
    size = F.abs(value)
    exponent = F.least(F.greatest(F.floor(F.log2(size)), F.lit(-1022)), F.lit(1023))
    fraction = F.floor((size / F.pow(F.lit(2.0), exponent) - 1) * _FRACTION)
    image = (exponent + _BIAS) * _FRACTION + fraction
    return F.when(value == 0, F.lit(0).cast("long")).when(value < 0, -image).otherwise(image)


@dataclass(frozen=True)
class _Range:
    """Values of one column from ``low`` to ``high``, of which ``before`` are smaller ones."""

    column: str
    low: float
    high: float
    before: int
    rows: int
    total: int


def _bins(df: DataFrame, cells: list[Column]) -> DataFrame:
    """(part, bin) with rows, least and greatest value, over (part, bin, value) cells."""
    return df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").filter(
        "bin IS NOT NULL").groupBy("part", "bin").agg(
        F.count(F.lit(1)).alias("rows"), F.min("value").alias("low"),
        F.max("value").alias("high"))


def _cell(part: int, bin_: Column, value: Column) -> Column:
    return F.struct(F.lit(part).alias("part"), bin_.cast("long").alias("bin"),
                    value.alias("value"))


def _ranks(total: int, shares: Sequence[float]) -> set[int]:
    places = [share * (total - 1) for share in shares]
    return {f(p) for p in places for f in (math.floor, math.ceil)}


def _asked(bins: DataFrame, parts: list[tuple[str, int, int]],
           shares: Sequence[float]) -> list[_Range]:
    """The bins that hold a wanted rank; ``parts`` has (column, rows before, rows in all).

    Where a total is not known yet (0), it is the sum over the bins. A window runs over
    at most as many rows as there are bins.
    """
    mine = Window.partitionBy("part")
    placed = bins.select(
        "*", F.sum("rows").over(mine.orderBy("bin")).alias("until"),
        F.sum("rows").over(mine).alias("in_part"))
    given = F.array(*[F.struct(F.lit(before).alias("before"), F.lit(total).alias("total"))
                      for _, before, total in parts])
    known = F.element_at(given, F.col("part") + 1)
    total = F.when(known["total"] > 0, known["total"]).otherwise(F.col("in_part"))
    rows = placed.select(
        "part", "low", "high", "rows", total.alias("total"),
        (known["before"] + F.col("until") - F.col("rows")).alias("before"))
    rank = [f(F.lit(share) * (F.col("total") - 1)) for share in shares for f in (F.floor, F.ceil)]
    holds = [(r >= F.col("before")) & (r < F.col("before") + F.col("rows")) for r in rank]
    # Two ranks per share and column at most.
    return [_Range(parts[r["part"]][0], r["low"], r["high"], r["before"], r["rows"], r["total"])
            for r in rows.filter(reduce(lambda a, b: a | b, holds)).collect()]


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float]
) -> dict[str, list[float] | None]:
    """Per column the quantiles at ``shares``, between neighbours by linear interpolation.

    Null, not-a-number and infinite values are left out; a column without values has None.
    The driver gets two bins per share and column and step, never values of rows.
    """
    if not columns:
        return {}
    cells = [_cell(i, order_image(number(c)), number(c)) for i, c in enumerate(columns)]
    ranges = _asked(_bins(df, cells), [(c, 0, 0) for c in columns], shares)
    found: dict[str, dict[int, float]] = {c: {} for c in columns}
    totals = {r.column: r.total for r in ranges}
    while ranges:
        for r in ranges:
            if r.low == r.high:
                found[r.column].update(
                    {k: r.low for k in _ranks(r.total, shares) if 0 <= k - r.before < r.rows})
        ranges = [r for r in ranges if r.low < r.high]
        if ranges:
            inside = [number(r.column).between(r.low, r.high) for r in ranges]
            cells = [_cell(i, F.when(here, F.floor(
                (number(r.column) - r.low) / F.lit(r.high - r.low) * _STEPS)), number(r.column))
                for i, (r, here) in enumerate(zip(ranges, inside))]
            part = df.filter(reduce(lambda a, b: a | b, inside))
            ranges = _asked(_bins(part, cells), [(r.column, r.before, r.total) for r in ranges],
                            shares)
    out: dict[str, list[float] | None] = {}
    for column in columns:
        if column not in totals:
            out[column] = None
            continue
        places = [share * (totals[column] - 1) for share in shares]
        values = found[column]
        out[column] = [
            values[math.floor(p)] + (values[math.ceil(p)] - values[math.floor(p)])
            * (p - math.floor(p)) for p in places]
    return out
