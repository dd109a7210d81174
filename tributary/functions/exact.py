"""Sums of doubles that do not depend on the order of addition.

A double is split without error into integers of fixed places: its whole part and four parts of 31 bits
each. Their sums are exact decimals, whatever the order, and what is subtracted again leaves nothing behind.
Bits below 2**-124 and values from 2**62 on, infinite or not a number are summed as doubles besides.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS, PLACES, LARGEST = 31, 4, float(1 << 62)
PART = 1 << BITS
PARTS = ("whole", *(f"p{k}" for k in range(1, PLACES + 1)), "rest")


def exact_parts(value: Column) -> list[Column]:
    """Columns named ``PARTS`` of a double; all NULL for NULL."""

    def truncated(place: int) -> Column:
        scaled = value * F.lit(float(1 << BITS * place))
        # From 2**53 on a double is whole.
        return F.when(F.abs(scaled) >= F.lit(float(1 << 53)), scaled).otherwise(scaled.try_cast("bigint").cast("double"))

    plain = F.abs(value) < F.lit(LARGEST)  # false for NaN, which is greater than all
    steps = [truncated(k) for k in range(PLACES + 1)]
    parts = [steps[0], *(steps[k] - steps[k - 1] * F.lit(float(PART)) for k in range(1, PLACES + 1))]
    whole = [F.when(plain, p).when(value.isNotNull(), F.lit(0.0)).cast("bigint").cast("decimal(20,0)") for p in parts]
    rest = F.when(plain, value - steps[-1] * F.lit(2.0 ** (-BITS * PLACES))).otherwise(value)
    return [c.alias(name) for name, c in zip(PARTS, [*whole, rest])]


def exact_total(sums: Mapping[str, Column]) -> Column:
    """The double next to a number given by the sums of its ``PARTS``, the same bits for the same number."""
    pair = F.lit(PART).cast("decimal(20,0)") * F.lit(PART).cast("decimal(18,0)")  # 62 bits

    def decimal(column: Column) -> Column:
        return column.cast("decimal(38,0)")

    def both(high: str, low: str) -> Column:
        return decimal(decimal(sums[high]) * F.lit(PART).cast("decimal(10,0)") + decimal(sums[low]))

    def carried(total: Column) -> tuple[Column, Column]:
        left = F.pmod(total, decimal(pair))
        return left, decimal((total - left) / decimal(pair))

    low, carry = carried(both("p3", "p4"))
    high, carry = carried(decimal(both("p1", "p2") + carry))
    whole = decimal(sums["whole"]) + carry
    # A negative number is taken from its amount, so that a small one keeps its digits.
    borrowed = (low > 0).cast("int").cast("decimal(1,0)")
    amount = _double(-whole - 1, decimal(pair) - high - borrowed, F.when(low > 0, decimal(pair) - low).otherwise(decimal(F.lit(0))))
    exact = F.when(whole < 0, -amount).otherwise(_double(whole, high, low))
    return F.when(sums["rest"] == 0, exact).otherwise(exact + sums["rest"])


def _double(whole: Column, high: Column, low: Column) -> Column:
    return whole.cast("double") + (high.cast("double") * F.lit(2.0**-62) + low.cast("double") * F.lit(2.0**-124))


def exact_sum(value: Column) -> Column:
    """An aggregate: the sum of a double column in any order of its rows; NULL without values."""
    return exact_total({name: F.sum(part) for name, part in zip(PARTS, exact_parts(value))})
