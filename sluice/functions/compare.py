"""Comparisons of hard rules and the tolerance test of soft ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The comparisons that a rule may ask for.
OPS = ("eq", "le", "ge")


def compare(op: str, observed: Column, value) -> Column:
    """Whether ``observed`` stands to ``value`` as a rule's ``op`` demands."""
    if op == "eq":
        return observed == F.lit(value)
    if op == "le":
        return observed <= F.lit(value)
    if op == "ge":
        return observed >= F.lit(value)
    raise ValueError(f"a rule can't compare by {op!r}, only by {', '.join(OPS)}")


def within_tolerance(observed: Column, expected: float, tolerance: float) -> Column:
    return F.abs(observed - F.lit(float(expected))) <= F.lit(float(tolerance))


def round_cents(x: Column) -> Column:
    """Round to 2 decimals, half-to-even (banker's rounding, like numpy)."""
    return F.bround(x, 2)
