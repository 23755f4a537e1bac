"""Small numeric expressions with a fixed result type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def percentage(part: Column, total: Column, digits: int = 1) -> Column:
    """Share in percent as a double; NULL when the total is zero."""
    return F.round(part.cast("double") * 100.0 / F.nullif(total.cast("double"), F.lit(0.0)), digits)


def ratio(part: Column, total: Column, digits: int | None = None) -> Column:
    value = part.cast("double") / F.nullif(total.cast("double"), F.lit(0.0))
    return value if digits is None else F.round(value, digits)


def exact_sum(value: Column, scale: int = 2) -> Column:
    """Sum of doubles in decimal arithmetic, so the result does not depend on row order."""
    return F.sum(value.cast(f"decimal(24,{scale})")).cast("double")


def exact_mean(value: Column, scale: int = 2, digits: int = 4) -> Column:
    return F.round(exact_sum(value, scale) / F.count(value), digits)


def fixed_bin(value: Column, width: float) -> Column:
    """Lower edge of the fixed-width bin."""
    return F.floor(value / width) * width


def cut(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(edge, next edge]``; values outside get NULL."""
    result = None
    for low, high, label in zip(edges, edges[1:], labels):
        hit = (value > low) & (value <= high)
        result = F.when(hit, F.lit(label)) if result is None else result.when(hit, F.lit(label))
    return result


def annualise(amount: Column, frequency: Column, factors: dict[str, int]) -> Column:
    """Yearly amount: the first keyword found in the frequency text gives the factor, else 1."""
    factor = None
    for word, times in factors.items():
        hit = F.contains(F.lower(frequency), F.lit(word))
        factor = F.when(hit, times) if factor is None else factor.when(hit, times)
    return amount * factor.otherwise(1)
