"""Optional filters and cross-filters over a star."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F

ALL = None


def parametric(df: DataFrame, choices: Mapping[str, object]) -> DataFrame:
    """Filter by optional choices: None keeps all, a list keeps members, a pair of a range tuple
    keeps the closed range, any other value must be equal."""
    for column, choice in choices.items():
        if choice is ALL:
            continue
        if isinstance(choice, tuple):
            low, high = choice
            df = df.where(F.col(column).between(F.lit(low), F.lit(high)))
        elif isinstance(choice, (list, set, frozenset)):
            df = df.where(F.col(column).isin(sorted(choice)))
        else:
            df = df.where(F.col(column) == F.lit(choice))
    return df


def linked(df: DataFrame, key: str, selected: DataFrame, selected_key: str | None = None) -> DataFrame:
    """Rows whose key is among the selected rows of a linked table."""
    keys = selected.select(F.col(selected_key or key).alias("_key"))
    return df.join(keys, F.col(key) == F.col("_key"), "left_semi")


@dataclass(frozen=True)
class Star:
    """A fact, dimensions ``name -> (frame, dim key, fact key)`` and bridges ``name -> (frame,
    bridge key, fact key)``."""

    fact: DataFrame
    dims: Mapping[str, tuple[DataFrame, str, str]]
    bridges: Mapping[str, tuple[DataFrame, str, str]] = field(default_factory=dict)


def cross_filter(star: Star, filters: Mapping[str, Column]) -> Star:
    """Filter dimensions, keep facts whose keys survive in all, then trim every table to the facts.

    Only the filtered dimensions are joined; all joins are semi joins.
    """
    fact = star.fact
    for name, condition in filters.items():
        frame, key, fk = star.dims[name]
        fact = linked(fact, fk, frame.where(condition), key)
    dims = {}
    for name, (frame, key, fk) in star.dims.items():
        kept = frame.where(filters[name]) if name in filters else frame
        dims[name] = (linked(kept, key, fact, fk), key, fk)
    bridges = {name: (linked(frame, key, fact, fk), key, fk) for name, (frame, key, fk) in star.bridges.items()}
    return replace(star, fact=fact, dims=dims, bridges=bridges)


def capped_star(star: Star, order: Sequence[Column], cap: int | None, unknown: object = "-1") -> Star:
    """Newest ``cap`` facts (None = all) with each dimension trimmed to the keys used plus the
    unknown member."""
    fact = star.fact if cap is None else star.fact.orderBy(*order).limit(cap)
    dims = {}
    for name, (frame, key, fk) in star.dims.items():
        kind = frame.schema[key].dataType
        lone = frame.sparkSession.range(1).select(F.lit(unknown).cast(kind).alias("_key"))
        used = fact.select(F.col(fk).cast(kind).alias("_key")).unionByName(lone)
        dims[name] = (frame.join(used, F.col(key) == F.col("_key"), "left_semi"), key, fk)
    return replace(star, fact=fact, dims=dims)
