"""Reference resolution and set-style joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def resolve_fk(df: DataFrame, fk: str, parent: DataFrame, pk: str = "id", mode: str = "null",
               unique: bool = True) -> DataFrame:
    """Check a reference against its parent table.

    ``null``: keep the row, empty the reference when the parent is missing.
    ``drop``: keep only rows whose reference exists.
    ``drop_given``: like ``drop``, but rows without a reference stay.
    ``unique=False`` first reduces the parent keys to distinct ones.
    """
    keys = parent.select(F.col(pk).alias("_parent")).where(F.col("_parent").isNotNull())
    if mode == "drop":
        return df.join(keys, F.col(fk) == F.col("_parent"), "left_semi")
    if not unique:
        keys = keys.distinct()
    joined = df.join(keys, F.col(fk) == F.col("_parent"), "left")
    if mode == "drop_given":
        return joined.where(F.col(fk).isNull() | F.col("_parent").isNotNull()).drop("_parent")
    if mode != "null":
        raise ValueError(f"unknown mode {mode!r}")
    # the joined key is the reference itself where the parent exists, NULL elsewhere
    return joined.select(*[F.col("_parent").alias(c) if c == fk else F.col(c) for c in df.columns])


def null_safe_join(left: DataFrame, right: DataFrame, keys: Mapping[str, str] | Sequence[str],
                   how: str = "left") -> DataFrame:
    """Join where NULL equals NULL; the key columns of ``right`` are dropped."""
    pairs = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in pairs.values() else F.col(c) for c in right.columns])
    condition = None
    for l, r in pairs.items():
        same = F.col(l).eqNullSafe(F.col(f"_r_{r}"))
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"_r_{r}" for r in pairs.values()])


def semi_any(df: DataFrame, key: str, *sets: DataFrame) -> DataFrame:
    """Rows whose key is in at least one of the one-column sets."""
    union = None
    for keys in sets:
        one = keys.select(F.col(keys.columns[0]).alias("_key"))
        union = one if union is None else union.unionByName(one)
    return df.join(union, F.col(key) == F.col("_key"), "left_semi")


def not_in(df: DataFrame, key: str, keys: DataFrame, null_rule: str = "ignore") -> DataFrame:
    """Anti join. ``sql`` applies NOT IN: a NULL in the set, or an empty key, gives no row."""
    column = F.col(keys.columns[0])
    wanted = keys.select(column.alias("_key"))
    kept = df.join(wanted.where(F.col("_key").isNotNull()), F.col(key) == F.col("_key"), "left_anti")
    if null_rule == "sql":
        has_null = wanted.select(F.coalesce(F.max(F.col("_key").isNull()), F.lit(False)).alias("_n"))
        is_empty = wanted.select((F.count(F.lit(1)) == 0).alias("_e"))
        kept = kept.where(~has_null.scalar() & (F.col(key).isNotNull() | is_empty.scalar()))
    return kept


def lookup(df: DataFrame, key: str, dim: DataFrame, dim_key: str, label: str, out: str,
           default: str | None = None) -> DataFrame:
    """Left join one label from a dimension with unique keys; missing labels become ``default``."""
    labels = dim.select(F.col(dim_key).alias("_dim_key"), F.col(label).alias("_label"))
    value = F.col("_label") if default is None else F.coalesce(F.col("_label"), F.lit(default))
    return df.join(labels, F.col(key) == F.col("_dim_key"), "left").select(*df.columns, value.alias(out))


def full_outer_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join of two aggregates on one key; missing measures become 0."""
    joined = left.join(right, key, "full")
    return joined.select(key, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in joined.columns if c != key])


def changed_columns(left: str, right: str, columns: Sequence[str]) -> Column:
    """True when any column differs between two aliases, NULL counting as a value."""
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return differs
