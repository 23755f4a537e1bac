"""Repeatable samples by key hash, the same in every engine that has MD5."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def one_in(df: DataFrame, key: Column, n: int) -> DataFrame:
    """Keep the keys whose hash (the first 8 hex digits of the MD5 of their text) falls in the first of ``n`` classes."""
    prefix = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return df.where(prefix % n == 0)


def seeded(seed: int, *keys: Column) -> Column:
    """MD5 of a seed and the texts of keys, for a random order that repeats."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def smallest_hashes(df: DataFrame, key: Column, n: int, seed: int = 0) -> DataFrame:
    """The ``n`` rows with the smallest seeded key hash: a repeatable random sample."""
    return df.orderBy(seeded(seed, key), key).limit(n)


def distinct_sample(df: DataFrame, columns: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` distinct value combinations, picked by seeded hash, for review by hand."""
    unique = df.select(*columns).distinct()
    return unique.orderBy(seeded(seed, *[F.col(c) for c in columns]), *columns).limit(n)
