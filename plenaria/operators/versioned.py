"""Current rows out of an append-only version log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_version(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``.

    ``row_number() = 1`` becomes a group limit that already runs before the shuffle, so each map
    task sends at most one row per key and a hot key stays small.
    """
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def feed_order(changed: str = "bijgewerkt", fed: str = "feed_updated", row_id: str = "_row_id") -> list[Column]:
    """Newest first by source change time, then feed time, then row id."""
    return [F.col(changed).desc_nulls_last(), F.col(fed).desc_nulls_last(), F.col(row_id).desc_nulls_last()]


def drop_deleted(df: DataFrame, flag: str = "verwijderd") -> DataFrame:
    """Keep rows whose flag is false; an empty flag counts as deleted.

    Run it on the latest versions only, or an older live version comes back.
    """
    return df.where(~F.col(flag))


def apply_corrections(df: DataFrame, corrections: DataFrame, key: str, columns: Sequence[str],
                      flag: str = "handmatig_aangevuld") -> DataFrame:
    """Fill empty values from a corrections table (one row per key) and flag corrected keys."""
    fixes = corrections.select(
        F.col(key).alias("_fix_key"), *[F.col(c).alias(f"_fix_{c}") for c in columns])
    joined = df.join(fixes, df[key] == fixes["_fix_key"], "left")
    return joined.select(
        *[F.coalesce(F.col(c), F.col(f"_fix_{c}")).alias(c) if c in columns else F.col(c) for c in df.columns],
        F.col("_fix_key").isNotNull().alias(flag))
