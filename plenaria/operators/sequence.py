"""Previous and next rows of a key, and global row numbers, without one task per hot key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from plenaria.session import checkpoint


def neighbour(df: DataFrame, keys: Sequence[str], order: Sequence[str], slot: Column,
              values: Mapping[str, str], direction: str = "previous") -> DataFrame:
    """Values of the previous (or next) row of the same key in ``order``.

    ``slot`` is a coarse step of the first order column such as its month. Rows are compared inside
    windows of one key and slot first, so a key with most of the rows spreads over its slots. What
    the first row of a slot needs is the last row of the key's slot before it: a second window holds
    only these edge rows of a key together, while every other row is a group of its own there. The
    input is read once and nothing runs before the result is asked for. ``order`` must be unique
    within a key. Rows without a key have no neighbour.
    """
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    near, opposite = (F.lag, F.lead) if direction == "previous" else (F.lead, F.lag)
    packed = F.struct(*[F.col(c).alias(out) for out, c in values.items()])
    inside = Window.partitionBy(*keys, "_slot").orderBy(*order)
    looked = df.withColumn("_slot", slot).select("*", near(packed, 1).over(inside).alias("_near"), opposite(F.lit(1), 1).over(inside).alias("_other"))
    edge = F.col("_near").isNull() | F.col("_other").isNull()
    dealt = looked.withColumn("_group", F.when(~edge, F.xxhash64(*order)))
    far = near(packed, 1).over(Window.partitionBy(*keys, "_group").orderBy(*order))
    found = F.when(known, F.coalesce(F.col("_near"), F.col("_far")))
    return dealt.withColumn("_far", far).select(*df.columns, *[found[out].alias(out) for out in values])


def surrogate_key(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Numbers 1..n in a total order, computed in parallel.

    The rows are range-partitioned and sorted, numbered inside each partition, and stored in the
    checkpoint folder. Adding the row counts of the earlier partitions gives the global number.
    Unique tie-breaks in ``order`` let the ranges split rows that share the leading value.
    """
    numbered = checkpoint(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_position", F.monotonically_increasing_id()))
    # the id holds the partition number above 33 bits of row position
    part = F.shiftright(F.col("_position"), 33)
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # one row per partition, so this unpartitioned window stays as small as the partition count
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    local = F.col("_position").bitwiseAND(F.lit((1 << 33) - 1))
    return (numbered.withColumn("_at", part).join(F.broadcast(offsets), F.col("_at") == F.col("_part"))
            .select((F.col("_offset") + local + 1).alias(name), *df.columns))


def dense_key(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Distinct values with a dense rank as key, in ascending order with NULL last."""
    order = [F.col(c).asc_nulls_last() for c in columns]
    return surrogate_key(df.select(*columns).distinct(), order, name)
