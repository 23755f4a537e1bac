"""How often two items meet in the same group."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, functions as F

from plenaria.session import stored

#: Items of a group that are paired in one place; a larger group is cut into parts of about this size.
PART_ITEMS = 256
#: Pairs that a task expands, and different ones that it counts, where the session's number of tasks would have more.
PAIRS_A_TASK = 1_000_000


def co_occurrence(df: DataFrame, group: str, item: str, sign: str | None = None, least: int = 1, part_items: int = PART_ITEMS,
                  pairs_a_task: int = PAIRS_A_TASK) -> DataFrame:
    """Columns ``a, b, samen[, gelijk]`` for items ``a < b`` that share at least ``least`` groups.

    ``samen`` counts shared groups. With ``sign`` (+1 or -1, one per group and item) ``gelijk`` counts the groups in
    which both signs agree. Repeated rows count once; rows without group or item are left out. The number of items and
    the size of a group have no limit.

    The items of a group are dealt into parts by a hash, and each pair of parts is a row of its own that holds at most
    about ``2 * part_items`` items; pairs are expanded from there and summed in their task before the shuffle. So a
    group that holds a third of all rows spreads over all tasks. Items in fewer than ``least`` groups go first, since
    no pair of theirs can reach it.

    The rows that are left are stored, and the pairs in them told from the groups' sizes. The tasks that expand and
    count pairs grow in number with them, so what one of them holds does not grow with the input.
    """
    spark = df.sparkSession
    base = (df.select(F.col(group).alias("_g"), F.col(item).alias("_i"), (F.lit(1) if sign is None else F.col(sign)).cast("int").alias("_s"))
            .where("_g IS NOT NULL AND _i IS NOT NULL").groupBy("_g", "_i").agg(F.max("_s").alias("_s")))
    if least > 1:
        frequent = base.groupBy("_i").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
        base = base.join(frequent.select("_i"), "_i", "left_semi")
    base = stored(base)
    sizes = base.groupBy("_g").agg(F.ceil(F.count(F.lit(1)) / part_items).cast("int").alias("_parts"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    size = F.col("_n").cast("double")
    pairs = sizes.agg(F.sum(size * (size - 1) / 2)).first()[0] or 0.0
    # the number of items sets how many different pairs there can be; it only decides the number of tasks
    items = base.agg(F.approx_count_distinct("_i")).first()[0]
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    expanding, counting = ceil(pairs / pairs_a_task), ceil(min(pairs, items * items / 2) / pairs_a_task)
    dealt = base.join(sizes.select("_g", "_parts"), "_g").select(
        "_g", F.struct("_i", "_s").alias("_x"), F.pmod(F.xxhash64("_i"), F.col("_parts")).cast("int").alias("_part"),
        F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_other"))
    lower = F.col("_part") <= F.col("_other")
    dealt = dealt.select("_g", F.least("_part", "_other").alias("_lo"), F.greatest("_part", "_other").alias("_hi"), "_x", lower.alias("_lower"))
    lower = F.col("_lower")
    if expanding > usual:
        dealt = dealt.repartition(expanding, "_g", "_lo", "_hi")
    cells = dealt.groupBy("_g", "_lo", "_hi").agg(
        F.sort_array(F.collect_list(F.when(lower, F.col("_x")))).alias("_left"), F.collect_list(F.when(~lower, F.col("_x"))).alias("_right"))
    # inside one part a pair is an item and one after it in order; across two parts it is one item of each
    first = cells.select("*", F.posexplode("_left").alias("_at", "_x"))
    others = F.when(F.col("_lo") == F.col("_hi"), F.slice("_left", F.col("_at") + 2, F.size("_left"))).otherwise(F.col("_right"))
    both = first.select("_x", F.explode(others).alias("_y")).select(
        F.least("_x._i", "_y._i").alias("a"), F.greatest("_x._i", "_y._i").alias("b"), (F.col("_x._s") == F.col("_y._s")).alias("_same"))
    if counting > usual:
        both = both.repartition(counting, "a", "b")
    counted = both.groupBy("a", "b").agg(F.count(F.lit(1)).alias("samen"), F.count(F.when(F.col("_same"), 1)).alias("gelijk"))
    kept = counted.where(F.col("samen") >= least) if least > 1 else counted
    return kept.drop("gelijk") if sign is None else kept
