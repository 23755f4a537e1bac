"""Resumable feed load and a continuously maintained current table."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from plenaria.operators.versioned import latest_version
from plenaria.session import checkpoint
from plenaria.sources import checked, feed, pages


#: Bytes of landed pages in a batch. A batch has a cost of its own, so a batch of few small pages is mostly that.
BATCH_BYTES = 1 << 30


def stream_feed(spark: SparkSession, path: str, log: str, checkpoint_path: str, category: str | None = None,
                pages_per_batch: int | None = None, strict: bool = True, entities: Sequence[str] | None = None,
                xsd: Mapping[str, str] | None = None, load_id: str | None = None) -> StreamingQuery:
    """Load all landed pages not seen before into the version log, then stop.

    The stream's checkpoint is the cursor; the file sink commits each batch once. Use one
    checkpoint per category. ``strict`` ends the load at the first page that does not decode.
    Otherwise entries are checked one by one (see ``checked.checked``, also for ``xsd``), and
    rejected ones stand in the log's own table for them, written in the same step as the good
    ones; there ``category`` keeps the rejected entries whose category cannot be told too.
    Each run has a load id of its own. A batch holds pages of ``BATCH_BYTES``, or ``pages_per_batch`` of them.
    """
    load = load_id or uuid.uuid4().hex
    reader = spark.readStream.option("maxBytesPerTrigger", BATCH_BYTES) if pages_per_batch is None else spark.readStream.option("maxFilesPerTrigger", pages_per_batch)
    if strict:
        rows = feed.entries(feed.decoded(reader, path, entities, True))
        rows = rows.withColumn("_row_id", feed.row_id(rows)).withColumn("_load_id", F.lit(load))
    else:
        rows = checked.log_rows(checked.checked(checked.split_pages(checked.page_texts(reader, path)), entities, xsd), load)
    if category is not None:
        rows = rows.where((F.col("category") == category) | ((F.col("tabel") == checked.REJECTED) & (F.col("category") == "unknown")))
    return (rows.writeStream.format("parquet").option("path", log).option("checkpointLocation", checkpoint_path)
            .partitionBy("tabel").trigger(availableNow=True).start())


def stream_source(spark: SparkSession, options: Mapping[str, str], log: str, checkpoint_path: str,
                  entities: Sequence[str] | None = None, xsd: Mapping[str, str] | None = None, load_id: str | None = None) -> StreamingQuery:
    """Load the next pages of a feed by address into the version log, then stop.

    ``options`` are those of the ``feed_pages`` format; ``pages`` bounds the run. The offset in the
    checkpoint holds each category's onward token, so the next run goes on from there. Entries are
    checked one by one like in ``stream_feed``.
    """
    pages.register(spark)
    texts = spark.readStream.format("feed_pages").options(**options).load().select("path", "page")
    rows = checked.log_rows(checked.checked(checked.split_pages(texts), entities, xsd), load_id or uuid.uuid4().hex)
    return (rows.writeStream.format("parquet").option("path", log).option("checkpointLocation", checkpoint_path)
            .partitionBy("tabel").trigger(once=True).start())


def stream_append(spark: SparkSession, path: str, schema: T.StructType, sink: str, checkpoint_path: str,
                  files_per_batch: int = 1) -> StreamingQuery:
    """Append landed Parquet files to a sink exactly once, then stop."""
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return (source.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True).start())


#: Parts of a streamed table; a batch rewrites only those that its keys fall into.
BUCKETS = 64
_COMMITS = "volgnummer bigint, stroom string, batch bigint, poging string, emmer int"


def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _committed(spark: SparkSession, root: str) -> DataFrame | None:
    """One row per commit and bucket that it wrote; None when nothing is committed yet."""
    try:
        return spark.read.schema(_COMMITS).parquet(f"{root}/commits")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def current_version(spark: SparkSession, root: str, before: int | None = None, only: Sequence[int] | None = None) -> DataFrame | None:
    """Newest row per key of a streamed table. ``before`` looks at it as it was before a commit, numbered from 0.

    Each bucket, or each of ``only`` these, is read from the last commit that wrote it. None when
    nothing is committed yet.
    """
    commits = _committed(spark, root)
    if commits is None:
        return None
    seen = commits if before is None else commits.where(F.col("volgnummer") < before)
    if seen.isEmpty():
        return None
    # as many rows as there are buckets
    newest = seen.groupBy("emmer").agg(F.max_by("poging", "volgnummer").alias("poging"))
    files = spark.read.parquet(f"{root}/data")
    chosen = files if only is None else files.where(F.col("emmer").isin(list(only)))
    return chosen.join(F.broadcast(newest), ["emmer", "poging"], "left_semi").drop("emmer", "poging")


def stream_latest(spark: SparkSession, source: DataFrame, root: str, checkpoint_path: str, key: Sequence[str],
                  order: Sequence[str], buckets: int = BUCKETS, repeats_within: str | None = None) -> StreamingQuery:
    """Keep the newest version per key of a stream, whatever order the versions arrive in.

    The table is cut into buckets by a hash of the key. A batch is reduced to its newest row per key
    and merged with the buckets that these keys fall into; only those are written, to a folder of
    this attempt, and a commit row per bucket then makes them visible at once. So a batch costs what
    its buckets cost, readers never see half a batch, and nothing that they read is overwritten. A
    batch that runs again after its commit does nothing; a stream is known by its checkpoint, and a
    table has one writer at a time. Late older versions never replace newer ones.

    ``repeats_within`` (such as ``2 hours``) drops versions that arrive again within that time, by
    watermarked state on key and order; the watermark is the time of arrival, so a late version is
    not lost. ``buckets`` must stay the same for a table; choose it so that one fits in a task.
    """
    newest_first: list[Column] = [F.col(c).desc_nulls_last() for c in order]
    stream = hashlib.md5(checkpoint_path.encode()).hexdigest()

    def apply(batch: DataFrame, number: int) -> None:
        session, commits = batch.sparkSession, _committed(batch.sparkSession, root)
        place = 0
        if commits is not None:
            seen = commits.agg(F.max("volgnummer").alias("last"), F.count(F.when((F.col("stroom") == stream) & (F.col("batch") == number), 1)).alias("same")).first()
            if seen["same"]:
                return
            place = seen["last"] + 1
        fresh = checkpoint(latest_version(batch, key, newest_first).withColumn("emmer", _bucket(key, buckets)))
        # at most as many numbers as there are buckets
        touched = [r[0] for r in fresh.select("emmer").distinct().collect()]
        if not touched:
            return
        earlier = current_version(session, root, only=touched)
        if earlier is not None:
            fresh = latest_version(earlier.withColumn("emmer", _bucket(key, buckets)).unionByName(fresh), key, newest_first)
        attempt = f"p{uuid.uuid4().hex}"
        fresh.repartition("emmer").withColumn("poging", F.lit(attempt)).write.mode("append").partitionBy("emmer", "poging").parquet(f"{root}/data")
        session.createDataFrame([(place, stream, number, attempt, e) for e in touched], _COMMITS).coalesce(1).write.mode("append").parquet(f"{root}/commits")

    if repeats_within:
        source = (source.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", repeats_within)
                  .dropDuplicatesWithinWatermark([*key, *order]).drop("_arrived"))
    return (source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True).start())
