"""Importance resampling towards a target: hashed word runs weigh documents, exponential noise draws them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plenaria.llm.common import column, slices, stored, texts_of
from plenaria.operators.sequence import surrogate_key

BUCKETS, LONGEST_RUN, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024
#: Code points of texts whose distinct features are hashed at once.
POINTS = 2_000_000
#: Lower-cases A-Z and makes every other ASCII character but digits and letters a space. In UTF-8 all bytes of other
#: characters are above 127, so the same table serves whole encoded texts.
CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
POLYNOMIAL = 0xEDB88320


def crc_table() -> np.ndarray:
    """What each byte value does to a CRC-32."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    return table


TABLE = crc_table()


def crcs(features: pa.BinaryArray) -> np.ndarray:
    """CRC-32 of every value, from one matrix of bytes per length, whose CRCs advance together column by column."""
    offsets = np.frombuffer(features.buffers()[1], np.int32)[features.offset : features.offset + len(features) + 1].astype(np.int64)
    data = np.frombuffer(features.buffers()[2] or b"", np.uint8)
    starts, lengths = offsets[:-1], np.diff(offsets)
    out = np.empty(len(features), np.uint32)
    order = np.argsort(lengths, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else []:
        length = int(lengths[rows[0]])
        matrix = data[starts[rows][:, None] + np.arange(length)]
        crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        for at in range(length):
            crc = TABLE[(crc ^ matrix[:, at]) & np.uint32(255)] ^ (crc >> np.uint32(8))
        out[rows] = ~crc
    return out


def words(text: str) -> list[bytes]:
    """Runs of a-z (A-Z lower-cased), digits and characters beyond ASCII, in UTF-8."""
    return text.encode().translate(CLEAN).split()


def runs(found: list[bytes], longest: int) -> list[bytes]:
    """All runs of 1 to ``longest`` consecutive words, joined by one space."""
    out = list(found)
    for size in range(2, longest + 1):
        out += [b" ".join(found[k : k + size]) for k in range(len(found) - size + 1)]
    return out


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> DataFrame:
    """doc_id, n_words, n_features and the features' buckets (little-endian unsigned 32-bit numbers) of every row.

    Each batch is encoded to its distinct features, so a feature is hashed once per batch; its bucket is then scattered
    to all places where it stands. Null text has no words.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for run in slices(rows, POINTS, lambda r: len(r[1])):
                counts, met = [], []
                for _, t in run:
                    found = words(t)
                    own = runs(found, longest) if longest > 1 else found
                    counts.append((len(found), len(own)))
                    met += own
                coded = pa.array(met, pa.binary()).dictionary_encode()
                of = (crcs(coded.dictionary) % np.uint32(buckets)).astype("<u4")[coded.indices.to_numpy()]
                raw, ends = of.tobytes(), 4 * np.cumsum([n for _, n in counts])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _ in run], pa.int64()), pa.array([n for n, _ in counts], pa.int64()), pa.array([n for _, n in counts], pa.int64()),
                     pa.array([raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)], pa.binary())],
                    ["doc_id", "n_words", "n_features", "buckets"])
    return texts_of(docs, doc_id, text).mapInArrow(task, "doc_id long, n_words long, n_features long, buckets binary")


def numbers(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All rows' buckets one after the other, and where each row's begin and end among them."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] // 4
    flat = np.frombuffer(column.buffers()[2] or b"", "<u4")
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def totals(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all rows: tasks count, ``buckets`` sums at most reach the driver."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            if batch.num_rows:
                counts += np.bincount(numbers(batch.column(0))[0], minlength=buckets)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(counts[met])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in found.select("buckets").mapInArrow(task, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket 1000 times the logarithm of how much likelier it is in the target, both smoothed by one; rounded down."""
    s, t, n = source.astype(float), target.astype(float), len(source)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weights(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight: the sum of its features' gains, 0 without features."""
    shared = found.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat, ends = numbers(batch.column(3))
            upto = np.concatenate([[0], np.cumsum(shared.value[flat])])[ends]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(upto))], ["doc_id", "n_words", "n_features", "weight"])
    return found.select("doc_id", "n_words", "n_features", "buckets").mapInArrow(task, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """1000 times a Gumbel draw that depends on the id and the seed alone, rounded down; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(uniform))).cast("long")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", buckets: int = BUCKETS,
             longest: int = LONGEST_RUN, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row; ranked are the rows drawn without replacement.

    Score is the weight plus noise, and the highest scores of the rows with ``least_words`` words are drawn: ``percent``
    percent of them, rounded down. Ties go to the smaller id (null last), then to the earlier row.

    Null text has no features and weight 0; repeated rows are rows of their own; an empty table gives an empty result;
    an empty target weighs by the documents alone; other columns are left out and may have any name.

    Texts are read once: their buckets are stored and both passes (counting and weighing) read those. The rank comes
    from a range partition with offsets.
    """
    found = stored(features(docs, doc_id, text, buckets, longest))
    aimed = features(target.select(F.lit(0).alias("_id"), column(target_text).alias("_text")), "_id", "_text", buckets, longest)
    weighed = weights(found, gains(totals(found, buckets), totals(aimed, buckets)))
    scored = stored(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumn("fits", F.col("n_words") >= least_words)
                    .drop("n_words")).withColumn("_row", F.monotonically_increasing_id())
    drawn = scored.where("fits").count() * percent // 100
    order = [F.col("fits").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    place = F.when(F.col("fits") & (F.col("_place") <= drawn), F.col("_place")).cast("long")
    return surrogate_key(scored, order, "_place").select("doc_id", "n_features", "weight", "score", place.alias("rank"))
