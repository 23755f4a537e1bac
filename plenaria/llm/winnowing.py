"""Document fingerprints by winnowing: rolling hashes of k code points, the smallest of each window."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.functions import pandas_udf

from plenaria.llm.common import slices, texts_of

GRAM, WINDOW = 12, 24
#: Odd, so it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
LOW = np.uint64(0xFFFFFFFF)
#: Code points that are hashed at once, text bytes of a range of ids, most ranges.
POINTS, RANGE_BYTES, MOST_RANGES = 1_000_000, 2_000_000, 10_000
FIRST = -(2**63)


def rolling(points: np.ndarray, k: int) -> np.ndarray:
    """32-bit hash of every run of k code points, from prefix sums of a polynomial modulo 2**64."""
    n = len(points)
    if n < k:
        return np.zeros(0, np.uint64)
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, BASE, np.uint64)]), dtype=np.uint64)
    inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, pow(BASE, -1, 2**64), np.uint64)]), dtype=np.uint64)
    prefix = np.concatenate([[np.uint64(0)], np.cumsum((points.astype(np.uint64) + np.uint64(1)) * powers, dtype=np.uint64)])
    mixed = (prefix[k:] - prefix[:-k]) * inverse[: n - k + 1]
    mixed ^= mixed >> np.uint64(33)
    mixed *= np.uint64(0xFF51AFD7ED558CCD)
    return mixed >> np.uint64(32)


def winnow(texts: list[str], k: int = GRAM, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and position of each selected gram, in text order.

    Of each window of w grams the smallest hash is selected, the rightmost of equals. So two texts that share
    w + k - 1 code points in a row share a selected gram. A text of fewer than w grams is one window, one of fewer
    than k code points is one gram (filled up with U+0000), and an empty one has none.
    """
    lengths = np.array([max(len(t), k) if t else 0 for t in texts], np.int64)
    points = np.frombuffer("".join(t.ljust(k, "\0") if t else "" for t in texts).encode("utf-32-le"), "<u4")
    hashes = rolling(points, k)
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
    key = (hashes << np.uint64(32)) | (LOW - np.arange(len(hashes), dtype=np.uint64))
    least, span = key, 1
    while span < w and len(least) > 1:
        step = min(span, w - span)
        if len(least) <= step:
            break
        least, span = np.minimum(least[:-step], least[step:]), span + step
    starts = np.cumsum(lengths) - lengths
    grams = np.where(lengths > 0, lengths - k + 1, 0)
    windows = np.where(grams > 0, np.maximum(grams - w + 1, 1), 0)
    owner = np.repeat(np.arange(len(texts)), windows)
    first = starts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    chosen = np.empty(len(owner), np.uint64)
    whole = (grams >= w)[owner]
    chosen[whole] = least[first[whole]]
    short = np.flatnonzero((grams > 0) & (grams < w))
    if len(short):
        ends = np.column_stack([starts[short], starts[short] + grams[short]]).ravel()
        chosen[~whole] = np.minimum.reduceat(np.append(key, np.uint64(2**64 - 1)), ends)[::2]
    at = (LOW - (chosen & LOW)).astype(np.int64)
    new = np.concatenate([[True], at[1:] != at[:-1]])
    return owner[new], (chosen[new] >> np.uint64(32)).astype(np.uint32), at[new] - starts[owner[new]]


def likeness(a: np.ndarray, a_hash: np.ndarray, b: np.ndarray, b_hash: np.ndarray, n: int) -> np.ndarray:
    """Shared part of the distinct hashes of text i on both sides (0 to 1); 1 if neither has any."""
    left, right = (np.unique((x.astype(np.uint64) << np.uint64(32)) | h) for x, h in ((a, a_hash), (b, b_hash)))
    count = lambda keys: np.bincount((keys >> np.uint64(32)).astype(np.int64), minlength=n)[:n]
    both = count(np.intersect1d(left, right, assume_unique=True))
    either = count(left) + count(right) - both
    return np.where(either > 0, both / np.maximum(either, 1), 1.0)


def written(owner: np.ndarray, hashes: np.ndarray, at: np.ndarray, n: int) -> list[str]:
    """Per text base64 of its selected grams: 4 bytes hash, 2 bytes distance from the gram before, little-endian."""
    gap = at.copy()
    same = owner[1:] == owner[:-1]
    gap[1:][same] = (at[1:] - at[:-1])[same]
    records = np.empty(len(owner), [("hash", "<u4"), ("gap", "<u2")])
    records["hash"], records["gap"] = hashes, gap
    raw, ends = records.tobytes(), np.cumsum(np.bincount(owner, minlength=n)) * records.itemsize
    return [base64.b64encode(raw[a:b]).decode() for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """doc_id, hashes and positions (arrays) of every row; null text is empty and has empty arrays."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for run in slices(rows, POINTS, lambda r: len(r[1])):
                owner, hashes, at = winnow([t for _, t in run], k, w)
                ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(run)))]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int64))) for x in (hashes, at)]
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in run], pa.int64()), *lists], ["doc_id", "hashes", "positions"])
    return texts_of(docs, doc_id, text).mapInArrow(task, "doc_id long, hashes array<long>, positions array<long>")


def edited_likeness(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """Each text's fingerprint, that of its edited text, and how alike they and the next document's are.

    The edited text has the last half of its code points replaced by the first as many of the next document's, in
    ascending id (null first; rows of one id by their text); after the last comes the first, so a single document
    is its own next. Null text is empty. Empty table: empty result. Repeated rows are rows of their own.

    Ids are cut into ranges at ids that occur. Each range is sorted in one task, which streams over it and also gets
    the first document of the next range; so texts are shuffled once and no task holds a range.
    """
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    rows = texts_of(docs, doc_id, text).withColumn("key", F.coalesce("doc_id", F.lit(FIRST)))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n"), F.min("key").alias("first")).first()
    if size.first is None:
        return docs.sparkSession.createDataFrame([], schema)
    ranges = int(min(MOST_RANGES, 1 + size.n // RANGE_BYTES))
    cuts = rows.agg(F.percentile_approx("key", [i / ranges for i in range(ranges)], 10 * MOST_RANGES).alias("cuts")).first().cuts
    bounds = np.unique(np.array([size.first, *cuts], np.int64))

    @pandas_udf("array<int>")
    def places(key: pd.Series) -> pd.Series:
        """Twice the range; and for the first id of a range, twice the range before and one."""
        keys = key.to_numpy()
        own = np.searchsorted(bounds, keys, "right") - 1
        starts = bounds[own] == keys
        return pd.Series([[2 * r, 2 * ((r - 1) % len(bounds)) + 1] if s else [2 * r] for r, s in zip(own.tolist(), starts.tolist(), strict=True)])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer, place = [], None

        def flush(following: str) -> pa.RecordBatch:
            texts = [t for _, t in buffer]
            after = [*texts[1:], following]
            n = len(texts)
            edited = [t[: len(t) - len(t) // 2] + u[: len(t) // 2] for t, u in zip(texts, after, strict=True)]
            owner, hashes, at = winnow([*texts, following], k, w)
            own = owner < n
            e_owner, e_hashes, e_at = winnow(edited, k, w)
            later = owner > 0
            columns = [
                pa.array([i for i, _ in buffer], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                pa.array(written(owner[own], hashes[own], at[own], n)), pa.array(written(e_owner, e_hashes, e_at, n)),
                pa.array(likeness(owner[own], hashes[own], e_owner, e_hashes, n)),
                pa.array(likeness(owner[own], hashes[own], owner[later] - 1, hashes[later], n)),
            ]
            return pa.RecordBatch.from_arrays(columns, schema=pa.schema([pa.field(c.split()[0], x.type) for c, x in zip(schema.split(", "), columns, strict=True)]))

        held = 0
        for batch in batches:
            for i, t, p in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "place")), strict=True):
                if p % 2:  # the first document of the next range; more rows of its id change nothing
                    if buffer:
                        yield flush(t)
                    buffer, held, place = [], 0, None
                    continue
                if place is not None and held > POINTS:
                    yield flush(t)
                    buffer, held = [], 0
                buffer.append((i, t))
                held, place = held + len(t), p

    placed = rows.select("doc_id", "key", "text", F.explode(places("key")).alias("place"))
    sorted_rows = placed.repartition(F.expr("place div 2")).sortWithinPartitions("place", "key", F.xxhash64("text"), "text")
    return sorted_rows.select("doc_id", "text", "place").mapInArrow(task, schema)
