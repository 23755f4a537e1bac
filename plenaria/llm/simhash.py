"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked within a small bit distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from plenaria.llm.common import checkpoint, column, texts_of
from plenaria.operators.graph import connected_components

SHINGLE, RADIUS, SEED = 3, 2, 42
#: Fingerprints on each side of a comparison in one task, and lanes of a bit-sliced block.
CELL, LANES = 256, 4096
#: How many of the eight bits are set at each place of a byte, by the byte's value.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text: bit i is set if over half of the shingles' hashes have it.

    A-Z are lower-cased, words end at ASCII white space, shingles are counted as often as they occur. Fewer words
    than a shingle are one shingle; no words give zero.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(octets[:, i], minlength=256) @ BITS for i in range(8)])
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def digest(text: Column) -> Column:
    """Hash of a text that tells rows of one id apart; null text counts as empty."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, digest and fingerprint (long, bits of the unsigned number) of every row; null text counts as empty."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found.view(np.int64))], ["doc_id", "digest", "fingerprint"])
    return texts_of(docs, doc_id, text).withColumn("digest", digest(F.col("text"))).mapInArrow(task, "doc_id long, digest long, fingerprint long")


def planes(values: np.ndarray) -> list[int]:
    """Vertical bit planes: number i holds bit i of all values, the first value lowest."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return [int.from_bytes(row.tobytes(), "little") for row in np.packbits(bits.T, axis=1, bitorder="little")]


def mask(flags: np.ndarray) -> int:
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def lanes(value: int, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(value.to_bytes((n + 7) // 8, "little"), np.uint8), bitorder="little")[:n])


def within(vertical: list[int], step: int, wanted: int, radius: int) -> int:
    """The wanted lanes whose value and the value ``step`` lanes on differ in at most ``radius`` bits.

    All lanes' distances grow at once: each plane's difference is added to bit-sliced counters with carries. When no
    wanted lane is left within the radius, the block is abandoned.
    """
    counters, alive = [0] * radius.bit_length(), wanted
    for i, plane in enumerate(vertical):
        carry = (plane ^ (plane >> step)) & alive
        for j, counter in enumerate(counters):
            counters[j], carry = counter ^ carry, counter & carry
        alive &= ~carry
        if i % 4 == 3 or i == len(vertical) - 1:
            above, equal = 0, alive
            for j in reversed(range(len(counters))):
                if radius >> j & 1:
                    equal &= counters[j]
                else:
                    above |= equal & counters[j]
                    equal &= ~counters[j]
            alive &= ~above
            if not alive:
                return 0
    return alive


def forest(values: np.ndarray, group: np.ndarray, radius: int) -> np.ndarray:
    """For each value the number of the least value of its group that links reach; groups are runs of rows."""
    n, label, vertical = len(values), np.arange(len(values)), planes(values)
    longest = int(np.bincount(group - group[0]).max())
    for step in range(1, longest):
        same = np.zeros(n, bool)
        same[:-step] = group[:-step] == group[step:]
        at = lanes(within(vertical, step, mask(same), radius), n)
        a, b = at, at + step
        while (apart := label[a] != label[b]).any():
            a, b = a[apart], b[apart]
            least = np.minimum(label[a], label[b])
            np.minimum.at(label, label[a], least)
            np.minimum.at(label, label[b], least)
            while (label != (label := label[label])).any():
                pass
    return label


def links_of(values: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between values of a group, enough to connect what all its links connect.

    Groups are taken together by size class, so that a block's lanes are all in use, in blocks of whole groups.
    """
    sizes = np.unique(group, return_counts=True)[1]
    kind = np.repeat(np.ceil(np.log2(sizes)).astype(int), sizes)
    left, right = [], []
    for c in np.unique(kind[kind > 0]):
        rows, of = values[kind == c], group[kind == c]
        starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        ends = np.append(starts, len(rows))
        cuts = [0, *ends[np.searchsorted(ends, np.arange(LANES, len(rows), LANES))], len(rows)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a < b:
                label = forest(rows[a:b], of[a:b], radius)
                linked = np.flatnonzero(label != np.arange(b - a))
                left.append(rows[a:b][linked])
                right.append(rows[a:b][label[linked]])
    none = [np.zeros(0, values.dtype)]
    return np.concatenate(none + left), np.concatenate(none + right)


def block_keys(fingerprint: Column, radius: int) -> Column:
    """Two fingerprints within the radius agree on two of radius + 2 blocks of bits, so they share one of these keys."""
    edges = [64 * i // (radius + 2) for i in range(radius + 3)]
    blocks = [F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:], strict=False)]
    return F.array(*(F.struct(F.lit(i).alias("pair"), a.alias("x"), b.alias("y")) for i, (a, b) in enumerate(combinations(blocks, 2))))


def distinct_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect whatever all links within the radius connect.

    Fingerprints meet by equal blocks. A bucket of more than CELL of them is cut into parts, and each pair of parts
    is compared in a group of its own, so no group grows with a bucket.
    """
    keyed = distinct.select("fingerprint", F.explode(block_keys(F.col("fingerprint"), radius)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / CELL).cast("int")
    member = keyed.join(sizes, "key").select("key", "fingerprint", parts.alias("parts"), F.pmod(F.xxhash64("fingerprint", "key.pair"), parts).cast("int").alias("part"))
    others = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(F.array_except(F.sequence(F.lit(0), F.col("parts") - 1), F.array("part")))
    cells = member.select("key", "fingerprint", "part", F.explode(others).alias("other"))
    cells = cells.select("fingerprint", F.struct("key", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi")).alias("cell"))
    placed = cells.select(F.xxhash64("cell").alias("place"), "cell", "fingerprint").repartition("place").sortWithinPartitions("place", "cell", "fingerprint")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(values: np.ndarray, group: np.ndarray) -> pa.RecordBatch:
            a, b = links_of(values.view(np.uint64), group, radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        values, group = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            values = np.concatenate([values, batch.column(1).to_numpy()])
            group = np.concatenate([group, batch.column(0).to_numpy()])
            whole = int(np.flatnonzero(group == group[-1])[0]) if len(group) else 0
            if whole:
                yield linked(values[:whole], run_numbers(group[:whole]))
                values, group = values[whole:], group[whole:]
        if len(values):
            yield linked(values, run_numbers(group))

    # the place is a hash of the cell: cells that share one are compared too, which finds no link that is not there
    return placed.select("place", "fingerprint").mapInArrow(task, "a long, b long").distinct()


def run_numbers(keys: np.ndarray) -> np.ndarray:
    """Number of the run of equal keys that each row is in."""
    return np.cumsum(np.concatenate([[0], keys[1:] != keys[:-1]]))


def grouped(docs: DataFrame, doc_id: str, text: str, shingle: int, radius: int) -> DataFrame:
    """doc_id, digest, fingerprint, component_id and root, the component's smallest fingerprint, of every row."""
    signed = checkpoint(signatures(docs, doc_id, text, shingle))
    distinct = checkpoint(signed.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    links = checkpoint(distinct_links(distinct, radius))
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    reached = connected_components(nodes, links).join(distinct, F.col("node") == F.col("fingerprint"))
    least = reached.groupBy("component").agg(F.min("least").alias("smallest"))
    linked = reached.select("fingerprint", "component").join(least, "component").select("fingerprint", "component", "smallest")
    classes = distinct.join(linked, "fingerprint", "left").select("fingerprint", F.coalesce("smallest", "least").alias("component_id"), F.coalesce("component", "fingerprint").alias("root"))
    return signed.join(classes, "fingerprint").select("doc_id", "digest", "fingerprint", "component_id", "root")


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (long) and component_id, the smallest doc_id that links reach, of every row.

    Rows of equal fingerprint are linked, the empty texts' zero included, so copies are compared once. Null text is
    empty; a null doc_id is never a component's id unless all its rows have none. Repeated rows come back as often.
    Empty table: empty result.
    """
    return grouped(docs, doc_id, text, shingle, radius).select("doc_id", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component, the one of the smallest id and, of that, text digest, with all its columns.

    Documents are told by id and digest, so texts of different components stay though they share an id; rows equal in
    both are one document. Rows without an id stay, since nothing tells which of them another row stands for.
    """
    found = checkpoint(grouped(docs, doc_id, text, shingle, radius).where("doc_id IS NOT NULL").groupBy("root", "doc_id", "digest").agg(F.count(F.lit(1)).alias("n")))
    place = F.struct("doc_id", "digest")
    kept = found.groupBy("root").agg(F.min(place).alias("kept"))
    gone = found.join(kept, "root").where(place != F.col("kept")).select("doc_id", "digest")
    # the row's own columns stand in a struct, so their names cannot clash
    rows = docs.select(F.struct(*(column(c) for c in docs.columns)).alias("row"), column(doc_id).cast("long").alias("doc_id"),
                       digest(column(text)).alias("digest"), column(text).alias("text"))
    left = rows.join(gone, ["doc_id", "digest"], "left_anti")
    repeated = found.where("n > 1").select("doc_id", "digest")
    if repeated.isEmpty():
        return left.select("row.*")
    number = F.row_number().over(Window.partitionBy("doc_id", "digest").orderBy("text"))
    first = left.join(repeated, ["doc_id", "digest"]).withColumn("number", number).where("number = 1").select("row")
    return left.join(repeated, ["doc_id", "digest"], "left_anti").select("row").unionAll(first).select("row.*")
