"""Packing token sequences by minimum bin slack."""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from plenaria.llm.common import kept, slices, stored, texts_of

CAPACITY, SEPARATOR = 2048, 0
#: Words whose ids a worker remembers before it starts anew, and code points in a run of texts.
REMEMBERED, POINTS = 800_000, 2_000_000
#: Parts that are asked for as one text; words of letters and then marks, each one part; the split they are known for.
TOGETHER, PLAIN = 500, re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!\"#$%&()*+,\-./:;<=>?@\[\\\]^_{|}~]*)")
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Rows of one length that are numbered in one group.
NUMBERED = 1_000_000
LEAST_PARTS = 64


class Words:
    """Ids of texts by a tokenizer that drops white space, remembered for each word between spaces or line ends.

    Right only if no token and no normalisation spans white space, as when the tokenizer's splits leave it out;
    other tokenizers are asked for whole texts.
    A plain word's letters, and the marks behind them, are looked up on their own. New ones are encoded many in one text,
    already small and parted by spaces; the tokens that the vocabulary says to end a part tell where each one's ids end.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # each task has one core
        self.tokenizer = Tokenizer.from_str(definition)
        parsed = json.loads(definition)
        split, *after = (parsed.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        pattern = split.get("pattern", {}).get("Regex", "")
        self.apart = split.get("behavior") == "Removed" and split.get("invert") is True and "[^\\s" in pattern
        self.known: dict[str, bytes] = {}
        changes, suffix = parsed.get("normalizer") or {}, parsed.get("model", {}).get("end_of_word_suffix")
        kinds = {c.get("type") for c in changes.get("normalizers", [changes] if changes else []) if c.get("pattern") != {"Regex": "\\s+"}}
        bytewise = [(p.get("type"), p.get("use_regex"), p.get("add_prefix_space")) for p in after] == [("ByteLevel", False, False)]
        self.small, self.parts = "Lowercase" in kinds, None
        if self.apart and pattern == PARTS and kinds <= {"NFC", "Lowercase"} and bytewise and suffix:
            spaced = parsed["pre_tokenizer"] | {"pretokenizers": [{"type": "WhitespaceSplit"}, *after]}
            self.parts = Tokenizer.from_str(json.dumps(parsed | {"normalizer": None, "pre_tokenizer": spaced, "added_tokens": []}))
            vocabulary = self.parts.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
            self.known_parts: dict[str, bytes] = {"": b""}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def together(self, parts: list[str]) -> list[bytes]:
        """Ids of small letters, or of marks, encoded TOGETHER at a time."""
        found = []
        groups = [parts[i : i + TOGETHER] for i in range(0, len(parts), TOGETHER)]
        for group, e in zip(groups, self.parts.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            cuts, joined = [0, *((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()], ids.tobytes()
            if len(cuts) != len(group) + 1 or cuts[-1] != len(joined):
                found += self.whole(group)
            else:
                found += [joined[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return found

    def learn(self, words: list[str]) -> None:
        """Adds the ids of words that are not yet known."""
        if self.parts is not None:
            met = {w: m.groups() for w in words if (m := PLAIN.fullmatch(w))}
            low = {x: x.lower() if self.small else x for x, _ in met.values()}
            new = [x for x in {*low.values(), *(x for _, x in met.values())} if x not in self.known_parts]
            self.known_parts.update(zip(new, self.together(new), strict=True))
            for w, (letters, marks) in met.items():
                self.known[w] = self.known_parts[low[letters]] + self.known_parts[marks]
            words = [w for w in words if w not in met]
        self.known.update(zip(words, self.whole(words), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        if not self.apart:
            return self.whole(texts)
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        told, ends = split.flatten().dictionary_encode(), np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy())])
        met, at = told.dictionary.to_pylist(), told.indices.to_numpy()
        if len(self.known) > REMEMBERED:
            self.known.clear()
            if self.parts is not None:
                self.known_parts = {"": b""}
        self.learn([w for w in met if w not in self.known])
        found = [self.known[w] for w in met]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first, size = (np.cumsum(sizes) - sizes)[at], sizes[at]
        cuts = np.concatenate([[0], np.cumsum(size)])
        places = np.repeat(first - cuts[:-1], size) + np.arange(cuts[-1])
        ids, cuts = np.frombuffer(b"".join(found), "<u4")[places].tobytes(), (4 * cuts[ends]).tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def pieces(docs: DataFrame, definition: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, separator: int = SEPARATOR) -> DataFrame:
    """Every row's ids and a separator, cut into pieces of ``capacity``; only the last piece may be shorter.

    Columns doc_id, piece, start, length, ids_crc32 and ids (binary, little-endian unsigned 32-bit). Null text is
    empty: the separator alone.
    """
    shared, width = docs.sparkSession.sparkContext.broadcast(definition), 4 * capacity
    mark = np.array([separator], "<u4").tobytes()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept(f"words {hashlib.md5(shared.value.encode()).hexdigest()}", lambda: Words(shared.value))
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for run in slices(rows, POINTS, lambda r: len(r[1])):
                found = []
                for (i, _), ids in zip(run, words.encode([t for _, t in run]), strict=True):
                    ids += mark
                    found += [(i, n, n * capacity, ids[a : a + width]) for n, a in enumerate(range(0, len(ids), width))]
                number, piece, start, ids = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array(number, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                ], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
    return texts_of(docs, doc_id, text).mapInArrow(task, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


def fullest(counts: dict[int, int], capacity: int) -> Counter:
    """Uses per length of the fullest combination that holds the longest piece.

    Bit s of a number says that s tokens can be reached; each further piece is one shift. The snapshots before each
    piece lead back from the highest reachable sum to the pieces.
    """
    longest = max(counts)
    room, chosen = capacity - longest, Counter({longest: 1})
    reach, steps, full = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        for _ in range(min(counts[length] - (length == longest), room // length)):
            after = (reach | reach << length) & full
            if after == reach:
                break
            steps.append((length, reach))
            reach = after
        if reach >> room & 1:
            break
    left = reach.bit_length() - 1
    for length, before in reversed(steps):
        if not before >> left & 1:
            chosen[length] += 1
            left -= length
    return chosen


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """Combinations and how often each is used, until no piece is left.

    A combination is repeated as long as its pieces last; so the work depends on the number of different lengths and
    not on the number of pieces.
    """
    counts, found = {x: n for x, n in counts.items() if n}, []
    while counts:
        chosen = fullest(counts, capacity)
        times = min(counts[x] // n for x, n in chosen.items())
        found.append((chosen, times))
        for x, n in chosen.items():
            counts[x] -= n * times
            if not counts[x]:
                del counts[x]
    return found


def slots(found: list[tuple[Counter, int]]) -> np.ndarray:
    """Per pattern and length: the length, its first rank, uses per sequence, first sequence, place in the sequence."""
    rows, ranks, sequence = [], Counter(), 0
    for chosen, times in found:
        at = 0
        for length in sorted(chosen, reverse=True):
            rows.append((length, ranks[length], chosen[length], sequence, at))
            ranks[length] += chosen[length] * times
            at += chosen[length] * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def ranked(cut: DataFrame) -> DataFrame:
    """The pieces with their number (from 0) among those of their length, counted in parts so that no length is one group."""
    key = ["doc_id", "piece", "start", "ids_crc32"]
    parts = LEAST_PARTS + cut.count() // NUMBERED
    cut = cut.withColumn("part", F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int"))
    sizes = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy("length", "part").orderBy(*key)) - 1
    return cut.withColumn("number", number).join(offsets, ["length", "part"]).withColumn("rank", F.col("before") + F.col("number"))


def pack(docs: DataFrame, definition: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, separator: int = SEPARATOR) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece.

    Null text is empty; every row, repeated ones too, gives at least one piece. Empty table: empty result. Pieces of
    equal length take their places in order of id, piece and ids.

    The driver sees how many pieces there are of each length (at most ``capacity`` numbers) and plans combinations
    of lengths; tasks then give each piece its place by its length and its number among the pieces of that length.
    """
    cut = stored(pieces(docs, definition, doc_id, text, capacity, separator).drop("ids"))
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = docs.sparkSession.sparkContext.broadcast(slots(patterns(counts, capacity)))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = plan.value
        keys = found[:, 0] << 48 | found[:, 1] if len(found) else np.zeros(0, np.int64)
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            row = found[np.searchsorted(keys, length << 48 | rank, "right") - 1]
            within = rank - row[:, 1]
            sequence, place = row[:, 3] + within // row[:, 2], row[:, 4] + within % row[:, 2] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(place)], [*names, "sequence_id", "offset"])
    return ranked(cut).select(*names, "rank").mapInArrow(task, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
