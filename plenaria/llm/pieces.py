"""SentencePiece encoding for merge-type vocabularies with byte fallback, and decoding."""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from plenaria.llm.common import column, kept, slices, texts_of

SPACE = "▁"
#: Chunks of up to so many symbols are merged together, longer ones one at a time.
WIDTHS = (8, 16, 32)
#: Chunks whose ids a worker remembers before it starts anew, and code points in a run of texts.
REMEMBERED, POINTS = 800_000, 2_000_000
NONE = np.iinfo(np.int32).max


class Merges:
    """The pieces of a model as merges of adjacent symbols: every split of a piece into two symbols makes the piece.

    Symbols are ids of pieces; characters without a piece have numbers from the vocabulary's size on.
    """

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size, lib = self.library.get_piece_size(), self.library
        if any(lib.is_unused(i) for i in range(size)) or sum(lib.is_byte(i) for i in range(size)) != 256:
            raise ValueError("the model must fall back to bytes and have no unused pieces")
        self.ids = {lib.id_to_piece(i): i for i in range(size) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))}
        self.octets = [np.array([lib.piece_to_id(f"<0x{b:02X}>")], "<u4").tobytes() for b in range(256)]
        self.size, self.span = size, size + 0x110000
        #: the smaller the rank the earlier a merge; pieces of one score share it
        scores = {piece: lib.get_score(i) for piece, i in self.ids.items()}
        ranks = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = np.full(size + 1, NONE, np.int32)
        for piece, i in self.ids.items():
            self.rank[i] = ranks[scores[piece]]
        pairs = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.symbol(piece[:cut]), self.symbol(piece[cut:])
                if a is not None and b is not None:
                    pairs[a * self.span + b] = i
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in sorted(pairs)], np.int32)
        #: merges never cross into a space unless some piece holds a space behind another character
        self.cuts = not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.ids)
        self.points = np.arange(self.size, self.span, dtype=np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.points[ord(piece)] = i
        self.known: dict[str, bytes] = {}

    def symbol(self, part: str) -> int | None:
        return self.ids.get(part, self.size + ord(part) if len(part) == 1 else None)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that two adjacent symbols make, ``size`` if none; symbols below 0 are fill."""
        key = a.astype(np.int64) * self.span + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.made[at], np.int32(self.size))

    def agenda(self, symbols: np.ndarray) -> list[int]:
        """Merge the adjacent pairs of one chunk in order of score, then from the left, from a heap of pairs."""
        n = len(symbols)
        ids, before, after = symbols.tolist(), list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(int(self.rank[m]), i, ids[i], ids[i + 1], int(m)) for i, m in enumerate(self.merged(symbols[:-1], symbols[1:])) if m < self.size]
        heapq.heapify(heap)
        while heap:
            _, i, left, right, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue  # one of the two was merged meanwhile
            ids[i], ids[j], after[i] = made, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0:
                    m = int(self.merged(np.array([ids[a]]), np.array([ids[b]]))[0])
                    if m < self.size:
                        heapq.heappush(heap, (int(self.rank[m]), a, ids[a], ids[b], m))
        return [i for i in ids if i >= 0]

    def agendas(self, rows: np.ndarray) -> np.ndarray:
        """The same for many chunks at once, one in a row, filled up with -1: each round merges every row's first pair."""
        result, where = np.full_like(rows, -1), np.arange(len(rows))
        made = self.merged(rows[:, :-1], rows[:, 1:])
        columns = np.arange(rows.shape[1])
        while len(rows):
            rank = self.rank[made]
            first = rank.argmin(axis=1)
            live = rank[np.arange(len(rows)), first] < NONE
            result[where[~live]] = rows[~live]
            rows, made, where, first = rows[live], made[live], where[live], first[live]
            each = np.arange(len(rows))
            piece = made[each, first]
            rows = np.concatenate([rows, np.full((len(rows), 1), -1, np.int32)], axis=1)
            rows = np.take_along_axis(rows, columns + (columns > first[:, None]), axis=1)
            rows[each, first] = piece
            made = np.concatenate([made, np.full((len(made), 1), self.size, np.int32)], axis=1)
            made = np.take_along_axis(made, columns[:-1] + (columns[:-1] > first[:, None]), axis=1)
            left = np.maximum(first - 1, 0)
            made[each, left] = np.where(first > 0, self.merged(rows[each, left], rows[each, first]), made[each, left])
            inner = first < made.shape[1]
            right = first[inner]
            made[each[inner], right] = self.merged(rows[each[inner], right], rows[each[inner], right + 1])
        return result

    def written(self, symbols: list[int]) -> bytes:
        """Ids of symbols, little-endian; a character without a piece is written as its bytes."""
        if max(symbols) < self.size:
            return np.array(symbols, "<u4").tobytes()
        return b"".join(np.array([s], "<u4").tobytes() if s < self.size else b"".join(self.octets[b] for b in chr(s - self.size).encode()) for s in symbols)

    def learn(self, chunks: list[str]) -> None:
        """Remember the ids of chunks; a chunk is written without its first space."""
        lengths = np.array([len(c) + 1 for c in chunks])
        symbols = self.points[np.frombuffer("".join(SPACE + c for c in chunks).encode("utf-32-le"), "<u4")]
        starts = np.cumsum(lengths) - lengths
        for low, high in zip((0, *WIDTHS), WIDTHS, strict=False):
            of = np.flatnonzero((lengths > low) & (lengths <= high))
            if len(of):
                fill = np.arange(high) < lengths[of][:, None]
                rows = np.where(fill, symbols[np.minimum(starts[of][:, None] + np.arange(high), len(symbols) - 1)], np.int32(-1))
                done = self.agendas(rows)
                plain = (done < self.size).all(axis=1)
                flat, ends = done[done >= 0].astype("<u4").tobytes(), 4 * np.cumsum((done >= 0).sum(axis=1))
                for i, ok, row, a, b in zip(of.tolist(), plain.tolist(), done, [0, *ends.tolist()[:-1]], ends.tolist(), strict=True):
                    self.known[chunks[i]] = flat[a:b] if ok else self.written(row[row >= 0].tolist())
        for i in np.flatnonzero(lengths > WIDTHS[-1]).tolist():
            self.known[chunks[i]] = self.written(self.agenda(symbols[starts[i] : starts[i] + lengths[i]]))

    def chunks(self, text: str) -> list[str]:
        """A text in parts that merge apart from each other, each without its first space."""
        if not text:
            return []
        if not self.cuts:
            return [text.replace(" ", SPACE)]
        if SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [c[1:] for c in re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        parts, unknown = [self.chunks(t) for t in texts], set()
        for p in parts:
            unknown.update(p)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [c for c in unknown if c not in self.known]
        if new:
            self.learn(new)
        return [b"".join(map(self.known.__getitem__, p)) for p in parts]


def worker_merges(model) -> Merges:
    data = model.value
    return kept(f"merges {hashlib.md5(data).hexdigest()}", lambda: Merges(data))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    for batch in batches:
        yield from slices(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), POINTS, lambda r: len(r[1]))


def encode(docs: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (array, without begin and end) of every row; null and empty texts have no ids."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = worker_merges(shared)
        for run in _runs(batches):
            ids = [np.frombuffer(b, "<u4").astype(np.int32) for b in merges.encode([t for _, t in run])]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in run], pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
    return texts_of(docs, doc_id, text).mapInArrow(task, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: bytes, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id and text of every row by the library's decode; null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = worker_merges(shared).library
        for batch in batches:
            texts = [library.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])
    rows = encoded.select(column(doc_id).cast("long").alias("doc_id"), column(ids).cast("array<int>").alias("ids"))
    return rows.mapInArrow(task, "doc_id long, text string")


def round_trip(docs: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Number and digest of every row's ids (begin and end included), and the digest of what they decode to.

    The ids come from the agenda; ``agrees`` says whether the library, run on the same batch, gives the same ids.
    Null text is empty: begin and end only. Repeated rows are rows of their own; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = worker_merges(shared)
        library = merges.library
        begin, end = (np.array([i], "<u4").tobytes() for i in (library.bos_id(), library.eos_id()))
        for run in _runs(batches):
            texts = [t for _, t in run]
            ids = [begin + b + end for b in merges.encode(texts)]
            numbers = [np.frombuffer(b, "<u4").tolist() for b in ids]
            expected = library.encode(texts, add_bos=True, add_eos=True, num_threads=1)
            decoded = library.decode(numbers)
            yield pa.RecordBatch.from_arrays([
                pa.array([i for i, _ in run], pa.int64()), pa.array([len(n) for n in numbers], pa.int64()),
                pa.array([hashlib.sha256(b).hexdigest() for b in ids]),
                pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded]),
                pa.array([n == e for n, e in zip(numbers, expected, strict=True)]),
            ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"])
    return texts_of(docs, doc_id, text).mapInArrow(task, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean")
