"""Substring dedup: passages that two documents share, found by collinear chains of common word seeds."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.functions import pandas_udf

from plenaria.llm.common import column, shuffles_freed, stored

#: Words of a seed; seeds of which the smallest hash is kept, all for a window of one; least words of a passage; least similarity.
SEED, WINDOW, WORDS, SIMILARITY = 5, 1, 50, 0.8
#: Words on either side of a segment within which its end is sought.
MARGIN = 18
#: Score of a match in a chain.
SCORE = 6
#: Cost of each word that a chain skips on either side.
GAP = 0.1
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def seeds(words: list[str], k: int = SEED, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hash and word number of the smallest k-word seed of each window of w, so w + k - 1 common words share one."""
    if len(words) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    codes = np.fromiter((zlib.crc32(x.encode()) for x in words), np.uint64, len(words))
    mixed = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        mixed = (mixed ^ codes[i : len(words) - k + 1 + i]) * MULTIPLIER
        mixed ^= mixed >> np.uint64(29)
    if len(mixed) <= w:
        at = np.array([int(mixed.argmin())])
    else:
        at = np.unique(np.arange(len(mixed) - w + 1) + np.lib.stride_tricks.sliding_window_view(mixed, w).argmin(axis=1))
    return mixed[at].view(np.int64), at.astype(np.int32)


class Fenwick:
    """Greatest (value, number) over a growing prefix of ranks."""

    def __init__(self, n: int):
        self.best: list[tuple[float, int]] = [(-np.inf, -1)] * (n + 1)

    def put(self, rank: int, value: tuple[float, int]) -> None:
        rank += 1
        while rank < len(self.best):
            if value > self.best[rank]:
                self.best[rank] = value
            rank += rank & -rank

    def below(self, rank: int) -> tuple[float, int]:
        found = (-np.inf, -1)
        while rank > 0:
            found = max(found, self.best[rank])
            rank -= rank & -rank
        return found


def chains(x: list[int], y: list[int], k: int = SCORE, gap: float = GAP) -> list[list[int]]:
    """Chains of matches (x, y), each ordered on both sides, the highest score first; every match is in one at most.

    A match scores k, and a step costs ``gap`` for each word from one match to the next on both sides. As that cost
    is the difference of x + y, the best step back is the greatest score plus gap * (x + y) among smaller y.
    """
    order = sorted(range(len(x)), key=lambda i: (x[i], -y[i]))
    ranks = {v: r for r, v in enumerate(sorted(set(y)))}
    tree, score, back = Fenwick(len(ranks)), [0.0] * len(x), [-1] * len(x)
    for i in order:
        value, j = tree.below(ranks[y[i]])
        gained = value - gap * (x[i] + y[i])
        score[i] = k + max(0.0, gained)
        back[i] = j if gained > 0 else -1
        tree.put(ranks[y[i]], (score[i] + gap * (x[i] + y[i]), i))
    used, found = [False] * len(x), []
    for end in sorted(range(len(x)), key=lambda i: (-score[i], x[i], y[i])):
        chain, at = [], end
        while at >= 0 and not used[at]:
            used[at] = True
            chain.append(at)
            at = back[at]
        if chain:
            found.append(chain[::-1])
    return found


def distance(a: list[str], b: list[str]) -> int:
    """Edit distance of two word sequences."""
    start = common(a, b)
    end = common(a[start:][::-1], b[start:][::-1])
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if not a or not b:
        return len(a) + len(b)
    ids = {word: i for i, word in enumerate(set(a) | set(b))}
    right, steps = np.array([ids[word] for word in b]), np.arange(len(b) + 1)
    row = steps
    for i, word in enumerate(a, 1):
        after = np.empty_like(row)
        after[0] = i
        after[1:] = np.minimum(row[1:] + 1, row[:-1] + (right != ids[word]))
        row = np.minimum.accumulate(after - steps) + steps
    return int(row[-1])


def alignment(a: list[str], b: list[str], x: list[int], y: list[int]) -> float:
    """Similarity of two passages aligned along a chain: 1 - edits between the chain's matches / longer length.

    Matches begin at words x and y; the words from the last match on are aligned too.
    """
    xs, ys = [0, *x, len(a)], [0, *y, len(b)]
    edits = sum(distance(a[i:j], b[u:v]) for i, j, u, v in zip(xs, xs[1:], ys, ys[1:], strict=False))
    return 1 - min(edits, max(len(a), len(b))) / max(len(a), len(b), 1)


def common(a: list[str], b: list[str]) -> int:
    """How many words both begin with."""
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def lengthened(a: list[str], b: list[str], spare: float, similarity: float = SIMILARITY, most: int = MARGIN) -> tuple[int, int, float]:
    """How many first words of both belong to the passage before them, and the edits left to spare.

    They end in an equal word and hold no more edits than are spare and their own length allows; the farthest end counts.
    """
    start = common(a, b)
    best, left = (0, 0), spare + (1 - similarity) * start
    x, y = a[start : start + most], b[start : start + most]
    row = list(range(len(y) + 1))
    for u, word in enumerate(x, 1):
        before, row = row, [u]
        for v, other in enumerate(y, 1):
            row.append(min(before[v] + 1, row[-1] + 1, before[v - 1] + (word != other)))
            after = spare + (1 - similarity) * (start + max(u, v)) - row[v]
            if word == other and row[v] <= spare + (1 - similarity) * max(u, v) + 1e-9 and (u + v, after) > (sum(best), left):
                best, left = (u, v), after
    return start + best[0], start + best[1], left


def segments(a: list[str], b: list[str], x: list[int], y: list[int], similarity: float = SIMILARITY, k: int = SEED) -> list[tuple[int, int]]:
    """First and last match of the parts of a chain that are similar enough, each judged on its own.

    A part that is not is cut at the step between two matches whose edits exceed the allowed ones by most.
    """
    edits = [distance(a[i:j], b[u:v]) for i, j, u, v in zip(x, x[1:], y, y[1:], strict=False)]
    excess = [e - (1 - similarity) * max(j - i, v - u) for e, i, j, u, v in zip(edits, x, x[1:], y, y[1:], strict=False)]
    found, left = [], [(0, len(x) - 1)]
    while left:
        first, last = left.pop()
        size = max(x[last] - x[first], y[last] - y[first]) + k
        if sum(edits[first:last]) <= (1 - similarity) * size + 1e-9:
            found.append((first, last))
        else:
            cut = max(range(first, last), key=lambda i: excess[i])
            left += [(first, cut), (cut + 1, last)]
    return sorted(found)


def texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows (doc, text) that take part."""
    return docs.select(column(doc_id).cast("long").alias("doc"), column(text).alias("text")).where("doc IS NOT NULL AND text IS NOT NULL")


def numbered(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Every distinct text once (unit, text), its number in the order of the smallest id that has it, and (doc, unit) of all documents."""
    rows = texts(docs, doc_id, text).withColumn("digest", F.unhex(F.md5("text")))
    known = stored(rows.groupBy("digest").agg(F.min("doc").alias("low")).orderBy("low", "digest").select("digest", F.monotonically_increasing_id().alias("unit")))
    units = stored(rows.groupBy("digest").agg(F.first("text").alias("text")).join(known, "digest").select("unit", "text"))
    return units, stored(rows.select("doc", "digest").distinct().join(known, "digest").select("doc", "unit"))


def occurrences(rows: DataFrame, k: int, w: int) -> DataFrame:
    """Seeds (seed, doc, at) of rows (doc, text)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes, at = seeds(t.lower().split(), k, w)
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(np.full(len(at), i)), pa.array(at, pa.int32())], ["seed", "doc", "at"])

    return rows.mapInArrow(task, "seed long, doc long, at int").where("seed IS NOT NULL AND doc IS NOT NULL AND at IS NOT NULL")


def matches(docs: DataFrame, doc_id: str, text: str, k: int, w: int, least: int) -> DataFrame:
    """Seeds that documents a < b have in common, however many documents hold them: all their places in either (a, b, xs, ys).

    Documents whose seeds that others hold lie within fewer than ``least`` words, as one common line does, can have no chain
    of so many and take no part.
    """
    # seeds are shuffled once: a text's places of one, and the texts that hold it, meet where it lies
    places = occurrences(texts(docs, doc_id, text), k, w).repartition("seed").groupBy("seed", "doc").agg(F.collect_list("at").alias("at"))
    same = Window.partitionBy("seed")
    common = stored(places.withColumn("several", F.min("doc").over(same) < F.max("doc").over(same)).where("several").drop("several"))
    wide = common.groupBy("doc").agg(F.min(F.array_min("at")).alias("low"), F.max(F.array_max("at")).alias("high")).where(F.col("high") - F.col("low") + k >= least).select("doc")
    left = common.join(wide, "doc")
    a, b = left.alias("a"), left.alias("b")
    both = a.join(b, (F.col("a.seed") == F.col("b.seed")) & (F.col("a.doc") < F.col("b.doc")))
    return both.select(F.col("a.doc").alias("a"), F.col("b.doc").alias("b"), F.col("a.at").alias("xs"), F.col("b.at").alias("ys"))


def diagonals(xs: list[np.ndarray], ys: list[np.ndarray], most: int = 2_000_000) -> np.ndarray:
    """Longest runs of matches that follow each other word by word on both sides: first x, y - x and length of each.

    The i-th seed is at xs[i] in one text and at ys[i] in the other; about ``most`` of its matches are held at once.
    """
    row, x, y = np.repeat(np.arange(len(xs)), [len(v) for v in xs]), np.concatenate(xs).astype(np.int64), np.concatenate(ys).astype(np.int64)
    order = np.argsort(x)
    row, x = row[order], x[order]
    counts = np.array([len(v) for v in ys])
    first, size = (np.cumsum(counts) - counts)[row], counts[row]
    cuts = np.searchsorted(np.cumsum(size), np.arange(most, int(size.sum()), most))
    found = []
    for part in np.split(np.arange(len(x)), np.unique(cuts)):
        n = size[part]
        u = np.repeat(x[part], n)
        d = y[np.repeat(first[part] - (np.cumsum(n) - n), n) + np.arange(len(u))] - u
        order = np.lexsort((u, d))
        found.append(joined(u[order], d[order], np.ones(len(u), np.int64)))
    u, d, n = np.concatenate(found, axis=1)
    order = np.lexsort((u, d))
    return joined(u[order], d[order], n[order]).T


def joined(x: np.ndarray, d: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Runs in order of diagonal and place, those that go on where one ends made one."""
    at = np.flatnonzero(np.concatenate([np.ones(min(len(x), 1), bool), (d[1:] != d[:-1]) | (x[1:] != x[:-1] + n[:-1])]))
    return np.stack([x[at], d[at], np.add.reduceat(n, at) if len(at) else n])


def covering(runs: np.ndarray) -> list[tuple[int, int, int]]:
    """Of the runs of diagonals() enough to hold each matched place of either text, those first that add most places.

    Of two that add as many, the one nearer to the longest run's diagonal goes first. What comes n times in both texts so
    gives about n runs and not n * n.
    """
    if len(runs) == 1:
        return [tuple(runs[0].tolist())]
    low, low_y = runs[:, 0].min(), (runs[:, 0] + runs[:, 1]).min()
    free = [np.ones(int((v + runs[:, 2]).max()), bool) for v in (runs[:, 0] - low, runs[:, 0] + runs[:, 1] - low_y)]
    main = runs[runs[:, 2].argmax(), 1]
    heap = [(-2 * n, abs(d - main), x, d, n) for x, d, n in runs.tolist()]
    heapify(heap)
    kept = []
    while heap:
        _, far, x, d, n = heap[0]
        sides = [f[i : i + n] for f, i in zip(free, (x - low, x + d - low_y), strict=True)]
        now = -sum(int(np.count_nonzero(side)) for side in sides), far, x, d, n
        heappop(heap)
        if now[0] and heap and now > heap[0]:
            heappush(heap, now)
        elif now[0]:
            kept.append((x, d, n))
            for side in sides:
                side[:] = False
    return kept


def chained(matches: DataFrame, k: int, words: int) -> DataFrame:
    """Chains (a, b, a_start, a_end, b_start, b_end, x, y) of at least so many words on both sides, ends exclusive.

    What both have word by word for so many words is in one chain.

    x and y are the word numbers of the chain's matches.
    """
    names = ["a", "b", "a_start", "a_end", "b_start", "b_end", "x", "y"]

    def spans(a: int, b: int, xs: list[np.ndarray], ys: list[np.ndarray]) -> list[tuple]:
        if any(max(v.max() for v in side) - min(v.min() for v in side) + k < words for side in (xs, ys)):
            return []
        # a run is taken as seeds at its ends and between, near enough to be chained
        taken = [[(x + i, x + d + i) for i in (*range(0, n - 1, 2 * k), n - 1)] for x, d, n in covering(diagonals(xs, ys))]
        met = sorted({m for run in taken for m in run})
        chosen = [[met[i] for i in c] for c in chains([m[0] for m in met], [m[1] for m in met])]
        of = {m: i for i, c in enumerate(chosen) for m in c}
        # where a text repeats itself a chain may change over to another run; one that is long enough then counts on its own, too
        chosen += [run for run in taken if run[-1][0] - run[0][0] + k >= words and of[run[0]] != of[run[-1]]]
        found = [(a, b, c[0][0], c[-1][0] + k, c[0][1], c[-1][1] + k, [m[0] for m in c], [m[1] for m in c]) for c in chosen]
        return [s for s in found if min(s[3] - s[2], s[5] - s[4]) >= words]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, xs, ys = None, [], []
        for batch in batches:
            rows, (a, b) = [], (batch.column(c).to_numpy() for c in range(2))
            sides = [np.split(c.flatten().to_numpy(), (c.offsets.to_numpy() - c.offsets[0].as_py())[1:-1]) if len(a) else [] for c in (batch.column(2), batch.column(3))]
            starts = np.flatnonzero(np.concatenate([[True], (np.diff(a) != 0) | (np.diff(b) != 0)])) if len(a) else []
            for i, j in zip(starts, [*starts[1:], len(a)], strict=True):
                if (a[i], b[i]) != pair:
                    if pair:
                        rows += spans(*pair, xs, ys)
                    pair, xs, ys = (int(a[i]), int(b[i])), [], []
                xs += sides[0][i:j]
                ys += sides[1][i:j]
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=schema)
        if pair:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in spans(*pair, xs, ys)], schema=schema)

    kinds = {"a": pa.int64(), "b": pa.int64(), "x": pa.list_(pa.int32()), "y": pa.list_(pa.int32())}
    schema = pa.schema([(n, kinds.get(n, pa.int32())) for n in names])
    return matches.repartition("a", "b").sortWithinPartitions("a", "b").mapInArrow(task, "a long, b long, a_start int, a_end int, b_start int, b_end int, x array<int>, y array<int>")


def shared(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SEED, w: int = WINDOW, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """Passages of at least ``words`` words that document a shares with document b, a < b, with their similarity.

    Columns a, b, the passages' first and last words (from 0, end exclusive) on both sides, and similarity (word edit
    distance). A chain of matches that is not similar enough is cut, and its parts are judged on their own. Words are lower-cased and end at white space.
    All pairs of distinct texts are compared by all seeds they have in common, and their passages hold for all documents
    with these texts, so rows grow with the square of the documents that share a passage. What comes several times in two
    texts is matched until each place of either is, not each with each. Rows without id or text take no part; of rows that share an id each text is compared on its own. Whole copies share one passage, their text. Empty
    table: empty result.
    """
    margin = max(k + w, MARGIN)  # a passage's outermost seeds are nearer to its ends than this
    least = max(k, words - 2 * margin)

    @pandas_udf("int")
    def size(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: len(t.lower().split())).astype("int32")

    with shuffles_freed(docs.sparkSession):
        units, members = numbered(docs, doc_id, text)
        found = judged(units, chained(matches(units, "unit", "text", k, w, least), k, least), "unit", "text", k, margin, words, similarity)
    several = members.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("unit")
    whole = units.join(several, "unit").select("unit", size("text").alias("n")).where(F.col("n") >= words)
    copies = whole.select(F.col("unit").alias("a"), F.col("unit").alias("b"), F.lit(0).alias("a_start"), F.col("n").alias("a_end"), F.lit(0).alias("b_start"), F.col("n").alias("b_end"), F.lit(1.0).alias("similarity"))
    left, right = (members.select(F.col("unit").alias(u), F.col("doc").alias(d)) for u, d in (("a", "c"), ("b", "d")))
    met = found.unionAll(copies).join(left, "a").join(right, "b").where("c < d OR c > d AND a != b")
    sides = lambda names: [F.when(F.col("c") < F.col("d"), F.col(n)).otherwise(F.col(o)).alias(n) for n, o in names]
    edges = [(f"{s}_{e}", f"{o}_{e}") for s, o in ("ab", "ba") for e in ("start", "end")]
    return met.select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b"), *sides(edges), "similarity").distinct()


def judged(docs: DataFrame, chains: DataFrame, doc_id: str, text: str, k: int, margin: int, words: int, similarity: float) -> DataFrame:
    """The passages, as of ``shared``, that the chains hold or, with up to ``margin`` more words at their ends, reach."""
    found = stored(chains)
    rows = texts(docs, doc_id, text)

    @pandas_udf("array<string>")
    def part(texts: pd.Series, start: pd.Series, end: pd.Series) -> pd.Series:
        """The words before the chain, in it and behind it."""
        split = (t.lower().split() for t in texts)
        return pd.Series([[" ".join(x) for x in (v[max(a - margin, 0) : a], v[a:b], v[b : b + margin])] for v, a, b in zip(split, start, end, strict=True)])

    @pandas_udf("array<array<double>>")
    def compared(a: pd.Series, b: pd.Series, xs: pd.Series, ys: pd.Series) -> pd.Series:
        """Per segment of a chain its ends on both sides, counted from the chain's first words, and its similarity."""
        out = []
        for left, right, x, y in zip(a, b, xs, ys, strict=True):
            sides = [[v.split() for v in side] for side in (left, right)]
            (v, w), (p, q) = (sum(side, []) for side in sides), (len(side[0]) for side in sides)
            x, y = (x - x[0] + p).tolist(), (y - y[0] + q).tolist()
            out.append([])
            for first, last in segments(v, w, x, y, similarity, k):
                ends = x[last] + k, y[last] + k
                size = max(ends[0] - x[first], ends[1] - y[first])
                spare = (1 - similarity) * size - (1 - alignment(v[x[first] : ends[0]], w[y[first] : ends[1]], *([m - z[first] for m in z[first : last + 1]] for z in (x, y)))) * size
                # edits of the segment itself are spared only for one that is else too short
                for allowed in (0.0, max(spare, 0.0)):
                    *before, rest = lengthened(v[: x[first]][::-1], w[: y[first]][::-1], allowed, similarity)
                    *after, _ = lengthened(v[ends[0] :], w[ends[1] :], min(rest, allowed) if allowed else 0.0, similarity)
                    i, j, e, f = x[first] - before[0], y[first] - before[1], ends[0] + after[0], ends[1] + after[1]
                    if min(e - i, f - j) >= words:
                        break
                alike = alignment(v[i:e], w[j:f], [m - i for m in x[first : last + 1]], [m - j for m in y[first : last + 1]])
                out[-1].append([i - p, e - p, j - q, f - q, alike])
        return pd.Series(out)

    left = found.join(rows, F.col("a") == F.col("doc")).select(*found.columns, part("text", "a_start", "a_end").alias("a_words"))
    both = left.join(rows, F.col("b") == F.col("doc")).select(*found.columns, "a_words", part("text", "b_start", "b_end").alias("b_words"))
    judged = both.select("a", "b", "a_start", "b_start", F.explode(compared("a_words", "b_words", "x", "y")).alias("c"))
    edges = [(F.col(f"{side}_start") + F.col("c")[2 * n + m].cast("int")).alias(f"{side}_{edge}") for n, side in enumerate("ab") for m, edge in enumerate(("start", "end"))]
    whole = judged.select("a", "b", *edges, F.col("c")[4].alias("similarity"))
    long = F.least(F.col("a_end") - F.col("a_start"), F.col("b_end") - F.col("b_start")) >= words
    with small_batches(docs.sparkSession):
        return stored(whole.where((F.col("similarity") >= similarity) & long).distinct())


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """While it lasts Python gets few rows at once, since each row of the joins carries a whole text."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "256")
    try:
        yield
    finally:
        spark.conf.set(name, before)
