"""Toxicity: a convolutional classifier over hashed word embeddings, trained in numpy on all labelled rows, dealt to tasks."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.functions import pandas_udf

from plenaria.llm.boosting import sigmoid
from plenaria.llm.common import column, slices, stored
from plenaria.llm.passages import small_batches

#: About so many rows and characters make a part, which one task trains on; the parts grow in number with the labelled rows.
ROWS, CHARS = 6_000, 50_000_000
#: Of more rows than this only the margins among which a threshold can lie are gathered, told by counts in steps of 1/GRID.
EXACT, GRID = 20_000, 1024
#: Buckets whose embeddings of all tasks are averaged at once.
SLOT = 2**10
BUCKETS, SIZE, FILTERS, WIDTHS, STEM = 2**15, 12, 12, (1, 2, 3), 4
EPOCHS, BATCH, RATE = 6, 32, 0.05
#: Words that are scored at once.
RUN = 60_000
WORD = re.compile(r"\w+")
#: Frequent words by which a text's language is guessed; the first group is for texts without any.
MARKS = [(), ("the", "of", "and", "to", "in", "is", "that"), ("der", "die", "und", "das", "von", "mit", "nicht"),
         ("le", "la", "les", "des", "et", "un", "une"), ("el", "los", "que", "y", "se", "con", "del")]


def language(words: list[str]) -> int:
    """Number of the language whose marks a text has most, by its words alone."""
    counts = [0] + [sum(map(words.count, marks)) for marks in MARKS[1:]]
    return int(np.argmax(counts))


def hashed(words: list[str]) -> np.ndarray:
    """Two buckets per word: of the word and of its first letters, so that inflected words are akin."""
    whole = [zlib.crc32(w.encode()) % BUCKETS for w in words]
    stem = [zlib.crc32(w[:STEM].encode() + b"*") % BUCKETS for w in words]
    return np.array([whole, stem], np.int32).reshape(2, -1).T


@dataclass
class Model:
    """Embeddings of the buckets, filters (width, place in it) over them, output weights and thresholds by language."""

    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    output: np.ndarray
    constant: float
    thresholds: np.ndarray
    training: bool = False

    def pooled(self, buckets: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per text the highest response of each filter and, in training, the word where it begins; the words; their rows.

        Texts are set apart by rows of zeros as long as the widest filter, which an empty text also has.
        """
        pad = WIDTHS[-1]
        starts = np.cumsum(lengths + pad) - lengths - pad
        words = np.zeros((int((lengths + pad).sum()), SIZE), np.float32)
        own = np.repeat(starts, lengths) + np.arange(len(buckets)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        words[own] = self.embedding[buckets[:, 0]] + self.embedding[buckets[:, 1]]
        best, where = [], []
        for filters in self.filters:
            response = words @ filters[0]
            for j in range(1, len(filters)):
                response[:-j] += words[j:] @ filters[j]
            top = np.maximum.reduceat(response, starts, axis=0)
            best.append(top)
            where.append(np.stack([a + response[a : a + n + pad].argmax(axis=0) for a, n in zip(starts, lengths, strict=True)]) if self.training else top)
        return np.concatenate(best, axis=1), np.concatenate(where, axis=1), words, own

    def margin(self, buckets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        best, *_ = self.pooled(buckets, lengths)
        return np.maximum(best + self.bias, 0) @ self.output + self.constant


def present(texts: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """In how many texts of either class each bucket is."""
    found = np.zeros((2, BUCKETS))
    for buckets, label in zip(texts, y, strict=True):
        found[int(label), np.unique(buckets)] += 1
    return found


def start(found: np.ndarray, rows: np.ndarray, seed: int = 7) -> tuple[Model, list, np.random.Generator]:
    """A model before training, its sums of squared gradients and the generator that goes on, from the counts of texts.

    The first place of each embedding starts at the bucket's smoothed log odds among the texts, the rest at random.
    """
    random = np.random.default_rng(seed)
    odds = np.diff(np.log((found + 1) / (rows[:, None] + 2)), axis=0)[0]
    seen = found.sum(axis=0)
    embedding = random.normal(0, 0.05, (BUCKETS, SIZE)).astype(np.float32)
    embedding[:, 0] = np.where(seen > 1, odds, np.minimum(odds, 0)) / 4
    filters = [random.normal(0, 0.2, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[:, 0, : FILTERS // 2] = 1 / len(f)
    model = Model(embedding, filters, np.full(FILTERS * len(WIDTHS), -0.1, np.float32), random.normal(0.1, 0.05, FILTERS * len(WIDTHS)).astype(np.float32), -1.0, np.zeros(len(MARKS)))
    squares = [np.full_like(embedding, 0.1), [np.full_like(f, 0.1) for f in filters], np.full_like(model.bias, 0.1), np.full_like(model.output, 0.1)]
    return model, squares, random


def epoch(model: Model, squares: list, texts: list[np.ndarray], y: np.ndarray, random: np.random.Generator) -> None:
    """Train on each text once, in place: stochastic gradients (Adagrad) of the log loss."""
    model.training = True
    embedding = model.embedding
    order = random.permutation(len(texts))
    for at in range(0, len(order), BATCH):
        chosen = order[at : at + BATCH]
        buckets, lengths = np.concatenate([texts[i] for i in chosen]), np.array([len(texts[i]) for i in chosen])
        best, where, words, own = model.pooled(buckets, lengths)
        active = np.maximum(best + model.bias, 0)
        error = (sigmoid(active @ model.output + model.constant) - y[chosen]) / len(chosen)
        back = np.outer(error, model.output) * (active > 0)
        place = np.full(len(words), -1)
        place[own] = np.arange(len(own))
        change = np.zeros_like(words)
        for k, f in enumerate(model.filters):
            part = slice(k * FILTERS, (k + 1) * FILTERS)
            for j in range(len(f)):
                rows = np.minimum(where[:, part] + j, len(words) - 1)
                moved = np.einsum("bfd,bf->df", words[rows], back[:, part])
                np.add.at(change, rows.ravel(), (back[:, part][:, :, None] * f[j].T[None]).reshape(-1, SIZE))
                squares[1][k][j] += moved**2
                f[j] -= RATE * moved / np.sqrt(squares[1][k][j])
        for values, moved, square in ((model.bias, back.sum(axis=0), squares[2]), (model.output, active.T @ error, squares[3])):
            square += moved**2
            values -= (RATE * moved / np.sqrt(square)).astype(np.float32)
        model.constant -= RATE * float(error.sum())
        touched = np.flatnonzero(np.abs(change).sum(axis=1))
        touched = touched[place[touched] >= 0]
        for side in (0, 1):
            of = buckets[place[touched], side]
            np.add.at(squares[0], of, change[touched] ** 2)
            np.add.at(embedding, of, -RATE * change[touched] / np.sqrt(squares[0][of]))
    model.training = False


def train(texts: list[np.ndarray], y: np.ndarray, seed: int = 7) -> Model:
    """Filters, embeddings and output weights from texts that one task holds."""
    model, squares, random = start(present(texts, y), np.array([(y == 0).sum(), (y == 1).sum()]), seed)
    for _ in range(EPOCHS):
        epoch(model, squares, texts, y, random)
    return model


def labelled(docs: DataFrame, clean: DataFrame, n: int) -> DataFrame:
    """Language and buckets of the documents (_id, _text) that may have labels, told by one bit of a map of all labels' ids.

    The map has 16 bits a label, so one in 16 others at most passes too; only buckets are left to be shuffled, not texts.
    """
    size = 1 << max(15, (16 * n).bit_length())
    place = F.expr(f"pmod(xxhash64(_id), {size})")
    bits = clean.select(place.alias("place")).groupBy(F.expr("bitmap_bucket_number(place + 1)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place + 1))").alias("bits"))
    known = np.zeros(size // 8, np.uint8)
    for bucket, part in bits.collect():
        known[(bucket - 1) * len(part) :][: len(part)] = np.frombuffer(part, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy()
            passed = np.flatnonzero(shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1)
            for some in np.array_split(passed, len(passed) // 256 + 1):
                words = [tokens(t) for t in batch.column(1).take(pa.array(some)).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some)), pa.array([language(w) for w in words], pa.int32()),
                                                  pa.array([hashed(w).astype(np.uint16).tobytes() for w in words], pa.binary())], ["_id", "language", "buckets"])

    return docs.select("_id", "_text", place.alias("place")).mapInArrow(task, "_id long, language int, buckets binary")


def packed(described: DataFrame, clean: DataFrame, parts: int) -> DataFrame:
    """Labelled documents dealt to so many parts by a hash of their id, one row per part, ordered by id; their buckets are compressed.

    ``last`` marks those of which one in five, by their id, is kept from training.
    """
    def task(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.to_pandas().merge(right.to_pandas(), on="_id").sort_values(["_id", "_label", "language"], kind="stable")
        if not len(rows):
            return pa.table({n: pa.array([], pa.int64() if n == "part" else pa.binary()) for n in names})
        last = [zlib.crc32(f"calibrate {i}".encode()) % 5 == 0 for i in rows._id]
        arrays = {"ids": rows._id.to_numpy(np.int64), "lengths": rows.buckets.map(len).to_numpy(np.int64) // 4, "languages": rows.language.to_numpy(np.int8),
                  "labels": rows._label.to_numpy(np.int8), "last": np.array(last, np.int8)}
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), **{n: pa.array([v.tobytes()], pa.binary()) for n, v in arrays.items()}, "buckets": pa.array([zlib.compress(b"".join(rows.buckets), 1)], pa.binary())})

    names = ["part", "ids", "lengths", "languages", "labels", "last", "buckets"]
    left, right = (df.withColumn("part", F.expr(f"pmod(xxhash64(_id, 1), {parts})")).groupBy("part") for df in (described, clean))
    return stored(left.cogroup(right).applyInArrow(task, ", ".join(f"{n} {'long' if n == 'part' else 'binary'}" for n in names)))


def unpacked(row: dict[str, pa.Buffer], held: bool | None = None) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Buckets, labels, languages and ids of a part's texts: of those kept from training, of the others, or of all."""
    lengths = np.frombuffer(row["lengths"], np.int64)
    texts = np.split(np.frombuffer(zlib.decompress(row["buckets"]), np.uint16).reshape(-1, 2), np.cumsum(lengths)[:-1])
    at = np.flatnonzero(np.frombuffer(row["last"], np.int8) != (not held)) if held is not None else np.arange(len(lengths))
    y, languages, ids = (np.frombuffer(row[n], kind)[at] for n, kind in (("labels", np.int8), ("languages", np.int8), ("ids", np.int64)))
    return [texts[i] for i in at], y.astype(float), languages, ids


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[str, pa.Buffer]]]:
    """Number and columns of each part, whose bytes are not copied."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column("part")[i].as_py(), {n: batch.column(n)[i].as_buffer() for n in batch.schema.names if n != "part"}


def flat(model: Model, squares: list) -> np.ndarray:
    """All values that are trained but the embeddings', in one array."""
    values = [*model.filters, *squares[1], model.bias, model.output, *squares[2:], model.constant]
    return np.concatenate([np.ravel(v).astype(float) for v in values])


def unflat(values: np.ndarray, model: Model, squares: list) -> None:
    """Put back what flat() gave."""
    at = 0
    for own in (*model.filters, *squares[1], model.bias, model.output, *squares[2:]):
        own[...] = values[at : at + own.size].reshape(own.shape)
        at += own.size
    model.constant = float(values[at])


def trained(parts: DataFrame, rows: np.ndarray, held: bool | None = None, seed: int = 7) -> Model:
    """train() over packed parts, of their texts those that unpacked() gives for ``held``.

    Each round every part trains for an epoch from the common model, and the results are averaged. An embedding is averaged over the parts that changed it. One part alone gives what train() gives.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, row in parts_of(batches):
            found = present(*unpacked(row, held)[:2]).astype(np.int64)
            at = np.flatnonzero(found.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[0, at]), pa.array(found[1, at])], ["bucket", "n0", "n1"])

    counts = parts.mapInArrow(counted, "bucket long, n0 long, n1 long").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()
    found = np.zeros((2, BUCKETS))
    found[:, counts.bucket] = counts[["n0", "n1"]].to_numpy().T
    model, squares, random = start(found, rows, seed)
    names = ["part", "slot", "buckets", "values"]

    def averaged(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        buckets, values = ([np.frombuffer(v, kind) for v in group.column(name).to_pylist()] for name, kind in (("buckets", np.int32), ("values", np.float64 if key[0].as_py() < 0 else np.float32)))
        if key[0].as_py() < 0:
            at, mean = np.zeros(0, np.int32), np.sum(values, axis=0) / len(values)
        else:
            at, own, n = np.unique(np.concatenate(buckets), return_inverse=True, return_counts=True)
            mean = np.zeros((len(at), 2 * SIZE))
            np.add.at(mean, own, np.concatenate(values).reshape(-1, 2 * SIZE))
            mean = (mean / n[:, None]).astype(np.float32)
        return pa.table({"slot": [key[0].as_py()], "buckets": [at.astype(np.int32).tobytes()], "values": [mean.tobytes()]})

    for done in range(EPOCHS):
        common = parts.sparkSession.sparkContext.broadcast((tuple(getattr(model, f.name) for f in fields(model)), squares, random.bit_generator.state))

        def task(batches: Iterator[pa.RecordBatch], done: int = done, common=common) -> Iterator[pa.RecordBatch]:
            for part, row in parts_of(batches):
                plain, before, state = common.value
                own, sums = Model(plain[0].copy(), [f.copy() for f in plain[1]], plain[2].copy(), plain[3].copy(), *plain[4:]), [before[0].copy(), [f.copy() for f in before[1]], *(v.copy() for v in before[2:])]
                bits = np.random.PCG64()
                bits.state = state
                order = np.random.Generator(bits.jumped(part) if part else bits)
                texts, y, *_ = unpacked(row, held)
                if not texts:
                    continue
                for _ in range(done):
                    order.permutation(len(texts))
                epoch(own, sums, texts, y, order)
                changed = np.flatnonzero(((own.embedding != plain[0]) | (sums[0] != before[0])).any(axis=1)).astype(np.int32)
                found = [(-1, b"", flat(own, sums).tobytes())]
                for at in np.split(changed, np.flatnonzero(np.diff(changed // SLOT)) + 1):
                    if len(at):
                        found.append((int(at[0]) // SLOT, at.tobytes(), np.concatenate([own.embedding[at], sums[0][at]], axis=1).tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(found), pa.int64()), *map(pa.array, zip(*found, strict=True))], names)

        means = parts.mapInArrow(task, "part long, slot long, buckets binary, values binary").groupBy("slot").applyInArrow(averaged, "slot long, buckets binary, values binary").collect()
        common.destroy()
        for slot, buckets, values in means:
            if slot < 0:
                unflat(np.frombuffer(values), model, squares)
            else:
                at, mean = np.frombuffer(buckets, np.int32), np.frombuffer(values, np.float32).reshape(-1, 2 * SIZE)
                model.embedding[at], squares[0][at] = mean[:, :SIZE], mean[:, SIZE:]
    return model


def errors(own: pd.DataFrame) -> np.ndarray:
    """Share of errors in both classes at each cut between rows in order, before the first one and behind the last one too."""
    zeros, ones = own.zeros.to_numpy(), own.ones.to_numpy()
    return np.concatenate([[0], np.cumsum(ones)]) / max(ones.sum(), 1) + np.concatenate([np.cumsum(zeros[::-1])[::-1], [0]]) / max(zeros.sum(), 1)


def calibrate(model: Model, found: pd.DataFrame, least: int = 10) -> None:
    """Set each language's threshold to the margin with the fewest errors, both classes weighing alike.

    Rows are margin, language and how many texts of either class have them (zeros, ones). A language with fewer than
    ``least`` texts of either class takes the threshold of all.
    """
    if not len(found):
        return

    def threshold(own: pd.DataFrame) -> float:
        own = own.sort_values("margin", kind="stable")
        m, wrong = own.margin.to_numpy(), errors(own)
        good = np.flatnonzero(wrong <= wrong.min() + 1e-12)
        cut = int(good[len(good) // 2])
        return float((m[max(cut - 1, 0)] + m[min(cut, len(m) - 1)]) / 2)

    everywhere = threshold(found)
    for g in range(len(MARKS)):
        own = found[found.language == g]
        enough = len(own) and min(own.ones.sum(), own.zeros.sum()) >= least
        model.thresholds[g] = threshold(own) if enough else everywhere


def candidates(counts: pd.DataFrame) -> pd.DataFrame:
    """Of the rows (language, step, zeros, ones) those in which the fewest errors of a language, or of all texts, can be.

    Within a step errors fall by its zeros at most, so a step that stays above the fewest at any step's end has none of them.
    Both neighbours of a cut with the fewest errors lie in steps that are kept.
    """
    everywhere = counts.groupby("step", as_index=False)[["zeros", "ones"]].sum()
    kept = []
    for own in (everywhere, *(own for _, own in counts.groupby("language"))):
        own = own.sort_values("step")
        wrong = errors(own)
        own = own[wrong[:-1] - own.zeros.to_numpy() / max(own.zeros.sum(), 1) <= wrong.min() + 1e-9]
        kept.append(counts.merge(own[["step"]] if "language" not in own else own[["language", "step"]]))
    return pd.concat(kept)[["language", "step"]].drop_duplicates()


def margins(model: Model, parts: DataFrame, n: int, held: bool | None = None) -> pd.DataFrame:
    """Margin, language and number of texts of either class (zeros, ones), by text.

    If they are many, texts in whose step no threshold can lie are one row of their step and language, at its least margin;
    calibrate() finds the same thresholds as by text.
    """
    shared = parts.sparkSession.sparkContext.broadcast(tuple(getattr(model, f.name) for f in fields(model)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for _, row in parts_of(batches):
            texts, y, languages, ids = unpacked(row, held)
            found = np.array([own.margin(t, np.array([len(t)]))[0] for t in texts], np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(y.astype(np.int64)), pa.array(languages.astype(np.int32)), pa.array(found)], ["id", "ones", "language", "margin"])

    found = parts.mapInArrow(task, "id long, ones long, language int, margin float")
    by_text = lambda rows: rows.toPandas().sort_values(["id", "ones", "language"], kind="stable").assign(zeros=lambda rows: 1 - rows.ones)
    if n <= EXACT:
        return by_text(found)
    found = stored(found).withColumn("step", F.floor(F.col("margin").cast("double") * GRID))
    counts = found.groupBy("language", "step").agg(F.sum(1 - F.col("ones")).alias("zeros"), F.sum("ones").alias("ones"), F.min("margin").alias("margin")).toPandas()
    near = candidates(counts)
    whole = by_text(found.join(F.broadcast(parts.sparkSession.createDataFrame(near.astype({"language": int, "step": int}), "language int, step long")), ["language", "step"]))
    rest = counts.merge(near, how="left", indicator=True).query("_merge == 'left_only'")
    return pd.concat([whole, rest])[["margin", "language", "zeros", "ones"]]


def tokens(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label_id: str = "doc_id", label: str = "toxic", rows: int = ROWS) -> Model | None:
    """A model fitted on all labelled documents, about ``rows`` of them in a task.

    One in five of them, by a hash of the id, is kept from training and sets the thresholds. Null ids, labels other than 0
    and 1 and labels without a document are left out; without both classes there is no model.
    """
    clean = labels.select(column(label_id).cast("long").alias("_id"), column(label).cast("int").alias("_label")).where("_id IS NOT NULL AND _label IN (0, 1)")

    named = docs.select(column(doc_id).cast("long").alias("_id"), F.coalesce(column(text).cast("string"), F.lit("")).alias("_text")).where("_id IS NOT NULL")
    last = (F.crc32(F.concat(F.lit("calibrate "), F.col("_id").cast("string"))) % 5 == 0).alias("last")
    n, chars = np.zeros((2, 2), np.int64), 0
    sizes = named.select("_id", F.length("_text").cast("long").alias("chars")).join(clean, "_id").groupBy(last, "_label").agg(F.count("*"), F.sum("chars"))
    for side, value, count, size in sizes.collect():
        n[int(side), value] = count
        chars += size
    if not n.sum(axis=0).all():
        return None
    # where either side lacks a class, all rows take its place
    used, held = (False if n[0].all() else None), (True if n[1].all() else None)
    own = n.sum(axis=0) if used is None else n[0]
    number = int(max(-(-own.sum() // rows), -(-chars // CHARS), 1))
    with small_batches(docs.sparkSession):
        parts = packed(labelled(named, clean, clean.count()), clean, number)
    model = trained(parts, own, used)
    calibrate(model, margins(model, parts, int((n.sum() if held is None else n[1].sum())), held))
    return model


def scores(model: Model | None, texts: list[str | None]) -> np.ndarray:
    """Probability of toxicity of each whole text; 0.5 is its language's threshold. Without a model all get 0."""
    if model is None:
        return np.zeros(len(texts))
    found = []
    for run in slices((((tokens(t)),) for t in texts), RUN, lambda r: len(r[0])):
        words = [w for (w,) in run]
        lengths = np.array([len(w) for w in words])
        margins = model.margin(hashed([x for w in words for x in w]), lengths)
        found.append(sigmoid(margins - model.thresholds[[language(w) for w in words]]))
    return np.concatenate(found) if found else np.zeros(0)


def score(model: Model | None, text: Column) -> Column:
    """Toxicity of each whole text as a column; null counts as empty.

    The model is broadcast as plain values, so that workers need no class of this package to read it.
    """
    plain = tuple(getattr(model, f.name) for f in fields(model)) if model else None
    shared = SparkSession.getActiveSession().sparkContext.broadcast(plain)

    @pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(scores(Model(*shared.value) if shared.value else None, texts.tolist()))
    return scored(F.coalesce(text.cast("string"), F.lit("")))
