"""Exact top-k search by term-at-a-time accumulation over blocks of vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from plenaria.llm.common import column

#: Candidates and queries that meet in one task.
CANDIDATES, QUERIES = 2048, 2048


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null if the vector is null or has a null or non-finite component."""
    x = vector.cast("array<double>")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.when(vector.isNotNull() & whole, F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v)))


def postings(vectors: list[np.ndarray]) -> list[tuple[int, np.ndarray | slice, np.ndarray]]:
    """Per term (component number) the rows that hold a weight other than zero, and the weights.

    Shorter vectors have no weight in the terms they lack.
    """
    lengths = np.array([len(v) for v in vectors])
    dense = np.zeros((len(vectors), int(lengths.max(initial=0))), np.int64)
    for row, vector in zip(dense, vectors, strict=True):
        row[: len(vector)] = vector
    found = []
    for term, weights in enumerate(dense.T):
        rows = np.flatnonzero(weights)
        if len(rows):
            full = len(rows) == len(vectors)
            found.append((term, slice(None) if full else rows, np.ascontiguousarray(weights if full else weights[rows])))
    return found


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k highest scores, ties to the earlier row."""
    if len(scores) <= k:
        return np.argsort(-scores, kind="stable")
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    chosen = np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]])
    return chosen[np.lexsort((chosen, -scores[chosen]))]


def unrepeated(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows in order of id; of rows that share an id, the one with the smallest vector."""
    order = sorted(range(len(rows)), key=lambda i: (rows.id.iat[i], tuple(rows.vector.iat[i])))
    return rows.iloc[order].drop_duplicates("id")


def search(queries: DataFrame, candidates: DataFrame, vec_id: str, vector: str, k: int, scale: int = 1024) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k highest integer inner products.

    Components count as floor(scale * x). Ties go to the smaller id; a query never finds its own id. Rows with a null
    id, and vectors that are null or have null or non-finite components, take no part. A row repeated under one id
    counts once, with the smallest vector. Missing components of shorter vectors count as zero, so an empty vector
    scores 0. Empty tables give an empty result.

    Candidates are dealt into blocks by their id, and queries too; each pair of blocks is one group, which scores
    every query against every candidate of the block and keeps k. Those are merged by a ranking per query.
    """
    def whole(df: DataFrame) -> DataFrame:
        rows = df.select(column(vec_id).cast("long").alias("id"), quantised(column(vector), scale).alias("vector"))
        return rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull())

    # counted by id, so that a block holds about as many different vectors
    blocks = [1 + whole(df).agg(F.count("id").alias("n")).first().n // size for df, size in ((candidates, CANDIDATES), (queries, QUERIES))]

    def dealt(df: DataFrame, side: int) -> DataFrame:
        own, other = blocks[side], blocks[1 - side]
        place = F.pmod(F.xxhash64("id"), F.lit(own)).cast("int")
        cells = F.transform(F.sequence(F.lit(0), F.lit(other - 1)), lambda o: (place * other + o) if side == 0 else (o * own + place))
        return whole(df).select("id", "vector", F.explode(cells).alias("cell"))

    def score(_: tuple, found: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        columns = {"query_id": [], "vec_id": [], "score": []}
        if len(found) and len(asked):
            found, asked = unrepeated(found), unrepeated(asked)
            ids, lists = found.id.to_numpy(), postings(list(found.vector))
            for query, weights in zip(asked.id.to_numpy(), asked.vector, strict=True):
                scores = np.zeros(len(ids), np.int64)
                for term, rows, values in lists:
                    if term < len(weights) and weights[term]:
                        scores[rows] += weights[term] * values
                others = np.flatnonzero(ids != query)
                chosen = others[best(scores[others], k)]
                columns["query_id"].append(np.full(len(chosen), query))
                columns["vec_id"].append(ids[chosen])
                columns["score"].append(scores[chosen])
        return pd.DataFrame({name: np.concatenate([np.zeros(0, np.int64), *parts]) for name, parts in columns.items()})

    scored = (dealt(candidates, 0).groupBy("cell").cogroup(dealt(queries, 1).groupBy("cell"))
              .applyInPandas(score, "query_id long, vec_id long, score long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
