"""Quality classifier: boosted trees over statistics of whole texts."""

from __future__ import annotations

import operator
import unicodedata
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.functions import pandas_udf

from plenaria.llm import boosting
from plenaria.llm.common import column, kept, slices

#: At most so many labelled rows are used to fit, and code points in a run of texts.
FIT_ROWS, POINTS = 20_000, 2_000_000
KINDS = ["upper", "lower", "digit", "space", "line", "stop", "bang", "bar", "symbol", "other"]


def _kinds() -> np.ndarray:
    """Kind of each code point of the first plane; later ones count as other."""
    def kind(c: str) -> str:
        category = unicodedata.category(c)
        if c in "\n.!|":
            return {"\n": "line", ".": "stop", "!": "bang", "|": "bar"}[c]
        if c in ",;:?'\"()-":
            return "stop"
        return {"Lu": "upper", "Ll": "lower", "Nd": "digit", "Zs": "space"}.get(category, "symbol" if category[0] in "PSC" else "other")
    return np.array([KINDS.index(kind(chr(i))) for i in range(0x10000)], np.uint8)


def statistics(texts: list[str]) -> np.ndarray:
    """One row of statistics per text, of characters, words, repetition and lines; an empty text has zeros."""
    table = kept("quality kinds", _kinds)
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    kinds = table[np.minimum(points, 0xFFFF)]
    lengths = np.array([len(t) for t in texts])
    owner = np.repeat(np.arange(len(texts)), lengths)
    counts = np.bincount(owner * len(KINDS) + kinds, minlength=len(texts) * len(KINDS)).reshape(-1, len(KINDS))
    shares = counts / np.maximum(lengths, 1)[:, None]
    rows = []
    for text in texts:
        words, lines = text.split(), text.split("\n")
        n, seen = max(len(words), 1), Counter(words)
        rows.append([
            np.log1p(len(text)), np.log1p(len(words)), sum(map(len, words)) / n, max(map(len, words), default=0), len(seen) / n,
            max(seen.values(), default=0) / n, sum(map(operator.eq, words, words[1:])) / n, len(set(zip(words, words[1:], strict=False))) / n,
            sum(map(str.isalpha, words)) / n, sum(map(str.isupper, words)) / n, sum(map(str.istitle, words)) / n, len(lines) / n, len(set(lines)) / len(lines),
        ])
    return np.column_stack([shares, np.array(rows, float).reshape(len(texts), -1)])


def all_statistics(texts: list[str]) -> np.ndarray:
    parts = [statistics([t for (t,) in run]) for run in slices(((t or "",) for t in texts), POINTS, lambda r: len(r[0]))]
    return np.concatenate(parts) if parts else np.zeros((0, len(KINDS) + 13))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label_id: str = "doc_id", label: str = "quality",
        rows: int = FIT_ROWS) -> boosting.Trees:
    """Trees fitted on at most ``rows`` labelled documents, chosen by a hash of their id.

    Labels other than 0 and 1, null ids and labels without a document are left out. Without any labels the score is
    the same for all texts.
    """
    chosen = (labels.select(column(label_id).cast("long").alias("_id"), column(label).cast("int").alias("_label"))
              .where(F.col("_label").isin(0, 1) & F.col("_id").isNotNull()).orderBy(F.xxhash64("_id"), "_id", "_label").limit(rows))

    @pandas_udf("array<double>")
    def described(texts: pd.Series) -> pd.Series:
        return pd.Series(list(all_statistics(texts.tolist())))

    found = (docs.select(column(doc_id).cast("long").alias("_id"), F.coalesce(column(text), F.lit("")).alias("_text"))
             .join(F.broadcast(chosen), "_id").select(described("_text").alias("x"), "_label").limit(rows).toPandas())
    x = np.stack(found.x.to_list()) if len(found) else np.zeros((0, len(KINDS) + 13))
    order = np.lexsort(x.T) if len(x) else []
    return boosting.fit(x[order], found._label.to_numpy(float)[order])


def score(model: boosting.Trees, text: Column) -> Column:
    """Probability of good quality of each whole text; null counts as empty."""
    @pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(all_statistics(texts.tolist())))
    return scored(F.coalesce(text.cast("string"), F.lit("")))


def accepted(docs: DataFrame, model: boosting.Trees, text: str = "text", least: float = 0.5) -> DataFrame:
    """The documents, all columns kept, whose score is at least ``least``."""
    row = docs.select(F.struct(*(column(c) for c in docs.columns)).alias("_row"), score(model, column(text)).alias("_score"))
    return row.where(F.col("_score") >= least).select("_row.*")
