"""Fill-in-middle transformation: a text's prefix, middle and suffix written in another order with sentinels."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from plenaria.llm.common import slices, texts_of

#: A unit is a run of ASCII letters or any other single character, so units cover every text without gaps.
UNIT = "[A-Za-z]+|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, PLAIN, SPM = 1, 10, 20
#: Code points of texts that are put into one Arrow batch.
POINTS = 2_000_000
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four unsigned 32-bit numbers that depend on the id and the seed alone; a null id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def rewritten(doc_id: int | None, text: str, units: regex.Pattern, seed: int = SEED, plain: int = PLAIN, spm: int = SPM) -> tuple:
    """Number of units, form, code points of prefix and middle (None if plain) and output of one text.

    One fullmatch of ``(unit)*`` keeps the end of every repetition: their number is the number of units, and the end of
    the k-th is the offset at which k units end.
    """
    ends = units.fullmatch(text).ends(1)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= 100 - plain or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (first, last))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: str = UNIT, seed: int = SEED, plain: int = PLAIN, spm: int = SPM) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output of every row.

    ``plain`` percent of the texts, empty texts and texts that hold a sentinel stay as they are (form ``plain``, no
    cuts); of the others ``spm`` percent put the suffix first. The two cuts fall on ends of units and depend on the id
    and the seed alone. ``unit`` is a pattern whose repetition covers any text.

    Null text is empty; a null id draws as an empty id; repeated rows are rows of their own with equal outputs; an
    empty table gives an empty result; other columns are left out and may have any name.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(f"({unit})*")
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for run in slices(rows, POINTS, lambda r: len(r[1])):
                n, form, prefix, middle, output = zip(*(rewritten(i, t, units, seed, plain, spm) for i, t in run), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _ in run], pa.int64()), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return texts_of(docs, doc_id, text).mapInArrow(task, SCHEMA)


def restored(form: Column, output: Column) -> Column:
    """The original text, rebuilt from a form and its output alone.

    No sentinel can begin inside another or across its edge, and a text with a sentinel stays plain; so the first
    occurrence of each sentinel is the one that was written.
    """
    def between(start: Column, end: Column | None = None) -> Column:
        return F.substring(output, start, F.length(output) if end is None else end - start)

    p, s, m = (F.locate(x, output) for x in (PREFIX, SUFFIX, MIDDLE))
    psm = F.concat(between(p + len(PREFIX), s), between(m + len(MIDDLE)), between(s + len(SUFFIX), m))
    spm = F.concat(between(p + len(PREFIX), m), between(m + len(MIDDLE)), between(s + len(SUFFIX), p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)

