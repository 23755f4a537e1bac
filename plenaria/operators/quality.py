"""Contracts, constraint checks and column profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from plenaria.functions.numbers import percentage
from plenaria.functions.text import PLACEHOLDERS, is_placeholder
from plenaria.operators.reshape import melt


class ContractError(ValueError):
    """A table does not have the declared columns or types."""


def enforce_contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in declared order with their comments; raises on any difference.

    Column order of the input is free; names and types must match exactly.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    problems = [f"missing {n}" for n in want if n not in have] + [f"undeclared {n}" for n in have if n not in want]
    problems += [f"{n}: {have[n].simpleString()} instead of {t.simpleString()}"
                 for n, t in want.items() if n in have and have[n] != t]
    if problems:
        raise ContractError("; ".join(problems))
    return df.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in schema.fields])


def contract_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per declared column whether a frame has it, with which type, and whether it carries the declared metadata.

    Metadata are the column's comment, key and reference. All comes from the schemas; no row is read.
    """
    have = {f.name: f for f in df.schema.fields}
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.metadata.get("comment"), f.name in have, f.name in have and have[f.name].dataType == f.dataType,
             f.name in have and have[f.name].metadata == f.metadata) for i, f in enumerate(schema.fields)]
    return df.sparkSession.createDataFrame(rows, "volgnummer int, kolom string, type string, toelichting string, aanwezig boolean, type_ok boolean, metadata_ok boolean")


@dataclass(frozen=True)
class Check:
    """One declared test: kind is not_null, unique, accepted, relationship, primary_key or rule."""

    table: str
    kind: str
    columns: tuple[str, ...]
    values: tuple = ()
    parent: str | None = None
    parent_key: str = "id"
    condition: Column | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.table}.{'+'.join(self.columns)}"


def _failures(column_check: Check) -> Column:
    c = F.col(column_check.columns[0])
    if column_check.kind == "not_null":
        return F.count(F.when(c.isNull(), 1))
    if column_check.kind == "accepted":
        return F.count(F.when(c.isNotNull() & ~c.isin(list(column_check.values)), 1))
    return F.count(F.when(column_check.condition, 1))


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("aantal")).where("aantal > 1")


def orphans(df: DataFrame, fk: str, parent: DataFrame, parent_key: str = "id") -> DataFrame:
    """Rows whose given reference has no parent."""
    keys = parent.select(F.col(parent_key).alias("_parent"))
    return df.where(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_parent"), "left_anti")


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Number of failures per check. Row-level checks of one table share a single scan."""
    parts = []
    rows = [c for c in checks if c.kind in ("not_null", "accepted", "rule")]
    for table in dict.fromkeys(c.table for c in rows):
        own = [c for c in rows if c.table == table]
        counted = tables[table].agg(*[_failures(c).alias(f"c{i}") for i, c in enumerate(own)])
        cells = F.array(*[F.struct(F.lit(c.name).alias("controle"), F.col(f"c{i}").alias("fouten")) for i, c in enumerate(own)])
        parts.append(counted.select(F.explode(cells).alias("x")).select("x.*"))
    for c in checks:
        if c.kind in ("unique", "primary_key"):
            bad = duplicate_keys(tables[c.table].where(F.col(c.columns[0]).isNotNull()) if c.kind == "unique" else tables[c.table], c.columns)
        elif c.kind == "relationship":
            bad = orphans(tables[c.table], c.columns[0], tables[c.parent], c.parent_key)
        else:
            continue
        parts.append(bad.agg(F.count(F.lit(1)).alias("fouten")).select(F.lit(c.name).alias("controle"), "fouten"))
    result = reduce(DataFrame.unionByName, parts)
    return result.withColumn("ok", F.col("fouten") == 0)


def expected_counts(actual: DataFrame, expected: Mapping[str, int], name: str = "naam", count: str = "werkelijk") -> DataFrame:
    """Compare named counts with expected ones."""
    wanted = F.create_map(*[F.lit(x) for pair in expected.items() for x in pair])
    return actual.select(name, count, F.try_element_at(wanted, F.col(name)).cast("bigint").alias("verwacht")).withColumn(
        "ok", F.col(count) == F.col("verwacht"))


def anomalies(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """How many rows meet each named condition, in one scan."""
    counted = df.agg(*[F.count(F.when(c, 1)).alias(n) for n, c in rules.items()])
    return melt(counted, [], list(rules), "controle", "aantal")


def digests(*columns: Column) -> list[Column]:
    """Two 64-bit hashes of a combination of values, which stand for it in a shuffle; NULL is a value of its own."""
    told = [x for c in columns for x in (c.isNull(), c)]
    return [F.xxhash64(*told).alias("_k1"), F.xxhash64(F.lit("second"), *told).alias("_k2")]


def profile(df: DataFrame, placeholders: Sequence[str] = PLACEHOLDERS, digits: int = 1) -> DataFrame:
    """Per column: rows, empty, placeholder texts, share filled and distinct values.

    One scan makes a cell per column and row, which is reduced to two 64-bit hashes and flags before
    anything is grouped: cells that are equal combine in their task, and no text is shuffled, however
    long it is. Distinct values are counted by their hashes.
    """
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    long = melt(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]), [], df.columns, "kolom", "_v")
    is_text = F.col("kolom").isin(sorted(text)) if text else F.lit(False)
    cells = long.select("kolom", *digests(F.col("_v")), F.col("_v").isNull().alias("_leeg"), (is_text & is_placeholder(F.col("_v"), placeholders)).alias("_p"))
    values = cells.groupBy("kolom", "_k1", "_k2", "_leeg").agg(F.count(F.lit(1)).alias("_n"), F.max("_p").alias("_p"))
    summary = values.groupBy("kolom").agg(
        F.sum("_n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("_leeg"), F.col("_n"))), F.lit(0)).alias("leeg"),
        F.coalesce(F.sum(F.when(F.col("_p"), F.col("_n"))), F.lit(0)).alias("placeholder"),
        F.count(F.when(~F.col("_leeg"), 1)).alias("uniek"))
    filled = F.col("n") - F.col("leeg") - F.col("placeholder")
    return summary.withColumn("pct_gevuld", percentage(filled, F.col("n"), digits))


def dominant_value(df: DataFrame, column: str, threshold: float = 0.8, digits: int = 1) -> DataFrame:
    """The most frequent value of a column with its share and whether it dominates."""
    counts = df.groupBy(F.col(column).alias("waarde")).agg(F.count(F.lit(1)).alias("aantal"))
    top = counts.orderBy(F.col("aantal").desc(), F.col("waarde").asc_nulls_last()).limit(1)
    total = df.agg(F.count(F.lit(1)).alias("_n")).scalar()
    return top.select(F.lit(column).alias("kolom"), "waarde", "aantal",
                      percentage(F.col("aantal"), total, digits).alias("aandeel"),
                      (F.col("aantal") >= total * threshold).alias("dominant"))


def duplicate_candidates(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Value combinations shared by several keys: how many, and the first and last key.

    Rows are grouped by two 64-bit hashes of the combination and the key, so the values themselves,
    which may be whole texts, are no shuffle key. Only hashes that several keys share take their
    rows' values along, and there equal values are confirmed.
    """
    told = df.select(*digests(*[F.col(c) for c in columns]), F.col(key).alias("_key"))
    several = (told.distinct().groupBy("_k1", "_k2").agg(F.count("_key").alias("_n")).where("_n > 1").select("_k1", "_k2"))
    rows = df.select(*digests(*[F.col(c) for c in columns]), *columns, F.col(key).alias("_key")).join(several, ["_k1", "_k2"], "left_semi")
    # one row per key of a candidate, with the same hashes in one place; different values with the same hashes stay apart
    packed = F.struct(*columns)
    per_key = rows.groupBy("_k1", "_k2", "_key").agg(F.min(packed).alias("_v"), F.max(packed).alias("_w"))
    same = per_key.where(F.col("_v") == F.col("_w")).groupBy("_k1", "_k2").agg(
        F.count("_key").alias("aantal"), F.min("_key").alias("eerste"), F.max("_key").alias("laatste"), F.min("_v").alias("_v"))
    return same.where("aantal > 1").select(*[F.col(f"_v.{c}").alias(c) for c in columns], "aantal", "eerste", "laatste")


def ambiguous_keys(df: DataFrame, key: str, target: str) -> DataFrame:
    """Keys that point to more than one target."""
    return df.groupBy(key).agg(F.countDistinct(target).alias("aantal")).where("aantal > 1")


def assert_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Guard before a lookup join: raise when the key repeats, else return the frame."""
    if duplicate_keys(df, columns).limit(1).count():
        raise ContractError(f"{columns} is not unique")
    return df
