"""Document flow: lead times, dossiers and citations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from plenaria.functions.dates import days_between
from plenaria.functions.numbers import cut, fixed_bin, percentage
from plenaria.operators.aggregates import quantiles
from plenaria.rules.fixed import FIRST_SIGNATORY, LIFESPAN_EDGES, LIFESPAN_LABELS


def lead_days(start: Column, end: Column, keep_negative: bool = False) -> Column:
    """Days from start to end; a negative lead time is invalid and NULL."""
    days = days_between(start, end)
    return days if keep_negative else F.when(days >= 0, days)


def lead_time_stats(rows: DataFrame, by: Sequence[str], days: str, probs: Mapping[str, float] | None = None,
                    within: int = 7, min_rows: int = 1) -> DataFrame:
    """Count, mean, quantiles and share within a number of days per group.

    Lead times are whole days, so quantiles come from counts per day.
    """
    valid = rows.where(F.col(days).isNotNull())
    base = valid.groupBy(*by).agg(
        F.count(F.lit(1)).alias("aantal"), F.round(F.avg(days), 2).alias("gemiddelde"),
        percentage(F.count(F.when(F.col(days) <= within, 1)), F.count(F.lit(1))).alias("pct_binnen"))
    spots = quantiles(valid, by, days, probs or {"mediaan": 0.5, "p90": 0.9}, few_values=True)
    return base.where(F.col("aantal") >= min_rows).join(spots, list(by))


def first_signatories(actors: DataFrame, relation: str = "relatie") -> DataFrame:
    return actors.where(F.col(relation) == FIRST_SIGNATORY)


def publication_chain(documents: DataFrame, versions: DataFrame, publications: DataFrame) -> DataFrame:
    """Documents with their versions' publication dates and the three lead times in days."""
    v = versions.select(F.col("id").alias("document_versie_id"), F.col("document_id").alias("id"))
    p = publications.select("document_versie_id", "publicatie_datum").where(F.col("publicatie_datum").isNotNull())
    rows = (documents.where(F.col("datum_registratie").isNotNull() & F.col("datum_ontvangst").isNotNull())
            .join(v, "id").join(p, "document_versie_id"))
    return rows.select(
        F.col("id").alias("document_id"), "document_versie_id", "publicatie_datum",
        days_between(F.col("datum_registratie"), F.col("datum_ontvangst")).alias("dagen_registratie_ontvangst"),
        days_between(F.col("datum_ontvangst"), F.col("publicatie_datum")).alias("dagen_ontvangst_publicatie"),
        days_between(F.col("datum_registratie"), F.col("publicatie_datum")).alias("dagen_registratie_publicatie"))


def dossier_span(documents: DataFrame, dossier: str = "kamerstukdossier_id", day: str = "datum") -> DataFrame:
    """Documents per dossier, first and last day, lifespan in days and its class."""
    spans = (documents.where(F.col(dossier).isNotNull() & F.col(day).isNotNull()).groupBy(dossier)
             .agg(F.count(F.lit(1)).alias("documenten"), F.min(day).alias("eerste"), F.max(day).alias("laatste")))
    days = days_between(F.col("eerste"), F.col("laatste"))
    return spans.withColumn("looptijd", days).withColumn("klasse", cut(F.col("looptijd"), LIFESPAN_EDGES, LIFESPAN_LABELS))


def lifespan_classes(spans: DataFrame) -> DataFrame:
    return spans.groupBy("klasse").agg(F.count(F.lit(1)).alias("dossiers"))


def lifespan_by_status(spans: DataFrame, status: str) -> DataFrame:
    """Count, mean, median and longest lifespan per status."""
    base = spans.groupBy(status).agg(F.count(F.lit(1)).alias("dossiers"), F.round(F.avg("looptijd"), 2).alias("gemiddelde"),
                                     F.max("looptijd").alias("langste"))
    return base.join(quantiles(spans, [status], "looptijd", {"mediaan": 0.5}, few_values=True), status)


def largest(spans: DataFrame, order: str, key: str, n: int = 10) -> DataFrame:
    return spans.orderBy(F.col(order).desc(), F.col(key).asc()).limit(n)


def most_cited(citations: DataFrame, n: int = 20, cited: str = "bron_document_id") -> DataFrame:
    counts = citations.groupBy(cited).agg(F.count(F.lit(1)).alias("verwijzingen"))
    return counts.orderBy(F.col("verwijzingen").desc(), F.col(cited).asc()).limit(n)


def cited_kinds(citations: DataFrame, documents: DataFrame, kind: str = "soort", cited: str = "bron_document_id") -> DataFrame:
    """How often each kind of document is a source.

    Citations are counted per document first, so a much-cited document joins as one row.
    """
    counts = citations.groupBy(cited).agg(F.count(F.lit(1)).alias("_n"))
    kinds = documents.select(F.col("id").alias(cited), F.col(kind))
    return counts.join(kinds, cited).groupBy(kind).agg(F.sum("_n").alias("als_bron"))


def citing_share(citations: DataFrame, documents: DataFrame, citing: str = "document_id") -> DataFrame:
    """Citations, documents with a citation, all documents and the share that cites."""
    counts = citations.agg(F.count(F.lit(1)).alias("vermeldingen"), F.countDistinct(citing).alias("met_bron"))
    total = documents.agg(F.count(F.lit(1)).alias("_n")).scalar()
    return counts.select("*", total.alias("documenten")).withColumn("pct_met_bron", percentage(F.col("met_bron"), F.col("documenten")))


def several_sources(citations: DataFrame, citing: str = "document_id") -> DataFrame:
    return citations.groupBy(citing).agg(F.count(F.lit(1)).alias("bronnen")).where("bronnen > 1")


def citations_per_year(citations: DataFrame, day: str) -> DataFrame:
    return citations.groupBy(F.year(day).cast("bigint").alias("jaar")).agg(F.count(F.lit(1)).alias("vermeldingen"))


def delay_histogram(rows: DataFrame, days: str, width: int = 100) -> DataFrame:
    """Documents per fixed-width class of delay."""
    lower = fixed_bin(F.col(days), width).cast("bigint")
    return rows.where(F.col(days).isNotNull()).groupBy(lower.alias("vanaf")).agg(F.count(F.lit(1)).alias("aantal"))
