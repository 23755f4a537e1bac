"""Classifiers built from the fixed values; every rule list can be replaced by the caller."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

from plenaria.functions import text as T
from plenaria.rules import fixed


def by_like(value: Column, types: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """Label by SQL LIKE patterns on the lower-case text, first match wins."""
    low, steps = F.lower(value), []
    for label, patterns in types:
        hit = low.like(patterns[0])
        for pattern in patterns[1:]:
            hit = hit | low.like(pattern)
        steps.append((hit, label))
    return T.first_match(steps, default)


def committee_type_star(name: Column) -> Column:
    return by_like(name, fixed.COMMITTEE_TYPES_STAR, fixed.COMMITTEE_TYPE_STAR_DEFAULT)


def committee_type_analysis(name: Column) -> Column:
    return by_like(name, fixed.COMMITTEE_TYPES_ANALYSIS, fixed.COMMITTEE_TYPE_ANALYSIS_DEFAULT)


def committee_label(name: Column, abbreviation: Column) -> Column:
    """Short chart label: name without its usual opening, at most 40 characters."""
    label = F.coalesce(name, abbreviation, F.lit("Onbekend"))
    for part, replacement in fixed.COMMITTEE_LABEL_PARTS:
        label = F.replace(label, F.lit(part), F.lit(replacement))
    return F.substring(label, 1, 40)


def normalise_faction(abbreviation: Column, merged: Iterable[str] = fixed.MERGED_ABBREVIATIONS,
                      label: str = fixed.MERGED_FACTION) -> Column:
    return F.when(abbreviation.isin(list(merged)), F.lit(label)).otherwise(abbreviation)


def normalise_faction_name(name: Column) -> Column:
    return F.when(T.any_keyword(F.lower(name), fixed.MERGED_NAME_PARTS), F.lit(fixed.MERGED_NAME)).otherwise(name)


def merged_party_key(key: Column, *labels: Column) -> Column:
    """Network key of a faction: one key for all factions with a merged label, else its own."""
    hit = F.lit(False)
    for label in labels:
        hit = hit | F.coalesce(F.lower(F.trim(label)).isin(list(fixed.MERGED_LABELS)), F.lit(False))
    return F.when(hit, F.lit("merged-pro")).otherwise(key)


def channel(kind: Column) -> Column:
    return T.map_values(F.lower(F.trim(kind)), fixed.MERGED_CHANNELS, kind)


def outcome_by_like(kind: Column) -> Column:
    """Outcome word contained in the decision kind, in any case; NULL when there is none."""
    return T.first_match([(F.contains(F.lower(kind), F.lit(w)), w) for w in fixed.OUTCOMES])


def outcome_by_regex(kind: Column) -> Column:
    """First outcome word in the decision kind (case-sensitive); NULL when there is none."""
    return T.extract_first(kind, fixed.OUTCOME_PATTERN)


def document_group(kind: Column) -> Column:
    return T.map_values(F.trim(kind), fixed.DOCUMENT_GROUPS, fixed.DOCUMENT_GROUP_DEFAULT)


def side_job_sector(description: Column) -> Column:
    return T.classify_like(description, fixed.SIDE_JOB_SECTORS, fixed.SIDE_JOB_DEFAULT)


def openness(closed: Column) -> Column:
    return (F.when(closed, fixed.OPENNESS[True]).when(~closed, fixed.OPENNESS[False]).otherwise(fixed.OPENNESS[None]))


def _filled(text: Column) -> Column:
    cleaned = T.clean_text(text)
    return text.isNotNull() & ~cleaned.isin(T.PLACEHOLDERS)


def institution_level(institution: Column, rules: Sequence[tuple[str, str]] = fixed.EDUCATION_INSTITUTION) -> Column:
    found = T.classify(T.clean_text(institution), [T.Rule(a, b) for a, b in rules])
    return F.when(_filled(institution), found)


def education_level(education: Column, institution: Column,
                    text_rules: Sequence[tuple[str, str]] = fixed.EDUCATION_TEXT,
                    institution_rules: Sequence[tuple[str, str]] = fixed.EDUCATION_INSTITUTION,
                    not_completed: str = fixed.NOT_COMPLETED) -> Column:
    """``struct(categorie, bron, status)``: level from the text, else from the institution."""
    rules = [T.Rule(a, b) for a, b in text_rules]

    def read(cleaned: Column) -> Column:
        given = education.isNotNull() & ~cleaned.isin(T.PLACEHOLDERS)
        return F.struct(F.when(given, T.classify(cleaned, rules)).alias("tekst"), institution_level(institution, institution_rules).alias("plek"),
                        given.alias("gegeven"), (given & cleaned.rlike(T.UNICODE + not_completed)).alias("open"))

    def conclude(found: Column) -> Column:
        fallback = F.when(found["gegeven"], fixed.SECTOR_NONE).otherwise(fixed.SECTOR_UNKNOWN)
        source = F.when(found["tekst"].isNotNull(), "tekst").when(found["plek"].isNotNull(), "instelling").otherwise("geen")
        status = F.when(found["open"], "niet_voltooid").otherwise("voltooid")
        return F.struct(F.coalesce(found["tekst"], found["plek"], fallback).alias("categorie"), source.alias("bron"), status.alias("status"))

    # the cleaned text and the rule results are each used several times but computed once
    return T.once(T.once(T.clean_text(education), read), conclude)


def canonical_institution(institution: Column, names: Sequence[tuple[str, str]] = fixed.UNIVERSITIES) -> Column:
    """Canonical university name; other institutions keep their own text."""
    own = F.trim(institution)
    known = T.classify(T.clean_text(institution), [T.Rule(a, b) for a, b in names], own)
    return F.when(_filled(institution), F.when(institution_level(institution) == "wo", known).otherwise(own))


def career_text(function: Column, employer: Column) -> Column:
    return F.lower(F.concat(F.coalesce(function, F.lit("")), F.lit(" | "), F.coalesce(employer, F.lit(""))))


def career_sector(function: Column, employer: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Sector of a job by ordered (label, pattern) rules over "function | employer".

    The support sector needs a political context, and membership is skipped for staff functions.
    The rule list is a parameter: load it from a rules table, see ``rules_from``.
    """
    text = career_text(function, employer)
    own = F.lower(F.coalesce(function, F.lit("")))
    guards = {
        fixed.SUPPORT_SECTOR: text.rlike(T.UNICODE + fixed.POLITICAL_CONTEXT),
        fixed.MEMBER_SECTOR: ~(own.rlike(T.UNICODE + fixed.STAFF_FUNCTION) & ~own.rlike(T.UNICODE + fixed.TRUE_MEMBER)),
    }
    found = T.classify(text, [T.Rule(a, b, guards.get(a)) for a, b in rules], fixed.SECTOR_NONE)
    return F.when(F.length(F.trim(F.replace(text, F.lit("|"), F.lit(" ")))) == 0, fixed.SECTOR_UNKNOWN).otherwise(found)


def rules_from(table) -> list[tuple[str, str]]:
    """Ordered (label, pattern) rules from a small table with ``volgorde, label, patroon``."""
    rows = table.select("volgorde", "label", "patroon").orderBy("volgorde").limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("a rule table holds at most 1000 rules")
    return [(r["label"], r["patroon"]) for r in rows]
