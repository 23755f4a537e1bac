"""Text cleaning, keys and ordered rule classifiers as Column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, functions as F

# Texts that stand for "nothing filled in".
PLACEHOLDERS = ["", "-", "onbekend", "n.v.t.", "nan", "none", "geen opgave", "geen"]

# Java classes and word boundaries follow Unicode only with this flag.
UNICODE = "(?U)"


def once(value: Column, build: Callable[[Column], Column]) -> Column:
    """``build(value)`` with ``value`` computed a single time, however often ``build`` uses it."""
    return F.transform(F.array(value), build)[0]


@dataclass(frozen=True)
class Rule:
    """One step of an ordered classifier: ``pattern`` (regex) wins ``label`` if ``guard`` holds."""

    label: str
    pattern: str
    guard: Column | None = None


def classify(text: Column, rules: Iterable[Rule], default: Column | str | None = None) -> Column:
    """Label of the first rule that matches ``text``."""
    steps = []
    for rule in rules:
        hit = text.rlike(UNICODE + rule.pattern)
        steps.append((hit if rule.guard is None else hit & rule.guard, rule.label))
    return first_match(steps, default)


def first_match(steps: Iterable[tuple[Column, str]], default: Column | str | None = None) -> Column:
    """CASE over (condition, label) pairs in order."""
    steps = list(steps)
    result = F.when(steps[0][0], F.lit(steps[0][1]))
    for condition, label in steps[1:]:
        result = result.when(condition, F.lit(label))
    if default is None:
        return result
    return result.otherwise(default if isinstance(default, Column) else F.lit(default))


def any_keyword(text: Column, words: Iterable[str]) -> Column:
    """True when any of the words occurs; plain substring search, no regex."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def classify_like(text: Column, groups: Mapping[str, Iterable[str]], default: str | None = None) -> Column:
    """Case-insensitive ``%word%`` classifier; the first group with a hit wins."""
    low = F.lower(text)
    return first_match([(any_keyword(low, words), label) for label, words in groups.items()], default)


def clean_text(text: Column) -> Column:
    """Lower case, no dots or double quotes, blanks squeezed."""
    bare = F.translate(F.lower(text), '."', "")
    return F.trim(F.regexp_replace(bare, UNICODE + r"\s+", " "))


def is_placeholder(text: Column, words: Iterable[str] = PLACEHOLDERS) -> Column:
    return F.lower(F.trim(text)).isin(list(words))


def placeholder_to_null(df: DataFrame, words: Iterable[str] = PLACEHOLDERS) -> DataFrame:
    """NULL instead of placeholder text, on the text columns only."""
    names = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return df.select(*[
        F.when(~is_placeholder(F.col(c), words), F.col(c)).alias(c) if c in names else F.col(c)
        for c in df.columns
    ])


@lru_cache(maxsize=None)
def _fold_table() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Letters that decompose to one ASCII character, and those that decompose to several."""
    source, target, longer = [], [], []
    blocks = [range(0x80, 0x250), range(0x1E00, 0x1F00), range(0xFB00, 0xFB07)]
    for code in (c for block in blocks for c in block):
        char = chr(code)
        if char.lower() != char:
            continue
        plain = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            source.append(char)
            target.append(plain)
        elif plain.strip():
            longer.append((char, plain))
    return "".join(source), "".join(target), tuple(longer)


def fold_letters(text: Column) -> Column:
    """Lower case with accents and ligatures replaced by their plain letters."""
    source, target, longer = _fold_table()
    folded = F.translate(F.lower(text), source, target)
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), longer, folded)


def fold_ascii(text: Column) -> Column:
    """Lower case without accents; characters with no ASCII form are dropped."""
    return F.regexp_replace(fold_letters(text), r"[^\x00-\x7F]+", "")


def place_key(text: Column) -> Column:
    """Search key of a place name: bracketed text removed, accents folded, other signs to blanks."""
    bare = F.regexp_replace(F.lower(text), r"\(.*?\)", " ")
    key = F.trim(F.regexp_replace(fold_ascii(bare), r"[^a-z0-9]+", " "))
    return F.when(~is_placeholder(clean_text(text)), F.nullif(key, F.lit("")))


def room_key(text: Column) -> Column:
    """Search key of a room name: accents folded, letters and digits only."""
    folded = fold_letters(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")))
    return F.regexp_replace(folded, r"[^\p{L}\p{N}]+", "")


def map_values(value: Column, mapping: Mapping[str, str], default: Column | str | None = None) -> Column:
    """Replace by a literal mapping; unmapped values keep ``default`` (the value itself if None)."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    fallback = value if default is None else (default if isinstance(default, Column) else F.lit(default))
    return F.coalesce(F.try_element_at(table, value), fallback)


def snake_case(name: Column) -> Column:
    """``CommissieZetel`` to ``commissie_zetel``."""
    split = F.regexp_replace(name, r"(.)([A-Z][a-z]+)", "$1_$2")
    return F.lower(F.regexp_replace(split, r"([a-z0-9])([A-Z])", "$1_$2"))


def normalize_bool(text: Column) -> Column:
    """Boolean of ``True``/``False`` text in any case; other text gives NULL."""
    return F.lower(text).try_cast("boolean")


def extract_first(text: Column, pattern: str, group: int = 1) -> Column:
    """First regex group, NULL when nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def person_name(*parts: Column) -> Column:
    """Name parts joined by blanks; NULL parts leave no gap."""
    return F.trim(F.concat_ws(" ", *parts))


def resource_url(base: str, key: Column, length: Column) -> Column:
    """Download address, only for items that have content."""
    return F.when(length > 0, F.concat(F.lit(base), key.cast("string"), F.lit("/resource")))
