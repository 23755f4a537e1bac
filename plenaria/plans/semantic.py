"""A small semantic view: named dimensions and metrics over related tables.

The view is declared once and queried by names. Each metric is computed at the grain of its own
table before metrics meet, so a metric of a parent table is not multiplied by its children.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plenaria.operators.references import resolve_fk
from plenaria.rules.fixed import MEMBER_FUNCTION


@dataclass(frozen=True)
class Relationship:
    """``child.column`` refers to the primary key of ``parent``."""

    child: str
    column: str
    parent: str


@dataclass(frozen=True)
class Metric:
    """``count_distinct`` or ``sum`` of a column of a table."""

    table: str
    kind: str
    column: str


class SemanticView:
    """Tables with primary keys, child-to-parent relationships, dimensions and metrics."""

    def __init__(self, tables: Mapping[str, tuple[DataFrame, str]], relationships: Sequence[Relationship],
                 dimensions: Mapping[str, tuple[str, str]], metrics: Mapping[str, Metric]):
        self.tables, self.relationships = dict(tables), list(relationships)
        self.dimensions, self.metrics = dict(dimensions), dict(metrics)
        for r in self.relationships:
            if r.child not in self.tables or r.parent not in self.tables or r.column not in self.tables[r.child][0].columns:
                raise ValueError(f"relationship {r} names an unknown table or column")
        for name, (table, column) in self.dimensions.items():
            if table not in self.tables or column not in self.tables[table][0].columns:
                raise ValueError(f"dimension {name} names an unknown table or column")
        for name, metric in self.metrics.items():
            if metric.table not in self.tables or metric.kind not in ("count_distinct", "sum"):
                raise ValueError(f"metric {name} is not defined on a known table")
        for table in self.tables:
            self._path(table, set(self.tables), ())

    def _path(self, table: str, wanted: set[str], seen: tuple[str, ...]) -> None:
        if table in seen:
            raise ValueError(f"relationships form a cycle at {table}")
        for r in self.relationships:
            if r.child == table:
                self._path(r.parent, wanted, (*seen, table))

    def _reaches(self, start: str, goal: str) -> list[Relationship] | None:
        """Child-to-parent steps from one table up to another."""
        if start == goal:
            return []
        for r in (x for x in self.relationships if x.child == start):
            rest = self._reaches(r.parent, goal)
            if rest is not None:
                return [r, *rest]
        return None

    def _base(self, needed: set[str], grain: str) -> str:
        """The highest table from which all needed tables are reached going up."""
        options = [t for t in self.tables if all(self._reaches(t, n) is not None for n in needed)]
        if not options:
            raise ValueError(f"no table relates {sorted(needed)}")
        return min(options, key=lambda t: (t != grain, sum(len(self._reaches(t, n)) for n in needed)))

    def _flat(self, needed: set[str], grain: str) -> DataFrame:
        base = self._base(needed, grain)
        steps = list(dict.fromkeys(s for n in sorted(needed) for s in self._reaches(base, n)))

        def named(table: str) -> DataFrame:
            frame = self.tables[table][0]
            return frame.select(*[F.col(c).alias(f"{table}__{c}") for c in frame.columns])

        flat, joined = named(base), {base}
        while steps:
            step = next(s for s in steps if s.child in joined)
            steps.remove(step)
            key = self.tables[step.parent][1]
            flat = flat.join(named(step.parent), F.col(f"{step.child}__{step.column}") == F.col(f"{step.parent}__{key}"), "left")
            joined.add(step.parent)
        return flat

    def query(self, dimensions: Sequence[str] = (), metrics: Sequence[str] = (), where: Mapping[str, object] | None = None,
              facts: Sequence[str] = (), order_by: Sequence[tuple[str, bool]] = (), limit: int | None = None) -> DataFrame:
        """Metrics by dimensions.

        ``where`` filters dimensions before aggregation, with a value, a list or a function from
        Column to Column. ``facts`` are ``table.column`` values returned row by row, without
        metrics. ``order_by`` holds (name, ascending) pairs and, like ``limit``, applies last.
        """
        where = dict(where or {})
        if not dimensions and not metrics and not facts:
            raise ValueError("name at least one dimension, metric or fact")
        unknown = [n for n in [*dimensions, *where] if n not in self.dimensions] + [m for m in metrics if m not in self.metrics]
        if unknown:
            raise ValueError(f"unknown names: {', '.join(unknown)}")
        if facts and metrics:
            raise ValueError("facts and metrics cannot be combined")
        by = {name: F.col("__".join(self.dimensions[name])).alias(name) for name in dimensions}

        def filtered(needed: set[str], grain: str) -> DataFrame:
            flat = self._flat(needed | {self.dimensions[n][0] for n in [*dimensions, *where]}, grain)
            for name, choice in where.items():
                column = F.col("__".join(self.dimensions[name]))
                if callable(choice):
                    flat = flat.where(choice(column))
                else:
                    flat = flat.where(column.isin(list(choice)) if isinstance(choice, (list, tuple, set)) else column == F.lit(choice))
            return flat

        if not metrics:
            named = [f.split(".", 1) for f in facts]
            needed = {t for t, _ in named} | {self.dimensions[n][0] for n in dimensions}
            grain = named[0][0] if named else self.dimensions[dimensions[0]][0]
            rows = filtered(needed, grain).select(*by.values(), *[F.col(f"{t}__{c}").alias(c) for t, c in named])
            result = rows if facts else rows.distinct()
        else:
            parts = [self._metric(name, filtered, by) for name in metrics]
            result = reduce(lambda a, b: self._meet(a, b, list(dimensions)), parts)
        if order_by:
            result = result.orderBy(*[F.col(n).asc_nulls_last() if up else F.col(n).desc_nulls_last() for n, up in order_by])
        return result if limit is None else result.limit(limit)

    def _metric(self, name: str, filtered, by: Mapping[str, Column]) -> DataFrame:
        metric = self.metrics[name]
        table, key = metric.table, self.tables[metric.table][1]
        flat = filtered({table}, table)
        value, row = F.col(f"{table}__{metric.column}"), F.col(f"{table}__{key}")
        if metric.kind == "count_distinct":
            return flat.groupBy(*by.values()).agg(F.countDistinct(value).alias(name))
        # one row per (dimensions, key of the metric's table), then sum
        single = flat.where(row.isNotNull()).groupBy(*by.values(), row.alias("_key")).agg(F.first(value).alias("_v"))
        return single.groupBy(*by).agg(F.sum("_v").alias(name))

    @staticmethod
    def _meet(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
        if not keys:
            return left.select("*", *[right.select(c).scalar().alias(c) for c in right.columns])
        renamed = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
        condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
        joined = left.join(renamed, condition, "full")
        return joined.select(*[F.coalesce(F.col(k), F.col(f"_k_{k}")).alias(k) for k in keys],
                             *[c for c in left.columns + right.columns if c not in keys])


def current_members(people: DataFrame, function: str = "functie") -> DataFrame:
    return people.where(F.col(function) == MEMBER_FUNCTION)


def active_factions(factions: DataFrame, end: str = "datum_inactief") -> DataFrame:
    return factions.where(F.col(end).isNull())


def open_seat_holders(seat_persons: DataFrame, members: DataFrame, end: str = "tot_en_met") -> DataFrame:
    """Running seat holdings of current members."""
    return resolve_fk(seat_persons.where(F.col(end).isNull()), "persoon_id", members, mode="drop")


def held_seats(seats: DataFrame, holders: DataFrame) -> DataFrame:
    """Seats that have a current holder."""
    return seats.join(holders.select(F.col("fractie_zetel_id").alias("_seat")), F.col("id") == F.col("_seat"), "left_semi")


def faction_view(tables: Mapping[str, DataFrame]) -> SemanticView:
    """Current factions, their seats and holders, ready to query by name."""
    people = current_members(tables["persoon"])
    holders = open_seat_holders(tables["fractie_zetel_persoon"], people)
    seats = held_seats(tables["fractie_zetel"], holders)
    return SemanticView(
        {"fractie": (active_factions(tables["fractie"]), "id"), "zetel": (seats, "id"),
         "houder": (holders, "id"), "persoon": (people, "id")},
        [Relationship("zetel", "fractie_id", "fractie"), Relationship("houder", "fractie_zetel_id", "zetel"),
         Relationship("houder", "persoon_id", "persoon")],
        {"FractieId": ("fractie", "id"), "FractieAfkorting": ("fractie", "afkorting"), "FractieNaam": ("fractie", "naam_nl"),
         "FractieDatumActief": ("fractie", "datum_actief"), "FractieAantalZetels": ("fractie", "aantal_zetels"),
         "FractieAantalStemmen": ("fractie", "aantal_stemmen"), "ZetelFunctie": ("houder", "functie"), "ZetelVan": ("houder", "van"),
         "PersoonId": ("persoon", "id"), "PersoonAchternaam": ("persoon", "achternaam"), "PersoonRoepnaam": ("persoon", "roepnaam"),
         "PersoonVoornamen": ("persoon", "voornamen"), "PersoonGeslacht": ("persoon", "geslacht"),
         "PersoonGeboortedatum": ("persoon", "geboortedatum"), "PersoonGeboorteplaats": ("persoon", "geboorteplaats"),
         "PersoonWoonplaats": ("persoon", "woonplaats")},
        {"AantalFracties": Metric("fractie", "count_distinct", "id"), "AantalStemmen": Metric("fractie", "sum", "aantal_stemmen"),
         "AantalZetels": Metric("zetel", "count_distinct", "id"), "AantalPersonen": Metric("houder", "count_distinct", "persoon_id")})
