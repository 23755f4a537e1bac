"""Conform entities and bridges: current, live, typed rows out of the version log.

Version-log frames hold nested columns: a single reference is ``struct<ref>``, a relation is
``array<struct<ref>>``, links are ``array<struct<rel, href>>``. A parent's relations travel inside
its row, so the relations of older versions vanish with those versions and need no join.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, functions as F, types as T

from plenaria.functions.dates import parse_partial_date
from plenaria.operators.quality import Check, enforce_contract
from plenaria.operators.references import resolve_fk
from plenaria.operators.versioned import drop_deleted, feed_order, latest_version

TYPES: dict[str, T.DataType] = {
    "str": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "bool": T.BooleanType(),
    "date": T.DateType(), "ts": T.TimestampNTZType(), "utc": T.TimestampType(), "dec": T.DecimalType(18, 2),
}


@dataclass(frozen=True)
class Field:
    """One conformed column.

    ``kind``: a type name, ``start``/``end`` (partial date), ``ref`` (reference), ``refs`` (first
    reference of a relation) or ``link`` (address of the enclosure link).
    """

    name: str
    kind: str
    source: str
    parent: str | None = None

    def outputs(self) -> list[tuple[str, T.DataType]]:
        if self.kind in ("start", "end"):
            return [(self.name, TYPES["date"]), (f"{self.name}_ruw", TYPES["str"]), (f"{self.name}_precisie", TYPES["str"])]
        return [(self.name, TYPES.get(self.kind, TYPES["str"]))]

    def metadata(self, column: str) -> dict:
        """What is declared about one of the field's columns: a comment, and the table it refers to."""
        if self.parent:
            return {"comment": f"id in {self.parent}, empty if that has none", "references": self.parent, "source": self.source}
        if self.kind in ("start", "end"):
            bound = "first" if self.kind == "start" else "last"
            part = {f"{self.name}_ruw": "as it is written in the source", f"{self.name}_precisie": "how precise the written date is"}
            return {"comment": part.get(column, f"{bound} day of the written date"), "source": self.source}
        if self.kind == "link":
            return {"comment": "address of the enclosed file", "source": self.source}
        kinds = {"int": "whole number", "long": "whole number", "bool": "flag", "date": "day", "ts": "local time", "utc": "time", "dec": "amount"}
        return {"comment": kinds.get(self.kind, "text"), "source": self.source}

    def columns(self) -> list[Column]:
        source = F.col(self.source)
        if self.kind in ("start", "end"):
            parsed = parse_partial_date(source, self.kind == "end")
            return [parsed["datum"].alias(self.name), source.alias(f"{self.name}_ruw"),
                    parsed["precisie"].alias(f"{self.name}_precisie")]
        if self.kind == "ref":
            return [F.col(f"{self.source}.ref").alias(self.name)]
        if self.kind == "refs":
            return [F.array_max(F.transform(source, lambda r: r["ref"])).alias(self.name)]
        if self.kind == "link":
            found = F.filter(source, lambda l: l["rel"] == "enclosure")
            return [F.array_max(F.transform(found, lambda l: l["href"])).alias(self.name)]
        return [source.cast(TYPES[self.kind]).alias(self.name)]


@dataclass(frozen=True)
class EntitySpec:
    name: str
    fields: tuple[Field, ...]
    accepted: Mapping[str, tuple[str, ...]]

    @property
    def schema(self) -> T.StructType:
        """Columns with their types and, as metadata, comment, key, reference and accepted values."""
        found = [T.StructField("id", TYPES["str"], metadata={"comment": f"id of the {self.name}", "key": True})]
        for f in self.fields:
            for name, kind in f.outputs():
                listed = {"accepted": list(self.accepted[name])} if name in self.accepted else {}
                found.append(T.StructField(name, kind, metadata=f.metadata(name) | listed))
        changed = {"gewijzigd_op": "when the source changed this version", "api_gewijzigd_op": "when the feed published this version"}
        return T.StructType(found + [T.StructField(n, TYPES["utc"], metadata={"comment": c}) for n, c in changed.items()])

    @property
    def references(self) -> dict[str, str]:
        return {f.name: f.parent for f in self.fields if f.parent}

    def checks(self) -> list[Check]:
        found = [Check(self.name, "unique", ("id",))]
        found += [Check(self.name, "not_null", (c,)) for c in ("id", "gewijzigd_op", "api_gewijzigd_op")]
        found += [Check(self.name, "relationship", (c,), parent=p) for c, p in self.references.items()]
        found += [Check(self.name, "accepted", (c,), values=v) for c, v in self.accepted.items()]
        return found


@dataclass(frozen=True)
class BridgeSpec:
    """Pairs (owner id, related id) from the owner's relation; see ``conform_bridge``."""

    name: str
    owner: str
    relation: str
    owner_id: str
    targets: Mapping[str, tuple[str, str]]  # output column -> (path in the relation item, parent table)
    stamp: str = "owner"                    # or "item": the relation item carries its own change time
    ordered: bool = False

    @property
    def key(self) -> tuple[str, ...]:
        return (self.owner_id, "volgorde") if self.ordered else (self.owner_id, *self.targets)

    def checks(self) -> list[Check]:
        found = [Check(self.name, "primary_key", self.key),
                 Check(self.name, "relationship", (self.owner_id,), parent=self.owner)]
        return found + [Check(self.name, "relationship", (c,), parent=p) for c, (_, p) in self.targets.items()]


@lru_cache(maxsize=None)
def entity(name: str, layout: str, accepted: tuple[tuple[str, tuple[str, ...]], ...] = ()) -> EntitySpec:
    """Build a spec from a one-line layout of blank-separated columns.

    ``a`` text, ``a:int`` typed, ``a~`` / ``a~end`` partial date, ``a_id>parent`` reference named
    after the column, ``a_id>>parent`` the same out of a relation, ``a@`` enclosure link;
    ``a=path`` before the mark reads another source column.
    """
    fields = []
    for word in layout.split():
        column, parent, kind = word, None, "str"
        if ">" in word:
            column, parent = word.split(">", 1)
            kind = "refs" if parent.startswith(">") else "ref"
            parent = parent.lstrip(">")
            fields.append(Field(column, kind, column.removesuffix("_id"), parent))
            continue
        if "~" in word:
            column, mark = word.split("~")
            kind = "end" if mark else "start"
        elif word.endswith("@"):
            fields.append(Field(word[:-1], "link", "atom_links"))
            continue
        elif ":" in word:
            column, kind = word.split(":")
        column, _, source = column.partition("=")
        fields.append(Field(column, kind, source or column))
    return EntitySpec(name, tuple(fields), dict(accepted) | {
        f"{f.name}_precisie": ("dag", "maand", "jaar", "week", "week_dag") for f in fields if f.kind in ("start", "end")})


def current(bronze: DataFrame) -> DataFrame:
    """Latest version per id, without ids whose latest version is deleted."""
    return drop_deleted(latest_version(bronze, ["id"], feed_order()))


def current_children(children: DataFrame, parents: DataFrame, parent_row: str = "_parent_id",
                     row_id: str = "_row_id") -> DataFrame:
    """Flat child rows that belong to a current parent version, with the parent's id."""
    owners = parents.select(F.col("id").alias("ouder_id"), F.col(row_id).alias("_owner"))
    return children.join(owners, F.col(parent_row) == F.col("_owner")).drop("_owner")


def conform_entity(bronze: DataFrame, parents: Mapping[str, DataFrame], spec: EntitySpec) -> DataFrame:
    """Typed current rows of one entity with checked references, in contract order."""
    columns = [c for f in spec.fields for c in f.columns()]
    rows = current(bronze).select(
        "id", *columns, F.col("bijgewerkt").alias("gewijzigd_op"), F.col("feed_updated").alias("api_gewijzigd_op"))
    for column, parent in spec.references.items():
        rows = resolve_fk(rows, column, parents[parent])
    return enforce_contract(rows, spec.schema)


def conform_bridge(bronze: DataFrame, targets: Mapping[str, DataFrame], spec: BridgeSpec) -> DataFrame:
    """Pairs from the current version of each owner whose other end is a live entity.

    The owner end needs no check: conformed owners are exactly the current, live versions.
    Duplicate references are removed inside the relation, before rows are made.
    """
    owners = current(bronze)
    paths = {c: path for c, (path, _) in spec.targets.items()}
    item = spec.relation

    def pick(x: Column, path: str) -> Column:
        for part in path.split("."):
            x = x[part]
        return x

    if spec.ordered:
        exploded = owners.select(F.col("id").alias(spec.owner_id), F.posexplode(item).alias("volgorde", "_x"), "feed_updated")
        rows = exploded.select(spec.owner_id, "volgorde", *[pick(F.col("_x"), p).alias(c) for c, p in paths.items()],
                               F.col("feed_updated").alias("relatie_gewijzigd_op"))
        for column, (_, parent) in spec.targets.items():
            rows = resolve_fk(rows, column, targets[parent], mode="drop_given")
        return rows
    (column, path), = paths.items()
    if spec.stamp == "item":
        rows = (owners.select(F.col("id").alias(spec.owner_id), F.explode(item).alias("_x"))
                .select(spec.owner_id, pick(F.col("_x"), path).alias(column), F.col("_x.bijgewerkt").alias("_at"))
                .where(F.col(column).isNotNull())
                .groupBy(spec.owner_id, column).agg(F.max("_at").alias("relatie_gewijzigd_op")))
    else:
        refs = F.array_distinct(F.transform(F.col(item), lambda x: pick(x, path)))
        rows = (owners.select(F.col("id").alias(spec.owner_id), F.explode(refs).alias(column),
                              F.col("feed_updated").alias("relatie_gewijzigd_op"))
                .where(F.col(column).isNotNull()))
    return resolve_fk(rows, column, targets[spec.targets[column][1]], mode="drop")


def conform_all(bronze: Mapping[str, DataFrame], entities: Mapping[str, EntitySpec], bridges: Mapping[str, BridgeSpec],
                materialise=lambda name, df: df) -> dict[str, DataFrame]:
    """Conform every entity, parents first, then every bridge.

    ``materialise(name, frame)`` may write the frame and return the written table, so that later
    entities read finished parents. A reference that points back up the order (a document's current
    version) is checked against the current versions of that entity's log instead.
    """
    done: dict[str, DataFrame] = {}
    for name, spec in entities.items():
        parents = {p: done[p] if p in done else current(bronze[p]).select("id") for p in set(spec.references.values())}
        done[name] = materialise(name, conform_entity(bronze[name], parents, spec))
    for name, spec in bridges.items():
        done[name] = materialise(name, conform_bridge(bronze[spec.owner], done, spec))
    return done
