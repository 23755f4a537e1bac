"""Increments, merges with deletes and cascading deletes as new table versions.

Plain Parquet tables have no in-place update, so each function returns the next version of the
table; the caller writes it beside the old one and then moves the release pointer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from plenaria.session import stored


def increment(df: DataFrame, target: DataFrame, changed: str) -> DataFrame:
    """Rows newer than anything in the target; everything when the target is empty."""
    mark = target.agg(F.max(changed).alias("_mark")).scalar()
    return df.where(mark.isNull() | (F.col(changed) > mark))


def retrigger(df: DataFrame, target: DataFrame, changed: str, fk: str, referenced: DataFrame,
              referenced_key: str, referenced_changed: str) -> DataFrame:
    """Increment that also takes rows whose referenced entity changed after the target's mark."""
    mark = target.agg(F.max(changed).alias("_mark")).scalar()
    touched = (referenced.where(mark.isNull() | (F.col(referenced_changed) > mark))
               .select(F.col(referenced_key).alias("_touched")).distinct())
    joined = df.join(touched, F.col(fk) == F.col("_touched"), "left")
    return joined.where(mark.isNull() | (F.col(changed) > mark) | F.col("_touched").isNotNull()).drop("_touched")


def merge_versions(target: DataFrame, source: DataFrame, keys: Sequence[str], deleted_keys: DataFrame | None = None,
                   delete_missing: bool = False, status: str | None = None) -> DataFrame:
    """Next version of ``target``: source rows replace or extend it, deleted keys leave.

    Both sides hold one row per key. ``deleted_keys`` lists keys whose latest version is deleted;
    ``delete_missing`` also removes target rows that the source does not have. ``status`` adds a
    column telling what happened: new, changed or same.
    """
    columns = target.columns
    values = [c for c in columns if c not in keys]
    old = target.select(F.struct(*columns).alias("t"))
    new = source.select(F.struct(*columns).alias("s"))
    condition = F.lit(True)
    for k in keys:
        condition = condition & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    joined = old.join(new, condition, "right" if delete_missing else "full")
    kept = F.when(F.col("s").isNotNull(), F.col("s")).otherwise(F.col("t"))
    same = F.lit(True)
    for c in values:
        same = same & F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
    what = (F.when(F.col("t").isNull(), "new")
            .when(F.col("s").isNull() | same, "same").otherwise("changed"))
    merged = joined.select(kept.alias("_row"), what.alias(status or "_what")).select("_row.*", *([status] if status else []))
    if deleted_keys is None:
        return merged
    gone = deleted_keys.select(*[F.col(k).alias(f"_d_{k}") for k in keys])
    match = F.lit(True)
    for k in keys:
        match = match & (F.col(k) == F.col(f"_d_{k}"))
    return merged.join(gone, match, "left_anti")


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    parent_key: str = "id"


def _delete_order(foreign_keys: Sequence[ForeignKey], root: str) -> tuple[list[str], bool]:
    """Tables below the root, parents first, and whether that order is free of cycles."""
    reached = [root]
    for table in reached:
        reached += dict.fromkeys(f.child for f in foreign_keys if f.parent == table and f.child not in reached)
    below = [t for t in reached if t != root]
    inner = [f for f in foreign_keys if f.parent in below and f.child in below and f.parent != f.child]
    order: list[str] = []
    while len(order) < len(below):
        ready = [t for t in below if t not in order and all(f.parent in order for f in inner if f.child == t)]
        if not ready:
            return order + [t for t in below if t not in order], False
        order += ready
    return order, not any(f.parent == f.child for f in foreign_keys if f.parent in reached)


def _links(rows: DataFrame, key: str, reference: str) -> DataFrame:
    """Key and reference, nothing else of a row."""
    return stored(rows.select(F.col(key).alias("_gone"), F.col(reference).alias("_to")).where("_gone IS NOT NULL AND _to IS NOT NULL"))


def _doomed_below(links: DataFrame, keys: DataFrame) -> DataFrame:
    """The given keys and all whose chain of references leads to one: a chain of d links takes log2(d) rounds.

    In each round a key whose reference is doomed is doomed, and every other key's reference is
    replaced by its reference's own. Keys whose chain has ended leave, so each round reads less.
    Chains that run in a circle end when references have been followed further than there are keys.
    """
    doomed, rest, reach, most = [keys], links, 1, links.count()
    left = most
    while left and reach <= 2 * most:
        known = reduce(DataFrame.unionByName, doomed).withColumnRenamed("_gone", "_known")
        judged = stored(rest.join(known.distinct(), F.col("_to") == F.col("_known"), "left").select("_gone", "_to", F.col("_known").isNotNull().alias("_hit")))
        hit, open_ = judged.where("_hit").select("_gone"), judged.where("NOT _hit").select("_gone", "_to")
        onward = judged.select(F.col("_gone").alias("_at"), F.col("_to").alias("_next"), "_hit")
        # a reference that is doomed itself stays and is seen in the next round
        moved = open_.join(onward, F.col("_to") == F.col("_at")).select("_gone", F.when(F.col("_hit"), F.col("_to")).otherwise(F.col("_next")).alias("_to"))
        rest = stored(moved)
        doomed, reach, left = [*doomed, hit], 2 * reach, rest.count()
    return stored(reduce(DataFrame.unionByName, doomed).distinct())


def _doomed_in_order(tables: Mapping[str, DataFrame], edges: Sequence[ForeignKey], order: Sequence[str], root: str,
                     keys: DataFrame, primary_keys: Mapping[str, str]) -> dict[str, DataFrame]:
    """Doomed keys of every table, parents first: each reference between tables is followed once."""
    doomed: dict[str, DataFrame] = {}
    for child in [root, *order]:
        pk = primary_keys.get(child, "id")
        parts = [keys] if child == root else []
        if pk in tables[child].columns:
            parts += [tables[child].join(doomed[fk.parent], F.col(fk.column) == F.col("_gone"), "left_semi").select(F.col(pk).alias("_gone"))
                      for fk in edges if fk.child == child and fk.parent in doomed]
        if not parts:
            continue
        doomed[child] = keys if child == root else stored(reduce(DataFrame.unionByName, parts).distinct())
        own = [fk for fk in edges if fk.child == fk.parent == child]
        if len(own) == 1:
            doomed[child] = _doomed_below(_links(tables[child], pk, own[0].column), doomed[child])
        elif own:
            doomed[child] = _doomed_in_rounds(tables, own, child, doomed[child], primary_keys)[child]
    return doomed


def _doomed_in_rounds(tables: Mapping[str, DataFrame], edges: Sequence[ForeignKey], root: str, keys: DataFrame,
                      primary_keys: Mapping[str, str]) -> dict[str, DataFrame]:
    """Doomed keys of every table where references run in circles.

    A round follows only the keys that the last one found, along links (key and reference, nothing
    else of a row) that no round has followed yet. What is followed leaves the links, so every round
    reads less than the one before.
    """
    links = {fk: _links(tables[fk.child], primary_keys.get(fk.child, "id"), fk.column) for fk in edges if primary_keys.get(fk.child, "id") in tables[fk.child].columns}
    doomed, fresh = {root: [keys]}, {root: keys}
    while fresh:
        found: dict[str, list[DataFrame]] = {}
        for fk in [f for f in links if f.parent in fresh]:
            last = fresh[fk.parent].withColumnRenamed("_gone", "_last")
            found.setdefault(fk.child, []).append(links[fk].join(last, F.col("_to") == F.col("_last"), "left_semi").select("_gone"))
        after = {}
        for child, parts in found.items():
            new = reduce(DataFrame.unionByName, parts).distinct()
            for known in doomed.get(child, []):
                new = new.join(known, "_gone", "left_anti")
            new = stored(new)
            if not new.isEmpty():
                after[child] = new
        for fk in [f for f in links if f.parent in fresh]:
            links[fk] = stored(links[fk].join(fresh[fk.parent].withColumnRenamed("_gone", "_last"), F.col("_to") == F.col("_last"), "left_anti"))
        for child, new in after.items():
            parts = [*doomed.get(child, []), new]
            # few parts keep the plan small; they grow like the rounds, so storing them again is rare
            doomed[child] = parts if len(parts) < 8 else [stored(reduce(DataFrame.unionByName, parts))]
        fresh = after
    return {t: reduce(DataFrame.unionByName, parts) for t, parts in doomed.items()}


def cascade_delete(tables: Mapping[str, DataFrame], foreign_keys: Sequence[ForeignKey], root: str, keys: DataFrame,
                   root_key: str = "id", primary_keys: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Delete root rows and, over the declared references, every row that depends on them.

    Doomed keys are collected parents first, those of a table that refers to itself by jumps along
    its chains; references that run in a circle of tables are followed in rounds from the keys found
    last. A reference from a lower table's parent back to the root is
    emptied, not followed. Returns the remaining rows of every table. Tables without a
    single-column key (bridges) only lose rows themselves.
    """
    primary_keys = {root: root_key, **(primary_keys or {})}
    order, acyclic = _delete_order([f for f in foreign_keys if f.child != f.parent], root)
    reached = {root, *order}
    edges = [f for f in foreign_keys if f.parent in reached and (f.child != root or f.parent == root)]
    back = [f for f in foreign_keys if f.child == root and f.parent in order]
    start = stored(keys.select(F.col(keys.columns[0]).alias("_gone")).distinct())
    doomed = (_doomed_in_order(tables, edges, order, root, start, primary_keys) if acyclic
              else _doomed_in_rounds(tables, edges, root, start, primary_keys))
    result = dict(tables)
    for table in [root, *order]:
        df = tables[table]
        if table == root:
            df = df.join(doomed[root], F.col(root_key) == F.col("_gone"), "left_anti")
        for fk in (e for e in edges if e.child == table and e.parent in doomed):
            df = df.join(doomed[fk.parent], F.col(fk.column) == F.col("_gone"), "left_anti")
        for fk in (e for e in back if e.child == table and e.parent in doomed):
            joined = df.join(doomed[fk.parent], F.col(fk.column) == F.col("_gone"), "left")
            df = joined.select(*[
                F.when(F.col("_gone").isNull(), F.col(c)).alias(c) if c == fk.column else F.col(c) for c in df.columns])
        result[table] = df
    return result
