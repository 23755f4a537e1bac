"""All conformed tables from version logs that are derived from the events by a rule, with SQL made by the same rule.

Event number ``e`` is a version of entity ``e % 37``; ``k = e // 37`` counts the versions of an entity and three in a row
belong to one id. Every field has a value that follows from ``k`` and the field's place, empty in one of five.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from plenaria.plans.catalog import BRIDGES, ENTITIES, relations_of
from plenaria.plans.conform import BridgeSpec, EntitySpec, Field, conform_all
from plenaria.queries import Tables, query
from plenaria.session import stored
from plenaria.sources.feed import log_schema

_N = len(ENTITIES)
_STAMP = "yyyy-MM-dd HH:mm:ss"


def _own(spec: EntitySpec, field: Field) -> int:
    """Place of a field: of the first with its source, so that one source has one value."""
    return next(j for j, f in enumerate(spec.fields) if f.source == field.source)


# ---- the log --------------------------------------------------------------------------------
_DAY = "date_format(date_add(DATE '2000-01-01', CAST(k % 3000 AS INT)), 'yyyy-MM-dd')"


def _ref(j: int) -> str:
    """An id near the version's own; the first of all is no id."""
    return f"concat('e', CAST(floor(k / 3) + {j % 3 - 1} AS STRING))"


def _field(spec: EntitySpec, field: Field) -> str:
    j = _own(spec, field)
    if field.kind == "ref":
        return f"if((k + {j}) % 5 <> 0, named_struct('ref', {_ref(j)}), NULL)"
    if field.kind == "refs":
        return f"array(named_struct('ref', {_ref(j)}), named_struct('ref', {_ref(j + 1)}))"
    partial = f"if((k + {j}) % 2 = 0, {_DAY}, CAST(1900 + k % 100 AS STRING))"
    value = {"str": f"concat('t', CAST((k + {j}) % 11 AS STRING))", "int": f"CAST((k * {j + 1}) % 1000 AS STRING)", "long": f"CAST((k * {j + 1}) % 1000 AS STRING)",
             "bool": f"if((k + {j}) % 2 = 0, 'true', 'false')", "date": _DAY, "ts": f"concat({_DAY}, ' 10:00:00')", "dec": "concat(CAST(k % 100000 AS STRING), '.5')",
             "start": partial, "end": partial}[field.kind]
    return f"if((k + {j}) % 5 <> 0, {value}, NULL)"


def _relation(bridge: BridgeSpec, kind: T.ArrayType) -> str:
    """Three items: two of one id and one of the next, with their own change time where the relation has one."""
    def item(j: int) -> str:
        parts = []
        for n, f in enumerate(kind.elementType.fields):
            if f.name == "bijgewerkt":
                value = f"CAST(ts + INTERVAL {j} HOURS AS TIMESTAMP)"
            else:
                # of two targets an item names one
                value = _ref(j // 2) if len(bridge.targets) == 1 or j % 2 == n else "CAST(NULL AS STRING)"
                value = f"named_struct('ref', {value})" if isinstance(f.dataType, T.StructType) else value
            parts.append(f"'{f.name}', {value}")
        return f"named_struct({', '.join(parts)})"

    return f"array({', '.join(item(j) for j in range(3))})"


def _log(events: DataFrame, number: int, spec: EntitySpec) -> DataFrame:
    by_source = {f.source: _field(spec, f) for f in spec.fields if f.kind != "link"}
    relations = relations_of(spec.name)
    columns = []
    for f in log_schema(spec).fields:
        if f.name in by_source:
            value = by_source[f.name]
        elif f.name in relations:
            value = _relation(relations[f.name], f.dataType)
        else:
            inner = ", ".join(f"'{g.name}', {by_source[f'{f.name}.{g.name}']}" for g in f.dataType.fields)
            value = f"named_struct({inner})"
        columns.append(f"{value} AS {f.name}")
    links = "array(named_struct('rel', 'self', 'href', 's', 'type', 'x'), named_struct('rel', 'enclosure', 'href', concat('h', CAST(k AS STRING)), 'type', 'x')) AS atom_links"
    own = events.where(f"event_id % {_N} = {number}").selectExpr("*", f"event_id div {_N} AS k")
    return own.selectExpr("concat('e', CAST(floor(k / 3) AS STRING)) AS id", "event_type = 'error' AS verwijderd", "CAST(ts AS TIMESTAMP) AS bijgewerkt", "CAST(ts AS TIMESTAMP) AS feed_updated",
                          "'f' AS feed_id", links, "lpad(CAST(event_id AS STRING), 12, '0') AS _row_id", *columns)


# ---- the same in SQL ------------------------------------------------------------------------
_DAY_SQL = "strftime(DATE '2000-01-01' + CAST(k % 3000 AS INTEGER), '%Y-%m-%d')"


def _ref_sql(j: int) -> str:
    return f"'e' || (k // 3 + {j % 3 - 1})"


def _columns_sql(spec: EntitySpec, f: Field) -> list[str]:
    """The conformed columns of a field as text, as they are compared."""
    j = _own(spec, f)
    given = f"(k + {j}) % 5 <> 0"
    if f.kind == "ref":
        return [f"CASE WHEN {given} AND {_ref_sql(j)} IN (SELECT id FROM c_{f.parent}) THEN {_ref_sql(j)} END AS {f.name}"]
    if f.kind == "refs":
        return [f"CASE WHEN greatest({_ref_sql(j)}, {_ref_sql(j + 1)}) IN (SELECT id FROM c_{f.parent}) THEN greatest({_ref_sql(j)}, {_ref_sql(j + 1)}) END AS {f.name}"]
    if f.kind == "link":
        return [f"'h' || k AS {f.name}"]
    if f.kind in ("start", "end"):
        year = f"(1900 + k % 100) || '-{'01-01' if f.kind == 'start' else '12-31'}'"
        whole = f"(k + {j}) % 2 = 0"
        return [f"CASE WHEN {given} THEN CASE WHEN {whole} THEN {_DAY_SQL} ELSE {year} END END AS {f.name}",
                f"CASE WHEN {given} THEN CASE WHEN {whole} THEN {_DAY_SQL} ELSE (1900 + k % 100)::VARCHAR END END AS {f.name}_ruw",
                f"CASE WHEN {given} THEN CASE WHEN {whole} THEN 'dag' ELSE 'jaar' END END AS {f.name}_precisie"]
    value = {"str": f"'t' || ((k + {j}) % 11)", "int": f"((k * {j + 1}) % 1000)::VARCHAR", "long": f"((k * {j + 1}) % 1000)::VARCHAR",
             "bool": f"CASE WHEN (k + {j}) % 2 = 0 THEN 'true' ELSE 'false' END", "date": _DAY_SQL, "ts": f"{_DAY_SQL} || ' 10:00:00'", "dec": "(k % 100000) || '.50'"}[f.kind]
    return [f"CASE WHEN {given} THEN {value} END AS {f.name}"]


def _bridge_sql(bridge: BridgeSpec) -> str:
    owner, stamp = bridge.owner, "strftime(ts, '%Y-%m-%d %H:%M:%S')"
    if bridge.ordered:
        (a, (_, parent_a)), (b, (_, parent_b)) = bridge.targets.items()
        items = f"SELECT id AS {bridge.owner_id}, j AS volgorde, CASE WHEN j % 2 = 0 THEN 'e' || (k // 3 + j // 2 - 1) END AS {a}, CASE WHEN j % 2 = 1 THEN 'e' || (k // 3 + j // 2 - 1) END AS {b}, {stamp} AS relatie_gewijzigd_op FROM c_{owner}, generate_series(0, 2) g(j)"
        return f"SELECT * REPLACE (volgorde::VARCHAR AS volgorde) FROM ({items}) WHERE ({a} IS NULL OR {a} IN (SELECT id FROM c_{parent_a})) AND ({b} IS NULL OR {b} IN (SELECT id FROM c_{parent_b}))"
    (column, (_, parent)), = bridge.targets.items()
    if bridge.stamp == "item":
        stamp = "strftime(max(ts + to_hours(CAST(j AS INTEGER))), '%Y-%m-%d %H:%M:%S')"
    else:
        stamp = "strftime(max(ts), '%Y-%m-%d %H:%M:%S')"
    return (f"SELECT id AS {bridge.owner_id}, 'e' || (k // 3 + j // 2 - 1) AS {column}, {stamp} AS relatie_gewijzigd_op FROM c_{owner}, generate_series(0, 2) g(j) "
            f"WHERE 'e' || (k // 3 + j // 2 - 1) IN (SELECT id FROM c_{parent}) GROUP BY 1, 2")


def _summary_sql(table: str, columns: list[str]) -> str:
    """Per column how many values it has, the least and the largest, and a sum over their digests."""
    return " UNION ALL ".join(f"SELECT '{table}' AS tabel, '{c}' AS kolom, count(*) AS rijen, count({c}) AS gevuld, min({c}) AS kleinste, max({c}) AS grootste, "
                              f"coalesce(sum(CAST('0x' || md5({c})[1:6] AS BIGINT)), 0)::BIGINT AS som FROM t_{table}" for c in columns)


def _sql() -> str:
    parts, ends = [], []
    for i, (name, spec) in enumerate(ENTITIES.items()):
        parts.append(f"c_{name} AS (SELECT * FROM (SELECT event_id, ts, event_type, event_id // {_N} AS k, 'e' || (event_id // {_N} // 3) AS id FROM events WHERE event_id % {_N} = {i}) "
                     "QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) = 1)")
        parts[-1] = parts[-1].replace("c_" + name + " AS (SELECT *", f"c_{name} AS (SELECT * FROM (SELECT *", 1) + " WHERE event_type <> 'error')"
    for name, spec in ENTITIES.items():
        columns = [c for f in spec.fields for c in _columns_sql(spec, f)]
        stamps = "strftime(ts, '%Y-%m-%d %H:%M:%S') AS gewijzigd_op, strftime(ts, '%Y-%m-%d %H:%M:%S') AS api_gewijzigd_op"
        parts.append(f"t_{name} AS (SELECT id, {', '.join([*columns, stamps])} FROM c_{name})")
        ends.append(_summary_sql(name, spec.schema.names))
    for name, bridge in BRIDGES.items():
        parts.append(f"t_{name} AS ({_bridge_sql(bridge)})")
        ends.append(_summary_sql(name, [bridge.owner_id, *(["volgorde"] if bridge.ordered else []), *bridge.targets, "relatie_gewijzigd_op"]))
    return f"WITH {', '.join(parts)} {' UNION ALL '.join(ends)}"


def _summary(name: str, df: DataFrame) -> DataFrame:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    text = {c: f"date_format({c}, '{_STAMP}')" if isinstance(k, (T.TimestampType, T.TimestampNTZType)) else f"CAST({c} AS STRING)" for c, k in kinds.items()}
    cells = ", ".join(f"struct('{c}' AS kolom, count({c}) AS gevuld, min({x}) AS kleinste, max({x}) AS grootste, "
                      f"coalesce(sum(CAST(conv(substring(md5({x}), 1, 6), 16, 10) AS BIGINT)), 0L) AS som)" for c, x in text.items())
    return df.selectExpr("count(1) AS rijen", f"array({cells}) AS cellen").selectExpr(f"'{name}' AS tabel", "rijen", "inline(cellen)")


def _union(frames: list[DataFrame]) -> DataFrame:
    """All frames as a balanced tree, which plans faster than a chain."""
    half = len(frames) // 2
    return frames[0] if len(frames) == 1 else _union(frames[:half]).unionAll(_union(frames[half:]))


@query("d3_catalogue", _sql())
def catalogue(t: Tables):
    """All 37 entities and 16 bridges out of their logs, with references checked against the finished parents."""
    events = t.events
    logs = {name: _log(events, i, spec) for i, (name, spec) in enumerate(ENTITIES.items())}
    tables = conform_all(logs, ENTITIES, BRIDGES, lambda _, df: stored(df))
    return _union([_summary(name, df) for name, df in tables.items()])
