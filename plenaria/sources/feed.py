"""Change-feed pages in XML: schema, decoding, paging by cursor and the version log.

A landed page is one Atom file whose ``next`` or ``resume`` link carries the token of the following
page. The cursor is the largest token read so far; it is also what a stream's checkpoint keeps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamReader

from plenaria.functions.text import normalize_bool, snake_case
from plenaria.plans.catalog import ENTITIES, relations_of
from plenaria.plans.conform import BridgeSpec, EntitySpec

# a nil element arrives as empty text, so empty text reads as NULL
XML_OPTIONS = {"rowTag": "feed", "ignoreNamespace": "true", "attributePrefix": "", "nullValue": ""}
TOKEN_PATTERN = r"skiptoken=(\d+)"
_REF = T.StructType().add("ref", "string")
_LINKS = T.ArrayType(T.StructType().add("rel", "string").add("href", "string").add("type", "string"))


def camel(name: str) -> str:
    """``commissie_zetel`` to ``commissieZetel``."""
    head, *rest = name.split("_")
    return head + "".join(w.capitalize() for w in rest)


def _relation_type(bridge: BridgeSpec) -> T.DataType:
    item = T.StructType()
    for path, _ in bridge.targets.values():
        if "." in path:
            item = item.add(path.split(".")[0], _REF)
        else:
            item = item.add(path, "string")
    if bridge.stamp == "item":
        item = item.add("bijgewerkt", "timestamp")
    return T.ArrayType(item)


def log_schema(spec: EntitySpec) -> T.StructType:
    """Columns an entity has in the version log: source fields, references and relations."""
    schema, nested = T.StructType(), {}
    for f in spec.fields:
        if f.kind == "link":
            continue
        if f.kind == "ref":
            schema = schema.add(f.source, _REF)
        elif f.kind == "refs":
            schema = schema.add(f.source, T.ArrayType(_REF))
        elif "." in f.source:
            outer, inner = f.source.split(".")
            nested.setdefault(outer, T.StructType()).add(inner, "string")
            if outer not in schema.names:
                schema = schema.add(outer, nested[outer])
        else:
            schema = schema.add(f.source, "string")
    for relation, bridge in relations_of(spec.name).items():
        schema = schema.add(relation, _relation_type(bridge))
    return schema


def _xml_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(camel(f.name), _xml_type(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_xml_type(kind.elementType))
    return kind


def entry_schema(entities: Sequence[str] | None = None) -> T.StructType:
    """XML schema of one feed entry with a content element per entity kind."""
    content = T.StructType()
    for name in entities or ENTITIES:
        element = (T.StructType().add("id", "string").add("verwijderd", "string").add("bijgewerkt", "timestamp"))
        for f in _xml_type(log_schema(ENTITIES[name])).fields:
            element = element.add(f)
        if "content_type" not in ENTITIES[name].schema.names:
            element = element.add("contentType", "string").add("contentLength", "string")
        content = content.add(camel(name), element)
    return (T.StructType().add("id", "string").add("title", "string").add("updated", "timestamp")
            .add("category", T.StructType().add("term", "string")).add("link", _LINKS).add("content", content))


def page_schema(entities: Sequence[str] | None = None) -> T.StructType:
    return T.StructType().add("link", _LINKS).add("entry", T.ArrayType(entry_schema(entities)))


def page_token(links: Column) -> Column:
    """Token in the page's ``next`` or ``resume`` link, NULL when there is none."""
    onward = F.filter(links, lambda l: l["rel"].isin("next", "resume") & l["href"].rlike(TOKEN_PATTERN))
    href = F.try_element_at(onward, F.lit(1))["href"]
    return F.nullif(F.regexp_extract(href, TOKEN_PATTERN, 1), F.lit("")).cast("bigint")


def _snake_value(value: Column, kind: T.DataType) -> Column:
    """Rebuild a decoded value with the log's snake_case field names."""
    if isinstance(kind, T.StructType):
        parts = [_snake_value(value[camel(f.name)], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _snake_value(x, kind.elementType))
    return value


def _as_text(kind: T.DataType) -> T.DataType:
    """The same structure with text for every value, so that no value keeps a page from decoding."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    return T.ArrayType(_as_text(kind.elementType)) if isinstance(kind, T.ArrayType) else T.StringType()


def decoded(reader: DataFrameReader | DataStreamReader, path: str, entities: Sequence[str] | None = None, strict: bool = True) -> DataFrame:
    """Pages of a reader with their onward token.

    ``strict`` fails on the first value or page that does not decode. Otherwise such a value is NULL in an entry that
    stays, and a page that is no XML has its text in ``_corrupt_record`` and no entries.
    """
    schema = page_schema(entities)
    if strict:
        rows = reader.format("xml").options(**XML_OPTIONS, mode="FAILFAST").schema(schema).load(path)
    else:
        texts = _as_text(schema).add("_corrupt_record", "string")
        read = reader.format("xml").options(**XML_OPTIONS, mode="PERMISSIVE").schema(texts).load(path)
        rows = read.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields], "_corrupt_record")
    return rows.withColumn("token", page_token(F.col("link")))


def pages(spark: SparkSession, path: str, entities: Sequence[str] | None = None, strict: bool = True) -> DataFrame:
    """Landed pages with their onward token, read as ``decoded`` says."""
    return decoded(spark.read, path, entities, strict)


def rejected_pages(spark: SparkSession, path: str, entities: Sequence[str] | None = None) -> DataFrame:
    """File, text and number of entries read (``path, page, entries``) of the landed pages that do not decode as a whole."""
    texts = _as_text(page_schema(entities)).add("_corrupt_record", "string")
    read = spark.read.format("xml").options(**XML_OPTIONS, mode="PERMISSIVE").schema(texts).load(path)
    found = read.select(F.col("_metadata.file_path").alias("path"), F.col("_corrupt_record").alias("page"),
                        F.coalesce(F.size("entry"), F.lit(0)).alias("entries"))
    return found.where("page IS NOT NULL")


def entries(page_rows: DataFrame) -> DataFrame:
    """One row per feed entry with its metadata, category and routed table name."""
    category = F.coalesce(F.col("e.category.term"), F.lit("unknown"))
    return (page_rows.withColumn("e", F.explode("entry"))
            .select("token", F.col("e.id").alias("feed_id"), F.col("e.title").alias("feed_title"),
                    F.col("e.updated").alias("feed_updated"), category.alias("category"),
                    snake_case(category).alias("tabel"), F.col("e.link").alias("atom_links"),
                    F.col("e.content").alias("content")))


def select_pages(page_rows: DataFrame, cursor: int | None = None, max_pages: int | None = None) -> DataFrame:
    """Pages past the cursor in token order, at most ``max_pages``; the last page may lack a token."""
    newer = page_rows if cursor is None else page_rows.where(F.col("token").isNull() | (F.col("token") > cursor))
    if max_pages is None:
        return newer
    return newer.orderBy(F.col("token").asc_nulls_last()).limit(max_pages)


def read_feed(spark: SparkSession, path: str, category: str | None = None, cursor: int | None = None,
              max_pages: int | None = None, entities: Sequence[str] | None = None, strict: bool = True) -> DataFrame:
    """Entries of the landed pages past the cursor, optionally of one category."""
    rows = entries(select_pages(pages(spark, path, entities, strict), cursor, max_pages))
    return rows if category is None else rows.where(F.col("category") == category)


def next_cursor(rows: DataFrame, cursor: int | None = None) -> DataFrame:
    """One row with the cursor to resume from after reading ``rows``."""
    return rows.agg(F.coalesce(F.max("token"), F.lit(cursor).cast("bigint")).alias("cursor"))


def row_id(df: DataFrame) -> Column:
    """Repeatable row id: a digest of the row's full content."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in df.columns])), 256)


def append_log(rows: DataFrame, path: str, load_id: str) -> None:
    """Append entries to the version log, one folder per routed table."""
    rows.withColumn("_row_id", row_id(rows)).withColumn("_load_id", F.lit(load_id)).write.mode("append").partitionBy(
        "tabel").parquet(path)


def entity_log(log: DataFrame, name: str) -> DataFrame:
    """Version-log rows of one entity with snake_case columns, read from its own folder only."""
    spec = ENTITIES[name]
    item = f"content.{camel(name)}"
    declared = log_schema(spec)
    columns = [_snake_value(F.col(f"{item}.{camel(f.name)}"), f.dataType).alias(f.name) for f in declared.fields]
    return log.where(F.col("tabel") == name).select(
        F.col(f"{item}.id").alias("id"), normalize_bool(F.col(f"{item}.verwijderd")).alias("verwijderd"),
        F.col(f"{item}.bijgewerkt").alias("bijgewerkt"), "feed_updated", "feed_id", "atom_links", "_row_id", *columns)


def route(rows: DataFrame, category: str = "category") -> DataFrame:
    """Adds the table name of each row's category; a missing category gives ``raw_entity``."""
    return rows.withColumn("tabel", snake_case(F.coalesce(F.col(category), F.lit("raw_entity"))))


def read_entity_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType, xsd: str | None = None,
                    strict: bool = True) -> DataFrame:
    """Entity elements validated against an XSD file.

    ``strict`` fails on the first invalid element; otherwise invalid ones keep their text in
    ``_corrupt_record``.
    """
    options = {**XML_OPTIONS, "rowTag": row_tag, "mode": "FAILFAST" if strict else "PERMISSIVE"}
    if xsd:
        options["rowValidationXSDPath"] = xsd
    if not strict:
        schema = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
    return spark.read.format("xml").options(**options).schema(schema).load(path)


def clean_names(df: DataFrame) -> DataFrame:
    """Names without namespace prefix or ``@`` at every level; namespace declarations dropped."""
    dropped = {"xmlns", "atom", "ns1", "xsi"}

    def bare(name: str) -> str:
        return name.split(":")[-1].lstrip("@")

    def keep(name: str) -> bool:
        return bare(name) not in dropped and not name.startswith("@xmlns")

    def rebuilt(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.StructType):
            return T.StructType([T.StructField(bare(f.name), rebuilt(f.dataType)) for f in kind.fields if keep(f.name)])
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(rebuilt(kind.elementType))
        return kind

    def value(column: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StructType):
            parts = [value(column.getField(f.name), f.dataType).alias(bare(f.name)) for f in kind.fields if keep(f.name)]
            return F.when(column.isNotNull(), F.struct(*parts)) if parts else F.lit(None).cast(rebuilt(kind))
        if isinstance(kind, T.ArrayType):
            return F.transform(column, lambda x: value(x, kind.elementType))
        return column

    return df.select(*[value(F.col(f"`{f.name}`"), f.dataType).alias(bare(f.name)) for f in df.schema.fields if keep(f.name)])
