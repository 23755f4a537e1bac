"""Feed entries checked one by one: good ones for the version log, rejected ones with their reason and text.

Pages are read as text and cut into entries, so one bad entry, or a page that breaks off, costs no other entry. Every
entry of a page comes back once, as good or as rejected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamReader

from plenaria.functions.dates import parse_partial_date
from plenaria.functions.text import normalize_bool, snake_case
from plenaria.plans.catalog import ENTITIES
from plenaria.plans.conform import TYPES, Field
from plenaria.sources import feed

#: Table of the rejected entries in the log.
REJECTED = "afgekeurd"
ENTRY = r"(?s)<(?:\w+:)?entry[\s>].*?</(?:\w+:)?entry\s*>"
CONTENT = r"(?s)<(?:\w+:)?content\b[^>]*>\s*(.*?)\s*</(?:\w+:)?content\s*>"
_OPTIONS = {k: v for k, v in feed.XML_OPTIONS.items() if k != "rowTag"} | {"mode": "PERMISSIVE"}
_BROKEN = "_corrupt_record"
#: Columns of an entry as the log has them, without those of the check.
COLUMNS = ("token", "feed_id", "feed_title", "feed_updated", "category", "tabel", "atom_links", "content")


def page_texts(reader: DataFrameReader | DataStreamReader, path: str) -> DataFrame:
    """Whole landed pages as text, with their file."""
    rows = reader.format("text").option("wholetext", True).load(path)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("page"))


def split_pages(texts: DataFrame) -> DataFrame:
    """``path``, the onward ``token``, the texts of the page's entries, and what is left if that is no XML."""
    shell = texts.select("path", F.regexp_extract_all("page", F.lit(ENTRY), F.lit(0)).alias("entries"), F.regexp_replace("page", ENTRY, "").alias("rest"))
    schema = T.StructType().add("link", feed._LINKS).add(_BROKEN, "string")
    read = shell.withColumn("_shell", F.from_xml("rest", schema, _OPTIONS))
    return read.select("path", feed.page_token(F.col("_shell.link")).alias("token"), "entries", F.when(F.col(f"_shell.{_BROKEN}").isNotNull(), F.col("rest")).alias("broken"))


def _value(field: Field, element: Column) -> Column:
    value = element
    for part in field.source.split("."):
        value = value[feed.camel(part)]
    return value


def _reasons(element: Column, fields: Sequence[Field]) -> list[Column]:
    """A reason per part of an entity that is missing or of another type, NULL for each that is right."""
    found = [F.when(element.isNull(), F.lit("content: missing")),
             F.when(element.isNotNull() & element["id"].isNull(), F.lit("id: missing")),
             F.when(element.isNotNull() & element["bijgewerkt"].try_cast("timestamp").isNull(), F.lit("bijgewerkt: no timestamp")),
             F.when(element["verwijderd"].isNotNull() & normalize_bool(element["verwijderd"]).isNull(), F.lit("verwijderd: no boolean"))]
    for f in fields:
        if f.kind in ("start", "end"):
            value = _value(f, element)
            found.append(F.when(value.isNotNull() & parse_partial_date(value, f.kind == "end")["datum"].isNull(), F.lit(f"{f.source}: no date")))
        elif f.kind in TYPES and f.kind != "str":
            value, kind = _value(f, element), TYPES[f.kind]
            found.append(F.when(value.isNotNull() & value.try_cast(kind).isNull(), F.lit(f"{f.source}: no {kind.simpleString()}")))
    return found


def checked(split: DataFrame, entities: Sequence[str] | None = None, xsd: Mapping[str, str] | None = None) -> DataFrame:
    """One row per entry with the columns of ``feed.entries``, and ``path``, ``reason`` and ``entry``.

    ``reason`` is NULL for a good entry. Otherwise it names all that is wrong, and ``entry`` has the text. An entry is
    rejected if it is no XML, if its category is unknown, or if its id, its change time or a typed column of its entity
    is missing or does not convert. ``xsd`` names a schema file by entity, which Spark then validates the entity's
    element with, after ``True`` and ``False`` of its flag are written small; the element declares its own namespaces.
    What is left of a page that breaks off is one rejected row. Entities that are not asked for are not checked.
    """
    names = list(entities or ENTITIES)
    schema = feed._as_text(feed.entry_schema(names)).add(_BROKEN, "string")
    item = F.explode(F.concat(F.transform("entries", lambda e: F.struct(e.alias("entry"), F.lit(True).alias("whole"))),
                              F.filter(F.array(F.struct(F.col("broken").alias("entry"), F.lit(False).alias("whole"))), lambda e: e["entry"].isNotNull())))
    rows = split.select("path", "token", item.alias("_item")).select("path", "token", "_item.*")
    read = rows.withColumn("e", F.when(F.col("whole"), F.from_xml("entry", schema, _OPTIONS)))
    category = F.coalesce(F.col("e.category.term"), F.lit("unknown"))
    read = read.withColumn("category", category).withColumn("tabel", snake_case(category))
    well = F.col("whole") & F.col(f"e.{_BROKEN}").isNull()
    general = [F.when(~F.col("whole"), F.lit("page: no XML")), F.when(F.col("whole") & ~well, F.lit("entry: no XML")),
               F.when(well & ~F.col("tabel").isin(list(ENTITIES)), F.lit("category: unknown")),
               F.when(well & F.col("e.updated").isNotNull() & F.col("e.updated").try_cast("timestamp").isNull(), F.lit("updated: no timestamp"))]
    own = [F.when(well & (F.col("tabel") == n), F.nullif(F.concat_ws("; ", *_reasons(F.col(f"e.content.{feed.camel(n)}"), ENTITIES[n].fields)), F.lit(""))) for n in names]
    element = F.regexp_replace(F.regexp_replace(F.regexp_extract("entry", CONTENT, 1), 'verwijderd="True"', 'verwijderd="true"'), 'verwijderd="False"', 'verwijderd="false"')
    valid = [F.when(well & (F.col("tabel") == n) & F.from_xml(element, T.StructType().add("id", "string").add(_BROKEN, "string"), {**_OPTIONS, "rowValidationXSDPath": path})[_BROKEN].isNotNull(),
                    F.lit("schema: not valid")) for n, path in (xsd or {}).items()]
    read = read.withColumn("reason", F.nullif(F.concat_ws("; ", *general, *own, *valid), F.lit("")))
    typed = feed.entry_schema(names)["content"].dataType
    return read.select(
        "path", "token", F.col("e.id").alias("feed_id"), F.col("e.title").alias("feed_title"), F.col("e.updated").try_cast("timestamp").alias("feed_updated"),
        "category", "tabel", F.col("e.link").cast(feed._LINKS).alias("atom_links"), F.col("e.content").try_cast(typed).alias("content"),
        "reason", F.when(F.col("reason").isNotNull(), F.col("entry")).alias("entry"))


def read_checked(spark: SparkSession, path: str, cursor: int | None = None, max_pages: int | None = None,
                 entities: Sequence[str] | None = None, xsd: Mapping[str, str] | None = None) -> DataFrame:
    """Checked entries of the landed pages past the cursor."""
    return checked(feed.select_pages(split_pages(page_texts(spark.read, path)), cursor, max_pages), entities, xsd)


def log_rows(rows: DataFrame, load_id: str) -> DataFrame:
    """Checked entries as log rows: rejected ones go to their own table, all carry row id and load id."""
    table = F.when(F.col("reason").isNotNull(), F.lit(REJECTED)).otherwise(F.col("tabel"))
    return rows.withColumn("_row_id", feed.row_id(rows.select(*COLUMNS))).withColumn("_load_id", F.lit(load_id)).withColumn("tabel", table)


def append_checked(rows: DataFrame, path: str, load_id: str) -> None:
    """Append checked entries to the version log in one write, rejected ones in a folder of their own."""
    log_rows(rows, load_id).write.mode("append").partitionBy("tabel").parquet(path)


def rejected(log: DataFrame) -> DataFrame:
    """The rejected entries of a log: file, token, category, reason, text and load."""
    return log.where(F.col("tabel") == REJECTED).select("path", "token", "feed_id", "category", "reason", "entry", "_load_id")
