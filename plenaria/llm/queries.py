"""The operators' registered queries, with SQL for DuckDB where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plenaria.llm import importance, infill, lines, packing, passages, personal, pieces, quality, secrets, simhash, topk, toxicity, winnowing
from plenaria.llm.common import column, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id's text modulo a number; a null id has remainder -1."""
    return F.coalesce(F.crc32(column(doc_id).cast("string")) % divisor, F.lit(-1))


@query
def op1_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 50 words and more that documents share, exact or with a few edits."""
    return passages.shared(table(spark, folder, "documents"))


@query
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of all documents, learnt from two of three folds of labels."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.fit(docs, labels.where(remainder("doc_id", 3) != 1))
    scored = docs.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), quality.score(model, column("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op3_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Every hundredth vector's ten highest integer inner products against all others."""
    vectors = table(spark, folder, "embeddings")
    return topk.search(vectors.where(column("vec_id") % 100 == 0), vectors, "vec_id", "embedding", 10)


SQL["op3_topk"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10"""


@query
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' tokens packed into sequences of at most 2048."""
    definition = Path(public_tokenizers.path("word_bpe_49k.json")).read_text()
    return packing.pack(table(spark, folder, "documents"), definition)


@query
def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Winnowing fingerprints of all documents and their edited texts."""
    return winnowing.edited_likeness(table(spark, folder, "documents"))


@query
def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded by merges and decoded again."""
    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    return pieces.round_trip(table(spark, folder, "documents"), model)


@query
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents by SimHash distance."""
    found = simhash.components(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Credential spans of all documents, with weak parts beside their complements."""
    found = secrets.scan(table(spark, folder, "documents"))
    counts = [secrets.count("base", k).alias(f"n_{k}") for k in secrets.KINDS[: secrets.BASE]]
    return found.select("doc_id", *counts, F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"), secrets.written(F.col("spans")).alias("spans"))


@query
def op9_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the lines that repeat an earlier one."""
    docs = table(spark, folder, "documents")
    return lines.dedup(docs, counted=True).select("doc_id", "text", F.col("n_removed").cast("long").alias("n_removed"))


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learnt from four of five folds of labels."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(docs, labels.where(remainder("doc_id", 5) != 0))
    scored = docs.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), toxicity.score(model, column("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op11_infill(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in fill-in-middle order, and the digest of what is rebuilt from that."""
    found = infill.transform(table(spark, folder, "documents"))
    output = F.col("output")
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(output, 256).alias("output_sha256"),
                        F.sha2(infill.restored(F.col("form"), output), 256).alias("restored_sha256"))


SQL["op11_infill"] = """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
units AS (
  SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM hashed),
cut AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM units),
parts AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS prefix, coalesce(array_to_string(u[a + 1:b], ''), '') AS middle,
    coalesce(array_to_string(u[b + 1:], ''), '') AS suffix
  FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts"""


@query
def op12_personal(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of all documents: plain identifiers, and all with those behind disguises."""
    found = personal.find(table(spark, folder, "documents"))
    base = F.col("base")
    return found.select("doc_id", *(personal.count(base, k).alias(f"n_{k}") for k in personal.KINDS),
                        F.sha2(personal.written(base), 256).alias("base_sha256"), personal.written(F.col("spans")).alias("spans"))


@query
def op13_importance(spark: SparkSession, folder: str) -> DataFrame:
    """All documents weighed towards the benchmark's words, and the tenth that is drawn."""
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL["op13_importance"] = """
WITH byte_table AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS bytes),
words AS (
  SELECT 0 AS side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
  FROM documents
  UNION ALL
  SELECT 1, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'))
  FROM benchmark),
written AS (SELECT DISTINCT word, hex(encode(word)) AS h FROM words),
hashed AS (
  SELECT word, xor(list_reduce(list_concat([4294967295], list_transform(range(0, len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, bytes[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM written, byte_table),
placed AS (SELECT side, doc_id, bucket FROM words JOIN hashed USING (word)),
counts AS (SELECT bucket, CAST(count(*) FILTER (side = 0) AS DOUBLE) AS s, CAST(count(*) FILTER (side = 1) AS DOUBLE) AS t FROM placed GROUP BY bucket),
sums AS (SELECT coalesce(sum(s), 0) AS big_s, coalesce(sum(t), 0) AS big_t FROM counts),
gains AS (SELECT bucket, CAST(floor(1000 * ln((t + 1) * (big_s + 10000) / ((s + 1) * (big_t + 10000)))) AS BIGINT) AS gain FROM counts, sums),
weighed AS (SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM placed JOIN gains USING (bucket) WHERE side = 0 GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || CAST(d.doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM documents d LEFT JOIN weighed w USING (doc_id)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM ranked"""
