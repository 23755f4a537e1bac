"""The pipeline end to end on a small folder, and its place among the entry points."""

import __spark_entry__ as entry
import corpus_pipeline
from plenaria.llm import secrets, simhash
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, {r.doc_id for r in docs.collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER))
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= kept, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns, name
        if name == "quality classifier":
            assert labels.where("quality = 1").join(docs, "doc_id").count() >= 0.95 * labels.where("quality = 1").count()
        if name == "SimHash near-dedup":
            assert simhash.components(docs).where("doc_id <> component_id").count() == 0
        if name == "secret scans":
            assert secrets.scan(docs).where(F.size("base") > 0).count() == 0
        kept = ids
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_entry_points():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert {n.split("_")[0] for n in names} >= {f"op{i}" for i in range(1, 11)} and "pipeline" in entry.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "SimHash near-dedup", "secret scans", "best-fit packing"]
