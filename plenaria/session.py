"""Session and checkpoint settings shared by the library, the tests and the benchmark."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "plenaria", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution on and the web page off.

    On a cluster leave ``master`` unset; the submit command decides it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(app: str = "plenaria-local", cpus: int | str = 8, **conf: str) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    settings = {"spark.sql.shuffle.partitions": str(cpus) if str(cpus).isdigit() else "8",
                "spark.driver.memory": os.environ.get("PLENARIA_DRIVER_MEMORY", "12g"),
                "spark.ui.showConsoleProgress": "false"}
    spark = get_session(app, f"local[{cpus}]", **{**settings, **conf})
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder and cut its lineage.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a local session
    without that setting gets a temporary folder of its own.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="plenaria-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder for intermediate tables of one run."""
    import uuid

    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        checkpoint(spark.range(1).toDF("id"))
    return f"{context.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The frame written to the shared checkpoint folder as Parquet and read back; later jobs start from there.

    Unlike a checkpoint it is computed once, compressed, and later uses read only the columns they need.
    """
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
