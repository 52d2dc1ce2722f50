"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# What the library relies on: UTC for every timestamp, adaptive execution with
# skew-join splitting, and Arrow batches bounded in bytes as well as in rows.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}

# Long-lived stateful queries keep their state off the JVM heap.
STREAMING_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}


def get_session(
    app_name: str = "cityflow", master: str | None = None, streaming: bool = False, **conf: str
) -> SparkSession:
    """Build (or fetch) a session carrying :data:`SESSION_CONF` plus ``conf``.

    ``streaming`` adds :data:`STREAMING_CONF`.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(STREAMING_CONF if streaming else {}), **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin UTC and make the package importable in the session's Python workers.

    Executors need not have it installed: it travels as a zip, once per application.
    """
    pin_utc(spark)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        base = Path(tempfile.mkdtemp(prefix="cityflow-package-")) / "cityflow"
        context.addPyFile(shutil.make_archive(str(base), "zip", package.parent, package.name))
        _shipped.add(context.applicationId)
    return spark


def pin_utc(spark: SparkSession) -> SparkSession:
    """Timestamps are read, windowed and formatted in UTC throughout."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path is lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="cityflow-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below :func:`shared_dir` for one run's tables or checkpoints."""
    return f"{shared_dir(spark)}/cityflow/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back: computed once, lineage cut.

    For input that several jobs go over. The table outlives lost executors.
    """
    out = run_dir(df.sparkSession, label)
    df.write.parquet(out)
    return df.sparkSession.read.schema(df.schema).parquet(out)
