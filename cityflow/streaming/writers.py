"""Starting streaming queries; every sink keeps its checkpoint in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from cityflow.session import run_dir


def _writer(
    df: DataFrame, checkpoint: str | None, mode: str, trigger: dict | None
) -> DataStreamWriter:
    folder = checkpoint or run_dir(df.sparkSession, "checkpoint")
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", folder)
    return writer.trigger(**trigger) if trigger else writer


def publish(
    df: DataFrame,
    fmt: str = "json",
    checkpoint: str | None = None,
    trigger: dict | None = None,
    **options: str,
) -> StreamingQuery:
    """Append a result stream to a broker topic (``kafka``) or to files (``json``)."""
    return _writer(df, checkpoint, "append", trigger).format(fmt).options(**options).start()


def append_csv(
    df: DataFrame, path: str, checkpoint: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Append rows as CSV files with a header."""
    return publish(df, "csv", checkpoint, trigger, path=path, header="true")


def append_table(
    df: DataFrame, table: str, checkpoint: str | None = None, trigger: dict | None = None,
    partition_by: Sequence[str] = (), path: str | None = None,
) -> StreamingQuery:
    """Append to a catalog table in Parquet, in a folder per value of ``partition_by``.

    The sink's log names the files of finished batches, so a restart from the same
    ``checkpoint`` adds no row twice. ``path`` places the table's files.
    """
    writer = _writer(df, checkpoint, "append", trigger).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    return writer.toTable(table)


def early_results(
    df: DataFrame,
    on_batch,
    every: str = "10 seconds",
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Windows as they stand after each trigger, before the watermark closes them.

    Rows repeat with newer values, so ``on_batch(frame, batch_id)`` must upsert, as
    :class:`Upserts` does. ``trigger`` takes the place of ``every``.
    Update mode takes one aggregation only: build hopping frames with ``paned=False``.
    """
    writer = _writer(df, checkpoint, "update", trigger or {"processingTime": every})
    return writer.foreachBatch(on_batch).start()


def drain(df: DataFrame, label: str, timeout: int | None = None) -> DataFrame:
    """Process everything available now, then read the appended rows back as a batch frame.

    The rows go to Parquet in the shared folder, never through the driver.
    """
    spark = df.sparkSession
    out = run_dir(spark, label)
    query = publish(df, "parquet", f"{out}/checkpoint", {"availableNow": True}, path=f"{out}/rows")
    finished = query.awaitTermination(timeout)
    if timeout is not None and not finished:
        query.stop()
        raise TimeoutError(f"{label} did not finish in {timeout} seconds")
    return spark.read.schema(df.schema).parquet(f"{out}/rows")


@dataclass
class Drained:
    """What a run over several deliveries left: the appended rows, batches, and rows past the watermark."""

    rows: DataFrame
    batches: int
    late_rows: int


@contextmanager
def state_parts(spark: SparkSession, partitions: int | None = None):
    """Queries started inside keep their state in ``partitions`` parts, or in two per core.

    Each part is opened and committed in every batch, with or without rows, so parts
    beyond what the cores take on are time alone. A session whose shuffles have fewer
    keeps its number. A query takes the settings when it starts.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(partitions or min(int(before), 2 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def drain_deliveries(
    spark: SparkSession,
    deliver: Sequence[Callable[[], None]],
    stream: Callable[[], DataFrame],
    label: str,
    partitions: int | None = None,
) -> Drained:
    """Run a query once per delivery, each time from where it stopped before.

    State is kept in ``partitions`` parts, as told by :func:`state_parts`.

    ``deliver`` lands one delivery each; ``stream`` builds the query over the
    landing place. State, watermark and progress come back from the checkpoint in
    the shared folder. Spark's progress reports tell how many rows a stateful
    operator dropped as late: input rows for the removal of repeats, whose
    figure is taken where there is one, else groups of rows.
    """
    out = run_dir(spark, label)
    batches = late = 0
    schema = None
    for land in deliver:
        land()
        df = stream()
        schema = df.schema
        with state_parts(spark, partitions):
            query = publish(df, "parquet", f"{out}/checkpoint", {"availableNow": True}, path=f"{out}/rows")
        query.awaitTermination()
        for progress in query.recentProgress:
            batches += progress["numInputRows"] > 0
            operators = progress["stateOperators"]
            first = [o for o in operators if o["operatorName"].startswith("dedupe")] or operators
            late += sum(o["numRowsDroppedByWatermark"] for o in first)
    return Drained(spark.read.schema(schema).parquet(f"{out}/rows"), batches, late)


class Upserts:
    """A table of the newest row per key, fed by the batches of an update-mode query.

    Batch ``n`` is the folder ``batch=n``: a batch that is delivered again takes
    the place of its first delivery, so nothing is counted twice. ``current`` keeps
    the row of the latest batch per key; ``fold`` writes that state as one folder
    and reads on from it, so that old batches need not be kept.
    """

    def __init__(self, spark: SparkSession, schema, keys: Sequence[str], path: str | None = None):
        self.spark, self.schema, self.keys = spark, schema, list(keys)
        self.path = path or run_dir(spark, "upserts")
        self.folded = -1

    def __call__(self, frame: DataFrame, batch_id: int) -> None:
        if batch_id > self.folded:
            frame.write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch_id}")

    def _all(self) -> DataFrame:
        columns = self.spark.createDataFrame([], self.schema).schema.add("batch", "long")
        folders = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/rows")
        files = folders.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folders):
            return self.spark.createDataFrame([], columns)
        return self.spark.read.schema(columns).option("basePath", f"{self.path}/rows").parquet(f"{self.path}/rows")

    def current(self) -> DataFrame:
        """The newest row of every key; the row of the later batch wins."""
        rows = self._all()
        names = [c for c in rows.columns if c not in (*self.keys, "batch")]
        newest = F.max_by(F.struct(*names), "batch").alias("row")
        return rows.groupBy(*self.keys).agg(newest).select(*self.keys, "row.*")

    def fold(self, batch_id: int) -> None:
        """The state after ``batch_id`` in a new place; later batches are added there."""
        state = self.current()
        target = run_dir(self.spark, "upserts")
        state.write.parquet(f"{target}/rows/batch={batch_id}")
        self.path, self.folded = target, batch_id
