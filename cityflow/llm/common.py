"""What the operators share: words, the held-out fold, Arrow maps over texts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow.session import prepare

#: A word, as the contracts define it: a run of anything but blank, tab and line ends.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, with the package made importable in the Python workers."""
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the quarter of ids kept away from learning; a null id is never held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % 4 == 2, F.lit(False))


def map_texts(
    docs: DataFrame,
    make: Callable[[], Callable[[list, list], dict]],
    schema: str,
    columns: tuple[str, ...] = ("doc_id", "text"),
) -> DataFrame:
    """Rows made from every document, batch by batch.

    ``make`` runs once per task (loading a model, building an automaton) and
    returns a function of the columns' value lists giving the output columns.
    """
    types = arrow_types(schema)
    fields = list(types)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            # a batch of long texts is cut further, so that one step's lists stay small
            for part in pieces(batch):
                out = work(*(part.column(i).to_pylist() for i in range(len(columns))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f], type=types[f]) for f in fields], names=fields
                )

    return docs.select(*columns).mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``limit`` bytes, one row at least."""
    rows = max(1, int(batch.num_rows * limit / max(batch.nbytes, 1)))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def arrow_types(schema: str) -> dict[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import DataType

    return {f.name: to_arrow_type(f.dataType) for f in DataType.fromDDL(schema).fields}


def sample_for_fit(labelled: DataFrame, bound: int, key: str = "doc_id") -> DataFrame:
    """At most ``bound`` rows, chosen by a hash of the id: the same rows on every run."""
    return labelled.orderBy(F.xxhash64(F.lit("fit"), key), key).limit(bound)


def distinct_labels(labels: DataFrame, label: str) -> DataFrame:
    """One row ``doc_id, label`` per labelled id; where labels disagree the larger holds."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    return known.groupBy("doc_id").agg(F.max(label).alias("label"))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))

