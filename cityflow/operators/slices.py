"""Rows by their place in a global order, without bringing the order to one task.

The rows are dealt out by ranges of the sort keys and laid down sorted, one
folder per range, in the shared folder. Counting the folders tells where each
range begins; a slice then reads only the folders it touches and cuts inside the
first and the last of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from cityflow.session import run_dir

_RANGE = "range_no"


def _tie(df: DataFrame) -> Column:
    """Tells rows with equal keys apart, so that a hot key is cut into ranges as well."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


@dataclass
class OrderedRows:
    """Sorted rows in folders by range; ``starts`` has each range's first place and its size."""

    rows: DataFrame
    keys: list[str]
    starts: dict[int, tuple[int, int]]

    @property
    def count(self) -> int:
        return sum(n for _, n in self.starts.values())

    def _inside(self, ranges: list[int]) -> DataFrame:
        """The rows of the ranges with ``place_in_range`` from 0; a range is sorted by one task."""
        chosen = self.rows.where(F.col(_RANGE).isin(ranges))
        order = Window.partitionBy(_RANGE).orderBy(*self.keys, "_tie")
        return chosen.withColumn("_place", F.row_number().over(order) - 1)

    def slice(self, first: int | None = None, last: int | None = None) -> DataFrame:
        """Rows ``first`` to ``last`` (exclusive); an open end means all.

        Ranges wholly inside are read as they are, ranges outside are not read.
        """
        first = max(0, first or 0)
        last = self.count if last is None else max(first, last)
        touched = {r: (s, n) for r, (s, n) in self.starts.items() if n and s < last and s + n > first}
        whole = [r for r, (s, n) in touched.items() if s >= first and s + n <= last]
        cut = [r for r in touched if r not in whole]
        out = self.rows.where(F.col(_RANGE).isin(whole) if whole else F.lit(False))
        if cut:
            base = F.create_map(*[F.lit(x) for r in cut for x in (r, touched[r][0])])
            place = base[F.col(_RANGE)] + F.col("_place")
            out = out.unionByName(
                self._inside(cut).where((place >= first) & (place < last)).drop("_place")
            )
        return out.drop(_RANGE, "_tie")

    def places(self, name: str = "place") -> DataFrame:
        """All rows with their place in the order, from 0."""
        if not self.starts:
            return self.rows.drop(_RANGE, "_tie").withColumn(name, F.lit(0).cast("long"))
        base = F.create_map(*[F.lit(x) for r, (s, _) in self.starts.items() for x in (r, s)])
        placed = self._inside(list(self.starts)).withColumn(name, base[F.col(_RANGE)] + F.col("_place"))
        return placed.drop(_RANGE, "_tie", "_place")


def lay_out(df: DataFrame, keys: list[str], ranges: int | None = None) -> OrderedRows:
    """Write ``df`` in ranges of ``keys`` to the shared folder; nulls come first.

    Only one number per range reaches the driver. Equal rows are interchangeable.
    """
    spark = df.sparkSession
    tied = df.withColumn("_tie", _tie(df))
    by = [*keys, "_tie"]
    dealt = tied.repartitionByRange(ranges, *by) if ranges else tied.repartitionByRange(*by)
    out = run_dir(spark, "ordered")
    numbered = dealt.sortWithinPartitions(*by).withColumn(_RANGE, F.spark_partition_id())
    numbered.write.partitionBy(_RANGE).parquet(out)
    schema = StructType([*tied.schema.fields, StructField(_RANGE, IntegerType())])
    rows = spark.read.schema(schema).parquet(out)
    starts, place = {}, 0
    for row in rows.groupBy(_RANGE).count().orderBy(_RANGE).collect():
        starts[row[_RANGE]] = (place, row["count"])
        place += row["count"]
    return OrderedRows(rows, list(keys), starts)
