"""Archived text feeds, comma-separated tables and label files.

The line parsers take a frame with one ``value`` column, as ``spark.read.text``
yields it. The date guard drops header and continuation lines, so files can be
split freely: no row numbering, no per-file state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow import schemas
from cityflow.functions.text import dash_at, number, tail
from cityflow.functions.weather import rain_level


def read_lines(spark: SparkSession, glob: str, streaming: bool = False) -> DataFrame:
    """All lines below a path or glob, as column ``value``."""
    return (spark.readStream if streaming else spark.read).text(glob)


def parse_tweet_lines(lines: DataFrame) -> DataFrame:
    """One leading character, a 19-character stamp, then the text from position 24."""
    line = F.col("value")
    return lines.filter(dash_at(line, 6)).select(
        F.substring(line, 2, 15).alias("bucket"), tail(line, 24).alias("text")
    )


def parse_traffic_lines(lines: DataFrame) -> DataFrame:
    """``yyyy-MM-dd-HH-mm,<score>``."""
    line = F.col("value")
    return lines.filter(dash_at(line, 5)).select(
        F.substring(line, 1, 15).alias("bucket"), number(tail(line, 18)).alias("traffic")
    )


def parse_weather_lines(lines: DataFrame, strict: bool = False) -> DataFrame:
    """``localdatetime,icon,precip,summary,temp,time,uv,wind``; fields 4, 5, 7 and 8 are used."""
    line = F.col("value")
    fields = F.split(line, ",")
    return lines.filter(dash_at(line, 5)).select(
        F.substring(line, 1, 15).alias("bucket"),
        rain_level(F.get(fields, 3), strict).alias("precip"),
        number(F.get(fields, 4)).alias("temp"),
        number(F.get(fields, 6)).alias("uv"),
        number(F.get(fields, 7)).alias("wind"),
    )


def read_vitals(spark: SparkSession, path: str) -> DataFrame:
    """Headerless ``id,vital`` lines."""
    return spark.read.schema(schemas.VITALS_CSV).csv(path)


def read_patients(spark: SparkSession, path: str) -> DataFrame:
    """Headerless ``id,name,birth_year,gender`` lines."""
    return spark.read.schema(schemas.PATIENTS_CSV).csv(path)


def read_weather_table(spark: SparkSession, path: str) -> DataFrame:
    """Weather table with a header line."""
    return spark.read.schema(schemas.WEATHER_CSV).option("header", True).csv(path)


def read_labels_table(spark: SparkSession, path: str) -> DataFrame:
    """Camera labels with a header line."""
    return spark.read.schema(schemas.LABELS_CSV).option("header", True).csv(path)


LABEL_LINE = r"^(\S+) - (?:Date: )?(.*?\bGMT)(?:,(\d+),(\d+)\s*$)?"


def parse_label_lines(lines: DataFrame) -> DataFrame:
    """``stamp - [Date: ]<http date>[,vehicles,people]``; without two whole counts both are null."""
    line = F.col("value")

    def group(i: int):
        return F.nullif(F.regexp_extract(line, LABEL_LINE, i), F.lit(""))

    return lines.filter(line.rlike(LABEL_LINE)).select(
        group(1).alias("datetime"),
        group(2).alias("http_date"),
        group(3).try_cast("int").alias("vehicles"),
        group(4).try_cast("int").alias("people"),
    )
