"""Camera images and landed fetches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: image names are `<camera>-<yyyy-MM-dd-HH-mm-ss>.jpg` with a three-digit camera.
NAME_STAMP_START, NAME_STAMP_LENGTH = 5, 16


def read_images(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Decoded images (``image`` struct, channels in BGR order)."""
    reader = spark.read.format("image").option("dropInvalid", True)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path)


UNDECODABLE = "undecodable"


def read_images_checked(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``image, fault`` of every file named; only these files are opened.

    A file that the decoder refuses keeps its row: ``image.origin`` tells which,
    ``fault`` is set and the pixels are empty. No paths: no rows.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        empty = "image STRUCT<origin: STRING, height: INT, width: INT, nChannels: INT, mode: INT, data: BINARY>"
        return spark.createDataFrame([], f"{empty}, fault STRING")
    frames = spark.read.format("image").option("dropInvalid", False).load(paths)
    return frames.withColumn("fault", F.when(F.col("image.height") < 0, F.lit(UNDECODABLE)))


#: Files that the image reader decodes.
IMAGE_FILES = "*.{jpg,jpeg,png,gif,bmp,JPG,JPEG,PNG,GIF,BMP}"


def read_manifest(
    spark: SparkSession, path: str, pattern: str = "*.jpg", recursive: bool = True
) -> DataFrame:
    """Stored path per image; the content is never read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", recursive)
        .load(path)
        .select("path", "modificationTime", "length")
    )


def file_name(path):
    return F.element_at(F.split(path, "/"), -1)


def image_stamp(name):
    """``yyyy-MM-dd-HH-mm`` out of an image file name."""
    return F.substring(name, NAME_STAMP_START, NAME_STAMP_LENGTH)


def image_metadata(images: DataFrame) -> DataFrame:
    """Camera id, local stamp, height and width of decoded images."""
    name = file_name(F.col("image.origin"))
    return images.select(
        F.regexp_extract(name, r"^([^-]+)-", 1).alias("camera"),
        F.regexp_extract(name, r"^[^-]+-([0-9-]+)", 1).alias("localdatetime"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
    )


def only_fetched(fetches: DataFrame, status: str = "status") -> DataFrame:
    """Rows whose HTTP status is 200."""
    return fetches.filter(F.col(status) == 200)
