"""Named queries over image files and slices of a global order."""

from __future__ import annotations

from pyspark.sql import functions as F

from cityflow.operators import imaging, spectral
from cityflow.plans import dataflows, feeds
from cityflow.plans.named import query
from cityflow.plans.registry import _PIXELS, rounded
from cityflow.session import run_dir
from cityflow.sources import images

NAME = "'689-' || lpad(vec_id::VARCHAR, 16, '0') || '.png'"


def _folder(spark, sf_dir: str) -> str:
    vectors = feeds.table(spark, sf_dir, "embeddings")
    return feeds.write_image_folder(vectors, run_dir(spark, "images"))


@query(f"SELECT {NAME} AS name, '689' AS camera FROM embeddings")
def image_manifest(spark, sf_dir):
    """A folder of PNG files listed without reading them."""
    listing = images.read_manifest(spark, _folder(spark, sf_dir), images.IMAGE_FILES)
    name = images.file_name(F.col("path"))
    return listing.select(name.alias("name"), F.regexp_extract(name, r"^([^-]+)-", 1).alias("camera"))


@query(f"""WITH named AS (SELECT vec_id, embedding, {NAME} AS name,
  row_number() OVER (ORDER BY {NAME}) - 1 AS place FROM embeddings),
px AS (SELECT name, vec_id, list_transform(embedding, lambda v:
  floor(least(greatest(v::DOUBLE + 0.5::DOUBLE, 0.0::DOUBLE), 0.996::DOUBLE) * 256)) AS p FROM named
  WHERE place >= 150)
SELECT substr(name, 5, 16) AS localdatetime,
  CASE WHEN vec_id % 100 <> 0 THEN round(list_sum([{_PIXELS}]) / 9 / 255, 4) END AS predict,
  CASE WHEN vec_id % 100 = 0 THEN 'undecodable' END AS fault FROM px""")
def image_folder_scores(spark, sf_dir):
    """All image files of a folder but the first 150 by name, decoded and scored; broken ones reported."""
    scored = dataflows.score_image_folder(
        spark, _folder(spark, sf_dir), feeds.mean_brightness, 150, None, crop=(1, 1, 6, 6), size=(3, 3)
    )
    return rounded(scored, "predict", digits=4)


@query("""SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
ORDER BY l_shipdate, l_orderkey, l_linenumber OFFSET (SELECT count(*) // 2 FROM lineitem) LIMIT 4000""")
def deep_slice(spark, sf_dir):
    """A slice from the middle of all order lines by date: only the ranges it touches are read."""
    lines = feeds.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    half = lines.count() // 2
    return imaging.sorted_slice(lines, ["l_shipdate", "l_orderkey", "l_linenumber"], half, half + 4000)


_TURN = "2 * pi() * i / 31"
_TAPER32 = f"(0.35875 - 0.48829 * cos({_TURN}) + 0.14128 * cos(2 * {_TURN}) - 0.01168 * cos(3 * {_TURN}))"


@query(f"""WITH taper AS (SELECT i, {_TAPER32} AS w FROM range(32) t(i)),
x AS (SELECT vec_id, i, embedding[i + 1]::DOUBLE * w AS re, embedding[i + 33]::DOUBLE * w AS im FROM embeddings, taper),
f AS (SELECT vec_id, k, sum(re * cos(2 * pi() * k * i / 32) + im * sin(2 * pi() * k * i / 32)) AS re,
  sum(im * cos(2 * pi() * k * i / 32) - re * sin(2 * pi() * k * i / 32)) AS im FROM x, range(32) b(k) GROUP BY ALL)
SELECT vec_id, ((k + 16) % 32)::INTEGER AS bin,
  round(10 * log10(greatest(re * re + im * im, 1e-18)), 4) + 0.0::DOUBLE AS power FROM f""")
def iq_power(spark, sf_dir):
    """Power spectra of complex frames: a vector's first half is in phase, its second in quadrature."""
    whole = F.col("embedding").cast("array<double>")
    frames = feeds.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.slice(whole, 1, 32).alias("re"), F.slice(whole, 33, 32).alias("im")
    )
    bins = spectral.power_spectrum(frames, "re", "im").select("vec_id", F.posexplode("power").alias("bin", "power"))
    return bins.withColumn("power", F.round("power", 4) + F.lit(0.0))
