"""Named queries that write through a batch sink and read back what it left."""

from __future__ import annotations

from pyspark.sql import functions as F

from cityflow.operators import cluster, enrich, imaging
from cityflow.options import WEATHER_FEATURES
from cityflow.plans import feeds
from cityflow.plans.named import ORACLES, query
from cityflow.plans.registry import _as_image, rounded
from cityflow.session import run_dir
from cityflow.sources import sinks


@query("SELECT event_id, value, event_type FROM events")
def sharded_sink(spark, sf_dir):
    """Events as JSON lines, a file per partition."""
    rows = feeds.events(spark, sf_dir).select("event_id", "value", "event_type")
    out = run_dir(spark, "sharded")
    sinks.write_sharded(rows, out)
    return spark.read.schema(rows.schema).json(out)


@query("SELECT count(*)::VARCHAR AS value, 1::BIGINT AS files FROM lineitem WHERE l_quantity >= 25")
def count_sink(spark, sf_dir):
    """A selective count in a single text file."""
    kept = feeds.table(spark, sf_dir, "lineitem").where("l_quantity >= 25")
    out = run_dir(spark, "count")
    sinks.write_count(enrich.count_rows(kept), out)
    lines = spark.read.text(out).select("value", F.col("_metadata.file_path").alias("file"))
    return lines.groupBy("value").agg(F.count_distinct("file").alias("files"))


@query(ORACLES["image_scores"])
def score_sink(spark, sf_dir):
    """Image scores as CSV with a header."""
    tiny = feeds.tiny_images(feeds.table(spark, sf_dir, "embeddings"))
    scored = imaging.score_images(_as_image(tiny), feeds.mean_brightness, crop=(1, 1, 6, 6), size=(3, 3))
    out = run_dir(spark, "scores")
    sinks.write_scores(scored, out)
    return rounded(spark.read.schema("origin STRING, predict DOUBLE").option("header", True).csv(out), "predict", digits=4)


@query("""SELECT count(*) AS rows, count(*) FILTER (event_type = 'error') AS errors, max(event_id) AS last FROM events""")
def tapped_rows(spark, sf_dir):
    """Figures observed while the events went to another sink, without a job of their own."""
    rows, seen = sinks.tap(
        feeds.events(spark, sf_dir), "tapped",
        errors=F.count_if(F.col("event_type") == "error"), last=F.max("event_id"),
    )
    sinks.write_sharded(rows.select("event_id"), run_dir(spark, "tapped"), "parquet")
    found = seen.get
    return spark.createDataFrame([(found["rows"], found["errors"], found["last"])], "rows LONG, errors LONG, last LONG")


@query("""WITH w AS (SELECT value AS temp, (user_id % 9)::DOUBLE AS uv, value / 10 AS wind,
  user_id % 9 = 3 AS partial FROM events WHERE event_type = 'purchase')
SELECT count(*) AS rows, count(*) FILTER (partial) AS unplaced, 6::BIGINT AS clusters,
  round(max(uv) FILTER (NOT partial), 6) AS top_uv, round(max(wind) FILTER (NOT partial), 6) AS top_wind,
  1.0::DOUBLE AS top_scaled FROM w""")
def weather_kmeans_rows(spark, sf_dir):
    """What k-means must keep whatever its centres: every row, none placed without its values, scales by the maxima."""
    rows = cluster.weather_training_rows(feeds.weather_table(feeds.events(spark, sf_dir)))
    rows = rows.withColumn("temp", F.when(F.col("uv") != 3, F.col("temp")))
    _, placed, centers = cluster.fit_weather_clusters(rows)
    whole = rows.dropna().agg(F.round(F.max("uv"), 6).alias("top_uv"), F.round(F.max("wind"), 6).alias("top_wind"))
    figures = placed.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("prediction").isNull()).alias("unplaced"),
        F.greatest(*[F.max(F.when(F.col("prediction").isNotNull(), F.col(c))) for c in WEATHER_FEATURES]).alias("top_scaled"),
    )
    clusters = centers.agg(F.count(F.lit(1)).alias("clusters"))
    # three rows of one each
    return figures.crossJoin(F.broadcast(clusters)).crossJoin(F.broadcast(whole))
