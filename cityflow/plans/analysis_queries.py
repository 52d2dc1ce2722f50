"""Named queries of the analyses across feeds, of annotators and of mergeable sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from cityflow.functions import sketch, text
from cityflow.operators import cluster, correlation
from cityflow.plans import feeds
from cityflow.plans.named import query
from cityflow.plans.registry import RECORDS, US, _page_text_sql, rounded
from cityflow.sources import annotations

FEEDS = ("temp", "uv", "precip", "traffic")
BUCKETS = f"""WITH records AS ({RECORDS}),
means AS (SELECT epoch_us(ts) // {3600 * US} AS bucket, avg(temp) AS temp, avg(uv) AS uv, avg(precip) AS precip, avg(traffic) AS traffic
  FROM records GROUP BY ALL),
buckets AS (SELECT bucket, feature, value FROM (SELECT bucket, unnest(['temp', 'uv', 'precip', 'traffic']) AS feature,
  unnest([temp, uv, precip, traffic]) AS value FROM means) WHERE value IS NOT NULL)"""


def _buckets(spark, sf_dir):
    return correlation.aligned_buckets(feeds.wide_records(feeds.events(spark, sf_dir)), FEEDS)


@query(f"""{BUCKETS} SELECT a.feature AS first, b.feature AS second, lag::INTEGER AS lag, count(*) AS n,
  round(corr(a.value, b.value), 6) + 0.0::DOUBLE AS correlation
FROM buckets a, buckets b, (SELECT unnest([0, 1, 3, 24]) AS lag)
WHERE b.bucket - lag = a.bucket AND a.feature <> b.feature AND (lag <> 0 OR a.feature < b.feature) GROUP BY ALL""")
def feed_correlation(spark, sf_dir):
    """Hourly feeds against each other, also with one of them some hours later."""
    found = correlation.lagged_correlation(_buckets(spark, sf_dir), [0, 1, 3, 24])
    return found.withColumn("correlation", F.round("correlation", 6) + F.lit(0.0))


# Means over 64 hours end in a 5 now and then, where engines round apart. Millionths
# are cut off at a place that no such mean comes near.
CUT = 0.283185307


@query(f"""{BUCKETS} SELECT bucket, feature,
  {", ".join(f'''floor(avg(value) OVER h{h} * 1000000 + {CUT}::DOUBLE)::BIGINT AS mean_{h}h,
  floor((max(value) OVER h{h} - min(value) OVER h{h}) * 1000000 + {CUT}::DOUBLE)::BIGINT AS range_{h}h''' for h in (24, 48, 72))}
FROM buckets WINDOW {", ".join(f"h{h} AS (PARTITION BY feature ORDER BY bucket RANGE BETWEEN {h - 1} PRECEDING AND CURRENT ROW)"
                               for h in (24, 48, 72))}""")
def feed_fluctuation(spark, sf_dir):
    """Mean and range of every hourly feed over the last one, two and three days, in millionths."""
    found = correlation.fluctuation(_buckets(spark, sf_dir)).drop("value")
    figures = [c for c in found.columns if c not in ("bucket", "feature")]
    return found.select("bucket", "feature", *[F.floor(F.col(c) * 1000000 + CUT).alias(c) for c in figures])


@query(f"""WITH plain AS ({_page_text_sql()}),
parts AS (SELECT page_id, list_filter(list_transform(regexp_split_to_array(text, '[.!?]+'), lambda s: trim(s, ' ')),
  lambda s: s <> '') AS p FROM plain),
cut AS (SELECT page_id, unnest(range(1, len(p) + 1)) AS sent_id, unnest(p) AS sentence FROM parts),
words AS (SELECT page_id, sent_id, list_filter(string_split(sentence, ' '), lambda w: w <> '') AS w FROM cut)
SELECT page_id, sent_id::BIGINT AS sent_id, len(w)::BIGINT AS n_tokens,
  len(list_filter(w, lambda x: regexp_matches(x, '^[A-Z][a-z]')))::BIGINT AS n_names, w[1] AS first_word FROM words""")
def annotated_pages(spark, sf_dir):
    """Whole pages to sentences by a table function, joined to their pages row by row."""
    pages = feeds.table(spark, sf_dir, "pages").select("page_id", text.page_text(F.col("html")).alias("text"))
    found = annotations.annotate_lateral(pages, feeds.NameAnnotator)
    return found.select(
        "page_id", "sent_id", F.size("tokens").cast("long").alias("n_tokens"),
        F.size(F.filter("tokens", lambda t: t["ner"] == "NAME")).cast("long").alias("n_names"),
        F.col("tokens")[0]["word"].alias("first_word"),
    )


START = ((10.0, 20.0), (40.0, 25.0), (25.0, 35.0), (30.0, 22.0))


@query(f"""WITH pts AS (SELECT p_size::DOUBLE AS size, p_retailprice / 50 AS price FROM part),
near AS (SELECT size, price, [{", ".join(f"(size - {a}) ** 2 + (price - {b}) ** 2" for a, b in START)}] AS d FROM pts),
own AS (SELECT size, price, list_position(d, list_min(d)) - 1 AS cluster FROM near),
sums AS (SELECT a.cluster, a.size, a.price, sum(sqrt((a.size - b.size) ** 2 + (a.price - b.price) ** 2)) AS s
  FROM (SELECT DISTINCT * FROM own) a JOIN own b USING (cluster) GROUP BY ALL)
SELECT cluster::INTEGER AS cluster, size, price FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY round(s, 6), size, price) AS r
  FROM sums) WHERE r = 1""")
def medoid_round(spark, sf_dir):
    """One round of k-medoids from given centres: nearest centre, then each cluster's exact medoid."""
    parts = feeds.table(spark, sf_dir, "part").select(
        F.col("p_size").cast("double").alias("size"), (F.col("p_retailprice") / 50).alias("price")
    )
    assigned = cluster.assign_clusters(parts, START, ["size", "price"])
    found = cluster.exact_medoids(assigned, ["size", "price"])
    return spark.createDataFrame([(k, *p) for k, p in found.items()], "cluster INT, size DOUBLE, price DOUBLE")


ACCURACY, QUANTILES = 0.01, (0.0, 0.05, 0.5, 0.95, 0.999)
_GROWTH = f"({1 + ACCURACY}::DOUBLE / {1 - ACCURACY}::DOUBLE)"


@query(f"""WITH b AS (SELECT event_type, sign(value)::INTEGER AS sign,
  CASE WHEN value = 0 THEN 0 ELSE ceil(ln(abs(value)) / ln({_GROWTH}))::INTEGER END AS bucket FROM events WHERE value IS NOT NULL),
n AS (SELECT event_type, sign, bucket, count(*) AS n FROM b GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY sign, sign * bucket) AS past,
  sum(n) OVER (PARTITION BY event_type) AS total FROM n)
SELECT event_type, q::DOUBLE AS q, round(sign * {_GROWTH} ** bucket * 2 / ({_GROWTH} + 1), 6) + 0.0::DOUBLE AS value
FROM c, (SELECT unnest({list(QUANTILES)}) AS q) WHERE past > floor(q * (total - 1)) AND past - n <= floor(q * (total - 1))""")
def value_quantiles(spark, sf_dir):
    """Quantiles per event type from sketches counted in Arrow batches and merged."""
    counted = sketch.quantile_sketch(feeds.events(spark, sf_dir), ["event_type"], "value", ACCURACY)
    found = sketch.sketch_quantiles(counted, ["event_type"], QUANTILES, ACCURACY)
    return found.withColumn("value", F.round("value", 6) + F.lit(0.0))
