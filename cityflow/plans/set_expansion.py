"""Iterative set expansion: grow a set of related pairs from a seed query.

Each round searches a page corpus for the query, extracts relations from the
annotated sentences of the pages found, and takes the best unused pair as the
next query. Pages and sentences are gone through once: an inverted table of words
and the sentences are laid out in folders by a hash of the word and of the page's
address, with Bloom filters within, so that a round reads the few folders and row
groups its words and pages lie in. The driver loop holds a query string and counts (and, for
a bounded number of hits, their addresses); pages, sentences and relations stay in
Spark. A round's pages and relations go to tables in the shared folder, so lineage
never grows and a lost executor costs one round's work at most.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain
from operator import or_

import xxhash
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cityflow.operators import relations as rel
from cityflow.operators.slices import lay_out
from cityflow.session import run_dir
from cityflow.sources.sinks import tap

WORD = r"[\p{L}\p{N}#]+"
WORD_BREAK = r"[^\p{L}\p{N}#]+"


@dataclass
class Expansion:
    """``relations`` holds everything found; ``queries`` and ``reason`` tell how it ended."""

    relations: DataFrame
    queries: list[str] = field(default_factory=list)
    reason: str = ""
    iterations: int = 0


def words_of(query: str) -> list[str]:
    """The query cut into words as pages are, each once."""
    return sorted(set(re.findall(r"(?:[^\W_]|#)+", query.lower())))


def search_pages(pages: DataFrame, query: str, hits: int | None = 10) -> DataFrame:
    """The ``hits`` pages holding most words of the query (None: all); equals in address order.

    Query and pages are cut into words alike; a query without words finds no page.
    A plain substring test comes first: only pages passing it are split into words.
    """
    words = words_of(query)
    if not words:
        return pages.limit(0).select("url", F.lit(0).alias("matched"))
    text = F.lower("text")
    maybe = reduce(or_, [text.contains(w) for w in words])
    found = F.array_intersect(F.array(*map(F.lit, words)), F.split(text, WORD_BREAK))
    scored = pages.filter(maybe).select("url", F.size(found).alias("matched"))
    return _best(scored.filter("matched > 0"), hits)


def _best(scored: DataFrame, hits: int | None) -> DataFrame:
    ranked = scored.orderBy(F.desc("matched"), "url")
    return ranked if hits is None else ranked.limit(hits)


@dataclass
class Index:
    """Words to pages, and sentences by page, in ``buckets`` folders each."""

    words: DataFrame
    sentences: DataFrame
    buckets: int

    def search(self, query: str, hits: int | None = 10) -> DataFrame:
        """As :func:`search_pages`, from the folders of the query's words only."""
        words = words_of(query)
        if not words:
            return self.words.limit(0).select("url", F.lit(0).alias("matched"))
        folders = {_folder(w, self.buckets) for w in words}
        rows = self.words.where(F.col("bucket").isin(*folders) & F.col("word").isin(words))
        scored = rows.groupBy("url").agg(F.count_distinct("word").cast("int").alias("matched"))
        return _best(scored, hits)

    def of_addresses(self, order: dict[str, int]) -> DataFrame:
        """Sentences of the pages in ``order`` (address to page order).

        Addresses are literals: they prune folders and row groups.
        """
        if not order:
            return self.sentences.limit(0).drop("bucket")
        folders = {_folder(u, self.buckets) for u in order}
        position = F.create_map(
            *chain.from_iterable((F.lit(u), F.lit(i).cast("long")) for u, i in order.items())
        )
        rows = self.sentences.where(F.col("bucket").isin(*folders) & F.col("url").isin(*order))
        return rows.withColumn("page_order", position[F.col("url")]).drop("bucket")

    def of_pages(self, pages: DataFrame) -> DataFrame:
        """Sentences of ``pages(url, page_order)``, any number of them, joined by folder and address."""
        keyed = pages.withColumn("bucket", _bucket(F.col("url"), self.buckets))
        return self.sentences.drop("page_order").join(keyed, ["bucket", "url"]).drop("bucket")


def _bucket(value, buckets: int):
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


def _folder(text: str, buckets: int) -> int:
    """``_bucket`` of a known text: the same hash, read as a signed number."""
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return (value - (1 << 64) if value >> 63 else value) % buckets


LISTS = ("tokens", "entities", "relations")


def build_index(
    pages: DataFrame, sentences: DataFrame, kind: rel.RelationKind | None = None, buckets: int = 32
) -> Index:
    """Lay out ``pages(url, text)`` by word and ``sentences`` by page in the shared folder.

    One pass over each, without a shuffle: every task sorts its rows by the folder's
    number alone and writes them there, so a word of very many pages is written by
    as many tasks as read those pages. Bloom filters of the words and addresses tell
    a round which row groups of a folder to read. The lists of a sentence are laid
    down as one JSON text, read back for the sentences a round takes. With ``kind``
    only the sentences that can hold such a relation are kept. ``buckets`` should
    grow with the corpus.
    """
    spark = pages.sparkSession
    folder = run_dir(spark, "page-index")
    kept = sentences if kind is None else rel.candidate_sentences(sentences, kind)
    lists = StructType([f for f in kept.schema if f.name in LISTS])
    packed = kept.withColumn("lists", F.to_json(F.struct(*lists.names))).drop(*lists.names)
    split = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))
    words = pages.select("url", F.explode(split).alias("word"))

    def lay(df: DataFrame, key: str, name: str, distinct: int) -> DataFrame:
        keyed = df.withColumn("bucket", _bucket(F.col(key), buckets))
        bloom = {f"enabled#{key}": "true", f"expected.ndv#{key}": str(distinct)}
        keyed.write.options(
            **{"parquet.block.size": str(4 << 20), "parquet.enable.dictionary": "false"},
            **{f"parquet.bloom.filter.{k}": v for k, v in bloom.items()},
        ).partitionBy("bucket").parquet(f"{folder}/{name}")
        return spark.read.schema(keyed.schema).parquet(f"{folder}/{name}")

    # two jobs that share nothing but the cores
    with ThreadPoolExecutor(2) as both:
        jobs = [(words, "word", "words", 100_000), (packed, "url", "sentences", 20_000)]
        found, laid = both.map(inheritable_thread_target(spark)(lambda job: lay(*job)), jobs)
    unpacked = laid.withColumn("lists", F.from_json("lists", lists))
    rows = [F.col(f"lists.{c}") if c in lists.names else F.col(c) for c in kept.columns]
    return Index(found, unpacked.select(*rows, "bucket"), buckets)


def expand(
    pages: DataFrame,
    sentences: DataFrame,
    seed: str,
    kind: rel.RelationKind,
    threshold: float,
    k: int,
    max_iterations: int = 5,
    patience: int = 4,
    hits: int | None = 10,
    index: Index | None = None,
) -> Expansion:
    """Run the loop over ``pages(url, text)`` and their annotated ``sentences``.

    Ends with ``k`` pairs above the threshold, after ``patience`` rounds that
    extracted nothing, after ``max_iterations``, or when no query is left. An
    ``index`` built before saves the one pass over pages and sentences.
    """
    spark = pages.sparkSession
    folder = run_dir(spark, "expansion")
    index = index or build_index(pages, sentences, kind)
    out = Expansion(relations=None, queries=[seed])
    visits = _Visits(index, hits)
    used: list[tuple[str, str]] = []
    stalled = 0
    query = seed
    for out.iterations in range(1, max_iterations + 1):
        chosen = visits.sentences(query)
        found = rel.extract_relations(rel.candidate_sentences(chosen, kind), kind)
        extracted = rel.keep_best(found, ["url", "e1.id", "e2.id"])
        watched, seen_rows = tap(extracted, f"round {out.iterations}")
        watched.write.mode("overwrite").parquet(f"{folder}/round={out.iterations}")
        per_round = spark.read.schema(extracted.schema).option("basePath", folder).parquet(folder)
        out.relations = rel.keep_best(per_round, ["e1.value", "e2.value"])
        pairs = out.relations.withColumns(
            {"value1": F.col("e1.value"), "value2": F.col("e2.value")}
        )
        # one job: the pairs above the threshold are counted on the way to the best of them
        counted, totals = tap(pairs, f"pairs {out.iterations}", above=F.count_if(rel.is_above(threshold)))
        tried = spark.createDataFrame(used, "value1 STRING, value2 STRING")
        best = rel.next_query(counted, tried, seed).select("value1", "value2").first()
        if totals.get["above"] >= k:
            out.reason = "enough"
            break
        if not seen_rows.get["rows"]:
            stalled += 1
            if stalled == patience:
                out.reason = "stalled"
                break
        if best is None:
            out.reason = "no query left"
            break
        used.append((best.value1, best.value2))
        if out.iterations < max_iterations:
            query = f"{best.value1} {best.value2}"
            out.queries.append(query)
    else:
        out.reason = "iteration limit"
    return out


class _Visits:
    """Which pages have been gone through, and in what order.

    A bounded number of hits is kept as a list of addresses, any number of them
    as a table per round.
    """

    def __init__(self, index: Index, hits: int | None):
        self.index, self.hits, self.count = index, hits, 0
        self.listed: set[str] = set()
        self.tables: list[DataFrame] = []

    def sentences(self, query: str) -> DataFrame:
        """Sentences of the pages found that were not gone through yet, in order of the find."""
        found = self.index.search(query, self.hits)
        if self.hits is not None:
            fresh = [r.url for r in found.collect() if r.url not in self.listed]
            order = {u: self.count + i for i, u in enumerate(fresh)}
            self.listed.update(fresh)
            self.count += len(fresh)
            return self.index.of_addresses(order)
        for table in self.tables:
            found = found.join(table.select("url"), "url", "left_anti")
        ordered = lay_out(found.select((-F.col("matched")).alias("least"), "url"), ["least", "url"])
        pages = ordered.places("page_order").select("url", (F.col("page_order") + self.count).alias("page_order"))
        self.count += ordered.count
        self.tables.append(pages)
        return self.index.of_pages(pages)
