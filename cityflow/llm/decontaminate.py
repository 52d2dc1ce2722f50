"""Benchmark decontamination by size-partitioned MinHash containment search.

An item's sketch holds its k smallest shingle hashes. A text that contains at
least t of an item's n shingles misses at most n - ceil(t n) of them, so with
k = n - ceil(t n) + 1 it must hold a shingle of the sketch: the search loses
nothing. k depends on the item's size, so items are partitioned by size (powers
of two), and a text probes only the partitions whose items it is long enough to
contain. Every hit is verified by exact shingle containment. An item of fewer
words than a shingle is one shingle of its own width, looked up among the text's
word sequences of that width: short items are found inside long documents too.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from functools import reduce

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow.llm.common import map_texts
from cityflow.session import settle

#: Letters and digits make a word; case and punctuation don't count.
TOKEN = re.compile(r"[^\W_]+")
WIDTH = 5
SHARE = 0.8
#: Bounds of one broadcast block of benchmark items; more items make more blocks.
BLOCK_ITEMS = 10_000
BLOCK_CHARS = 16 << 20


def need(n: int, share: float) -> int:
    """Shingles of an item of ``n`` that a text must hold."""
    return max(1, math.ceil(share * n - 1e-9))


def sequences(words: list[str], width: int):
    """The word sequences of ``width`` words, repeats included; none if the text is shorter."""
    return map(" ".join, zip(*(words[k:] for k in range(width))))


class Search:
    """Sketches of a block of items, and the search of one text for them."""

    def __init__(self, items: list[tuple], width: int = WIDTH, share: float = SHARE):
        self.width, self.share = width, share
        self.items = []
        self.short: dict[int, dict[str, list]] = {}
        for i, t in items:
            words = TOKEN.findall((t or "").lower())
            if len(words) >= width:
                self.items.append((i, set(sequences(words, width))))
            elif words:
                self.short.setdefault(len(words), {}).setdefault(" ".join(words), []).append(i)
        sizes = defaultdict(list)
        for at, (_, found) in enumerate(self.items):
            sizes[len(found).bit_length()].append(at)
        self.partitions = []
        sketch: dict[str, list[int]] = {}
        for _, members in sorted(sizes.items()):
            for at in members:
                found = self.items[at][1]
                ranked = sorted(found, key=lambda s: (xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")), s))
                for s in ranked[: len(found) - need(len(found), share) + 1]:
                    sketch.setdefault(s, []).append(at)
            # a partition's probe holds those of all smaller ones: one pass over the text
            least = min(need(len(self.items[at][1]), share) for at in members)
            self.partitions.append((least, frozenset(sketch)))
        self.sketch = sketch

    def __call__(self, text: str | None) -> list[tuple]:
        """``(item_id, shingles of the item, of them in the text)`` of every item contained."""
        words = TOKEN.findall((text or "").lower())
        out = []
        for size, wanted in self.short.items():
            for held in wanted.keys() & set(sequences(words, size)):
                out += [(item, 1, 1) for item in wanted[held]]
        n = len(words) - self.width + 1
        probe = next((p for least, p in reversed(self.partitions) if least <= n), None)
        hits = probe.intersection(sequences(words, self.width)) if probe else ()
        if not hits:
            return out
        whole = set(sequences(words, self.width))
        for at in sorted({at for s in hits for at in self.sketch[s]}):
            item, wanted = self.items[at]
            shared = len(wanted & whole)
            if shared >= need(len(wanted), self.share):
                out.append((item, len(wanted), shared))
        return out


def block_makers(spark: SparkSession, items: DataFrame):
    """Functions that broadcast the items ``item_id, text, copies``, ``BLOCK_ITEMS`` rows or ``BLOCK_CHARS`` on average each.

    Equal rows are one row with their number, so a block does not grow with repeats.
    """
    known = items.select("item_id", "text").where("text IS NOT NULL")
    known = settle(known.groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("copies")), "benchmark-items")
    n, chars = known.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    parts = max(1, -(-n // BLOCK_ITEMS), -(-chars // BLOCK_CHARS))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for k in range(parts):
        yield lambda k=k: spark.sparkContext.broadcast([tuple(r) for r in known.where(part == k).collect()])


def blocks(spark: SparkSession, items: DataFrame):
    """The broadcasts of :func:`block_makers`, one by one."""
    for make in block_makers(spark, items):
        yield make()


def matches(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, share: float = SHARE
) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared, containment`` of every item contained in a document.

    Containment is the share of the item's distinct shingles found anywhere in
    the whole text. Null and empty texts and items match nothing; an item of fewer
    words than ``width`` is contained where its words occur in a row. Repeated rows
    (of either side) give repeated rows; null ids are carried. One pass over
    ``docs`` per block of items; no benchmark, or no match: no rows.
    """
    schema = "doc_id long, item_id long, n_item long, n_shared long, containment double"
    found = None
    for rows in blocks(docs.sparkSession, items):

        def make(rows=rows):
            search = Search([((i, n), t) for i, t, n in rows.value], width, share)

            def work(ids, texts):
                hits = [
                    (d, i, *m) for d, t in zip(ids, texts) for (i, n), *m in search(t) for _ in range(n)
                ]
                d, i, n, s = (list(x) for x in zip(*hits)) if hits else ([], [], [], [])
                share_of = [b / a for a, b in zip(n, s)]
                return {"doc_id": d, "item_id": i, "n_item": n, "n_shared": s, "containment": share_of}

            return work

        part = map_texts(docs, make, schema)
        found = part if found is None else found.union(part)
    return found


def clean(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, share: float = SHARE
) -> DataFrame:
    """``docs`` without those that contain an item; columns unchanged.

    Null and empty texts stay, whole texts count however long, repeated rows share
    their text's fate, ids don't matter. A benchmark of one block is a filter
    without a shuffle. Of several blocks each is a pass of its own, whose worker
    holds that block alone; the leaking texts, known by a 128-bit hash, are then
    left out together.
    """
    spark = docs.sparkSession
    leaks = []
    for k, rows in enumerate(cut := list(block_makers(spark, items))):
        held = rows()
        if len(cut) == 1:
            return docs.where(~holds_any(held, width, share)("text"))
        texts = docs.select("text").where("text IS NOT NULL")
        hit = texts.where(holds_any(held, width, share)("text")).select(F.md5("text").alias("leak")).distinct()
        leaks.append(settle(hit, f"leaks-{k}"))
        held.unpersist()
    leaking = reduce(DataFrame.union, leaks).distinct()
    return docs.join(leaking, F.md5(F.coalesce(docs["text"], F.lit(""))) == leaking["leak"], "left_anti")


def holds_any(rows, width: int, share: float):
    """A column function: does a text contain an item of the broadcast block?"""
    searches: list[Search] = []  # built once per task

    @F.pandas_udf("boolean")
    def leaks(texts: pd.Series) -> pd.Series:
        if not searches:
            searches.append(Search([(i, t) for i, t, _ in rows.value], width, share))
        return texts.map(lambda t: bool(searches[0](t))).astype(bool)

    return leaks


MATCHES_SQL = """
WITH cut AS (
  SELECT kind, id, words, len(words) AS n FROM (
    SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS words FROM documents
    UNION ALL
    SELECT 'i', item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') FROM benchmark)
  WHERE len(words) > 0),
wide AS (
  SELECT kind, id, words, n, least(n, 5) AS w FROM cut WHERE kind = 'i'
  UNION ALL
  SELECT kind, id, words, n, w FROM cut, (SELECT DISTINCT least(n, 5) AS w FROM cut WHERE kind = 'i')
  WHERE kind = 'd' AND n >= w),
shingled AS (
  SELECT DISTINCT kind, id, w, unnest(list_transform(range(1, n - w + 2),
    lambda i: array_to_string(words[i:i + w - 1], ' '))) AS shingle FROM wide),
sizes AS (SELECT id AS item_id, count(*) AS n_item FROM shingled WHERE kind = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, any_value(s.n_item) AS n_item, count(*) AS n_shared,
  CAST(count(*) AS DOUBLE) / any_value(s.n_item) AS containment
FROM shingled d JOIN shingled i ON d.shingle = i.shingle AND d.w = i.w AND d.kind = 'd' AND i.kind = 'i'
JOIN sizes s ON s.item_id = i.id
GROUP BY d.id, i.id HAVING count(*) >= ceil(0.8 * any_value(s.n_item) - 1e-9)
"""
