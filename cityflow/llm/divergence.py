"""How far each source's use of words lies from the other sources of its language.

Terms are found and counted by sorting pointers. A task takes texts shard by
shard from their Arrow buffers, keeps a pointer to the first byte of every term,
and sorts the pointers by the terms they point to: a multikey quicksort whose
character is eight bytes, so pointers are ordered by eight bytes at once and only
runs of equal ones that go on are ordered by the next eight. A run of equal terms
then gives, per source, the number of occurrences and of documents. Texts are
never cut into lists of words, and a term is copied once per run and source.

The audit itself is a plan over those counts: document frequency per language
keeps the terms, smoothed shares are exact integers, and the divergence of two
sources is a sum over the terms both hold plus sums that depend on one of them
alone, so that no source is expanded to the whole vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityflow.llm.common import pieces
from cityflow.session import settle

LEAST_DOCUMENTS = 10
TOP = 10
SCALE = 1_000_000_000
#: Bytes of text whose pointers are sorted together; a task takes some 17 times as much.
SHARD = 4 << 20


def tables() -> tuple[np.ndarray, np.ndarray]:
    """Bytes that belong to terms (ASCII letters, all bytes past ASCII), and bytes with A-Z lower-cased."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    inside = lower >= 128
    inside[97:123] = inside[65:91] = True
    return inside, lower


_INSIDE, _LOWER = tables()


def term_pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and text number of every term of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    inside = _INSIDE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    # a text's border ends a term even between two letters
    cuts = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    lengths = np.flatnonzero(last) + 1 - starts
    return starts, lengths, np.searchsorted(offsets, starts, side="right") - 1


def sort_pointers(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the pointers by term that keeps equal terms as they were, and the number of each one's run.

    ``data`` must go on for eight zero bytes past the last term. No term holds a zero byte.
    """
    # an unaligned big-endian word at every byte
    words = np.ndarray(len(data) - 7, dtype=">u8", buffer=data, strides=(1,))
    keep = np.array([0] + [(1 << 64) - (1 << 8 * (8 - k)) for k in range(1, 9)], dtype=np.uint64)
    order = np.arange(len(starts))
    run = np.zeros(len(starts), dtype=np.int64)
    todo, depth = np.arange(len(starts)), 0  # places in the order that are still undecided
    while len(todo):
        at = order[todo]
        left = np.clip(lengths[at] - depth, 0, 8)
        key = words[np.minimum(starts[at] + depth, len(words) - 1)].astype(np.uint64) & keep[left]
        by = np.argsort(key, kind="stable") if depth == 0 else np.lexsort((key, run[todo]))
        order[todo] = at[by]
        key, left = key[by], left[by]
        # runs split where the key changes; run numbers are places of their first pointer
        new = np.empty(len(todo), dtype=bool)
        new[0] = True
        new[1:] = (key[1:] != key[:-1]) | (run[todo][1:] != run[todo][:-1])
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(todo)))
        run[todo] = np.repeat(todo[head], size)
        goes_on = np.repeat(size > 1, size) & (left == 8)
        todo, depth = todo[goes_on], depth + 8
    return order, run


def count_runs(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, document: np.ndarray, group: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per run of one term in one group: a pointer number, the group, occurrences, documents.

    Pointers must come ordered by group, and by document within it.
    """
    order, run = sort_pointers(data, starts, lengths)
    document, group = document[order], group[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (run[1:] != run[:-1]) | (group[1:] != group[:-1])
    other = new.copy()
    other[1:] |= document[1:] != document[:-1]
    head = np.flatnonzero(new)
    past = np.append(head, len(order))
    documents = np.diff(np.append(0, np.cumsum(other))[past])
    return order[head], group[head], np.diff(past), documents


def take_terms(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.StringArray:
    past = np.cumsum(lengths)
    place = np.arange(past[-1] if len(past) else 0) + np.repeat(starts - past + lengths, lengths)
    offsets = np.concatenate([[0], past]).astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(data[place]))


def term_counts(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """``lang, source, term, n, documents``: occurrences, and documents that hold the term.

    Null text, lang and source are read as empty. A text longer than a shard is
    gone through shard by shard; a document counts once for a term all the same.
    """
    read = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")))

    def count(data, offsets, groups):
        """Runs of one shard whose texts are ordered by group."""
        lower = np.zeros(len(data) + 8, dtype=np.uint8)
        lower[:-8] = _LOWER[data]
        starts, lengths, document = term_pointers(data, offsets)
        head, group, n, documents = count_runs(lower, starts, lengths, document, groups[document])
        return take_terms(lower, starts[head], lengths[head]), group, n, documents

    def rows(names, found):
        terms, group, n, documents = found
        taken = names.take(pa.array(group))
        return pa.RecordBatch.from_arrays(
            [taken.field(0), taken.field(1), terms, pa.array(n, pa.int64()), pa.array(documents, pa.int64())],
            names=["lang", "source", "term", "n", "documents"],
        )

    def long_text(data, name):
        """A text beyond the shard's size, cut between terms; terms of earlier cuts count no document."""
        start, seen = 0, set()
        while start < len(data):
            stop = min(len(data), start + shard)
            while stop < len(data) and _INSIDE[data[stop]]:
                stop += 1
            terms, group, n, _ = count(data[start:stop], np.array([0, stop - start]), np.zeros(1, np.int64))
            listed = terms.to_pylist()
            yield rows(name, (terms, group, n, np.array([t not in seen for t in listed], dtype=np.int64)))
            if stop < len(data):
                seen.update(listed)
            start = stop

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in pieces(batch, shard):
                held.append(part)
                size += part.nbytes
                if size >= shard:
                    yield from shards(pa.Table.from_batches(held))
                    held, size = [], 0
        if held:
            yield from shards(pa.Table.from_batches(held))

    def shards(texts: pa.Table) -> Iterator[pa.RecordBatch]:
        texts = texts.sort_by([("lang", "ascending"), ("source", "ascending")]).combine_chunks()
        for part in texts.to_batches():
            text = part.column(0).cast(pa.large_binary())
            offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
            if offsets[-1] == offsets[0]:
                continue
            data = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
            offsets = offsets - offsets[0]
            pairs = pa.StructArray.from_arrays([part.column(1), part.column(2)], ["lang", "source"])
            lang, source = part.column(1), part.column(2)
            new = np.ones(len(text), dtype=bool)
            if len(text) > 1:
                same = [np.asarray(pa.compute.equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False), dtype=bool) for c in (lang, source)]
                new[1:] = ~(same[0] & same[1])
            groups = np.cumsum(new) - 1
            names = pairs.take(pa.array(np.flatnonzero(new)))
            # consecutive texts make up a shard; one beyond the size is alone
            start = 0
            while start < len(text):
                stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + shard, side="right")) - 1)
                low, high = offsets[start], offsets[stop]
                if high - low > shard:
                    yield from long_text(data[low:high], names.take(pa.array(groups[start:stop])))
                elif high > low:
                    own = groups[start:stop]
                    yield rows(names.slice(own[0]), count(data[low:high], offsets[start : stop + 1] - low, own - own[0]))
                start = stop

    counts = read.mapInArrow(run, "lang string, source string, term string, n long, documents long")
    return counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def share(n: Column | str, total: Column | str, terms: Column | str) -> Column:
    """``1 + floor(SCALE * (n + 2) / (total + 2 * terms))``, exact for counts of any size."""
    n, total, terms = (F.col(c) if isinstance(c, str) else c for c in (n, total, terms))
    top = F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", top, (total + 2 * terms).cast("decimal(19,0)"))


def apart(p: Column | str, q: Column | str) -> Column:
    """``floor((p - q) ^ 2 / (p + q))`` of two shares."""
    p, q = (F.col(c) if isinstance(c, str) else c for c in (p, q))
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, shard: int = SHARD) -> DataFrame:
    """``lang, source, part, item, value, rank``: distances between sources, and each one's own terms.

    Part ``pair`` has each other source of the language with the sum of distances
    over all kept terms (those in ``least`` documents of the language or more), part
    ``term`` the ``top`` terms a source uses more than its language. Rank follows
    value, largest first, then the item's bytes. A null lang or source is the empty
    string and a group like any other; a lone source has no pairs, groups without
    kept terms have distance 0. Repeated rows count as often as they occur.
    """
    groups = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    counted = settle(term_counts(docs, shard), "term-counts")
    known = counted.groupBy("lang", "term").agg(F.sum("documents").alias("documents"), F.sum("n").alias("in_lang"))
    known = known.where(F.col("documents") >= least).select("lang", "term", "in_lang")
    kept = settle(counted.join(known, ["lang", "term"]).select("lang", "source", "term", "n", "in_lang"), "kept-terms")

    # N and V per language, N and the number of terms held per group; narrow tables
    langs = kept.groupBy("lang", "term").agg(F.max("in_lang").alias("n")).groupBy("lang").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("n").alias("lang_total"))
    held = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("held"))
    sizes = (
        groups.join(held, ["lang", "source"], "left").join(langs, "lang", "left")
        .fillna(0, ["total", "held", "terms", "lang_total"])
        .withColumn("zero", F.when(F.col("terms") > 0, share(F.lit(0), "total", "terms")).otherwise(F.lit(0)))
    )
    sizes = settle(sizes, "source-sizes")
    shares = (
        kept.join(sizes, ["lang", "source"])
        .withColumn("p", share("n", "total", "terms"))
        .withColumn("q", share("in_lang", "lang_total", "terms"))
    )

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    own = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), apart("p", "q").alias("value"))
    own = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    between = distances(shares, sizes).withColumn("rank", F.row_number().over(order))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return between.withColumn("part", F.lit("pair")).select(columns).union(
        own.withColumn("part", F.lit("term")).select(columns))


def distances(shares: DataFrame, sizes: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every two sources of a language, both ways round.

    With z the share of a term that a source lacks, the sum over all terms is
    that of f(p, z_b) over the terms of a, of f(z_a, q) over those of b, of
    f(z_a, z_b) over the rest, and a correction for the terms of both. The first
    two only need how many terms of a source have each count.
    """
    one = sizes.select("lang", F.col("source").alias("a"), F.col("zero").alias("za"), F.col("held").alias("na"), "terms")
    two = sizes.select("lang", F.col("source").alias("b"), F.col("zero").alias("zb"), F.col("held").alias("nb"))
    pairs = one.join(two, "lang").where("a < b")
    rest = pairs.select("lang", "a", "b", ((F.col("terms") - F.col("na") - F.col("nb")) * F.when(F.col("terms") > 0, apart("za", "zb")).otherwise(F.lit(0))).alias("value"))

    levels = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("times"))
    zeros = sizes.select("lang", F.col("source").alias("other"), F.col("zero").alias("z"))
    # a source's own levels against every share of absence in its language, sources with the same one together
    absences = zeros.groupBy("lang", "z").agg(F.count(F.lit(1)).alias("sharing"))
    lone = (
        levels.join(absences, "lang").groupBy("lang", "source", "z")
        .agg(F.sum(F.col("times") * apart("p", "z")).alias("value"))
        .join(zeros, ["lang", "z"]).where("source <> other")
        .select("lang", F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b"), "value")
    )

    left = shares.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("zero").alias("za"))
    right = shares.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("zero").alias("zb"))
    both = (
        left.join(right, ["lang", "term"]).where("a < b")
        .select("lang", "a", "b", (apart("pa", "pb") - apart("pa", "zb") - apart("za", "pb") + apart("za", "zb")).alias("value"))
    )
    total = rest.union(lone).union(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    return total.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").union(
        total.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))


AUDIT_SQL = r"""
WITH read AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
groups AS (SELECT DISTINCT lang, source FROM read),
kept AS (
    SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM read)
    GROUP BY lang, term HAVING count(*) >= 10),
said AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM read) GROUP BY ALL),
full_counts AS (
    SELECT g.lang, g.source, k.term, coalesce(s.n, 0) AS n
    FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN said s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term),
p AS (
    SELECT lang, source, term, n,
           1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p
    FROM full_counts),
q AS (
    SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q
    FROM (SELECT lang, term, sum(n) AS n FROM full_counts GROUP BY lang, term)),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
           coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY ALL
    UNION ALL
    SELECT p.lang, p.source, 'term', p.term, (p - q) * (p - q) // (p + q)
    FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
           CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""
