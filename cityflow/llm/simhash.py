"""SimHash near-dedup over pivot distance tables.

A text becomes a 64-bit fingerprint: a bit is set if it is set in over half of
the hashes of the text's word shingles. Fingerprints link within ``radius``
differing bits. Hamming distance is a metric, so two linked fingerprints have
distances to any reference fingerprint (pivot) that differ by ``radius`` at
most. Each distinct fingerprint carries its distances to many pivots; a pair is
dropped as soon as one coordinate differs more, and survivors are verified.

The pairs looked at come from keys that lose none: of ``radius + 1`` blocks of
bits one must be equal, and within it the distance to the first pivot must lie
in the same or in the next bin. The second pivot orders a group, so that only a
window of it is looked at.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import map_texts
from cityflow.llm.components import components
from cityflow.llm.pairs import arranged, merge, spread, whole_groups, windows
from cityflow.session import settle

SEED = 42
PIVOTS = 16
CHUNK = 1 << 16


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints, the same everywhere."""
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % i) for i in range(n)], dtype=np.uint64)


def fingerprint(text: str | None, width: int = 3) -> int:
    """The fingerprint of a whole text as an unsigned integer; no words: zero.

    Fewer words than ``width``: the whole sequence is the one shingle. A long
    text is hashed a bounded number of shingles at a time.
    """
    # bytes.lower and bytes.split know ASCII letters and blanks only, as wanted here
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < width:
        words = [b" ".join(words)]
        width = 1
    n = len(words) - width + 1
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, CHUNK):
        stop = min(n, start + CHUNK)
        shingles = map(b" ".join, zip(*(words[start + k : stop + k] for k in range(width))))
        digests = b"".join(map(xxhash.xxh64_digest, shingles, repeat(SEED)))
        bits = np.unpackbits(np.frombuffer(digests, dtype=np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id, fp`` per row of ``docs``; ``fp`` holds the 64 bits as a signed long."""

    def make():
        def work(ids, texts):
            prints = np.array([fingerprint(t, width) for t in texts], dtype=np.uint64)
            return {"doc_id": ids, "fp": prints.view(np.int64)}

        return work

    return map_texts(docs, make, "doc_id long, fp long")


def links(prints: DataFrame, radius: int = 2, limit: int = 8192) -> DataFrame:
    """Links ``u, v`` between distinct fingerprints (column ``fp``) that connect all within ``radius``.

    Within a group of candidates only a star per connected part is returned: a
    dense group of n fingerprints gives n - 1 rows, not n squared.
    """
    table = pivots()
    first = int(table[:1].view(np.int64)[0])
    edges = [round(64 * i / (radius + 1)) for i in range(radius + 2)]
    blocks = F.array(
        *(
            F.xxhash64(
                F.lit(i),
                F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << (high - low)) - 1)),
            )
            for i, (low, high) in enumerate(zip(edges, edges[1:]))
        )
    )
    bin_of = lambda d: F.floor(d / (radius + 1)).cast("int")
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.lit(first)))
    rows = (
        prints.select("fp", F.explode(blocks).alias("block"), distance.alias("d"))
        # at home in its own bin, a visitor in the next if that is within reach
        .select("fp", "block", F.explode(F.array_distinct(F.array(bin_of(F.col("d")), bin_of(F.col("d") + radius)))).alias("bin"), bin_of(F.col("d")).alias("own"))
        .select("fp", F.xxhash64("block", "bin").alias("key"), (F.col("bin") == F.col("own")).alias("home"))
    )

    def compare(batches):
        for part in whole_groups(batches):
            group = part.column("group").to_numpy()
            fp = part.column("fp").to_numpy().view(np.uint64)
            home = part.column("home").to_numpy(zero_copy_only=False)
            side = part.column("side").to_numpy()
            cross = part.column("cross").to_numpy(zero_copy_only=False)
            second = np.bitwise_count(fp ^ table[1]).astype(np.int16)
            order = np.lexsort((second, group))
            group, fp, home, side, cross, second = (
                a[order] for a in (group, fp, home, side, cross, second)
            )
            far = np.stack([np.bitwise_count(fp ^ p).astype(np.int16) for p in table])
            labels = np.arange(len(fp))
            held, size = [], 0
            for left, right in windows(group, second, radius):
                keep = (home[left] | home[right]) & (~cross[left] | (side[left] != side[right]))
                left, right = left[keep], right[keep]
                for coordinate in far:
                    near = np.abs(coordinate[left] - coordinate[right]) <= radius
                    left, right = left[near], right[near]
                near = np.bitwise_count(fp[left] ^ fp[right]) <= radius
                held.append((left[near], right[near]))
                size += int(near.sum())
                if size > 1 << 20:
                    labels = merge(labels, *(np.concatenate(x) for x in zip(*held)))
                    held, size = [], 0
            if held:
                labels = merge(labels, *(np.concatenate(x) for x in zip(*held)))
            moved = np.flatnonzero(labels != np.arange(len(fp)))
            bits = fp.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bits[moved]), pa.array(bits[labels[moved]])], names=["u", "v"]
            )

    return arranged(spread(rows, "key", "fp", limit)).mapInArrow(compare, "u long, v long")


def near_duplicates(
    docs: DataFrame, width: int = 3, radius: int = 2, limit: int = 8192
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs``.

    ``component_id`` is the smallest doc_id that a document reaches over links,
    itself included. Equal fingerprints are one node, whatever their number.
    Null and empty texts have fingerprint zero and link like any other; a null
    doc_id keeps its row and takes its component's id, null if no id is known;
    repeated rows stay repeated. An empty table gives an empty result.
    """
    prints = settle(fingerprints(docs, width), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    parts = components(links(classes.select("fp"), radius, limit))
    named = (
        classes.join(parts, classes["fp"] == parts["node"], "left")
        .select("fp", "least", F.coalesce("component", "fp").alias("part"))
    )
    # a part's smallest id: parts of one fingerprint need no second look
    smallest = named.groupBy("part").agg(F.min("least").alias("component_id"))
    ids = named.join(smallest, "part").select("fp", "component_id")
    return prints.join(ids, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def one_of_each(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each group of linked fingerprints: that of the smallest doc_id.

    Unknown ids come last, equal ids are ordered by a hash of the text; so a
    group of nothing but null ids keeps one row too, repeated rows leave one,
    and one id with texts of several groups keeps a row in each. Null, empty and
    blank texts share fingerprint zero and are one group. Long texts count
    whole. Columns are unchanged; an empty table stays empty.
    """
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))

    def make():
        def work(ids, texts, hashes):
            prints = np.array([fingerprint(t, width) for t in texts], dtype=np.uint64)
            return {"doc_id": ids, "th": hashes, "fp": prints.view(np.int64)}

        return work

    signs = settle(map_texts(texts, make, "doc_id long, th long, fp long", ("doc_id", "text", "th")), "signs")
    classes = signs.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "th")).alias("first"))
    parts = components(links(classes.select("fp"), radius))
    named = classes.join(parts, classes["fp"] == parts["node"], "left")
    kept = named.groupBy(F.coalesce("component", "fp")).agg(F.min("first").alias("first"))
    # ids are not keys: a kept row is known by id and text; columns travel packed, so that no name can clash
    packed = docs.select("doc_id", F.xxhash64("text").alias("th"), F.struct(*docs.columns).alias("row"))
    kept = kept.select(F.col("first.doc_id").alias("kept_id"), F.col("first.th").alias("kept_th"))
    rows = packed.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("th") == F.col("kept_th")))
    return rows.groupBy("doc_id", "th").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")
