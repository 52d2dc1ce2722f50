"""Fill-in-the-middle forms of whole texts, over memoized content-defined chunks.

A text is cut into units (a word with the blanks before it; blanks at the end are
a unit), two cuts are drawn per document from a hash of its id, and the three
parts are put in one of two orders behind markers, or the text is left plain.

Units are never listed. A rolling hash over the bytes cuts a text into chunks
whose borders depend on nearby content alone, so texts that share a passage share
its chunks. A chunk's summary (does it begin and end inside a word, how many words
end in it, how many code points) is worked out once and kept under the chunk's own
bytes: equal content, not an equal hash, finds it. Summaries add up: running sums
over a text's chunks give the number of units and the chunk that holds a cut, and
only that chunk is searched for the place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import pieces

SEED = 42
#: Percent of eligible texts that are transformed, and of these in suffix-first order.
RATE, SUFFIX_FIRST = 50, 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

#: Bytes the rolling hash sees, and the least and greatest size of a chunk; on average 1 in 512 places cuts.
SPAN, LEAST, MOST = 32, 128, 4096
CUT_BITS = np.uint64(511 << 40)
#: Bytes hashed at a time, and bytes of chunks a worker remembers.
SLAB, REMEMBERED = 1 << 20, 64 << 20

_GEAR = np.random.default_rng(SEED).integers(0, 1 << 64, 256, dtype=np.uint64)
_FACTOR = 0x9E3779B97F4A7C15


def blank_table() -> np.ndarray:
    blank = np.zeros(256, dtype=bool)
    blank[[0x20, *range(0x09, 0x0E)]] = True
    return blank


_BLANK = blank_table()


def cut_places(data: np.ndarray) -> np.ndarray:
    """Places after which the rolling hash of the last SPAN bytes asks for a cut.

    The hash of 2w bytes is that of the last w plus a multiple of that of the w
    before, so a window takes log2(SPAN) passes. Places before SPAN bytes are none.
    """
    found = []
    for start in range(0, len(data), SLAB):
        low = max(0, start - SPAN + 1)
        h = _GEAR[data[low : start + SLAB]]
        if len(h) < SPAN:
            break
        width, factor = 1, _FACTOR
        while width < SPAN:
            h = h[width:] + h[:-width] * np.uint64(factor)
            factor = factor * factor % (1 << 64)
            width *= 2
        found.append(np.flatnonzero((h & CUT_BITS) == 0) + low + SPAN)
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def borders(start: int, stop: int, places: np.ndarray) -> list[int]:
    """Chunk borders of the text ``data[start:stop]``: LEAST to MOST bytes each, the last may be shorter."""
    out, last = [start], start
    for place in places[np.searchsorted(places, start + LEAST) : np.searchsorted(places, stop)].tolist():
        while place - last > MOST:
            last += MOST
            out.append(last)
        if place - last >= LEAST:
            out.append(place)
            last = place
    while stop - last > MOST:
        last += MOST
        out.append(last)
    if stop > last:
        out.append(stop)
    return out


def word_ends(chunk: bytes) -> np.ndarray:
    """Places past a word's last byte, where a blank of the same chunk follows."""
    blank = _BLANK[np.frombuffer(chunk, dtype=np.uint8)]
    return np.flatnonzero(~blank[:-1] & blank[1:]) + 1


def code_points(chunk: bytes) -> int:
    raw = np.frombuffer(chunk, dtype=np.uint8)
    return len(raw) - int(np.count_nonzero((raw & 0xC0) == 0x80))


class Chunks:
    """Summaries of chunks, under the chunks' bytes; emptied when they are too many."""

    def __init__(self, remembered: int = REMEMBERED):
        self.remembered, self.held, self.known = remembered, 0, {}

    def summary(self, chunk: bytes) -> tuple[bool, bool, int, int]:
        """Begins in a word, ends in a word, words ended by a blank of the chunk, code points."""
        found = self.known.get(chunk)
        if found is None:
            if self.held > self.remembered:
                self.held, self.known = 0, {}
            found = (not _BLANK[chunk[0]], not _BLANK[chunk[-1]], len(word_ends(chunk)), code_points(chunk))
            self.known[chunk] = found
            self.held += len(chunk) + 200
        return found


class Text:
    """A text as its chunks' summaries, summed up."""

    def __init__(self, data: memoryview, edges: list[int], chunks: Chunks):
        self.chunks = [bytes(data[a:b]) for a, b in zip(edges, edges[1:])]
        rows = [chunks.summary(c) for c in self.chunks]
        # a word that reaches a chunk's end ends there unless the next chunk goes on with it
        goes_on = [r[0] for r in rows[1:]] + [False]
        ends = [inner + (last and not on) for (_, last, inner, _), on in zip(rows, goes_on)]
        self.ends = np.cumsum(ends, dtype=np.int64) if rows else np.zeros(0, np.int64)
        self.words = int(self.ends[-1]) if rows else 0
        self.units = self.words + (bool(rows) and not rows[-1][1])
        self.at = np.array(edges, dtype=np.int64) - edges[0]
        self.points = np.concatenate([[0], np.cumsum([r[3] for r in rows], dtype=np.int64)])

    def cut(self, unit: int) -> tuple[int, int]:
        """Bytes and code points before the end of unit number ``unit``."""
        if unit == 0:
            return 0, 0
        if unit > self.words:
            return int(self.at[-1]), int(self.points[-1])
        k = int(np.searchsorted(self.ends, unit))
        inside = unit - int(self.ends[k - 1] if k else 0)
        places = word_ends(self.chunks[k])
        if inside > len(places):  # the word that the chunk's end closes
            return int(self.at[k + 1]), int(self.points[k + 1])
        place = int(places[inside - 1])
        return int(self.at[k]) + place, int(self.points[k]) + code_points(self.chunks[k][:place])


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from the id; an unknown id is written as nothing."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * k : 4 * k + 4], "big") for k in range(4))


def transform(
    docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED, remembered: int = REMEMBERED
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` per row of ``docs``.

    ``n`` counts units; ``form`` is ``plain``, ``psm`` or ``spm``; ``output`` is the
    whole text in that form. Null text is read as empty, and empty texts, texts that
    hold a marker and texts not drawn stay plain, with null lengths. Equal rows
    give equal rows. Other columns are not read. No rows: no rows.
    """
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks(remembered)
        for batch in batches:
            for rows in pieces(batch, 4 << 20):
                yield infill(rows, chunks)

    def infill(rows: pa.RecordBatch, chunks: Chunks) -> pa.RecordBatch:
        ids = rows.column(0).to_pylist()
        texts = rows.column(1).cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        view = memoryview(data) if data is not None else memoryview(b"")
        places = cut_places(np.frombuffer(view, np.uint8)[offsets[0] : offsets[-1]]) + offsets[0]
        empty = texts.is_null().to_numpy(zero_copy_only=False)
        n, forms, before, inside, outputs = [], [], [], [], []
        for k, doc_id in enumerate(ids):
            start, stop = (0, 0) if empty[k] else (int(offsets[k]), int(offsets[k + 1]))
            whole = bytes(view[start:stop])
            text = Text(view, borders(start, stop, places), chunks)
            h1, h2, h3, h4 = draws(doc_id, seed)
            n.append(text.units)
            if not whole or h3 % 100 >= rate or any(m in whole for m in (PREFIX, SUFFIX, MIDDLE)):
                forms.append("plain")
                before.append(None)
                inside.append(None)
                outputs.append(whole)
                continue
            units = sorted((h1 % (text.units + 1), h2 % (text.units + 1)))
            (a, a_points), (b, b_points) = map(text.cut, units)
            before.append(a_points)
            inside.append(b_points - a_points)
            if h4 % 100 < suffix_first:
                forms.append("spm")
                outputs.append(b"".join((SUFFIX, whole[b:], PREFIX, whole[:a], MIDDLE, whole[a:b])))
            else:
                forms.append("psm")
                outputs.append(b"".join((PREFIX, whole[:a], SUFFIX, whole[b:], MIDDLE, whole[a:b])))
        return pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(before, pa.int64()),
             pa.array(inside, pa.int64()), pa.array(outputs, pa.binary()).view(pa.string())],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text again: a transformed one holds each marker once, so its parts are known."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    part = F.split(output, "<[PSM]>")
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(part[1], part[3], part[2]))
        .otherwise(F.concat(part[2], part[3], part[1]))
    )


def digest(docs: DataFrame) -> DataFrame:
    """The transform's lengths, and SHA-256 of each output and of the text rebuilt from it."""
    return transform(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"),
    )


DIGEST_SQL = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
    FROM documents),
drawn AS (
    SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n,
           CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS a,
           CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                     OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
                WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM cut),
parts AS (
    SELECT doc_id, t, n, form, array_to_string(u[1:least(a, b)], '') AS p,
           array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
           array_to_string(u[greatest(a, b) + 1:], '') AS s
    FROM drawn)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
