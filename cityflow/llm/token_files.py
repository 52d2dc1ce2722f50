"""Token ids in ORC: one row per document, in ascending order of id.

ORC keeps an array of ids as integer runs (run-length encoding), cuts a file
into stripes that are read in parallel, and holds row indexes and a Bloom filter
on ``doc_id``, so a lookup by id reads metadata first and few stripes after.
Each file is one range of ids; ``part`` numbers the ranges in order.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cityflow.llm.common import pieces
from cityflow.session import run_dir, settle

END = 2
TOKENIZER = "byte_bpe_50k.json"
#: Distinct words whose ids a Python worker remembers.
REMEMBERED = 600_000
LAYOUT = "doc_id long, part int, at long, ids array<int>"

ORC = {
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "compression": "zstd",
}

BETWEEN = re.compile(r"(?<=\S) (?=\S)|(?<=\S)(?=\n\S)")
INNER = re.compile(r"\s")


def byte_letters() -> dict[int, str]:
    """The printable stand-in that byte-level vocabularies use for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class Words(dict):
    """Numbers of words; a new word gets the next number and is noted.

    A word is kept with what stands before it: a blank (left out of the key) or a
    line end (the key's first character). Empty words and white space at either
    side of a word tell that the text is not cut between non-blanks: such words
    get no number, and ``irregular`` is set.
    """

    def __init__(self):
        self.new: list[str] = []
        self.count, self.irregular = 0, False

    def __missing__(self, word: str) -> int:
        rest = word[1:] if word[:1] == "\n" else word
        if not rest or rest[0].isspace() or rest[-1].isspace():
            self.irregular = True
            return -1
        return self.number(word)

    def number(self, word: str) -> int:
        self[word] = code = self.count
        self.count += 1
        self.new.append(word)
        return code


class Encoder:
    """Ids of whole texts from the tokenizers library, each distinct word encoded once.

    The byte-level pattern never joins over a single blank or line end between
    two non-blanks, so a text's ids are those of the words between them. Words
    repeat: their ids are kept in one pool, and a text's ids are gathered from it.
    What a batch of texts has of new words is encoded in few calls. The pool is
    emptied when it is full.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.model._resize_cache(0)  # words are remembered here
        # a word of letters is one piece of the pattern: cut before blanks, already in stand-ins
        self.of_letters = Tokenizer.from_file(path)
        self.of_letters.model._resize_cache(0)
        self.letters = byte_letters()
        blank, line_end = self.letters[0x20], self.letters[0x0A]
        self.of_letters.pre_tokenizer = pre_tokenizers.Split(blank, "merged_with_next")
        self.remembered = remembered
        # ids whose piece begins with a blank or a line end
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.begins[[i for piece, i in vocabulary.items() if piece[:1] in (blank, line_end)]] = True
        self.clear()

    def clear(self) -> None:
        self.known, self.odd = Words(), {}
        self.pool = array("i")
        self.starts, self.sizes = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.end = self.unnamed(np.array([END]))

    def ids(self, text: str, tokenizer=None) -> np.ndarray:
        found, = (tokenizer or self.tokenizer).encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, dtype=np.int64)

    def keep(self, codes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Put the ids of words, one after the other, into the pool."""
        while len(self.starts) < self.known.count:
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        self.starts[codes] = np.cumsum(sizes) - sizes + len(self.pool)
        self.sizes[codes] = sizes
        self.pool.frombytes(ids.astype(np.int32).tobytes())

    def unnamed(self, ids: np.ndarray) -> int:
        """A number for ids that belong to no word."""
        code = self.known.count
        self.known.count += 1
        self.keep(np.array([code]), ids, np.array([len(ids)]))
        return code

    def learn(self) -> None:
        """Encode the words noted as new: those without inner white space together."""
        words, first = self.known.new, self.known.count - len(self.known.new)
        left = list(range(len(words)))
        letters = [k for k in left if words[k].isalpha()]
        mixed = [k for k in left if not words[k].isalpha()]
        if INNER.search("".join(words[k][1:] for k in mixed)):
            mixed = [k for k in mixed if not INNER.search(words[k], 1)]
        done = self.together(words, letters, first, True) | self.together(words, mixed, first, False)
        for k in left:
            if k not in done:
                word = words[k]
                ids = self.ids(word if word[:1] == "\n" else " " + word)
                self.keep(np.array([first + k]), ids, np.array([len(ids)]))
        words.clear()

    def together(self, words: list[str], chosen: list[int], first: int, letters: bool) -> set[int]:
        """Encode the chosen words as one text; those whose ids were told apart."""
        done: set[int] = set()
        for start in range(0, len(chosen), 4096):
            part = chosen[start : start + 4096]
            text = "".join([w if w[0] == "\n" else " " + w for w in map(words.__getitem__, part)])
            if letters:
                text = text.encode("utf-8").decode("latin-1").translate(self.letters)
            ids = self.ids(text, self.of_letters if letters else self.tokenizer)
            heads = np.flatnonzero(self.begins[ids])
            if len(heads) == len(part):
                self.keep(np.array(part) + first, ids, np.diff(np.append(heads, len(ids))))
                done.update(part)
        return done

    def codes(self, text: str) -> list[int]:
        """Numbers of the words of a text that begins with a non-blank; the first stands behind an added line end."""
        known = self.known
        known.irregular = False
        found = list(map(known.__getitem__, ("\n" + text.replace("\n", " \n")).split(" ")))
        if known.irregular:
            found = [self.odd_code(w) for w in BETWEEN.split("\n" + text)]
        return found

    def odd_code(self, word: str) -> int:
        """The number of a word that may hold white space anywhere."""
        code = self.known.get(word)
        if code is None:
            code = self.odd.get(word)
        if code is None:
            code = self.odd[word] = self.known.number(word)
            del self.known[word]  # a plain cut must not find it
        return code

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, with its end id, and all ids in a row."""
        if self.known.count > self.remembered or len(self.pool) > 16 * self.remembered:
            self.clear()
        # a text that begins with white space is encoded whole: nothing may be put before it
        led = [bool(t) and not t[0].isspace() for t in texts]
        rows = [self.codes(t) if cut else [] for t, cut in zip(texts, led)]
        self.learn()
        for row, t, cut in zip(rows, texts, led):
            if t and not cut:
                row.append(self.unnamed(self.ids(t)))
            row.append(self.end)
        places = np.fromiter(chain.from_iterable(rows), dtype=np.int64)
        lengths = np.array([len(r) for r in rows], dtype=np.int64)
        starts, each = self.starts[places], self.sizes[places]
        # what was added in front is one id
        front = (np.cumsum(lengths) - lengths)[np.array(led, dtype=bool)]
        starts[front] += 1
        each[front] -= 1
        past = np.cumsum(each)
        place = np.arange(past[-1] if len(past) else 0) + np.repeat(starts - past + each, each)
        ids = np.frombuffer(self.pool, np.int32)[place]
        return np.diff(past[np.cumsum(lengths) - 1], prepend=0), ids


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker; workers are reused from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, part, at, ids``: the ids of each text of ``docs`` with the end id.

    ``part`` is the task, ``at`` the ids of the task's rows before this one. Null
    text is read as empty and has the end id only.
    """
    path = path or public_tokenizers.path(TOKENIZER)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, part, seen = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in pieces(batch, 2 << 20):
                sizes, ids = work.encode(rows.column(1).to_pylist())
                past = np.cumsum(sizes)
                offsets = np.concatenate([[0], past]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.full(len(sizes), part, np.int32)),
                     pa.array(past - sizes + seen), pa.ListArray.from_arrays(offsets, ids)],
                    names=["doc_id", "part", "at", "ids"],
                )
                seen += int(past[-1])

    return docs.select("doc_id", "text").mapInArrow(run, LAYOUT)


def write(docs: DataFrame, out: str, path: str | None = None) -> str:
    """Write the token ids of ``docs`` as ORC files below ``out``; returns ``out``.

    The texts, not the longer ids, are what is sorted: ascending by doc_id, null
    first, equal ids by text. Every task then encodes and writes one range.
    """
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    encode(ordered, path).write.options(**ORC).orc(out)
    return out


def read(spark: SparkSession, out: str) -> DataFrame:
    """The rows of the files; a filter on ``doc_id`` prunes stripes by index and Bloom filter."""
    return spark.read.schema(LAYOUT).orc(out)


def digest(spark: SparkSession, out: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, from the files alone.

    ``start`` counts the ids of all documents before it: its place in its range
    plus the totals of the ranges before (one row per range). Ids are never
    shuffled. Repeated ids keep their rows. No files, or no rows: no rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy()
            flat = ids.values.to_numpy().astype("<u4", copy=False)
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), batch.column("at"),
                 pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())],
                names=["doc_id", "part", "at", "n_tokens", "ids_crc32"],
            )

    rows = settle(
        read(spark, out).mapInArrow(
            run, "doc_id long, part int, at long, n_tokens long, ids_crc32 long"
        ),
        "token-digest",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("part").agg(F.max(F.col("at") + F.col("n_tokens")).alias("total"))
    ranges = ranges.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return rows.join(ranges, "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def write_and_digest(docs: DataFrame, path: str | None = None, out: str | None = None) -> DataFrame:
    """Write ``docs`` below ``out`` (a fresh shared folder by default) and report from the files."""
    spark = docs.sparkSession
    return digest(spark, write(docs, out or run_dir(spark, "tokens"), path))
