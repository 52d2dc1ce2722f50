"""Quality rules on how public vocabularies take a text apart.

Vocabularies learnt on clean prose need few tokens for prose and many for noise.
Two are read as published: byte-level BPE (``byte_bpe_50k.tiktoken``) and BPE with
byte fallback (``piece_bpe_32k.model``). Each whole text has its characters per
token under both, the share of tokens that are single fallback bytes, and the
entropy of its tokens against the most that they could have. A band per
language, or else per script, says what is kept.

Counting rules come first: too few words, or too many words in repeated windows.
"""

from __future__ import annotations

import base64
import math
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from cityflow.llm.common import arrow_types, pieces
from cityflow.llm.token_files import BETWEEN, INNER, Words

BYTE_VOCABULARY = "byte_bpe_50k.tiktoken"
PIECE_VOCABULARY = "piece_bpe_32k.model"

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
LEAST_WORDS, WINDOW, REPEATED_PERCENT = 20, 8, 30
#: Characters measured at a time; a longer text is cut before single blanks and its counts are added.
PART = 1 << 20
#: Words a worker remembers.
REMEMBERED = 400_000
#: The piece vocabulary's sign for a blank.
BLANK_PIECE = "\u2581"


@dataclass(frozen=True)
class Band:
    """What is kept: characters per token (the larger of both vocabularies), byte fallback, entropy."""

    least: float
    most: float = 12.0
    fallback: float = 0.2
    entropy: float = 0.4


@dataclass(frozen=True)
class Bands:
    """Bands by language code where one is set, else by the script most letters belong to."""

    by_script: dict[str, Band] = field(default_factory=lambda: dict(SCRIPT_BANDS))
    by_lang: dict[str, Band] = field(default_factory=dict)

    def of(self, lang: str | None, script: str) -> Band:
        return self.by_lang.get(lang) or self.by_script.get(script) or self.by_script["other"]


#: Both vocabularies hold mostly Latin words; other alphabets take about a token a
#: letter, and scripts of many signs up to three byte tokens a sign.
SCRIPT_BANDS = {
    "latin": Band(1.9),
    "greek": Band(0.7),
    "cyrillic": Band(0.9),
    "semitic": Band(0.6, fallback=0.5),
    "indic": Band(0.3, fallback=0.9),
    "kana": Band(0.4, fallback=0.6),
    "han": Band(0.35, fallback=0.7),
    "hangul": Band(0.35, fallback=0.9),
    "other": Band(0.3, fallback=0.9),
}

#: First code point of each run of blocks, and its script; letters outside are of no script.
_RUNS = [
    (0x00, ""), (0x41, "latin"), (0x5B, ""), (0x61, "latin"), (0x7B, ""), (0xC0, "latin"), (0x370, "greek"),
    (0x400, "cyrillic"), (0x530, "other"), (0x590, "semitic"), (0x900, "indic"), (0xE00, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, ""), (0x3040, "kana"), (0x3100, "han"), (0xAC00, "hangul"), (0xD7B0, ""), (0xF900, "han"),
    (0xFB00, ""), (0x20000, "han"), (0x32000, ""),
]
_NAMES = sorted({name for _, name in _RUNS})
#: Number of the script of every code point up to the last run; those past it have the last run's.
_WHICH = np.repeat(
    np.array([_NAMES.index(name) for _, name in _RUNS], dtype=np.uint8),
    np.diff([first for first, _ in _RUNS] + [_RUNS[-1][0] + 1]),
)


def script(text: str) -> str:
    """The script of most letters, by name among equals; no letter: ``other``."""
    counts = np.zeros(len(_NAMES), dtype=np.int64)
    for start in range(0, len(text), PART):
        points = np.frombuffer(text[start : start + PART].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        counts += np.bincount(_WHICH[np.minimum(points, len(_WHICH) - 1)], minlength=len(_NAMES))
    counts[_NAMES.index("")] = 0
    return _NAMES[int(counts.argmax())] if counts.any() else "other"


def parts(text: str, size: int = PART) -> Iterator[str]:
    """The text in parts of about ``size`` characters, cut before a blank between two words.

    Without such a blank nearby a part ends at its size.
    """
    start = 0
    while len(text) - start > size:
        found = list(re.finditer(r"(?<=[^\s]) (?=[^\s])", text[start + size // 2 : start + size]))
        stop = start + size // 2 + found[-1].start() if found else start + size
        yield text[start:stop]
        start = stop
    yield text[start:]


class Vocabularies:
    """Both published vocabularies, loaded once per worker, and what they made of words seen before.

    Neither joins over a single blank or line end between two non-blanks, so a
    text's tokens are those of the words between, each with what stands before it:
    a blank (left out of the key) or a line end (the key's first character). New
    words of many texts are encoded together and remembered, until too many are.
    """

    def __init__(self, byte_path: str, piece_path: str, remembered: int = REMEMBERED):
        import sentencepiece
        import tiktoken

        with open(byte_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes = tiktoken.Encoding("published", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        names = [self.pieces.IdToPiece(i) for i in range(self.pieces.GetPieceSize())]
        self.fallback = np.array([self.pieces.IsByte(i) for i in range(len(names))])
        self.byte_begins = np.zeros(max(ranks.values()) + 1, dtype=bool)
        self.byte_begins[[i for b, i in ranks.items() if b[:1] in (b" ", b"\n")]] = True
        self.piece_begins = np.array([n.startswith(BLANK_PIECE) or n == "<0x0A>" for n in names])
        self.remembered = remembered
        self.clear()

    def clear(self) -> None:
        self.known = Words()
        self.odd: dict[str, int] = {}
        self.pool = array("i")
        size = 1 << 16
        self.starts, self.sizes, self.byte_counts = (np.zeros(size, np.int64) for _ in range(3))

    def byte_ids(self, text: str) -> np.ndarray:
        return self.bytes.encode_to_numpy(text, disallowed_special=())

    def piece_ids(self, text: str) -> np.ndarray:
        return np.array(self.pieces.encode(text), dtype=np.int64)

    def learn(self) -> None:
        """Encode the words noted as new, under both vocabularies: those without inner white space together."""
        words, first = self.known.new, self.known.count - len(self.known.new)
        while len(self.starts) < self.known.count:
            self.starts, self.sizes, self.byte_counts = (
                np.concatenate([a, np.zeros_like(a)]) for a in (self.starts, self.sizes, self.byte_counts)
            )
        plain = list(range(len(words)))
        if INNER.search("".join([w[1:] for w in words])):
            plain = [k for k in plain if not INNER.search(words[k], 1)]
        for of, done in ((self.bytes_of, set()), (self.pieces_of, set())):
            for start in range(0, len(plain), 4096):
                part = plain[start : start + 4096]
                text = "".join([w if w[0] == "\n" else " " + w for w in map(words.__getitem__, part)])
                if of(text, np.array(part) + first, True):
                    done.update(part)
            for k, word in enumerate(words):
                if k not in done:
                    of(word if word[:1] == "\n" else " " + word, np.array([first + k]), False)
        words.clear()

    def bytes_of(self, text: str, codes: np.ndarray, together: bool) -> bool:
        ids = self.byte_ids(text)
        heads = np.flatnonzero(self.byte_begins[ids]) if together else np.array([0])
        if len(heads) != len(codes):
            return False
        self.byte_counts[codes] = np.diff(np.append(heads, len(ids)))
        return True

    def pieces_of(self, text: str, codes: np.ndarray, together: bool) -> bool:
        # the vocabulary puts a blank before a text by itself; a letter leads here that takes it
        ids = self.piece_ids("a" + text)[1:]
        heads = np.flatnonzero(self.piece_begins[ids]) if together else np.array([0])
        if len(heads) != len(codes) or heads[0]:
            return False
        self.starts[codes] = heads + len(self.pool)
        self.sizes[codes] = np.diff(np.append(heads, len(ids)))
        self.pool.frombytes(ids.astype(np.int32).tobytes())
        return True

    def codes(self, text: str) -> list[int]:
        """Numbers of a text's words, and last that of its first word behind a line end."""
        known = self.known
        known.irregular = False
        found = list(map(known.__getitem__, text.replace("\n", " \n").split(" ")))
        if known.irregular:
            cut = BETWEEN.split(text)
            return [*map(self.odd_code, cut), self.odd_code("\n" + cut[0])]
        found.append(known["\n" + text.split(" ", 1)[0].split("\n", 1)[0]])
        return found

    def odd_code(self, word: str) -> int:
        """The number of a word that may hold white space anywhere."""
        code = self.known.get(word, self.odd.get(word))
        if code is None:
            code = self.odd[word] = self.known.number(word)
            del self.known[word]  # a plain cut must not find it
        return code

    def measure(self, texts: list[str]) -> list[tuple[int, int, int, float]]:
        """Per text: tokens of both vocabularies, fallback bytes, entropy as a share of the greatest."""
        if self.known.count > self.remembered or len(self.pool) > 16 * self.remembered:
            self.clear()
        whole = [bool(t) and len(t) <= PART and not t[0].isspace() and BLANK_PIECE not in t for t in texts]
        rows = [self.codes(t) for t, cut in zip(texts, whole) if cut]
        self.learn()
        pool = np.frombuffer(self.pool, np.int32)
        at = np.fromiter(chain.from_iterable(rows), np.int64)
        counts, starts, sizes = self.byte_counts[at], self.starts[at], self.sizes[at]
        out, stop = [], 0
        rows = iter(rows)
        for text, cut in zip(texts, whole):
            if not cut:
                out.append(self.measure_parts(text))
                continue
            start, stop = stop, stop + len(next(rows))
            # the first word counts behind a line end, which is one token, and not behind a blank
            byte_tokens = int(counts[start:stop].sum() - counts[start] - 1)
            each = sizes[start : stop - 1]
            past = np.cumsum(each)
            ids = pool[np.arange(past[-1]) + np.repeat(starts[start : stop - 1] - past + each, each)]
            out.append((byte_tokens, *self.shape(*np.unique(ids, return_counts=True))))
        return out

    def measure_parts(self, text: str) -> tuple[int, int, int, float]:
        """A text that is long, begins with white space or holds the sign for a blank, part by part."""
        byte_tokens, counts = 0, np.zeros(len(self.fallback), dtype=np.int64)
        for k, part in enumerate(parts(text)):
            byte_tokens += len(self.byte_ids(part))
            counts += np.bincount(self.piece_ids(part[1:] if k and part[:1] == " " else part), minlength=len(counts))
        ids = np.flatnonzero(counts)
        return byte_tokens, *self.shape(ids, counts[ids])

    def shape(self, ids: np.ndarray, counts: np.ndarray) -> tuple[int, int, float]:
        total = int(counts.sum())
        share = counts / max(total, 1)
        entropy = float(-(share * np.log2(share)).sum())
        level = entropy / math.log2(min(total, len(self.fallback))) if total > 1 else float(total)
        return total, int(counts[self.fallback[ids]].sum()), level


@lru_cache(maxsize=2)
def vocabularies(byte_path: str, piece_path: str) -> Vocabularies:
    return Vocabularies(byte_path, piece_path)


def repeated_words(said: list[bytes], document: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """True for the words in windows of ``window`` words found twice or more in their document.

    Windows of one hash are candidates (equal windows have one hash), and only
    those are compared word by word.
    """
    covered = np.zeros(len(said), dtype=bool)
    if len(said) < window:
        return covered
    mixed = np.fromiter(map(hash, said), np.int64, len(said)).astype(np.uint64)
    count = len(said) - window + 1
    key = document[:count].astype(np.uint64)
    for k in range(window):
        key = key * np.uint64(0xD6E8FEB86659FD93) + mixed[k : k + count]
    at = np.flatnonzero(document[:count] == document[window - 1 :])
    ordered = np.sort(key[at])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return covered
    place = np.minimum(np.searchsorted(twice, key[at]), len(twice) - 1)
    at = at[twice[place] == key[at]]
    known: dict[bytes, int] = {}
    held = np.unique((at[:, None] + np.arange(window)).ravel())
    number = np.zeros(len(said), dtype=np.int64)
    number[held] = [known.setdefault(said[i], len(known)) for i in held.tolist()]
    rows = [document[at], *(number[at + k] for k in range(window))]
    order = np.lexsort(rows[::-1])
    same = np.ones(len(at) - 1, dtype=bool)
    for column in rows:
        column = column[order]
        same &= column[1:] == column[:-1]
    equal = np.zeros(len(at), dtype=bool)
    equal[1:] |= same
    equal[:-1] |= same
    edge = np.zeros(len(said) + 1, dtype=np.int64)
    starts = at[order[equal]]
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return np.cumsum(edge)[:-1] > 0


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    worded = [line for line in lines if line.strip(BLANKS)]
    return len(worded) - len(set(worded))


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, script string, chars_per_byte_token double, chars_per_piece double, fallback_share double, token_entropy double"
)


def judge(
    docs: DataFrame, bands: Bands | None = None, byte_path: str | None = None, piece_path: str | None = None
) -> DataFrame:
    """Counts, token measures and the verdict of each row of ``docs``.

    Null text has no words: its counts are zero, it fails the base rules, and its
    measures are zero as those of empty text. ``token_entropy`` is a share of the
    greatest entropy that the number of tokens and the vocabulary allow (one token: 1). A null or
    unknown language is judged by script. Repeated rows give repeated rows; no
    rows give none. Texts longer than ``PART`` are measured part by part, whole.
    """
    bands = bands or Bands()
    byte_path = byte_path or public_tokenizers.path(BYTE_VOCABULARY)
    piece_path = piece_path or public_tokenizers.path(PIECE_VOCABULARY)
    types = arrow_types(SCHEMA)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = vocabularies(byte_path, piece_path)
        for batch in batches:
            for rows in pieces(batch, 4 << 20):
                out = measured(work, *(rows.column(i).to_pylist() for i in range(3)))
                yield pa.RecordBatch.from_arrays([pa.array(out[f], type=types[f]) for f in types], names=list(types))

    def measured(work, ids, texts, langs):
        texts = [t or "" for t in texts]
        split = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        sizes = np.array([len(w) for w in split], dtype=np.int64)
        document = np.repeat(np.arange(len(texts)), sizes)
        repeats = np.bincount(document[repeated_words(list(chain.from_iterable(split)), document)], minlength=len(texts))
        del split
        found = work.measure(texts)
        out = {name: [] for name in types}
        for k, text in enumerate(texts):
            n, again = int(sizes[k]), int(repeats[k])
            failed = n < LEAST_WORDS or 100 * again > REPEATED_PERCENT * n
            byte_tokens, tokens, fallback, level = found[k]
            named = script(text)
            per_byte, per_piece = (len(text) / max(c, 1) for c in (byte_tokens, tokens))
            share = fallback / max(tokens, 1)
            band = bands.of(langs[k], named)
            fits = band.least <= max(per_byte, per_piece) <= band.most and share <= band.fallback and level >= band.entropy
            values = (
                ids[k], n, len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), duplicate_lines(text),
                again, failed, not failed and fits, named, per_byte, per_piece, share, level,
            )
            for name, value in zip(out, values):
                out[name].append(value)
        return out

    return docs.select("doc_id", "text", "lang").mapInArrow(run, SCHEMA)

