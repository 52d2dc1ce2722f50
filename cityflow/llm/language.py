"""Language identification by error-correcting output codes.

Every language gets a codeword of bits, far from all others. One binary
classifier per bit, logistic over hashed character n-grams, predicts that bit.
Decoding weighs every bit by its loss: the language whose codeword the margins
contradict least is chosen, and a text whose best two are close is flagged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cityflow.llm.common import held_out, map_texts
from cityflow.session import settle

FIT_ROWS = 20_000
BUCKETS = 1 << 13
UNKNOWN = "und"
#: A text counts as ambiguous if its best languages are closer than this in score.
CLOSE = 0.1
_CHUNK = 1 << 20


def grams(text: str | None) -> np.ndarray | None:
    """Shares of hashed 1-, 2- and 3-grams of a whole text's letters, square-rooted, of length 1.

    Case is dropped and every run of other characters is one gap. None if there
    is no letter. A long text is hashed a bounded piece at a time.
    """
    if not text:
        return None
    total = np.zeros(BUCKETS)
    tail = np.zeros(0, dtype=np.uint32)
    any_letter = False
    for start in range(0, len(text), _CHUNK):
        low = text[start : start + _CHUNK].lower()
        code = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = (code - 97 < 26) | ((code >= 0xC0) & (code != 0xD7) & (code != 0xF7))
        if (code >= 0x250).any() or ((code >= 0xAA) & (code < 0xC0)).any():
            # beyond Latin, ask for each distinct character
            kinds, where = np.unique(code, return_inverse=True)
            letter = np.array([chr(c).isalpha() for c in kinds])[where]
        any_letter = any_letter or bool(letter.any())
        code = np.where(letter, code, 32)
        code = code[(code != 32) | np.r_[True, code[:-1] != 32]]
        if len(tail) and tail[-1] == 32 and len(code) and code[0] == 32:
            code = code[1:]  # a gap that goes on from the piece before
        code = np.concatenate([tail, code])
        one = code * np.uint32(2654435761)
        two = (one[:-1] ^ (code[1:] * np.uint32(2246822519))) * np.uint32(3266489917)
        three = (two[:-1] ^ (code[2:] * np.uint32(668265263))) * np.uint32(374761393)
        old = len(tail)
        for size, values in ((1, one[old:]), (2, two[max(0, old - 1):]), (3, three)):
            total += np.bincount((values >> np.uint32(19)).astype(np.int64), minlength=BUCKETS)
        tail = code[-2:]
    if not any_letter:
        return None
    total = np.sqrt(total)
    return total / np.linalg.norm(total)


def codewords(n: int) -> np.ndarray:
    """``n`` rows of ±1, one per language, far apart.

    Up to five languages all different splits in two are used; beyond that the
    best of several seeded random codes of about 10 log2(n) bits.
    """
    if n <= 1:
        return np.ones((n, 1))
    if n <= 5:
        bits = [[1 if (s >> k) & 1 else -1 for k in range(n)] for s in range(1, 1 << (n - 1))]
        return np.array(bits, dtype=float).T
    rng = np.random.default_rng(7)
    width = int(np.ceil(10 * np.log2(n)))
    best, apart = None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], size=(n, width))
        least = min(int((code[a] != code[b]).sum()) for a, b in combinations(range(n), 2))
        if least > apart:
            best, apart = code, least
    return best


@dataclass
class Codes:
    """A fitted model: languages, their codewords, and a weight vector per bit."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # buckets x bits
    bias: np.ndarray
    trust: np.ndarray  # weight of each bit in decoding

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the best language, its score, and the score of the runner-up, per row."""
        margin = x @ self.weights + self.bias
        # logistic loss of every bit of every codeword, weighted
        loss = np.stack(
            [(self.trust * np.logaddexp(0, -margin * c)).sum(axis=1) for c in self.code], axis=1
        )
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        share /= share.sum(axis=1, keepdims=True)
        order = np.argsort(-share, axis=1, kind="stable")
        best = order[:, 0]
        rows = np.arange(len(x))
        second = share[rows, order[:, 1]] if share.shape[1] > 1 else np.zeros(len(x))
        return best, share[rows, best], second


Sparse = tuple[np.ndarray, np.ndarray]


def packed(rows: list[Sparse], size: int = 512) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Rows of (buckets, shares) by blocks: number of rows, places in a dense block, shares."""
    out = []
    for start in range(0, len(rows), size):
        part = rows[start : start + size]
        place = [k * BUCKETS + at.astype(np.int32) for k, (at, _) in enumerate(part)]
        out.append((len(part), np.concatenate(place), np.concatenate([s for _, s in part])))
    return out


def dense(blocks) -> Iterator[np.ndarray]:
    """Each block as a matrix, one at a time in the same memory: the fit never holds them all."""
    room = np.zeros((max((n for n, _, _ in blocks), default=0), BUCKETS), np.float32)
    for n, place, share in blocks:
        room.reshape(-1)[place] = share
        yield room[:n]
        room.reshape(-1)[place] = 0


def fit(rows: list[Sparse], lang: list[str], rounds: int = 60, rate: float = 20.0) -> Codes:
    """One logistic regression per bit by full-batch accelerated gradient steps.

    ``rows`` holds the buckets and shares of one text each. Classes count alike,
    however many texts each has.
    """
    languages = sorted(set(lang))
    at = {name: i for i, name in enumerate(languages)}
    y = np.array([at[name] for name in lang], dtype=int)
    code = codewords(len(languages))
    bits = code.shape[1]
    weights, bias, ahead = np.zeros((BUCKETS, bits)), np.zeros(bits), np.zeros((BUCKETS, bits))
    if not len(languages):
        return Codes([], code, weights, bias, np.ones(bits))
    sign = code[y]
    each = 1.0 / (np.bincount(y)[y] * len(languages))
    blocks = packed(rows)

    def margins(w: np.ndarray) -> Iterator[tuple[np.ndarray, slice, np.ndarray]]:
        start = 0
        for x in dense(blocks):
            own = slice(start, start + len(x))
            yield x, own, sign[own] * (x @ w.astype(np.float32) + bias)
            start += len(x)

    for step in range(rounds):
        slope, shift = -1e-4 * ahead, np.zeros(bits)
        for x, own, margin in margins(ahead):
            pull = sign[own] / (1.0 + np.exp(np.clip(margin, -40, 40))) * each[own, None]
            slope += x.T @ pull.astype(np.float32)
            shift += pull.sum(axis=0)
        new = ahead + rate * slope
        bias = bias + shift
        ahead = new + (step / (step + 3.0)) * (new - weights)
        weights = new
    right = sum(((m > 0) * each[own, None]).sum(axis=0) for _, own, m in margins(weights))
    error = np.clip(1 - right, 1e-3, 0.5)
    trust = np.log((1 - error) / error)
    return Codes(languages, code, weights, bias, trust / max(trust.mean(), 1e-9))


def by_language(known: DataFrame, bound: int) -> DataFrame:
    """``doc_id``: at most ``bound`` ids, drawn by hash alike from every language.

    First one id of each language, then a second, and so on: a rare language is
    learnt from a large table as from a small one. Where there are more languages
    than ``bound``, those with the least hashes count. Most rows of a common
    language drop out by their hash before any are ordered.
    """
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    draw = F.pmod(F.xxhash64(F.lit("draw"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # on average four times what a language can come to; few rows of it all stay
    likely = known.select("doc_id", "lang", draw.alias("draw")).join(sizes, "lang")
    likely = likely.where(F.col("draw") * F.col("size") < F.lit(4.0 * bound))
    mark = F.xxhash64(F.lit("fit"), "doc_id")
    order = Window.partitionBy("lang").orderBy("draw", mark, "doc_id")
    ranked = likely.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= bound)
    return ranked.orderBy("rank", mark, "doc_id").limit(bound).select("doc_id").distinct()


def learn(docs: DataFrame, bound: int = FIT_ROWS) -> Codes:
    """Fit on texts with a known language outside the held-out fold, at most ``bound`` of them.

    Languages are drawn from alike, see :func:`by_language`.

    The n-gram shares of the sample come to the driver sparse: about a thousand
    numbers a text. Of rows that repeat an id one counts, the least by language
    and shares.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    known = known.where(F.col("doc_id").isNotNull())
    # at most ``bound`` ids: small enough to send to every task
    chosen = F.broadcast(by_language(known, bound))
    rows = known.select("doc_id", "text", "lang").join(chosen, "doc_id", "left_semi")

    def make():
        def work(ids, texts, langs):
            kept = [(i, g, n) for i, g, n in zip(ids, map(grams, texts), langs) if g is not None]
            at = [np.flatnonzero(g) for _, g, _ in kept]
            return {
                "doc_id": [i for i, _, _ in kept],
                "at": [k.astype("<u2").tobytes() for k in at],
                "share": [g[k].astype("<f4").tobytes() for (_, g, _), k in zip(kept, at)],
                "lang": [n for _, _, n in kept],
            }

        return work

    schema = "doc_id long, at binary, share binary, lang string"
    got = map_texts(rows, make, schema, ("doc_id", "text", "lang"))
    one = got.groupBy("doc_id").agg(F.min(F.struct("lang", "at", "share")).alias("r"))
    found = settle(one.select("doc_id", "r.*"), "language-sample")
    ordered = sorted(found.toLocalIterator(), key=lambda r: r["doc_id"])
    pairs = [(np.frombuffer(r["at"], "<u2"), np.frombuffer(r["share"], "<f4")) for r in ordered]
    return fit(pairs, [r["lang"] for r in ordered])


def identify(docs: DataFrame, model: Codes, close: float = CLOSE) -> DataFrame:
    """``doc_id, lang_pred, score, second_score, ambiguous`` per row of ``docs``.

    Whole texts are read. Null texts and texts without a letter are ``und`` with
    score 0, not ambiguous; so is every text if nothing was learned. Repeated
    rows get equal results; null ids are carried.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def work(ids, texts):
            codes = shared.value
            pred, score, second = [UNKNOWN] * len(ids), np.zeros(len(ids)), np.zeros(len(ids))
            for start in range(0, len(texts), 256):
                found = [(start + k, g) for k, g in enumerate(map(grams, texts[start : start + 256])) if g is not None]
                if not found or not codes.languages:
                    continue
                at = np.array([k for k, _ in found])
                best, first, next_ = codes.decode(np.stack([g for _, g in found]))
                score[at], second[at] = first, next_
                for k, b in zip(at, best):
                    pred[k] = codes.languages[b]
            flags = [p != UNKNOWN and bool(a - b < close) for p, a, b in zip(pred, score, second)]
            return {"doc_id": ids, "lang_pred": pred, "score": score, "second_score": second, "ambiguous": flags}

        return work

    schema = "doc_id long, lang_pred string, score double, second_score double, ambiguous boolean"
    return map_texts(docs, make, schema)
