"""Quality classifier: a generalised additive model with pairwise interactions.

A text becomes a few dozen figures, each cut into bins. Cyclic boosting grows
one shallow tree on one feature at a time, round after round, and adds it to
that feature's lookup table; then the strongest pairs of features get tables of
their own, grown the same way. A score is the intercept plus one table entry per
feature and pair, so scoring is a few vectorised additions and each table can
be read as the feature's effect.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import distinct_labels, held_out, map_texts, sample_for_fit, sigmoid

#: Labelled rows that the fit looks at, at most.
FIT_ROWS = 40_000
THRESHOLD = 0.7

FEATURES = (
    "log_bytes log_words log_lines word_length line_words upper digit symbol pipe bang percent"
    " hash_mark dollar ampersand star slash brace angle quote comma stop colon other_punct"
    " non_ascii control blank distinct_words distinct_lines distinct_end longest_word top_word"
    " top_line symbol_words upper_words digit_words end_punct_lines entropy short_words"
    " distinct_pairs bullet_lines"
).split()

_SINGLE = {"pipe": b"|", "bang": b"!?", "percent": b"%", "hash_mark": b"#", "dollar": b"$",
           "ampersand": b"&", "star": b"*", "slash": b"/\\", "brace": b"{}[]()", "angle": b"<>=",
           "quote": b"\"'`", "comma": b",", "stop": b".", "colon": b":;", "other_punct": b"~^_+-@"}


def features(text: str | None) -> list[float]:
    """The figures of a whole text, in the order of ``FEATURES``; null is read as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    size = max(len(raw), 1)
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n, m = max(len(words), 1), max(len(lines), 1)
    times: dict[bytes, int] = {}
    for w in words:
        times[w] = times.get(w, 0) + 1
    seen: dict[bytes, int] = {}
    for x in lines:
        seen[x] = seen.get(x, 0) + 1
    kinds = list(times)
    lengths = list(map(len, kinds))
    share = counts[counts > 0] / size
    upper = sum(times[w] for w in kinds if w.isupper() and len(w) > 1)
    digits = sum(times[w] for w in kinds if w.strip(b".,;:!?").isdigit())
    symbols = sum(times[w] for w in kinds if w[-1:] in b"|%#$&*~^=<>!" or not w.isalnum() and w[:1] in b"|%#$&*~^=<>!")
    ends = {w[-3:] for w in kinds}
    values = {
        "log_bytes": math.log1p(len(raw)),
        "log_words": math.log1p(len(words)),
        "log_lines": math.log1p(len(lines)),
        "word_length": (len(raw) - len(words)) / n,
        "line_words": math.log1p(len(words) / m),
        "upper": counts[65:91].sum() / size,
        "digit": counts[48:58].sum() / size,
        "symbol": (counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()) / size,
        "non_ascii": counts[128:].sum() / size,
        "control": (counts[:9].sum() + counts[14:32].sum() + counts[127]) / size,
        "blank": (counts[9:14].sum() + counts[32]) / size,
        "distinct_words": len(kinds) / n,
        "distinct_lines": len(seen) / m,
        "distinct_end": len(ends) / n,
        "longest_word": math.log1p(max(lengths, default=0)),
        "top_word": max(times.values(), default=0) / n,
        "top_line": max(seen.values(), default=0) / m,
        "symbol_words": symbols / n,
        "upper_words": upper / n,
        "digit_words": digits / n,
        "end_punct_lines": sum(c for x, c in seen.items() if x.rstrip()[-1:] in b".!?:") / m,
        "entropy": float(-(share * np.log2(share)).sum()),
        "short_words": sum(times[w] for w in kinds if len(w) < 3) / n,
        "distinct_pairs": len(set(zip(words, words[1:]))) / n,
        "bullet_lines": sum(c for x, c in seen.items() if x.lstrip()[:1] in b"-*|") / m,
    } | {k: sum(int(counts[b]) for b in marks) / size for k, marks in _SINGLE.items()}
    return [float(values[k]) for k in FEATURES]


def best_tree(gradient: np.ndarray, weight: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """Values per bin of a tree of at most ``leaves`` leaves over ordered bins, by Newton steps."""
    cuts = [0, len(gradient)]
    g, h = np.r_[0, np.cumsum(gradient)], np.r_[0, np.cumsum(weight)]
    gain_of = lambda lo, hi: (g[hi] - g[lo]) ** 2 / (h[hi] - h[lo] + 1.0)
    while len(cuts) <= leaves:
        best = (1e-9, None)
        for lo, hi in zip(cuts, cuts[1:]):
            at = np.arange(lo + 1, hi)
            if not len(at):
                continue
            gain = gain_of(lo, at) + gain_of(at, hi) - gain_of(lo, hi)
            gain[(h[at] - h[lo] < least) | (h[hi] - h[at] < least)] = -1
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), int(at[k]))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(gradient))
    for lo, hi in zip(cuts, cuts[1:]):
        out[lo:hi] = (g[hi] - g[lo]) / (h[hi] - h[lo] + 1.0)
    return out


def best_cross(gradient: np.ndarray, weight: np.ndarray, least: float) -> tuple[np.ndarray, float]:
    """Values per cell of the best cut of both features into four quadrants, and its gain."""
    g = np.zeros((gradient.shape[0] + 1, gradient.shape[1] + 1))
    h = np.zeros_like(g)
    g[1:, 1:], h[1:, 1:] = gradient.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    a, b = g[1:-1, 1:-1], h[1:-1, 1:-1]
    if not a.size:
        return np.zeros_like(gradient), 0.0
    quarters = [(a, b), (g[1:-1, -1:] - a, h[1:-1, -1:] - b), (g[-1:, 1:-1] - a, h[-1:, 1:-1] - b)]
    quarters.append((g[-1, -1] - sum(q[0] for q in quarters), h[-1, -1] - sum(q[1] for q in quarters)))
    gain = sum(q**2 / (w + 1.0) for q, w in quarters)
    for _, w in quarters:
        gain = np.where(w < least, -1.0, gain)
    x, y = np.unravel_index(int(np.argmax(gain)), gain.shape)
    if gain[x, y] <= 0:
        return np.zeros_like(gradient), 0.0
    steps = [float(q[x, y] / (w[x, y] + 1.0)) for q, w in quarters]
    out = np.empty_like(gradient)
    out[: x + 1, : y + 1], out[: x + 1, y + 1 :] = steps[0], steps[1]
    out[x + 1 :, : y + 1], out[x + 1 :, y + 1 :] = steps[2], steps[3]
    base = g[-1, -1] ** 2 / (h[-1, -1] + 1.0)
    return out, float(gain[x, y] - base)


@dataclass
class Additive:
    """Bins, tables and intercept of a fitted model; ``scores`` takes a matrix of features."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]
    intercept: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)]
        total = np.full(len(x), self.intercept)
        for b, table in zip(bins, self.tables):
            total += table[b]
        for f, g, table in self.pairs:
            total += table[self.coarse[f][bins[f]], self.coarse[g][bins[g]]]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margins(x))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 200,
    pair_rounds: int = 100,
    n_pairs: int = 10,
    n_bins: int = 64,
    n_coarse: int = 8,
    rate: float = 0.1,
    leaves: int = 3,
) -> Additive:
    """Fit on features ``x`` and labels ``y`` (0 or 1). Without rows every score is 0.5;
    with one label only, scores lean to that label by the smoothed share of labels."""
    n, width = x.shape
    share = (y.sum() + 1.0) / (n + 2.0)
    intercept = math.log(share / (1 - share))
    edges = []
    for f in range(width):
        cuts = np.quantile(x[:, f], np.linspace(0, 1, n_bins + 1)[1:-1]) if n else np.zeros(0)
        edges.append(np.unique(cuts))
    sizes = [len(e) + 1 for e in edges]
    tables = [np.zeros(s) for s in sizes]
    coarse = [np.minimum(np.arange(s) * n_coarse // max(s, 1), n_coarse - 1) for s in sizes]
    model = Additive(edges, tables, coarse, [], intercept)
    if not n or y.min() == y.max():
        return model
    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]
    margin = np.full(n, intercept)
    least = 2.0
    for _ in range(rounds):
        for f in range(width):
            if sizes[f] < 2:
                continue
            p = sigmoid(margin)
            step = rate * best_tree(
                np.bincount(bins[f], y - p, sizes[f]),
                np.bincount(bins[f], p * (1 - p), sizes[f]), leaves, least,
            )
            tables[f] += step
            margin += step[bins[f]]
    small = [coarse[f][bins[f]] for f in range(width)]

    def cross(f: int, g: int) -> tuple[np.ndarray, float]:
        p = sigmoid(margin)
        cell = small[f] * n_coarse + small[g]
        square = (n_coarse, n_coarse)
        grad = np.bincount(cell, y - p, n_coarse**2).reshape(square)
        return best_cross(grad, np.bincount(cell, p * (1 - p), n_coarse**2).reshape(square), least)

    gains = sorted(((cross(f, g)[1], f, g) for f, g in combinations(range(width), 2)), reverse=True)
    model.pairs = [
        (f, g, np.zeros((n_coarse, n_coarse))) for gain, f, g in gains[:n_pairs] if gain > 0
    ]
    for _ in range(pair_rounds):
        for f, g, table in model.pairs:
            step = rate * cross(f, g)[0]
            table += step
            margin += step[small[f], small[g]]
    return model


def learn(docs: DataFrame, labels: DataFrame, bound: int = FIT_ROWS) -> Additive:
    """Fit on labelled documents outside the held-out fold, ``bound`` of them at most.

    Only the figures of the sampled rows come to the driver.
    """
    known = sample_for_fit(distinct_labels(labels, "quality").where(~held_out()), bound)
    # ``bound`` rows of two numbers at most: sent to the texts, which stay where they are
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")

    def make():
        return lambda ids, texts, y: {"doc_id": ids, "x": [features(t) for t in texts], "y": y}

    got = map_texts(rows, make, "doc_id long, x array<double>, y int", ("doc_id", "text", "label"))
    # repeated rows of one id could pass the bound
    got = got.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(bound).toPandas()
    x = np.array(got["x"].tolist(), dtype=np.float64).reshape(-1, len(FEATURES))
    return fit(x, got["y"].to_numpy(dtype=np.float64))


def score(docs: DataFrame, model: Additive, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` per row of ``docs``; null and empty texts are scored too.

    Repeated rows get the same score, null ids are carried, other columns don't matter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def work(ids, texts):
            x = np.array([features(t) for t in texts], dtype=np.float64).reshape(-1, len(FEATURES))
            s = shared.value.scores(x)
            return {"doc_id": ids, "score": s, "predicted": (s >= threshold).astype(np.int32)}

        return work

    return map_texts(docs, make, "doc_id long, score double, predicted int")


def accepted(docs: DataFrame, model: Additive, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those the model rejects; columns unchanged, no shuffle.

    Null and empty texts are judged as texts without words, long texts whole;
    repeated rows share their fate, ids (null ones too) don't matter. No rows: no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in texts], dtype=np.float64).reshape(-1, len(FEATURES))
        return pd.Series(shared.value.scores(x) >= threshold)

    return docs.where(good("text"))
