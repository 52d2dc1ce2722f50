"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the sum of an embedding of the word itself and one of its
character n-grams. Two gated recurrent passes read a window of words, attention
weighs their states, and a linear layer gives the window's logit. All windows of
a text are scored, each overlapping the next; a small logistic layer over the
highest window logits and the number of windows gives the text's score, so that
long texts are not toxic for having many windows.

Labels are per text. Training therefore picks, from labelled texts, the windows
that word and character statistics find most telling, and a plain one; the
network learns from those, then the last layer from all windows of those texts.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import distinct_labels, held_out, map_texts, sigmoid
from cityflow.session import settle

#: Labelled texts of each label that the fit looks at, at most.
FIT_ROWS = 4_000
THRESHOLD = 0.3
WINDOW, STRIDE = 32, 24
DIM, HIDDEN, ATTEND = 16, 12, 12
WORDS, GRAMS = 1 << 13, 1 << 15
SIZES = (3, 5, 7)
TOKEN = re.compile(r"[^\W_]+")


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def word_bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) & (WORDS - 1)


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of each word (with its ends marked), and where each word's begin."""
    joined = "".join(f"^{w}$" for w in words)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.fromiter((len(w) + 2 for w in words), dtype=np.int64, count=len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    values, owners = [], []
    mixed = code * np.uint32(2654435761)
    for n in range(2, max(SIZES) + 1):
        if len(code) < n:
            break
        mixed = (mixed[:-1] ^ (code[n - 1 :] * np.uint32(2246822519 + 2 * n))) * np.uint32(3266489917)
        if n in SIZES:
            whole = owner[: len(mixed)] == owner[n - 1 :]
            values.append((mixed[whole] >> np.uint32(7)) & np.uint32(GRAMS - 1))
            owners.append(owner[: len(mixed)][whole])
    value, owner = np.concatenate(values).astype(np.int64), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    # every word has a gram: one letter with both its ends is three characters
    return value[order], np.searchsorted(owner[order], np.arange(len(words)))


@dataclass
class Network:
    """Parameters in single precision, and the last layer over window logits."""

    p: dict[str, np.ndarray]
    top: np.ndarray | None = None  # weights of top_features

    def inputs(self, words: list[str]) -> np.ndarray:
        """Input vectors of distinct words."""
        grams, starts = gram_buckets(words)
        counts = np.diff(starts, append=len(grams))
        chars = np.add.reduceat(self.p["chars"][grams], starts, axis=0)
        whole = self.p["words"][np.fromiter(map(word_bucket, words), np.int64, len(words))]
        return whole + chars / np.sqrt(counts)[:, None].astype(np.float32)

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Window logits; ``x`` is windows x words x DIM or, projected before, lists of gates."""
        return self.forward(x, mask)[0]

    def forward(self, x, mask, keep: bool = False):
        p = self.p
        n, steps = mask.shape
        states = np.zeros((n, steps, 2 * HIDDEN), dtype=np.float32)
        trace = {}
        for d, side in enumerate("fb"):
            gates = x[side] if isinstance(x, dict) else x @ p["w" + side] + p["c" + side]
            h = np.zeros((n, HIDDEN), dtype=np.float32)
            u = p["u" + side]
            saved = []
            for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
                g = gates[:, t]
                zr = 1 / (1 + np.exp(-(g[:, : 2 * HIDDEN] + h @ u[:, : 2 * HIDDEN])))
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(g[:, 2 * HIDDEN :] + (r * h) @ u[:, 2 * HIDDEN :])
                m = mask[:, t, None]
                new = h + m * z * (c - h)
                if keep:
                    saved.append((t, h, z, r, c, m))
                h = new
                states[:, t, d * HIDDEN : (d + 1) * HIDDEN] = h
            trace[side] = saved
        a = np.tanh(states @ p["a"])
        e = a @ p["v"] - 1e4 * (1 - mask)
        e = np.exp(e - e.max(axis=1, keepdims=True)) * mask
        weight = e / np.maximum(e.sum(axis=1, keepdims=True), 1e-9)
        pooled = (weight[:, :, None] * states).sum(axis=1)
        return pooled @ p["o"] + p["b"][0], (x, mask, states, trace, a, weight, pooled)

    def backward(self, error: np.ndarray, saved) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the parameters and of the inputs for the given logit errors."""
        p = self.p
        x, mask, states, trace, a, weight, pooled = saved
        g = {"o": pooled.T @ error, "b": np.array([error.sum()], np.float32)}
        dpool = error[:, None] * p["o"]
        dweight = (states * dpool[:, None, :]).sum(axis=2)
        de = weight * (dweight - (weight * dweight).sum(axis=1, keepdims=True))
        da = de[:, :, None] * p["v"] * (1 - a * a)
        g["v"] = np.einsum("nt,nta->a", de, a)
        flat = states.reshape(-1, 2 * HIDDEN)
        g["a"] = flat.T @ da.reshape(-1, ATTEND)
        dstates = weight[:, :, None] * dpool[:, None, :] + da @ p["a"].T
        dx = np.zeros_like(x)
        for d, side in enumerate("fb"):
            u = p["u" + side]
            dgates = np.zeros((*mask.shape, 3 * HIDDEN), dtype=np.float32)
            du = np.zeros_like(u)
            dh = np.zeros((len(x), HIDDEN), dtype=np.float32)
            for t, h, z, r, c, m in reversed(trace[side]):
                dh = dh + dstates[:, t, d * HIDDEN : (d + 1) * HIDDEN]
                dz = dh * m * (c - h) * z * (1 - z)
                dc = dh * m * z * (1 - c * c)
                drh = dc @ u[:, 2 * HIDDEN :].T
                dr = drh * h * r * (1 - r)
                du[:, : 2 * HIDDEN] += h.T @ np.concatenate([dz, dr], axis=1)
                du[:, 2 * HIDDEN :] += (r * h).T @ dc
                dgates[:, t] = np.concatenate([dz, dr, dc], axis=1)
                dh = dh * (1 - m * z) + drh * r + np.concatenate([dz, dr], axis=1) @ u[:, : 2 * HIDDEN].T
            g["u" + side] = du
            g["w" + side] = x.reshape(-1, DIM).T @ dgates.reshape(-1, 3 * HIDDEN)
            g["c" + side] = dgates.sum(axis=(0, 1))
            dx += dgates @ p["w" + side].T
        return g, dx

    def window_logits(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Logits of all overlapping windows of each text's words; a text without words has one."""
        index: dict[str, int] = {}
        ids = [[index.setdefault(w, len(index)) for w in t] for t in texts]
        x = self.inputs(list(index)) if index else np.zeros((0, DIM), np.float32)
        # one more row for the places past a text's end
        x = np.concatenate([x, np.zeros((1, DIM), np.float32)])
        gates = {side: x @ self.p["w" + side] + self.p["c" + side] for side in "fb"}
        rows, counts = [], []
        for t in ids:
            starts = range(0, max(len(t) - WINDOW + STRIDE, 1), STRIDE)
            counts.append(len(starts))
            rows.extend(t[s : s + WINDOW] for s in starts)
        out = np.empty(len(rows), dtype=np.float32)
        for k in range(0, len(rows), 2048):
            part = rows[k : k + 2048]
            grid = np.full((len(part), WINDOW), len(index), dtype=np.int64)
            for i, r in enumerate(part):
                grid[i, : len(r)] = r
            mask = (grid < len(index)).astype(np.float32)
            out[k : k + 2048] = self.logits({s: gates[s][grid] for s in "fb"}, mask)
        return np.split(out, np.cumsum(counts)[:-1])


def top_features(logits: np.ndarray) -> list[float]:
    """What the last layer sees of a text: its three highest windows, their number, and one."""
    high = np.sort(np.clip(logits, -12, 12))[::-1][:3]
    high = np.concatenate([high, np.full(3 - len(high), -8.0)])
    return [*map(float, high), float(np.log(len(logits))), 1.0]


def fresh(word_odds: np.ndarray, gram_odds: np.ndarray, seed: int = 5) -> Network:
    """Small random weights; one input dimension starts from the statistics' log-odds."""
    rng = np.random.default_rng(seed)
    normal = lambda *shape: rng.standard_normal(shape).astype(np.float32)
    p = {"words": normal(WORDS, DIM) * 0.05, "chars": normal(GRAMS, DIM) * 0.05}
    p["words"][:, 0] = word_odds / 4
    p["chars"][:, 0] = gram_odds / 4
    for side in "fb":
        p["w" + side] = normal(DIM, 3 * HIDDEN) / np.float32(np.sqrt(DIM))
        p["u" + side] = normal(HIDDEN, 3 * HIDDEN) / np.float32(np.sqrt(HIDDEN))
        p["c" + side] = np.zeros(3 * HIDDEN, np.float32)
    p |= {"a": normal(2 * HIDDEN, ATTEND) * np.float32(0.3), "v": normal(ATTEND) * np.float32(0.3)}
    p |= {"o": normal(2 * HIDDEN) * np.float32(0.3), "b": np.zeros(1, np.float32)}
    return Network(p)


def train(net: Network, windows: list[list[str]], y: np.ndarray, epochs: int = 6, batch: int = 256, rate: float = 0.01) -> None:
    """Adam over windows of words and their labels, classes counting alike."""
    if not len(windows):
        return
    index: dict[str, int] = {}
    ids = [[index.setdefault(w, len(index)) for w in t] for t in windows]
    words = list(index)
    bucket = np.fromiter(map(word_bucket, words), np.int64, len(words))
    grams, starts = gram_buckets(words) if words else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    ends = np.append(starts[1:], len(grams))
    grid = np.full((len(ids), WINDOW), -1, dtype=np.int64)
    for i, r in enumerate(ids):
        grid[i, : len(r)] = r
    share = np.bincount(y.astype(int), minlength=2) / len(y)
    each = (0.5 / np.maximum(share, 1e-3))[y.astype(int)].astype(np.float32)
    rng = np.random.default_rng(11)
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(ids))
        for k in range(0, len(order), batch):
            at = order[k : k + batch]
            mask = (grid[at] >= 0).astype(np.float32)
            used, where = np.unique(np.maximum(grid[at], 0), return_inverse=True)
            where = where.reshape(grid[at].shape)
            spread = np.concatenate([np.arange(starts[w], ends[w]) for w in used])
            counts = (ends - starts)[used]
            scale = (1 / np.sqrt(counts)).astype(np.float32)
            bounds = np.cumsum(counts) - counts
            vectors = net.p["words"][bucket[used]] + np.add.reduceat(net.p["chars"][grams[spread]], bounds, axis=0) * scale[:, None]
            logit, saved = net.forward(vectors[where], mask, keep=True)
            error = ((sigmoid(logit) - y[at]) * each[at] / len(at)).astype(np.float32)
            grads, dx = net.backward(error, saved)
            dx = (dx * mask[:, :, None]).reshape(-1, DIM)
            by_word = np.stack([np.bincount(where.reshape(-1), dx[:, j], len(used)) for j in range(DIM)], axis=1).astype(np.float32)
            step += 1
            size = rate * (1 - epoch / (epochs + 1)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for name, grad in grads.items():
                first[name] += 0.1 * (grad - first[name])
                second[name] += 0.001 * (grad * grad - second[name])
                net.p[name] -= (size * first[name] / (np.sqrt(second[name]) + 1e-8)).astype(np.float32)
            for name, rows, grad in (
                ("words", bucket[used], by_word),
                ("chars", grams[spread], np.repeat(by_word * scale[:, None], counts, axis=0)),
            ):
                kinds, spot = np.unique(rows, return_inverse=True)
                total = np.stack([np.bincount(spot, grad[:, j], len(kinds)) for j in range(DIM)], axis=1).astype(np.float32)
                first[name][kinds] += 0.1 * (total - first[name][kinds])
                second[name][kinds] += 0.001 * (total * total - second[name][kinds])
                net.p[name][kinds] -= (size * first[name][kinds] / (np.sqrt(second[name][kinds]) + 1e-8)).astype(np.float32)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic layer by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = sigmoid(x @ w)
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        w = w + np.linalg.solve(h, x.T @ (weight * (y - p)) - 1e-2 * w)
    return w


def odds_of(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of each word and gram bucket between labels, by texts that hold it.

    One row of counts per task comes to the driver, whatever the number of texts.
    """
    import pyarrow as pa

    def run(batches):
        counts = np.zeros((2, WORDS + GRAMS + 1), dtype=np.int64)
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = list(set(tokens(text)))
                counts[label, -1] += 1
                if words:
                    counts[label, np.unique(np.fromiter(map(word_bucket, words), np.int64))] += 1
                    counts[label, np.unique(gram_buckets(words)[0]) + WORDS] += 1
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(list(counts))], names=["label", "counts"])

    total = np.zeros((2, WORDS + GRAMS + 1))
    for r in rows.select("text", "label").coalesce(8).mapInArrow(run, "label int, counts array<long>").collect():
        total[r["label"]] += np.array(r["counts"])
    share = (total[:, :-1] + 0.5) / (total[:, -1:] + 1.0)
    odds = np.clip(np.log(share[1] / share[0]), -4, 4)
    odds[total[:, :-1].sum(axis=0) < 4] = 0
    return odds[:WORDS].astype(np.float32), odds[WORDS:].astype(np.float32)


def learn(docs: DataFrame, labels: DataFrame, bound: int = FIT_ROWS) -> Network:
    """Fit on labelled documents outside the held-out fold, at most ``bound`` of each label.

    Of each sampled text three windows come to the driver, then one row of figures.
    """
    known = distinct_labels(labels, "toxic").where(~held_out() & F.col("label").isin(0, 1))
    near = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    known = known.join(near.select("doc_id").distinct(), "doc_id", "left_semi")
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    mark = (F.xxhash64(F.lit("fit"), "doc_id"), F.col("doc_id"))
    chosen = known.where("label = 1").orderBy(*mark).limit(bound).union(
        known.where("label = 0").orderBy(*mark).limit(bound)
    )
    # twice ``bound`` ids at most: sent to the texts; of texts that repeat an id one counts, by hash
    sampled = near.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label")
    first = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    rows = settle(sampled.agg(first).select("doc_id", "text", "label"), "toxic-sample")
    words, grams = odds_of(rows)
    net = fresh(words, grams)
    if set(totals) != {0, 1}:
        share = (totals.get(1, 0) + 1) / (sum(totals.values()) + 2)
        net.top = np.array([0.0, 0.0, 0.0, 0.0, np.log(share / (1 - share))])
        return net

    def pick():
        def work(ids, texts, y):
            out = {"doc_id": [], "words": [], "y": []}
            for i, text, label in zip(ids, texts, y):
                t = tokens(text)
                kinds = list(set(t))
                if not t:
                    continue
                value, starts = gram_buckets(kinds)
                best = np.maximum(np.maximum.reduceat(grams[value], starts), 0) / 2
                telling = dict(zip(kinds, best + np.maximum(words[[word_bucket(w) for w in kinds]], 0)))
                weigh = np.cumsum([0.0, *(telling[w] for w in t)])
                begins = np.arange(0, max(len(t) - WINDOW + STRIDE, 1), STRIDE)
                mass = weigh[np.minimum(begins + WINDOW, len(t))] - weigh[begins]
                order = np.argsort(-mass, kind="stable")
                chosen = order[:1] if label else np.unique(np.r_[order[:2], zlib.crc32(str(i).encode()) % len(begins)])
                for b in begins[chosen]:
                    out["doc_id"].append(i)
                    out["words"].append(t[b : b + WINDOW])
                    out["y"].append(label)
            return out

        return work

    columns = ("doc_id", "text", "label")
    got = map_texts(rows, pick, "doc_id long, words array<string>, y int", columns)
    got = got.orderBy("doc_id", "y", "words").toPandas()
    train(net, [list(w) for w in got["words"]], got["y"].to_numpy(dtype=np.float32))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def figures():
        def work(ids, texts, y):
            logits = shared.value.window_logits([tokens(t) for t in texts])
            return {"doc_id": ids, "x": [top_features(z) for z in logits], "y": y}

        return work

    got = map_texts(rows, figures, "doc_id long, x array<double>, y int", columns).orderBy("doc_id").toPandas()
    y = got["y"].to_numpy(dtype=float)
    # the sample holds more of the rarer label than the table: weigh it back
    drawn = np.bincount(y.astype(int), minlength=2)
    back = np.array([totals[k] / max(drawn[k], 1) for k in (0, 1)])
    net.top = logistic(np.array(got["x"].tolist()), y, back[y.astype(int)] / back.max())
    return net


def score(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted, windows`` per row of ``docs``.

    Every window of the whole text counts. Null and empty texts are one empty
    window and get a score like any other. Repeated rows get equal scores, null
    ids are carried.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def make():
        def work(ids, texts):
            values, windows = [], []
            for k in range(0, len(texts), 64):
                for z in shared.value.window_logits([tokens(t) for t in texts[k : k + 64]]):
                    values.append(top_features(z))
                    windows.append(len(z))
            s = sigmoid(np.array(values).reshape(-1, 5) @ shared.value.top)
            return {"doc_id": ids, "score": s, "predicted": (s >= threshold).astype(np.int32), "windows": windows}

        return work

    return map_texts(docs, make, "doc_id long, score double, predicted int, windows long")
