"""The three model queries over a whole small table against slow, plain re-computation of every score."""

import math
import os
import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import pytest

from cityflow.llm import language, quality, registry, toxicity
from cityflow.llm.common import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}


def letters(text):
    """Lower case, every run of other characters one blank."""
    out = ""
    for c in (text or "").lower():
        if c.isalpha():
            out += c
        elif not out.endswith(" "):
            out += " "
    return out


def plain_grams(text):
    said = letters(text)
    if not said.strip():
        return None
    m = 1 << 32
    counts = Counter()
    for i in range(len(said)):
        h = ord(said[i]) * 2654435761 % m
        counts[h >> 19] += 1
        if i + 1 < len(said):
            h = (h ^ ord(said[i + 1]) * 2246822519 % m) * 3266489917 % m
            counts[h >> 19] += 1
            if i + 2 < len(said):
                h = (h ^ ord(said[i + 2]) * 668265263 % m) * 374761393 % m
                counts[h >> 19] += 1
    length = math.sqrt(sum(counts.values()))
    return {k: math.sqrt(n) / length for k, n in counts.items()}


def test_language_of_every_text(spark, docs):
    model = language.learn(table(spark, SF, "documents"))
    got = registry.op2_language_codes(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == held(r.doc_id)
        shares = plain_grams(docs[r.doc_id])
        if shares is None:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        losses = []
        for word in model.code:
            loss = 0.0
            for bit, sign in enumerate(word):
                margin = model.bias[bit] + sum(x * model.weights[k, bit] for k, x in shares.items())
                loss += model.trust[bit] * math.log1p(math.exp(-margin * sign))
            losses.append(loss)
        odds = [math.exp(min(losses) - x) for x in losses]
        best = max(range(len(odds)), key=lambda k: odds[k])
        assert r.lang_pred == model.languages[best] and r.score == pytest.approx(odds[best] / sum(odds), abs=1e-4)


def test_equal_losses_take_the_first_language():
    model = language.Codes(["aa", "bb", "cc"], language.codewords(3), np.zeros((language.BUCKETS, 3)), np.zeros(3), np.ones(3))
    best, first, second = model.decode(np.eye(1, language.BUCKETS))
    assert best[0] == 0 and first[0] == pytest.approx(1 / 3) and second[0] == pytest.approx(1 / 3)


def test_quality_of_every_text(spark, docs):
    model = quality.learn(table(spark, SF, "documents"), table(spark, SF, "labels"))
    got = registry.op4_quality_additive(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        x = quality.features(docs[r.doc_id])
        bins = [bisect_right(list(edges), v) for edges, v in zip(model.edges, x)]
        margin = model.intercept + sum(float(t[b]) for t, b in zip(model.tables, bins))
        for f, g, pair in model.pairs:
            margin += float(pair[model.coarse[f][bins[f]], model.coarse[g][bins[g]]])
        score = 1 / (1 + math.exp(-margin))
        assert r.score == pytest.approx(score, abs=1e-9) and r.predicted == (score >= 0.7) and r.held_out == held(r.doc_id)


def plain_window(net, words):
    """The logit of one window, word by word."""
    p = net.p
    sigma = lambda v: 1 / (1 + np.exp(-v))
    vectors = [net.inputs([w])[0].astype(float) for w in words]
    H = toxicity.HIDDEN
    states = np.zeros((len(words), 2 * H))
    for d, side in enumerate("fb"):
        h = np.zeros(H)
        for t in range(len(words)) if side == "f" else reversed(range(len(words))):
            g = vectors[t] @ p["w" + side] + p["c" + side]
            z, r = sigma(g[:H] + h @ p["u" + side][:, :H]), sigma(g[H : 2 * H] + h @ p["u" + side][:, H : 2 * H])
            c = np.tanh(g[2 * H :] + (r * h) @ p["u" + side][:, 2 * H :])
            h = h + z * (c - h)
            states[t, d * H : (d + 1) * H] = h
    e = np.array([np.tanh(s @ p["a"]) @ p["v"] for s in states])
    weight = np.exp(e - e.max()) / np.exp(e - e.max()).sum()
    return float((weight @ states) @ p["o"] + p["b"][0])


def test_toxicity_of_every_text(spark, docs):
    net = toxicity.learn(table(spark, SF, "documents"), table(spark, SF, "labels"))
    got = {r.doc_id: r for r in registry.op10_toxicity_network(spark, SF).collect()}
    assert set(got) == set(docs)
    for i, text in list(docs.items()):
        words = toxicity.tokens(text)
        starts = range(0, max(len(words) - toxicity.WINDOW + toxicity.STRIDE, 1), toxicity.STRIDE)
        assert got[i].windows == len(starts) and got[i].held_out == held(i)
        if len(words) > 400 or not words:
            continue  # the plain form takes long; the longer texts' windows are no different
        logits = sorted((plain_window(net, words[s : s + toxicity.WINDOW]) for s in starts), reverse=True)
        high = [min(max(x, -12.0), 12.0) for x in logits[:3]] + [-8.0] * (3 - len(logits[:3]))
        z = np.dot([*high, math.log(len(logits)), 1.0], net.top)
        score = 1 / (1 + math.exp(-z))
        assert got[i].score == pytest.approx(score, abs=2e-3) and got[i].predicted == (got[i].score >= 0.3)
