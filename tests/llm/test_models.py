"""Language, quality and toxicity models: held-out accuracy on the given tables, and their parts."""

import os

import numpy as np
import pytest

from cityflow.llm import language, quality, registry, toxicity

SF = "/root/testdata/sf0.01"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def fold(spark, query, label, table, sf=SF):
    truth = spark.read.parquet(f"{sf}/{table}.parquet").select("doc_id", label)
    return query(spark, sf).where("held_out").join(truth, "doc_id").toPandas()


@given
def test_language_held_out(spark):
    got = fold(spark, registry.op2_language_codes, "lang", "documents")
    assert (got["lang"] == got["lang_pred"]).mean() > 0.98


@given
def test_quality_held_out(spark):
    got = fold(spark, registry.op4_quality_additive, "quality", "labels")
    assert (got["quality"] == got["predicted"]).mean() > 0.95


@given
def test_toxicity_held_out(spark):
    got = fold(spark, registry.op10_toxicity_network, "toxic", "labels", "/root/testdata/sf0.1")
    assert ((got["toxic"] == 0) & (got["predicted"] == 1)).sum() <= 0.01 * len(got)
    assert got.loc[got["toxic"] == 1, "predicted"].mean() > 0.8


def test_codewords_are_apart():
    for n in range(2, 30):
        code = language.codewords(n)
        least = min((code[a] != code[b]).sum() for a in range(n) for b in range(a))
        assert least >= (1 if n == 2 else 2 if n < 5 else code.shape[1] // 4)


def test_grams_of_pieces_equal_those_of_the_whole(monkeypatch):
    text = "Señor Müller aß 3 Äpfel, été! " * 40
    whole = language.grams(text)
    monkeypatch.setattr(language, "_CHUNK", 7)
    assert np.allclose(language.grams(text), whole)
    assert language.grams(" 12 !?") is None and language.grams("日") is not None


def test_ambiguous_text_is_flagged(spark, documents):
    rows = [(k, "the cat and the dog of the house " * 3, "en", "a") for k in range(40)]
    rows += [(100 + k, "der hund und die katze von dem haus " * 3, "de", "a") for k in range(40)]
    model = language.learn(documents(*rows))
    got = {r.doc_id: r for r in language.identify(documents((1, "the house and the cat"), (2, "zzzz"), (3, "42")), model, 0.4).collect()}
    assert got[1].lang_pred == "en" and not got[1].ambiguous
    assert got[2].ambiguous and got[3].lang_pred == "und" and got[3].score == 0


def test_tables_add_up():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # an interaction only
    model = quality.fit(x, y, rounds=20, pair_rounds=60)
    assert (0, 1) in [(f, g) for f, g, _ in model.pairs]
    assert ((model.scores(x) > 0.5) == y).mean() > 0.97
    row = x[:1]
    bins = [np.searchsorted(e, row[0, f], side="right") for f, e in enumerate(model.edges)]
    total = model.intercept + sum(t[b] for t, b in zip(model.tables, bins))
    total += sum(t[model.coarse[f][bins[f]], model.coarse[g][bins[g]]] for f, g, t in model.pairs)
    assert np.isclose(model.margins(row)[0], total)


def test_network_gradients():
    rng = np.random.default_rng(1)
    net = toxicity.fresh(np.zeros(toxicity.WORDS, np.float32), np.zeros(toxicity.GRAMS, np.float32))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = rng.standard_normal((3, toxicity.WINDOW, toxicity.DIM))
    mask = (np.arange(toxicity.WINDOW) < np.array([[32], [5], [1]])).astype(float)
    _, saved = net.forward(x, mask, keep=True)
    grads, dx = net.backward(np.ones(3), saved)
    for name in ("uf", "wb", "a", "v", "o", "cf"):
        at = tuple(rng.integers(0, s) for s in net.p[name].shape)
        net.p[name][at] += 1e-3
        up = net.forward(x, mask)[0].sum()
        net.p[name][at] -= 2e-3
        down = net.forward(x, mask)[0].sum()
        net.p[name][at] += 1e-3
        assert np.isclose(grads[name][at], (up - down) / 2e-3, rtol=0.02, atol=1e-3), name


def test_windows_cover_every_word():
    net = toxicity.fresh(np.zeros(toxicity.WORDS, np.float32), np.zeros(toxicity.GRAMS, np.float32))
    for n in (0, 1, 31, 32, 33, 56, 57, 500):
        (z,) = net.window_logits([[f"w{k}" for k in range(n)]])
        assert len(z) == max(1, -(-max(n - (toxicity.WINDOW - toxicity.STRIDE), 1) // toxicity.STRIDE))
    # a text's windows do not depend on the texts scored with it
    both = net.window_logits([["a", "b"], ["c"] * 90])
    assert np.allclose(both[1], net.window_logits([["c"] * 90])[0], atol=1e-5)
