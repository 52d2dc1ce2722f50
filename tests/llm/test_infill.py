"""Fill-in-the-middle forms against cutting lists of units."""

import hashlib
import random
import re

import numpy as np
import pytest

from cityflow.llm import infill

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_form(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts(rng, count):
    bits = ["word", "ÉTÉ", "日本", " ", "  ", "\n", "\t\r", " ", "\x1c", "<", "<S", "P>", "x" * 300, " " * 200, "🎉"]
    passage = " ".join(rng.choices(["shared", "passage", "of", "words"], k=800))
    for k in range(count):
        out = rng.choices(bits, k=rng.choice([0, 1, 3, 40, 400]))
        if k % 3 == 0:
            out.insert(rng.randrange(len(out) + 1), passage)
        if k % 17 == 0:
            out.append(rng.choice(["<P>", "<S>", "<M>"]))
        yield "".join(out)


@pytest.mark.parametrize("remembered", [infill.REMEMBERED, 2000])
def test_forms(spark, documents, remembered):
    rows = [*enumerate(texts(random.Random(remembered), 400)), (None, "no id but a text"), (-7, "negative id of a text"),
            (401, None), (402, ""), (403, " \n "), (404, "y" * 70_000 + " z " * 70_000), (5, "repeated id"), (5, "repeated id")]
    got = infill.transform(documents(*rows), remembered=remembered)
    got = got.withColumn("again", infill.restored()).collect()
    want = [(i, *plain_form(i, t), t or "") for i, t in rows]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)
    forms = {r.form for r in got}
    assert forms == {"plain", "psm", "spm"}


def test_rate_and_order(spark, documents):
    rows = documents(*((k, "some words to cut") for k in range(400)))
    assert {r.form for r in infill.transform(rows, rate=0).collect()} == {"plain"}
    assert {r.form for r in infill.transform(rows, rate=100, suffix_first=0).collect()} == {"psm"}


def test_chunks_follow_the_content():
    rng = random.Random(3)
    passage = "".join(rng.choices("abcdefgh \n", k=20_000)).encode()
    found = []
    for head in (b"", b"one head ", b"another and longer head of the text " * 20):
        data = np.frombuffer(head + passage, np.uint8)
        edges = infill.borders(0, len(data), infill.cut_places(data))
        assert all(b - a <= infill.MOST for a, b in zip(edges, edges[1:]))
        found.append({bytes(data[a:b]) for a, b in zip(edges, edges[1:])})
    common = found[0] & found[1] & found[2]
    assert sum(map(len, common)) > 0.8 * len(passage)


def test_slabs_give_the_same_places(monkeypatch):
    data = np.random.default_rng(1).integers(0, 256, 50_000, dtype=np.uint8)
    whole = infill.cut_places(data)
    monkeypatch.setattr(infill, "SLAB", 1000)
    assert (infill.cut_places(data) == whole).all() and len(whole) > 50
