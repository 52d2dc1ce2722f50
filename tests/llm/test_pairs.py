"""Near-duplicate operators against comparing everything with everything."""

import random

import numpy as np
import pytest
import xxhash

from cityflow.llm import neighbours, simhash
from cityflow.llm.components import components


def smallest_reachable(nodes, edges):
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    return {n: root(n) for n in nodes}


def plain_fingerprint(text, width=3):
    words = bytes(text, "utf-8").lower().split()
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), 42) for i in range(max(1, len(words) - width + 1))]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


@pytest.mark.parametrize("limit", [8192, 7])
def test_components_of_random_links(spark, limit):
    rng = random.Random(limit)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(400, 460)]
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    want = smallest_reachable(nodes, edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {n: got.get(n, n) for n in nodes} == want


@pytest.mark.parametrize("limit", [8192, 5])
def test_fingerprint_links(spark, limit):
    rng = random.Random(limit)
    prints = [rng.getrandbits(64) for _ in range(300)]
    for _ in range(500):  # a dense cloud, and chains of one to three bits
        prints.append(prints[rng.randrange(20)] ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 4))))
    prints = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    edges = [(a, b) for i, a in enumerate(prints) for b in prints[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    found = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), 2, limit).collect()
    assert smallest_reachable(prints, edges) == smallest_reachable(prints, [tuple(r) for r in found])


def test_near_duplicate_documents(spark, documents):
    rng = random.Random(1)
    vocabulary = [f"w{k}" for k in range(500)] + ["Größe", "ÉTÉ", " x", "\x1cy"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(0, 120))) for _ in range(150)]
    for _ in range(150):
        words = rng.choice(texts).split(" ")
        if len(words) > 60:
            words[rng.randrange(len(words))] = "changed"
        texts.append("\n".join(words) if rng.random() < 0.5 else " ".join(words).upper())
    prints = [plain_fingerprint(t) for t in texts]
    assert [simhash.fingerprint(t) for t in texts] == prints
    n = range(len(texts))
    edges = [(a, b) for a in n for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    want = smallest_reachable(n, edges)
    rows = simhash.near_duplicates(documents(*enumerate(texts))).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{prints[i]:016x}", want[i]) for i in n}


@pytest.mark.parametrize("limit", [4096, 6])
def test_vector_links(spark, limit):
    rng = np.random.default_rng(limit)
    x = rng.standard_normal((300, 16))
    near = x[rng.integers(0, 40, 300)] + rng.standard_normal((300, 16)) * 0.12
    x = np.concatenate([x, near, x[:5], x[:3] * 2]).astype(np.float32)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hit = unit @ unit.T >= 0.9
    hit |= (x[:, None] == x[None]).all(axis=2)
    np.fill_diagonal(hit, False)
    a, b = np.nonzero(hit)
    want = smallest_reachable(range(len(x)), zip(a.tolist(), b.tolist()))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = {r.vec_id: r for r in neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), limit=limit).collect()}
    links = sum(r.n_links for r in got.values())
    # recall against brute force; never a link too many
    assert all(got[i].n_links <= hit[i].sum() for i in got)
    assert links >= 0.98 * hit.sum()
    same = sum(got[i].component_id == want[i] for i in got)
    assert same >= 0.98 * len(got)


def test_plan_meets_the_wanted_recall():
    rng = np.random.default_rng(0)
    plan = neighbours.Plan.of(50_000, 0.9)
    a = neighbours.unit(rng.standard_normal((800, 64)))
    other = rng.standard_normal((800, 64))
    other -= (other * a).sum(1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * neighbours.unit(other)  # pairs at the threshold itself
    lines = neighbours.directions(64, plan.tables * plan.per_cell, 1)
    shift = np.random.default_rng([2, 64]).random(lines.shape[1])
    place = lambda m: np.floor(m @ lines / plan.interval + shift).reshape(800, plan.tables, -1)
    met = (place(a) == place(b)).all(axis=2).any(axis=1)
    spots = neighbours.directions(64, neighbours.LINES, 3)
    counted = (np.abs((a - b) @ spots) <= plan.width).sum(axis=1) >= plan.count
    assert (met & counted).mean() > 0.97


@pytest.mark.parametrize("size", [64, 256])
def test_links_find_pairs_at_the_threshold(spark, size):
    rng = np.random.default_rng(size)
    a = neighbours.unit(rng.standard_normal((3000, size)))
    other = rng.standard_normal(a.shape)
    other -= (other * a).sum(1, keepdims=True) * a
    cosine = 0.9 + 1e-6
    b = cosine * a + np.sqrt(1 - cosine**2) * neighbours.unit(other)
    rows = [(i, 1, v.tolist()) for i, v in enumerate(np.concatenate([a, b]))]
    classes = spark.createDataFrame(rows, "rep long, copies long, v array<double>")
    found = neighbours.links(classes, neighbours.Plan.of(len(rows), 0.9), 0.9)
    links = found.groupBy("rep").sum("n").count()
    assert links / len(rows) > 0.988


def test_corpus_keeps_one_of_each_group(spark, documents):
    rng = random.Random(5)
    texts = []
    for _ in range(40):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([2, 30, 300, 900]))]
        texts.append(" ".join(words))
        for _ in range(4):
            near = list(words)
            near[rng.randrange(len(near))] = "changed"
            texts.append(" ".join(near))
    hub = [f"h{k}" for k in range(2000)]  # a large group of near copies
    for _ in range(60):
        hub[rng.randrange(2000)] = "other"
        texts.append(" ".join(hub))
    prints = [plain_fingerprint(t) for t in texts]
    n = range(len(texts))
    edges = [(a, b) for a in n for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    want = smallest_reachable(n, edges)
    kept = sorted(r.doc_id for r in simhash.one_of_each(documents(*enumerate(texts))).collect())
    assert kept == [i for i in n if want[i] == i] and len(kept) < len(texts) - 50


def test_one_id_with_texts_of_several_groups(spark, documents):
    one, two, three = (" ".join(f"{c}{k}" for k in range(60)) for c in "xyz")
    # 1 is the smallest id of two groups; the third has 0 and 1
    rows = documents((1, one), (1, two), (2, one.upper()), (3, two + "\n"), (0, three), (1, "  " + three), (1, one))
    kept = sorted((r.doc_id, r.text[0]) for r in simhash.one_of_each(rows).collect())
    assert kept == [(0, "z"), (1, "x"), (1, "y")]


def test_groups_of_unknown_ids_keep_one_row(spark, documents):
    rows = documents((None, "one two three four"), (None, "one two three four"), (None, "quite another text than that"), (4, "quite another text than that"))
    kept = [(r.doc_id, r.text[:3]) for r in simhash.one_of_each(rows).collect()]
    assert sorted(kept, key=repr) == sorted([(None, "one"), (4, "qui")], key=repr)
