"""The source audit against counting words in dictionaries."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from cityflow.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = {k: k + 32 for k in range(65, 91)}


def plain_audit(rows, least=10, top=10):
    groups, found, frequency = set(), Counter(), Counter()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall((text or "").translate(ASCII_LOWER))
        found.update((lang, source, t) for t in terms)
        frequency.update((lang, t) for t in set(terms))
    kept = defaultdict(list)
    for (lang, t), n in frequency.items():
        if n >= least:
            kept[lang].append(t)

    def shares(lang, counts):
        total, v = sum(counts.values()), len(kept[lang])
        return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * v) for t in kept[lang]}

    of_group = {(g, s): shares(g, {t: found[g, s, t] for t in kept[g]}) for g, s in groups}
    of_lang = {g: shares(g, {t: sum(found[g, s, t] for h, s in groups if h == g) for t in kept[g]}) for g, _ in groups}
    f = lambda p, q: (p - q) ** 2 // (p + q)
    out = []
    for g, s in groups:
        own = of_group[g, s]
        pairs = [(o, sum(f(own[t], of_group[h, o][t]) for t in kept[g])) for h, o in groups if h == g and o != s]
        terms = [(t, f(own[t], of_lang[g][t])) for t in kept[g] if found[g, s, t] and own[t] > of_lang[g][t]]
        by = lambda x: (-x[1], x[0].encode())
        out += [(g, s, "pair", i, v, k + 1) for k, (i, v) in enumerate(sorted(pairs, key=by))]
        out += [(g, s, "term", i, v, k + 1) for k, (i, v) in enumerate(sorted(terms, key=by)[:top])]
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "The", "Größe", "ÉTÉ", "été", "日本語", "a" * 8, "a" * 9, "a" * 16, "a" * 17, "A" * 40, "x1y", "it's", "🎉"]
    words += ["".join(rng.choices("abc", k=rng.randrange(1, 20))) for _ in range(60)]
    rows = []
    for k in range(300):
        lang = rng.choice(["en", "fr", "", None, "de"])
        source = rng.choice(["s1", "s2", "ß", "", None, "S"]) if k % 3 else "hot"
        text = rng.choice([" ", ", ", "\n"]).join(rng.choices(words[: rng.choice([5, 30, 70])], k=rng.choice([0, 1, 20, 200])))
        rows.append((k, rng.choice([text] * 9 + [None]), lang, source))
    rows += [(900, None, "xx", "lone"), (901, "rare words here", "yy", "a"), (902, "", "yy", "b"), (7, "repeated row", "en", "s1")] * 2
    return rows + [(903, " ".join(words) * 300, "en", "long")]


@pytest.mark.parametrize("shard", [divergence.SHARD, 3000])
def test_audit(spark, documents, shard):
    rows = corpus(shard)
    got = divergence.audit(documents(*rows).repartition(3), shard=shard).collect()
    want = plain_audit(rows)
    assert sorted(map(tuple, got)) == want and len(want) > 50


def test_odd_and_empty(spark, odd):
    got = sorted(map(tuple, divergence.audit(odd).collect()))
    want = plain_audit([(r.doc_id, r.text, r.lang, r.source) for r in odd.select("doc_id", "text", "lang", "source").collect()])
    assert got == want and {g[2] for g in got} == {"pair"}
    assert divergence.audit(odd.limit(0)).collect() == []


def test_counts_beyond_a_long(spark):
    big = 7 * 10**17
    row = spark.createDataFrame([(big, 2 * big, 3)], "n long, total long, terms long")
    assert row.select(divergence.share("n", "total", "terms")).first()[0] == 1 + 10**9 * (big + 2) // (2 * big + 6)


@pytest.mark.parametrize("seed", range(4))
def test_pointer_order(seed):
    rng = random.Random(seed)
    terms = ["".join(rng.choices("ab" if seed % 2 else "abcdé", k=rng.randrange(1, 30))) for _ in range(3000)]
    raw = " ".join(terms).encode()
    data = np.frombuffer(raw + bytes(8), np.uint8)
    starts, lengths, document = divergence.term_pointers(data[:-8], np.array([0, len(raw)]))
    assert [raw[a : a + n].decode() for a, n in zip(starts, lengths)] == terms and not document.any()
    order, run = divergence.sort_pointers(data, starts, lengths)
    assert order.tolist() == sorted(range(len(terms)), key=lambda k: (terms[k].encode(), k))
    runs = {terms[k]: r for k, r in zip(order.tolist(), run.tolist())}
    assert [runs[terms[k]] for k in order.tolist()] == run.tolist() and len(set(run.tolist())) == len(set(terms))


def test_a_task_holds_little_memory(spark):
    """32 MB of text pass through a task that never holds arrays of more than 160 MB."""
    held = {}

    class Docs:
        """Takes the function that a task runs."""

        def select(self, *columns):
            return self

        groupBy = agg = select

        def mapInArrow(self, run, schema):
            held["run"] = run
            return self

    divergence.term_counts(Docs())
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(20_000)]
    text = " ".join(rng.choices(words, k=150_000))
    batch = pa.RecordBatch.from_pydict({"text": [text] * (32_000_000 // len(text)), "lang": ["a"] * (32_000_000 // len(text)),
                                        "source": ["s"] * (32_000_000 // len(text))})
    del words
    tracemalloc.start()
    try:
        n = sum(pyarrow.compute.sum(out.column(3)).as_py() for out in held["run"](iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 150_000 * batch.num_rows
    assert peak < 160 << 20, peak
