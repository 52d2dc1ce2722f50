"""Mixing, decontamination, token files and the pipeline, against plain Python."""

import glob
import os
import random
import zlib

import numpy as np
import pyarrow.orc as orc
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cityflow.llm import decontaminate, mixing, quality, simhash, token_files
from cityflow.llm.common import table

SF = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def level_targets(sizes, cap=3):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, open_ = {}, set(order)
    while True:
        left = sum(sizes.values()) - sum(target.values())
        total = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] / total > cap * sizes[s]]
        if not above:
            return target | {s: left * weight[s] / total for s in open_}
        for s in above:
            target[s] = cap * sizes[s]
            open_.remove(s)


def test_targets_and_copies(spark, documents):
    rng = random.Random(2)
    shares = {"a": 3000, "b": 20, "c": 400, "d": 1, None: 700, "zero": 0}
    rows = []
    for source, words in shares.items():
        for k in range(60):
            rows.append((len(rows), "w " * (words * 2 * rng.random() / 60 * 30).__int__(), None, source))
    report = mixing.report(documents(*rows)).toPandas()
    report["source"] = [rows[i][3] or "~" for i in report["doc_id"]]
    sizes = {(s if s != "~" else None): int(n) for s, n in report.groupby("source")["size"].sum().items()}
    want = level_targets(sizes)
    for s, part in report.groupby("source"):
        s = None if s == "~" else s
        assert (part["source_size"] == sizes[s]).all() and np.allclose(part["target"], want[s])
        spread = (part["size"] ** 2).sum() ** 0.5
        assert abs(part["taken"].sum() - want[s]) <= 2.5 * spread + 1
    assert (report["taken"] <= 3 * report["size"]).all()
    again = mixing.report(documents(*rows[::-1])).toPandas().sort_values("doc_id")
    assert (again["taken"].to_numpy() == report.sort_values("doc_id")["taken"].to_numpy()).all()
    assert mixing.mix(documents(*rows)).count() == report["copies"].sum()


@pytest.mark.parametrize("seed", range(8))
def test_targets_of_any_sizes(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{k}": rng.choice([0, 1, 10, 900, 1000, 1100, 50_000]) for k in range(rng.randrange(1, 25))}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(mixing.cycled_weights(rows)).collect()}
    want = level_targets(sizes)
    assert all(np.isclose(got[s], want[s]) for s in sizes) and np.isclose(sum(got.values()), sum(sizes.values()))


@pytest.mark.parametrize("seed", range(4))
def test_containment_finds_all(spark, documents, seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(40)]
    items = [(k, " ".join(rng.choices(words, k=rng.choice([1, 3, 5, 6, 9, 20, 60])))) for k in range(40)]
    docs = []
    for d in range(60):
        text = rng.choices(words, k=rng.randrange(0, 300))
        part = rng.choice(items)[1].split()
        if rng.random() < 0.7 and len(part) > 5:
            part[rng.randrange(len(part))] = "broken"
        at = rng.randrange(len(text) + 1)
        docs.append((d, ", ".join(text[:at] + [p.upper() for p in part] + text[at:])))
    want = set()
    for d, t in docs:
        said = t.lower().replace(",", "").split()
        for i, item in items:
            w = min(5, len(item.split()))
            rows_of = lambda x: {tuple(x[k : k + w]) for k in range(len(x) - w + 1)}
            wanted = rows_of(item.split())
            if len(wanted & rows_of(said)) >= 0.8 * len(wanted) - 1e-9:
                want.add((d, i))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.matches(documents(*docs), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) > 10
    left = decontaminate.clean(documents(*docs), benchmark).select("doc_id").collect()
    assert {r.doc_id for r in left} == {d for d, _ in docs} - {d for d, _ in want}


def test_blocks_of_items_find_the_same(spark, documents, monkeypatch):
    docs = documents(*((k, f"a{k} b c d e f{k}") for k in range(30)))
    items = spark.createDataFrame([(k, f"a{k} b c d e") for k in range(30)], "item_id long, text string")
    whole = sorted(map(tuple, decontaminate.matches(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 4)
    assert sorted(map(tuple, decontaminate.matches(docs, items).collect())) == whole and len(whole) == 30
    more = docs.union(documents((50, "nothing of it is in here at all"), (51, None), (52, ""), (53, "a3 b c d")))
    assert sorted(r.doc_id for r in decontaminate.clean(more, items).collect()) == [50, 51, 52, 53]


def test_short_items_inside_long_texts(spark, documents):
    items = spark.createDataFrame([(1, "The secret answer"), (2, "word"), (3, "!"), (4, "one two three four five")], "item_id long, text string")
    docs = documents((10, "it held, at last, the Secret -- answer; that was all"), (11, "the answer secret"), (12, "a word"), (13, "one two three four"))
    got = sorted((r.doc_id, r.item_id, r.n_item) for r in decontaminate.matches(docs, items).collect())
    assert got == [(10, 1, 1), (12, 2, 1)]
    assert sorted(r.doc_id for r in decontaminate.clean(docs, items).collect()) == [11, 13]


def test_equal_items_are_one_row_of_a_block(spark, documents, monkeypatch):
    docs = documents((1, "x a b c d e f"), (2, "nothing of it in here at all"))
    items = spark.createDataFrame([(7, "a b c d e f")] * 20 + [(k, f"other item number {k} of it") for k in range(20)], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 10)
    assert max(len(b.value) for b in decontaminate.blocks(spark, items)) < 20
    got = decontaminate.matches(docs, items).collect()
    assert [(r.doc_id, r.item_id, r.n_item) for r in got] == [(1, 7, 2)] * 20
    assert [r.doc_id for r in decontaminate.clean(docs, items).collect()] == [2]


ODD_TEXTS = ["\n", "\na", "a\n", "a\nb\nc\n\nd", "a\n's", "a \nb", "a\x1c\nc", "a <|endoftext|>\nb", "", "a", "  a", " a", "a ", "a  b", "a\n b", "it's <|endoftext|> ok", "don't, we'll...what?!", "12,34 5,6!", "a\t b",
             "ñ, é. ß!", "日本 語", "\n\n a \n", "word,'s", "o'clock's", None, "€5,00 ok", "ABC!'s", "x\x1c y\x85 z", "ª, º", "ab́c, d"]


def test_pieces_give_the_ids_of_the_whole():
    path = public_tokenizers.path(token_files.TOKENIZER)
    plain = Tokenizer.from_file(path)
    rng = random.Random(0)
    texts = ODD_TEXTS + ["".join(rng.choices(["the", " ", "  ", ",", "'s", "É", "\n", "9", "!", "Word"], k=30)) for _ in range(500)]
    small = token_files.Encoder(path, remembered=50)  # emptied again and again
    for start in range(0, len(texts), 20):
        part = texts[start : start + 20]
        sizes, ids = small.encode(part)
        for text, got in zip(part, np.split(ids, np.cumsum(sizes)[:-1])):
            assert got.tolist() == plain.encode(text or "", add_special_tokens=False).ids + [2], text


def test_token_files_round_trip(spark, documents, tmp_path):
    plain = Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))
    rows = [(1000 - 7 * k, t) for k, t in enumerate(ODD_TEXTS * 3)]
    out = token_files.write(documents(*rows), f"{tmp_path}/orc")
    got = {r.doc_id: r for r in token_files.digest(spark, out).collect()}
    start = 0
    for i, t in sorted(rows):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), crc)
        start += len(ids)
    # ascending within and across files, and indexed on the id
    ids = [i for f in sorted(glob.glob(f"{out}/part-*")) for i in orc.ORCFile(f).read(["doc_id"]).column(0).to_pylist()]
    assert ids == sorted(i for i, _ in rows)
    one = token_files.read(spark, out).where("doc_id = 1000")
    assert one.count() == 1 and "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,1000)]" in one._jdf.queryExecution().toString()


@given
def test_pipeline_against_its_parts(spark):
    docs = table(spark, SF, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    model = quality.learn(docs, table(spark, SF, "labels"))
    good = [i for i, r in rows.items() if model.scores(np.array([quality.features(r.text)]))[0] >= 0.7]
    prints = {i: simhash.fingerprint(rows[i].text) for i in good}
    label = {i: i for i in good}
    for _ in good:  # smallest id over links, until nothing moves
        moved = {i: min(label[j] for j in good if (prints[i] ^ prints[j]).bit_count() <= 2) for i in good}
        if moved == label:
            break
        label = moved
    kept = [i for i in good if label[i] == i]
    search = decontaminate.Search([tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()])
    kept = [i for i in kept if not search(rows[i].text)]
    copies = {r.doc_id: r.copies for r in mixing.report(docs.where(docs.doc_id.isin(kept))).collect()}
    plain = Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))
    want, start = [], 0
    for i in sorted(kept):
        n = len(plain.encode(rows[i].text or "", add_special_tokens=False).ids) + 1
        for _ in range(copies[i]):
            want.append((i, start, n))
            start += n
    got = corpus_pipeline.run(spark, SF).select("doc_id", "start", "n_tokens").collect()
    assert sorted(map(tuple, got)) == want and len(want) > 20
