import random

import pytest
from pyspark.sql import functions as F

from cityflow import schemas
from cityflow.operators import relations as rel
from cityflow.plans.set_expansion import build_index, expand, search_pages
from frames import rows


def sentence(url, sent_id, words, entities, found, page=0):
    """``words``: (word, tag); ``entities``: (id, type, end); ``found``: (type, args, probs)."""
    tokens = [(str(i + 1), w, t) for i, (w, t) in enumerate(words)]
    return (url, page, sent_id, tokens, entities, found)


def frame(spark, *sentences):
    return spark.createDataFrame(list(sentences), schemas.SENTENCE)


ANN = sentence(
    "u", 1, [("Ann", "PERSON"), ("in", "O"), ("Paris", "LOCATION")],
    [("e1", "PEOPLE", "1"), ("e2", "LOCATION", "3"), ("e3", "O", "2")],
    [
        ("Live_In", [("e2", "LOCATION"), ("e1", "PEOPLE")], [("_NR", 0.1), ("Live_In", 0.9)]),
        ("Live_In", [("e1", "PEOPLE"), ("e3", "O")], [("Live_In", 0.8)]),
        ("Work_For", [("e1", "PEOPLE"), ("e2", "LOCATION")], [("Work_For", 0.7)]),
        ("Live_In", [("e1", "PEOPLE"), ("nowhere", "LOCATION")], [("Live_In", 0.6)]),
    ],
)


@pytest.mark.parametrize(
    "kind, tags, kept",
    [
        ("Live_In", ["PERSON", "LOCATION"], True),
        ("Live_In", ["PERSON", "PERSON"], False),
        ("Located_In", ["LOCATION"], False),
        ("Located_In", ["LOCATION", "LOCATION"], True),
        ("OrgBased_In", ["ORGANIZATION", "LOCATION"], True),
        ("OrgBased_In", ["ORGANIZATION"], False),
        ("Work_For", ["ORGANIZATION", "PERSON"], True),
        ("Work_For", ["LOCATION", "PERSON"], False),
    ],
)
def test_keep_rules(spark, kind, tags, kept):
    words = [(f"w{i}", t) for i, t in enumerate(tags)]
    nested = frame(spark, sentence("u", 1, words, [], []))
    assert rel.candidate_sentences(nested, rel.KINDS[kind]).count() == kept
    flat = spark.createDataFrame([("s", t) for t in tags], "s STRING, tag STRING")
    assert rel.candidate_groups(flat, ["s"], "tag", rel.KINDS[kind]).count() == kept


def test_extraction_orders_arguments_and_drops_unfit_ones(spark):
    got = rel.extract_relations(frame(spark, ANN), rel.KINDS["Live_In"]).collect()
    assert [(r.e1.value, r.e1.type, r.e2.value, r.confidence, r.seq) for r in got] == [
        ("Ann", "PERSON", "Paris", 0.9, 0)
    ]
    assert frame(spark, ANN).select(rel.sentence_text()).first()[0] == "Ann in Paris"


def test_equal_types_are_swapped(spark):
    s = sentence("u", 1, [("Lyon", "LOCATION"), ("France", "LOCATION")],
                 [("a", "LOCATION", "1"), ("b", "LOCATION", "2")],
                 [("Located_In", [("a", "LOCATION"), ("b", "LOCATION")], [("Located_In", 0.5)])])
    r = rel.extract_relations(frame(spark, s), rel.KINDS["Located_In"]).first()
    assert (r.e1.value, r.e2.value) == ("France", "Lyon")


def test_first_entry_of_a_repeated_entity_id_counts(spark):
    s = sentence("u", 1, [("x", "PERSON"), ("y", "LOCATION"), ("z", "PERSON")],
                 [("e", "PEOPLE", "1"), ("e", "PEOPLE", "3"), ("f", "LOCATION", "2")],
                 [("Live_In", [("e", "PEOPLE"), ("f", "LOCATION")], [("Live_In", 0.5)])])
    assert rel.extract_relations(frame(spark, s), rel.KINDS["Live_In"]).first().e1.value == "x"


def relation_rows(spark, values):
    """``(url, page, sent, seq, id1, value1, id2, value2, confidence)`` rows."""
    entity = "STRUCT<id: STRING, type: STRING, value: STRING>"
    data = [(u, p, s, q, "Live_In", (i1, "PERSON", v1), (i2, "LOCATION", v2), c)
            for u, p, s, q, i1, v1, i2, v2, c in values]
    return spark.createDataFrame(
        data, "url STRING, page_order LONG, sent_id LONG, seq LONG, rel_type STRING,"
        f" e1 {entity}, e2 {entity}, confidence DOUBLE",
    )


def sequential(values):
    """The two passes over lists, written out: position of the first, confidence of the best."""
    overall = []
    pages = sorted({(v[1], v[0]) for v in values})
    for _, url in pages:
        page = []
        for v in sorted((v for v in values if v[0] == url), key=lambda v: v[2:4]):
            for known in page:
                if known["ids"] == (v[4], v[6]):
                    if v[8] > known["conf"]:
                        known.update(values=(v[5], v[7]), conf=v[8])
                    break
            else:
                page.append({"ids": (v[4], v[6]), "values": (v[5], v[7]), "conf": v[8]})
        for p in page:
            for known in overall:
                if known["values"] == p["values"]:
                    if p["conf"] > known["conf"]:
                        known.update(conf=p["conf"])
                    break
            else:
                overall.append(dict(p))
    return [(o["values"][0], o["values"][1], o["conf"]) for o in overall]


@pytest.mark.parametrize("seed", range(4))
def test_dedup_matches_sequential_passes(spark, seed):
    rng = random.Random(seed)
    values = []
    for page in range(4):
        for i in range(12):
            a, b = rng.randrange(3), rng.randrange(3)
            # within a page an id always names one entity
            values.append((f"u{page}", page, i // 3, i % 3, f"e{a}", f"A{a % 2}", f"f{b}", f"B{b % 2}",
                           rng.randrange(4) / 4))
    got = rel.ranked(rel.dedup_relations(relation_rows(spark, values)))
    expected = sorted(sequential(values), key=lambda r: -r[2])
    assert [(r.e1.value, r.e2.value, r.confidence) for r in got.collect()] == expected


def test_a_hot_pair_is_reduced_before_the_shuffle(spark):
    values = [("u", 0, i, 0, "e", "A", "f", "B", (i % 100) / 100) for i in range(1000)]
    best = rel.dedup_relations(relation_rows(spark, values))
    row = best.first()
    assert (row.confidence, row.sent_id) == (0.99, 0) and best.count() == 1
    assert "Window" not in best._jdf.queryExecution().executedPlan().toString()


def test_threshold_is_strict_and_numeric(spark):
    r = relation_rows(spark, [("u", 0, 0, i, "e", f"A{i}", "f", "B", c)
                              for i, c in enumerate((9e-5, 0.5, 0.75, 1.0))])
    assert rows(rel.above(r, 0.5), "confidence") == [(0.75,), (1.0,)]
    assert [x.confidence for x in rel.top_relations(r, 1e-5, 3).collect()] == [1.0, 0.75, 0.5]
    for bad in (0, 1.5):
        with pytest.raises(ValueError):
            rel.above(r, bad)


def pairs(spark, *values):
    return spark.createDataFrame(
        list(values), "value1 STRING, value2 STRING, confidence DOUBLE, page_order LONG,"
        " sent_id LONG, seq LONG")


def test_next_query(spark):
    p = pairs(spark, ("Ann", "Paris", 0.9, 0, 0, 0), ("Bob", "Rome", 0.8, 0, 0, 1),
              ("Cem", "Oslo", 0.8, 0, 0, 2))
    used = spark.createDataFrame([("ANN", "paris")], "value1 STRING, value2 STRING")
    none = used.limit(0)
    assert rel.next_query(p, none).first().value1 == "Ann"
    assert rel.next_query(p, used).first().value1 == "Bob"
    assert rel.next_query(p, used, seed="bob in rome").first().value1 == "Cem"
    assert rel.next_query(p.limit(1), used).count() == 0


def test_unseen(spark):
    seen = spark.createDataFrame([("A",)], "u STRING")
    frame_ = spark.createDataFrame([("a",), ("A",), ("b",)], "u STRING")
    assert rows(rel.unseen(frame_, seen, ["u"])) == [("a",), ("b",)]
    assert rows(rel.unseen(frame_, seen, ["u"], ignore_case=True)) == [("b",)]


def test_search_counts_whole_words(spark):
    pages = spark.createDataFrame(
        [("u1", "Ann lives in Paris"), ("u2", "Annex Parisian"), ("u3", "paris, PARIS"),
         ("u4", None)], "url STRING, text STRING")
    assert [tuple(r) for r in search_pages(pages, "ann Paris").collect()] == [("u1", 2), ("u3", 1)]
    assert search_pages(pages, "ann Paris", hits=1).count() == 1


def lives(url, sent_id, who, where, confidence):
    return sentence(
        url, sent_id, [(who, "PERSON"), ("in", "O"), (where, "LOCATION")],
        [(f"{who}-e", "PEOPLE", "1"), (f"{where}-e", "LOCATION", "3")],
        [("Live_In", [(f"{who}-e", "PEOPLE"), (f"{where}-e", "LOCATION")], [("Live_In", confidence)])],
    )


@pytest.fixture
def corpus(spark):
    """Pages chained by shared names: the seed reaches u1, u1's best pair reaches u2, and so on."""
    sentences = frame(
        spark,
        lives("u1", 1, "Ann", "Paris", 0.9), lives("u1", 2, "Bob", "Rome", 0.8),
        lives("u2", 1, "Bob", "Rome", 0.95), lives("u2", 2, "Cem", "Oslo", 0.7),
        lives("u3", 1, "Cem", "Oslo", 0.2), lives("u3", 2, "Dee", "Bern", 0.6),
    )
    pages = spark.createDataFrame(
        [("u1", "Ann in Paris. Bob somewhere."), ("u2", "Rome, says Cem"), ("u3", "Oslo and Bern")],
        "url STRING, text STRING")
    return pages, sentences


def found(result):
    ordered = rel.ranked(result.relations)
    return [(r.e1.value, r.e2.value, r.confidence) for r in ordered.collect()]


def test_expansion_follows_the_best_unused_pair(corpus):
    result = expand(*corpus, "Ann Paris", rel.KINDS["Live_In"], threshold=0.5, k=4)
    assert result.queries == ["Ann Paris", "Bob Rome", "Cem Oslo"] and result.reason == "enough"
    assert found(result) == [
        ("Bob", "Rome", 0.95), ("Ann", "Paris", 0.9), ("Cem", "Oslo", 0.7), ("Dee", "Bern", 0.6),
    ]


def test_expansion_ends(corpus):
    kind = rel.KINDS["Live_In"]
    assert expand(*corpus, "Ann Paris", kind, 0.5, k=1).iterations == 1
    dry = expand(*corpus, "Ann Paris", kind, 0.5, k=99)
    assert dry.reason == "no query left" and len(found(dry)) == 4
    assert expand(*corpus, "Ann Paris", kind, 0.5, k=99, max_iterations=2).reason == (
        "iteration limit")
    nothing = expand(*corpus, "Zoe", kind, 0.5, k=1)
    assert nothing.reason == "no query left" and found(nothing) == []
    assert expand(*corpus, "Ann Paris", kind, 0.5, k=99, patience=1).reason in (
        "stalled", "no query left")


def test_expansion_lineage_stays_short(corpus):
    result = expand(*corpus, "Ann Paris", rel.KINDS["Live_In"], threshold=0.5, k=4)
    plan = result.relations._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "parquet" in plan.lower()
    assert result.relations.filter(F.col("e1.value") == "Ann").count() == 1


def test_index_finds_what_a_scan_finds(spark, corpus):
    pages, sentences = corpus
    index = build_index(pages, sentences, buckets=5)
    for query in ("ann Paris", "Bob", "Zoe", "!!", "rome OSLO bern"):
        for hits in (1, 10, None):
            want = [tuple(r) for r in search_pages(pages, query, hits).collect()]
            assert [tuple(r) for r in index.search(query, hits).collect()] == want


def test_rounds_read_folders_not_the_corpus(spark, corpus):
    pages, sentences = corpus
    index = build_index(pages, sentences, buckets=5)
    plan = index.search("Ann Paris")._jdf.queryExecution().toString()
    assert "PartitionFilters: [bucket" in plan and "In(word, [ann,paris])" in plan, plan
    plan = index.of_addresses({"u1": 0})._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "(bucket#" in plan and "EqualTo(url,u1)" in plan, plan
    assert {r.url for r in index.of_addresses({"u1": 3, "u3": 4}).collect()} == {"u1", "u3"}


def test_the_index_is_laid_out_without_a_shuffle(spark, corpus):
    spark.sparkContext.setJobGroup("lay out", "two jobs")
    try:
        build_index(*corpus, rel.KINDS["Live_In"], buckets=5)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [len(tracker.getJobInfo(job).stageIds) for job in tracker.getJobIdsForGroup("lay out")]
    assert stages == [1, 1]


def test_the_index_gives_sentences_back_as_they_were(spark):
    odd = sentence("u", 2, [('"Ann"\\ \n', "PERSON"), (None, None), ("Zürich 😀", "LOCATION")], [("e1", "PEOPLE", None)],
                   [("Live_In", [("e1", None)], [("Live_In", float("nan")), ("x", 0.1 + 0.2), (None, None)]), ("Live_In", None, [])])
    sentences = frame(spark, odd, sentence("u", 3, [], None, [None]), ("v", 0, 4, None, [], []), sentence(None, 5, [], [], []))
    pages = spark.createDataFrame([("u", "Ann")], "url STRING, text STRING")
    index = build_index(pages, sentences, buckets=3)
    assert index.of_addresses({"u": 7, "v": 8}).schema.simpleString() == sentences.schema.simpleString()
    kept = [c for c in sentences.columns if c != "page_order"]
    got, want = index.of_addresses({"u": 7, "v": 8}), sentences.where("url IS NOT NULL")
    assert repr(rows(got, *kept)) == repr(rows(want, *kept))  # NaN included


def test_the_keep_rule_is_compiled(spark):
    """A list function with a lambda would keep the rule, and all before it, out of generated code."""
    kept = rel.candidate_sentences(frame(spark, ANN), rel.KINDS["Work_For"])
    assert "lambda" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_any_number_of_hits_is_joined_as_a_table(corpus):
    kind = rel.KINDS["Live_In"]
    bounded = expand(*corpus, "Ann Paris", kind, threshold=0.5, k=4)
    whole = expand(*corpus, "Ann Paris", kind, threshold=0.5, k=4, hits=None)
    assert found(whole) == found(bounded) and whole.queries == bounded.queries
    assert rows(whole.relations, "page_order", "sent_id") == rows(bounded.relations, "page_order", "sent_id")
