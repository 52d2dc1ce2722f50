"""Every operator on nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cityflow.llm import decontaminate, fertility, infill, language, mixing, neighbours, pii, quality, secret_scan, simhash, token_files, toxicity


@pytest.fixture
def labels(spark):
    rows = [(1, 0, 0), (2, 1, 1), (5, 1, 0), (6, None, None), (7, 0, 1), (8, 1, 0), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture
def items(spark):
    rows = [(0, "the same text twice over"), (1, None), (2, ""), (None, "no id at all here")]
    return spark.createDataFrame(rows, "item_id long, text string")


OPERATORS = {
    "mix": lambda d, lab, it: mixing.report(d),
    "language": lambda d, lab, it: language.identify(d, language.learn(d)),
    "quality": lambda d, lab, it: quality.score(d, quality.learn(d, lab)),
    "pii": lambda d, lab, it: pii.scan(d),
    "secrets": lambda d, lab, it: secret_scan.digest(d),
    "tokens": lambda d, lab, it: token_files.write_and_digest(d),
    "fertility": lambda d, lab, it: fertility.judge(d),
    "infill": lambda d, lab, it: infill.digest(d),
    "simhash": lambda d, lab, it: simhash.near_duplicates(d),
    "toxicity": lambda d, lab, it: toxicity.score(d, toxicity.learn(d, lab)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(name, odd, labels, items):
    got = OPERATORS[name](odd, labels, items).select("doc_id").collect()
    ids = sorted((r.doc_id for r in got), key=repr)
    assert ids == sorted((r.doc_id for r in odd.select("doc_id").collect()), key=repr)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, odd, labels, items):
    assert OPERATORS[name](odd.limit(0), labels.limit(0), items).collect() == []


@pytest.mark.parametrize("name", ["language", "quality", "toxicity"])
def test_models_without_labels(name, odd, labels, items):
    got = OPERATORS[name](odd.withColumn("lang", F.lit(None).cast("string")), labels.limit(0), items)
    assert all(0 <= r.score <= 1 for r in got.collect())


def test_matches_on_odd_rows(odd, items):
    got = decontaminate.matches(odd, items).collect()
    assert sorted(((r.doc_id, r.item_id) for r in got), key=repr) == sorted([(5, 0), (5, 0), (6, 0), (None, None)], key=repr)
    assert decontaminate.matches(odd, items.limit(0)).count() == 0
    assert decontaminate.clean(odd, items).count() == odd.count() - 4


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages(k, spark, odd, labels, items, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    stage = corpus_pipeline.STAGES[k][1]
    got = stage(spark, odd, str(tmp_path))
    assert got.count() > 0 or k == 0  # a handful of labels may accept none
    if k < len(corpus_pipeline.STAGES) - 1:
        assert got.dtypes == odd.dtypes
    assert stage(spark, odd.limit(0), str(tmp_path)).count() == 0


def test_near_duplicates_keep_one_row(spark, odd):
    kept = simhash.one_of_each(odd).select("doc_id").collect()
    # the texts without words are one group, 5 and 6 another; one text has no id
    assert sorted((r.doc_id for r in kept), key=repr) == sorted([1, 5, 7, 8, 9, None], key=repr)


def test_ids_with_several_vectors(spark):
    e1, e2, near1, near2 = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [1.0, 0.01, 0.0], [0.0, 1.0, 0.01]
    rows = [(1, e1), (1, e2), (2, near1), (3, near2), (1, [0.0, 0.0, 1.0])]
    got = neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 0, 1), (1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]


def test_samples_do_not_depend_on_the_dealing(documents, labels):
    rows = documents(*((i, f"{w} text number {i}", "en" if i % 2 else "fr") for i in range(1, 9) for w in ("one", "other")))
    texts = [w for n in (1, 3, 7) for w in [toxicity.learn(rows.repartition(n), labels).top.tolist()]]
    assert texts[0] == texts[1] == texts[2]


def test_rare_languages_are_drawn(documents):
    rows = documents(*((i, "some text", "xx" if i in (11, 500) else "en") for i in range(3000)))
    drawn = {r.doc_id for r in language.by_language(rows, 10).collect()}
    assert len(drawn) == 10 and {11, 500} <= drawn


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [0.0, 0.0]), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, []),
            (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0, 0.0]), (None, [1.0, 0.01]), (10, [1.0, 0.0, 0.0]), (7, [1.0, 0.0])]
    got = neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    found = sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr)
    linked = [(7, 4, 7), (7, 4, 7), (8, 4, 7), (9, 4, 7), (None, 4, 7)]
    assert found == sorted([(k, 0, k) for k in (1, 2, 3, 4, 5, 6, 10)] + linked, key=repr)
    assert neighbours.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
