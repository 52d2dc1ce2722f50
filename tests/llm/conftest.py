import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from ``(id, text)`` or ``(id, text, lang, source)`` rows."""

    def build(*rows):
        full = [(*r, None, None)[:4] for r in rows]
        return spark.createDataFrame([(i, t, g, s, len(t or "")) for i, t, g, s in full], SCHEMA)

    return build


@pytest.fixture
def odd(documents):
    """Nulls everywhere, empty and blank texts, repeated rows, a very long text, clashing columns."""
    rows = documents(
        (1, None), (2, ""), (3, " \n\t "), (None, "no id at all here"), (None, None),
        (5, "the same text twice over"), (5, "the same text twice over"), (6, "the same text twice over", "en", "a"),
        (7, "word " * 60_000, "en", "a"), (8, "x" * 200_000, "fr", None), (9, "ünïcödé — 日本語 🎉 !", None, "b"),
    )
    names = "score copies row key group side cross fp block bin home n size target blob spans start part at ids label x y u v d".split()
    return rows.withColumns({n: F.lit(n) for n in names})
