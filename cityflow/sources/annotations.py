"""Annotated sentences: from the annotator's XML, or from an annotator run over pages."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow import schemas
from cityflow.operators.slices import lay_out


RECORD_END = "</sentence>"
_CORRUPT = "_corrupt_record"


def _cut(spark: SparkSession, path: str) -> DataFrame:
    """``url, value``: the files below ``path``, cut at the closing tag, which is left out."""
    return spark.read.option("lineSep", RECORD_END).text(path).withColumn("url", F.col("_metadata.file_path"))


def _record() -> Column:
    """The XML text of the sentence in ``value``, empty without one."""
    filled = F.regexp_replace("value", r"<sentence(\s[^<>]*)?/>", "")
    opened = F.regexp_extract(filled, r"(?s)<sentence[\s>].*", 0)
    return F.when(opened != "", F.concat(opened, F.lit(RECORD_END))).otherwise("")


def sentence_records(spark: SparkSession, path: str) -> DataFrame:
    """``url, record``: the XML text of every sentence below ``path``.

    Files are cut at the closing tag by the text scan, so one large file feeds as
    many tasks as it has splits. What precedes an opening tag (a header, the end
    of the list before) is left out. An element without content is no sentence.
    """
    return _cut(spark, path).select("url", _record().alias("record")).where("record <> ''")


def page_positions(spark: SparkSession, path: str, by: str = "path") -> DataFrame:
    """``url, page_order``: each file's place among the files, from 0.

    ``by="path"`` orders by name, ``by="time"`` by modification, equals by name.
    Only the listing is read.
    """
    keys = {"path": ["url"], "time": ["modificationTime", "url"]}[by]
    listing = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("url"), "modificationTime"
    )
    return lay_out(listing, keys).places("page_order").select("url", "page_order")


def _parsed(spark: SparkSession, path: str) -> DataFrame:
    """``url, parts, full``: ``full`` has the record and what the XML parser makes of it.

    It is null for a sentence in the plain form of :data:`PLAIN`, which ``parts`` has cut up.
    """
    schema = f"{schemas.SENTENCE_XML}, {_CORRUPT} STRING"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}

    def generated(value: Column) -> Column:
        # filters on a generated column stay above, so that it is computed once
        return F.explode(F.array(value))

    cut = _cut(spark, path).select("url", "value", generated(plain_parts("value")).alias("parts"))
    plain = (F.size("parts") == 5) & (F.col("parts")[0] == "") & ~F.col("value").startswith(_PART)
    others = cut.select(
        "url", "parts", generated(F.when(~plain, F.struct(_record().alias("record")))).alias("other")
    ).where("other IS NULL OR other.record <> ''")
    read = F.struct("other.record", F.from_xml("other.record", schema, options).alias("s"))
    return others.select("url", "parts", generated(F.when(F.col("other").isNotNull(), read)).alias("full"))


def read_sentences(spark: SparkSession, path: str, pages_by: str | None = "path") -> DataFrame:
    """Sentence rows in the SENTENCE shape; the file path stands for the page address.

    Pages are ordered as in :func:`page_positions`; ``pages_by=None`` makes every
    page the first. Records that cannot be read are rows of :func:`sentence_faults`.
    """
    plain = F.col("full").isNull()
    good = _parsed(spark, path).where(plain | (F.col(f"full.s.{_CORRUPT}").isNull() & F.col("full.s").isNotNull()))
    parsed = from_xml_rows(good.select("url", "parts", "full", "full.s.*"), "parts", "full")
    cut_up = plain_sentence("parts")
    rows = parsed.select("url", "page_order", *[F.when(plain, cut_up[c]).otherwise(F.col(c)).alias(c) for c in cut_up])
    if pages_by is None:
        return rows
    placed = rows.drop("page_order").join(page_positions(spark, path, pages_by), "url")
    return placed.select(*rows.columns)


def sentence_faults(spark: SparkSession, path: str) -> DataFrame:
    """``url, record``: records that are no well-formed sentence, as they stand in the file."""
    other = _parsed(spark, path).where(F.col("full").isNotNull())
    return other.where(F.col(f"full.s.{_CORRUPT}").isNotNull() | F.col("full.s").isNull()).select("url", "full.record")


def _bare(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+$", ""))


def from_xml_rows(xml: DataFrame, *keep: str) -> DataFrame:
    """Rename the annotator's element names; absent lists become empty arrays."""
    reading = F.col("MachineReading")

    tokens = F.transform(
        F.col("tokens.token"),
        lambda t: F.struct(
            t["_id"].alias("id"), t["word"].alias("word"), t["NER"].alias("ner")
        ),
    )
    entities = F.transform(
        reading["entities"]["entity"],
        lambda e: F.struct(
            e["_id"].alias("id"),
            _bare(e["_VALUE"]).alias("type"),
            e["span"]["_end"].alias("end"),
        ),
    )
    relations = F.transform(
        reading["relations"]["relation"],
        lambda r: F.struct(
            _bare(r["_VALUE"]).alias("type"),
            F.transform(
                r["arguments"]["entity"],
                lambda a: F.struct(a["_id"].alias("id"), _bare(a["_VALUE"]).alias("type")),
            ).alias("args"),
            F.transform(
                r["probabilities"]["probability"],
                lambda p: F.struct(
                    p["label"].alias("label"),
                    F.trim(p["value"]).try_cast("double").alias("value"),
                ),
            ).alias("probs"),
        ),
    )
    return xml.select(
        "url",
        *keep,
        F.lit(0).cast("long").alias("page_order"),
        F.col("_id").alias("sent_id"),
        F.coalesce(tokens, F.array()).alias("tokens"),
        F.coalesce(entities, F.array()).alias("entities"),
        F.coalesce(relations, F.array()).alias("relations"),
    )


# A sentence (without its closing tag) in the plain form annotators write: elements in
# their usual order, attributes in double quotes, text without references, comments or
# sections. What does not match as a whole goes to the XML parser, so the form decides how
# fast a record is read, not what is read. Loops over elements are possessive: lists are
# gone through once and without recursion, however long they are. Loops over characters
# are greedy and their characters given one by one: Java is several times slower in others.
_PART = "\x01"
_ODD = "<>&" + "".join(rf"\x{code:02x}" for code in [*range(9), 11, 12, *range(13, 32), 127])
_S = r"[ \t\r\n]*"
_BEGUN = rf"[^{_ODD} \t\n][^{_ODD}]*"
_TEXT = rf"{_BEGUN}(?<![ \t\n])"
_QUOTED = rf'"[^{_ODD} \t\n"]+"'
_LEAF = rf"<(?!(?i:word|ner)>)(?<{{0}}>[A-Za-z]\w*)>(?:{_TEXT})?+</\k<{{0}}>>{_S}"
_MENTION = rf"<entity id={_QUOTED}>{_S}{_BEGUN}"
_SPAN = rf"<span start={_QUOTED} end={_QUOTED}/>{_S}"
_NO_ODDS = rf"(?:<probabilities/>{_S})?+"
_SYNTAX = (
    rf"(?:<parse>[^{_ODD}]*</parse>{_S})?+(?:<dependencies type={_QUOTED}>{_S}"
    rf"(?:<dep type={_QUOTED}(?: extra={_QUOTED})?+>{_S}<governor idx={_QUOTED}>{_TEXT}</governor>{_S}"
    rf"<dependent idx={_QUOTED}>{_TEXT}</dependent>{_S}</dep>{_S})*+</dependencies>{_S})*+"
)
PLAIN = (
    rf'\A{_S}<sentence id="(?<id>\d{{1,18}})">{_S}<tokens>{_S}'
    rf"(?<tokens>(?:<token id={_QUOTED}>{_S}<word>{_TEXT}</word>{_S}(?:{_LEAF.format('a')})*+<NER>{_TEXT}</NER>{_S}"
    rf"(?:{_LEAF.format('b')})*+</token>{_S})++)</tokens>{_S}{_SYNTAX}<MachineReading>{_S}"
    rf"(?:<entities/>|<entities>{_S}(?<entities>(?:{_MENTION}{_SPAN}{_NO_ODDS}</entity>{_S})++)</entities>){_S}"
    rf"(?:<relations/>|<relations>{_S}(?<relations>(?:<relation id={_QUOTED}>{_S}{_BEGUN}"
    rf"<arguments>{_S}(?:{_MENTION}(?:{_SPAN})?+{_NO_ODDS}</entity>{_S})++</arguments>{_S}"
    rf"<probabilities>{_S}(?:<probability>{_S}<label>{_TEXT}</label>{_S}<value>{_TEXT}</value>{_S}</probability>{_S})++"
    rf"</probabilities>{_S}</relation>{_S})++)</relations>){_S}</MachineReading>{_S}\z"
)


def plain_parts(value: str) -> Column:
    """Nothing, then id, tokens, entities and relations of a text that :data:`PLAIN` matches; else the text."""
    parts = "".join(f"{_PART}${{{name}}}" for name in ("id", "tokens", "entities", "relations"))
    return F.split(F.regexp_replace(value, PLAIN, parts), _PART)


def plain_sentence(parts: str) -> dict[str, Column]:
    """The columns of SENTENCE from :func:`plain_parts` of a text that matched."""
    told = rf">{_S}([^<]*(?<!\s))"
    number, tokens, entities, relations = (F.col(parts)[place] for place in range(1, 5))

    def every(text: Column, pattern: str) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))

    def together(**lists: Column) -> Column:
        return F.arrays_zip(*[of_all.alias(name) for name, of_all in lists.items()])

    def mentions(text: Column, **more: str) -> Column:
        return together(
            id=every(text, '<entity id="([^"]*)'), type=every(text, f'<entity id="[^"]*"{told}'),
            **{name: every(text, pattern) for name, pattern in more.items()},
        )

    def relation(text: Column) -> Column:
        odds = together(
            label=every(text, "<label>([^<]*)"), value=every(text, "<value>([^<]*)").try_cast("ARRAY<DOUBLE>")
        )
        named = F.regexp_extract(text, told, 1)
        return F.struct(named.alias("type"), mentions(text).alias("args"), odds.alias("probs"))

    ended = F.split(F.regexp_replace(relations, rf"</relation>{_S}", _PART), _PART)
    return {
        "sent_id": number.cast("long"),
        "tokens": together(
            id=every(tokens, '<token id="([^"]*)'), word=every(tokens, "<word>([^<]*)"), ner=every(tokens, "<NER>([^<]*)")
        ),
        "entities": mentions(entities, end=' end="([^"]*)'),
        # of one relation no list has to be made; it is read by compiled code
        "relations": F.when(F.size(ended) == 2, F.array(relation(relations))).otherwise(
            F.transform(F.slice(ended, F.lit(1), F.size(ended) - 1), relation)
        ),
    }


Annotator = Callable[[str], Iterable[dict]]


def annotate_pages(pages: DataFrame, load_annotator: Callable[[], Annotator]) -> DataFrame:
    """Sentence rows of ``pages(url, text)`` from a supplied annotator.

    ``load_annotator`` runs once per task. The annotator maps a page's whole
    text to sentences, each a dict with ``tokens``, ``entities`` and
    ``relations`` as lists of dicts named as in SENTENCE; absent lists are empty.
    """

    def annotated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        annotate = load_annotator()
        for batch in batches:
            for url, page in zip(batch.url, batch.text):
                rows = [
                    {
                        "url": url, "page_order": 0, "sent_id": i,
                        **{k: sentence.get(k, []) for k in ("tokens", "entities", "relations")},
                    }
                    for i, sentence in enumerate(annotate(page), start=1)
                ]
                if rows:
                    yield pd.DataFrame(rows)

    texts = pages.select("url", "text").filter(F.col("text").isNotNull())
    return texts.mapInPandas(annotated, schemas.SENTENCE)


SENTENCE_OUT = schemas.SENTENCE.replace("url STRING, page_order LONG, ", "")


def annotate_lateral(pages: DataFrame, annotator: type, text: str = "text") -> DataFrame:
    """Every page with the sentences of its text: a table function joined laterally.

    ``annotator`` is a class whose instances, one per task, map a page's whole text
    to sentences, each a dict as :func:`annotate_pages` takes them. The page's
    columns stay; a page without text or sentences has no row.
    """

    class Annotate:
        def __init__(self):
            self.annotate = annotator()

        def eval(self, page: str):
            if page is None:
                return
            for i, sentence in enumerate(self.annotate(page), start=1):
                yield i, *(sentence.get(k, []) for k in ("tokens", "entities", "relations"))

    table = F.udtf(Annotate, returnType=SENTENCE_OUT, useArrow=True)
    return pages.lateralJoin(table(F.col(text).outer()))
