"""Secret scans over an incremental blob ledger, in SQL functions only.

Every version of a text is addressed by its content. The ledger holds a row per
(blob, rule, rule version) that was scanned, with its findings; a scan only
looks at pairs the ledger lacks, appends them, and joins findings back to every
path that holds the blob. Adding a rule, or a new version of one, scans old blobs
for that rule alone; unchanged content is never scanned again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow.session import run_dir


@dataclass(frozen=True)
class Rule:
    """A pattern; ``least`` is the fewest characters of group ``group`` that count as a secret."""

    kind: str
    version: int
    pattern: str
    least: int = 1
    group: int = 0


#: The base rules in the order in which spans at one place are listed, then those added here.
BASE_RULES = (
    Rule(
        "assign", 1,
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        6, 2,
    ),
    # a run too short at its first AKIA is too short at any later one
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}+"),
    Rule("hex", 1, r"[0-9a-f]{24,}+"),
)
ADDED_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]{36,}+"),
)
RULES = BASE_RULES + ADDED_RULES

LEDGER = "blob string, kind string, version int, found array<struct<start:int,stop:int>>"


#: Matches summed up together; sums of blocks come before those within.
BLOCK = 256


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def found(text: Column, rule: Rule) -> Column:
    """Spans of a rule's matches in code points: the pieces between matches give the places.

    Places are running sums over the matches. They are taken in blocks, each from
    the sum of the blocks before, so that the work grows with the matches and not
    with their square; a text may hold any number.
    """
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    part = hits if rule.least <= 1 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    lengths = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
        F.transform(hits, F.length).alias("hit"),
        F.transform(part, F.length).alias("part"),
    )
    none = F.array().cast("array<struct<start:int,stop:int>>")

    def step(state: Column, m: Column) -> Column:
        start = state["past"] + m["gap"]
        stop = start + m["hit"]
        kept = F.concat(state["spans"], F.array(F.struct(start.alias("start"), stop.alias("stop"))))
        if rule.least > 1:
            kept = F.when(m["part"] >= rule.least, kept).otherwise(state["spans"])
        return F.struct(stop.alias("past"), kept.alias("spans"))

    def spans_of(block: Column, base: Column) -> Column:
        start = F.struct(base.alias("past"), none.alias("spans"))
        return F.aggregate(block, start, step, lambda state: state["spans"])

    def total(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), lambda past, m: past + m["gap"] + m["hit"])

    def bases(blocks: Column) -> Column:
        """The sum of all blocks before each."""
        sums = F.transform(blocks, total)
        return F.aggregate(
            sums, F.array(F.lit(0)), lambda past, n: F.concat(past, F.array(F.element_at(past, -1) + n))
        )

    def cut(matches: Column) -> Column:
        # the last piece has no match after it
        last = F.call_function("div", F.size(matches) - 2, F.lit(BLOCK)).cast("int")
        matches = F.slice(matches, 1, F.size(matches) - 1)
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(matches, k * BLOCK + 1, BLOCK))

    def joined(blocks: Column) -> Column:
        return bound(
            bases(blocks),
            lambda base: F.flatten(F.transform(blocks, lambda block, k: spans_of(block, F.get(base, k)))),
        )

    spans = bound(lengths, lambda matches: bound(cut(matches), joined))
    # most texts match nothing: one pass of the pattern settles that
    return F.when(text.rlike(rule.pattern), spans).otherwise(none)


def addressed(docs: DataFrame) -> DataFrame:
    """``path, text, blob``: a null text is an empty one; ``blob`` is the content's SHA-256."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").alias("path"), text.alias("text")).withColumn(
        "blob", F.sha2("text", 256)
    )


def update(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what the ledger at ``ledger`` (Parquet) lacks of ``docs`` and append it.

    Copies combine before the shuffle, so content that fills a third of all rows
    reaches its task once per input task. Every blob and rule version pair
    gets a row, also without a finding: that it was scanned is what the ledger tells.
    """
    spark = docs.sparkSession
    seen = read(spark, ledger)
    blobs = addressed(docs).groupBy("blob").agg(F.first("text").alias("text"))
    wanted = F.array(*(F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules))
    if seen is not None:
        done = seen.groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("done"))
        blobs = blobs.join(done, "blob", "left")
        wanted = F.array_except(wanted, F.coalesce("done", F.array().cast("array<struct<kind:string,version:int>>")))
        blobs = blobs.withColumn("todo", wanted).where(F.size("todo") > 0)
    else:
        blobs = blobs.withColumn("todo", wanted)
    results = F.array(
        *(
            F.when(
                F.array_contains("todo", F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"))),
                F.struct(
                    F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"),
                    found(F.col("text"), r).alias("found"),
                ),
            )
            for r in rules
        )
    )
    scanned = blobs.select("blob", results.alias("results"))
    rows = scanned.select("blob", F.explode("results").alias("r")).where("r IS NOT NULL")
    rows.select("blob", "r.*").write.mode("append").parquet(ledger)


def read(spark: SparkSession, ledger: str) -> DataFrame | None:
    """The ledger's rows, or None where nothing was scanned yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.schema(LEDGER).parquet(ledger) if files.exists(path) else None


def findings(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``path, blob, spans`` per row of ``docs``, spans as ``(kind, start, stop)`` in order.

    ``rules`` names the versions that count; call ``update`` first. Spans come by
    start, then by the rules' order. A null path keeps its row.
    """
    spark = docs.sparkSession
    rank = F.element_at(
        F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(f"{r.kind}/{r.version}"), F.lit(i)))),
        F.concat_ws("/", "kind", "version"),
    )
    rows = read(spark, ledger).withColumn("rank", rank).where("rank IS NOT NULL AND size(found) > 0")
    per_blob = (
        rows.select("blob", "kind", "rank", F.explode("found").alias("f"))
        # an append that was repeated leaves equal rows
        .groupBy("blob").agg(F.collect_set(F.struct("f.start", "rank", "f.stop", "kind")).alias("spans"))
        .select("blob", F.array_sort("spans").alias("spans"))
    )
    return addressed(docs).select("path", "blob").join(per_blob, "blob", "left")


def digest(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` per row of ``docs``, and the added kinds' counts.

    Scans into ``ledger``, a fresh one in the shared folder by default. Null and
    empty texts have no span; long texts are scanned whole, in time that grows with
    their length; repeated rows and copies get equal results, null ids are carried.
    No rows: no rows.
    """
    ledger = ledger or run_dir(docs.sparkSession, "secret-ledger")
    update(docs, ledger)
    none = F.array().cast("array<struct<start:int,rank:int,stop:int,kind:string>>")
    rows = findings(docs, ledger).withColumn("spans", F.coalesce("spans", none))
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE_RULES))
    return rows.select(
        F.col("path").alias("doc_id"),
        *(count(r.kind).alias(f"n_{r.kind}") for r in RULES),
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


def _sql_rules() -> str:
    """One SELECT per rule: the same places in SQL, from a pattern without possessive marks."""
    parts = []
    for i, r in enumerate(RULES):
        pattern = r.pattern.replace("}+", "}").replace("'", "''")
        if r.kind == "assign":  # ASCII letters in either case, spelt out
            letters = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
            words = "|".join(letters(w) for w in ("password", "passwd", "secret", "token"))
            pattern = pattern.replace(
                "(?i:(password|passwd|secret|token|api_?key))", f"({words}|{letters('api')}_?{letters('key')})"
            )
        parts.append(
            f"SELECT doc_id, {i} AS rank, '{r.kind}' AS kind, {r.least} AS least,"
            f" string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS hits,"
            f" regexp_extract_all(text, '{pattern}', {r.group}) AS parts FROM texts"
        )
    return "\n  UNION ALL ".join(parts)


DIGEST_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
cut AS (
  {_sql_rules()}),
placed AS (
  SELECT doc_id, rank, kind, unnest(list_transform(range(1, len(hits) + 1), lambda i: struct_pack(
    start := list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0),
    size := length(hits[i]), part := length(parts[i]) >= least))) AS s
  FROM cut WHERE len(hits) > 0),
spans AS (
  SELECT doc_id, rank, kind, CAST(s.start AS BIGINT) AS start, kind || ':' || CAST(CAST(s.start AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(s.start + s.size AS BIGINT) AS VARCHAR) AS span
  FROM placed WHERE s.part)
SELECT t.doc_id,
  {', '.join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in RULES)},
  sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 3), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans
FROM texts t LEFT JOIN spans s ON t.doc_id = s.doc_id
GROUP BY t.doc_id
"""
