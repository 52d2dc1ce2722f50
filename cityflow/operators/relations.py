"""Relations between named entities: sentence filter, extraction, best-confidence dedup.

A sentence is one row whose token, entity and relation lists stay nested, so
keep rules, type checks and id lookups are array expressions within the row:
no explode, no join and no shuffle until relations are deduplicated.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import starmap
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERSON, LOCATION, ORGANIZATION = "PERSON", "LOCATION", "ORGANIZATION"

# The sentence tagger says PERSON where the relation tagger says PEOPLE.
TYPE_ALIASES = {"PEOPLE": PERSON}


@dataclass(frozen=True)
class RelationKind:
    """Argument types in order, and the entity counts a candidate sentence needs."""

    name: str
    first: str
    second: str

    @property
    def needs(self) -> dict[str, int]:
        if self.first == self.second:
            return {self.first: 2}
        return {self.first: 1, self.second: 1}


KINDS = {
    kind.name: kind
    for kind in (
        RelationKind("Live_In", PERSON, LOCATION),
        RelationKind("Located_In", LOCATION, LOCATION),
        RelationKind("OrgBased_In", ORGANIZATION, LOCATION),
        RelationKind("Work_For", ORGANIZATION, PERSON),
    )
}


def _spellings(wanted: str) -> list[str]:
    return [wanted, *[alias for alias, target in TYPE_ALIASES.items() if target == wanted]]


def is_type(name: Column, wanted: str) -> Column:
    """Whether a tag names the wanted type, under either tagger's spelling."""
    spellings = _spellings(wanted)
    return name.isin(spellings) if len(spellings) > 1 else name == spellings[0]


def canonical_type(name: Column) -> Column:
    out = name
    for alias, target in TYPE_ALIASES.items():
        out = F.when(name == alias, F.lit(target)).otherwise(out)
    return out


def sentence_text(tokens: Column | str = "tokens") -> Column:
    """The words of a sentence, joined by blanks."""
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.array_join(F.transform(tokens, lambda t: t["word"]), " ")


def candidate_sentences(sentences: DataFrame, kind: RelationKind) -> DataFrame:
    """Sentences holding the entities the relation needs."""

    def enough(name: str, least: int) -> Column:
        if least == 1:
            return reduce(or_, [F.array_contains("tokens.ner", tag) for tag in _spellings(name)])
        return F.size(F.filter("tokens", lambda token: is_type(token["ner"], name))) >= least

    return sentences.filter(reduce(and_, starmap(enough, kind.needs.items())))


def candidate_groups(tags: DataFrame, keys: list[str], tag: str, kind: RelationKind) -> DataFrame:
    """The same rule over one tag per row: groups whose tag counts satisfy it."""
    names = list(kind.needs)
    counts = tags.groupBy(*keys).agg(
        *[F.count_if(is_type(F.col(tag), name)).alias(f"n_{name}") for name in names]
    )
    return counts.filter(
        " AND ".join(f"n_{name} >= {least}" for name, least in kind.needs.items())
    )


def extract_relations(sentences: DataFrame, kind: RelationKind) -> DataFrame:
    """One row per relation of the requested kind, arguments in the kind's order.

    Kept are relations whose two argument types match in either order and whose
    arguments resolve to an entity of a legal type in the sentence. An entity's
    value is the word of the token its span ends at; of several entries with one
    id the first counts.
    """

    def two_types(rel: Column) -> Column:
        a, b = rel["args"][0]["type"], rel["args"][1]["type"]
        return (is_type(a, kind.first) & is_type(b, kind.second)) | (
            is_type(a, kind.second) & is_type(b, kind.first)
        )

    wanted = F.filter(
        "relations",
        lambda r: (r["type"] == kind.name) & (F.size(r["args"]) >= 2) & two_types(r),
    )
    legal = F.filter(
        "entities", lambda e: is_type(e["type"], kind.first) | is_type(e["type"], kind.second)
    )
    rows = sentences.select(
        "url", "page_order", "sent_id", "tokens", legal.alias("legal"),
        F.posexplode(wanted).alias("seq", "r"),
    )

    # Each list is searched once per argument: one projection finds the entities,
    # the next their words.
    def entity(arg: int) -> Column:
        return F.get(F.filter("legal", lambda e: e["id"] == F.col("r.args")[arg]["id"]), 0)

    def argument(name: str) -> Column:
        found = F.col(name)
        word = F.get(F.filter("tokens", lambda t: t["id"] == found["end"]), 0)["word"]
        return F.struct(
            found["id"].alias("id"), canonical_type(found["type"]).alias("type"), word.alias("value")
        )

    named = F.filter("r.probs", lambda p: p["label"] == kind.name)
    swap = is_type(F.col("r.args")[0]["type"], kind.second)
    located = rows.select(
        "url", "page_order", "sent_id", "seq", "tokens", swap.alias("swap"),
        entity(0).alias("a"), entity(1).alias("b"), F.get(named, 0)["value"].alias("confidence"),
    ).filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    worded = located.select(
        "url", "page_order", "sent_id", "seq", "swap", "confidence",
        argument("a").alias("a"), argument("b").alias("b"),
    )
    return worded.select(
        "url",
        "page_order",
        "sent_id",
        F.col("seq").cast("long").alias("seq"),
        F.lit(kind.name).alias("rel_type"),
        F.when(F.col("swap"), F.col("b")).otherwise(F.col("a")).alias("e1"),
        F.when(F.col("swap"), F.col("a")).otherwise(F.col("b")).alias("e2"),
        "confidence",
    )


ORDER = ("page_order", "sent_id", "seq")


def _positions(relations: DataFrame, order: list[str] | None) -> list[str]:
    """``order``, ended by the page's address: positions repeat from page to page."""
    order = list(order or ORDER)
    return [*order, "url"] if "url" in relations.columns and "url" not in order else order


def keep_best(relations: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """The highest-confidence row per ``keys``; of equals the earliest wins.

    An aggregate, not a ranking window: a pair holding a third of all rows
    reaches its reducer as one candidate per task. The survivor takes the
    position at which its pair was first seen, which later ties go by. Rows at
    the same position of different pages go by ``url``; unknown confidences lose.
    """
    order = list(order or ORDER)
    payload = [c for c in relations.columns if c not in keys and c not in order]
    rest = F.struct(*payload) if payload else F.struct(F.lit(None).alias("_none"))
    worst = F.coalesce(-F.col("confidence"), F.lit(float("nan")))  # NaN sorts last
    rank = F.struct(worst.alias("_worst"), *_positions(relations, order))
    seen = F.struct(*order)
    best = relations.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.min_by(rest, rank).alias("_rest"), F.min(seen).alias("_seen")
    )
    return best.select(
        *[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys) if "." not in k],
        *[F.col(f"_rest.{c}").alias(c) for c in payload],
        *[F.col(f"_seen.{c}").alias(c) for c in order],
    )


def dedup_relations(relations: DataFrame) -> DataFrame:
    """First by entity ids within a page, then by entity values over all pages."""
    per_page = keep_best(relations, ["url", "e1.id", "e2.id"])
    return keep_best(per_page, ["e1.value", "e2.value"])


def is_above(threshold: float) -> Column:
    """Confidence strictly above the threshold, which lies in (0, 1]."""
    if not 0 < threshold <= 1:
        raise ValueError(f"threshold must be in (0, 1], not {threshold}")
    return F.col("confidence") > F.lit(threshold)


def above(relations: DataFrame, threshold: float) -> DataFrame:
    """Relations whose confidence lies strictly above the threshold."""
    return relations.filter(is_above(threshold))


def ranked(relations: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Best confidence first; equals in the order they were seen."""
    places = _positions(relations, order)
    return relations.orderBy(F.desc("confidence"), *[F.asc(c) for c in places])


def top_relations(relations: DataFrame, threshold: float, k: int, order=None) -> DataFrame:
    """The ``k`` best relations above the threshold."""
    return ranked(above(relations, threshold), order).limit(k)


def unseen(df: DataFrame, seen: DataFrame, columns: list[str], ignore_case: bool = False):
    """Rows whose ``columns`` do not occur in ``seen``."""
    if not ignore_case:
        return df.join(seen.select(*columns).distinct(), columns, "left_anti")
    lowered = {c: f"_{c}_lower" for c in columns}
    left = df.withColumns({n: F.lower(c) for c, n in lowered.items()})
    right = seen.select(*[F.lower(c).alias(n) for c, n in lowered.items()]).distinct()
    return left.join(right, list(lowered.values()), "left_anti").drop(*lowered.values())


def next_query(relations: DataFrame, used: DataFrame, seed: str | None = None, order=None):
    """The best pair ``(value1, value2)`` not used as a query yet.

    A pair both of whose values occur in the seed query counts as used.
    """
    pairs = relations
    if seed is not None:
        text = F.lit(seed.lower())
        pairs = pairs.filter(
            ~(text.contains(F.lower("value1")) & text.contains(F.lower("value2")))
        )
    fresh = unseen(pairs, used, ["value1", "value2"], ignore_case=True)
    return ranked(fresh, order).limit(1)
