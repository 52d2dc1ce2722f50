"""Message payloads, fixed-position archive lines and page text."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F


def payload_text(data: Column | str = "data") -> Column:
    """Message bytes as UTF-8 text."""
    return F.decode(F.col(data) if isinstance(data, str) else data, "UTF-8")


def attribute(name: str) -> Column:
    """A message attribute; null when absent."""
    return F.col("attributes").getItem(name)


def number(text: Column) -> Column:
    """Text to double; null instead of an error on bad input."""
    return F.trim(text).try_cast("double")


def dash_at(line: Column, position: int) -> Column:
    """True when the 1-based ``position`` holds the dash of a leading date.

    Header and continuation lines, and lines too short to hold a date, are false.
    """
    return F.substring(line, position, 1) == F.lit("-")


def tail(line: Column, position: int) -> Column:
    """Everything from the 1-based ``position`` to the end of the line."""
    return F.substring(line, F.lit(position), F.greatest(F.length(line), F.lit(1)))


# Named character references that `page_text` resolves with or without their semicolon;
# ampersands come last, however they are written, so that an escaped reference such as
# `&amp;lt;` or `&#38;lt;` is resolved only once.
NAMED_REFERENCES = (
    ("nbsp", " "),
    ("lt", "<"),
    ("gt", ">"),
    ("quot", '"'),
    ("apos", "'"),
    ("copy", "©"),
    ("reg", "®"),
    ("middot", "·"),
    ("hellip", "…"),
    ("ndash", "–"),
    ("mdash", "—"),
    ("lsquo", "‘"),
    ("rsquo", "’"),
    ("ldquo", "“"),
    ("rdquo", "”"),
    ("amp", "&"),
)

AMPERSAND = r"&(amp;?|#0{0,5}38;|#[xX]0{0,4}26;)"

MARKUP = (
    r"(?is)<!--.*?(-->|\z)",
    r"(?is)<script\b[^>]*>.*?(</script\s*>|\z)",
    r"(?is)<style\b[^>]*>.*?(</style\s*>|\z)",
    r"(?s)</?[a-zA-Z!][^>]*(>|\z)",
)


def _numeric_references(text: Column) -> Column:
    """Resolve ``&#233;`` and ``&#xe9;``, one piece per reference."""

    def resolve(piece: Column) -> Column:
        digits = F.regexp_extract(piece, r"^&#([0-9]{1,7});", 1)
        hexits = F.regexp_extract(piece, r"^&#[xX]([0-9a-fA-F]{1,6});", 1)
        code = F.coalesce(
            digits.try_cast("long"), F.conv(F.nullif(hexits, F.lit("")), 16, 10).try_cast("long")
        )
        valid = (code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)) & (code != ord("&"))
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        rest = F.regexp_replace(piece, r"^&#[0-9a-fA-FxX]{1,7};", "")
        return F.when(valid, F.concat(char, rest)).otherwise(piece)

    pieces = F.transform(F.split(text, r"(?=&#)"), resolve)
    return F.when(text.contains("&#"), F.array_join(pieces, "")).otherwise(text)


def _other_names(text: Column) -> Column:
    """Resolve the names of the public entity table that are not in ``NAMED_REFERENCES``."""
    done = {name for name, _ in NAMED_REFERENCES}
    rest = {n: chr(c) for n, c in sorted(name2codepoint.items()) if n not in done}
    known = F.create_map(*[F.lit(x) for pair in rest.items() for x in pair])
    name = r"^&([A-Za-z][A-Za-z0-9]{0,31});"

    def resolve(piece: Column) -> Column:
        char = F.try_element_at(known, F.regexp_extract(piece, name, 1))
        return F.coalesce(F.concat(char, F.regexp_replace(piece, name, "")), piece)

    pieces = F.transform(F.split(text, r"(?=&[A-Za-z])"), resolve)
    # most pages hold nothing but the common names
    common = "|".join(sorted(done))
    asked = text.rlike(rf"&(?!(?:{common});)[A-Za-z][A-Za-z0-9]*;")
    return F.when(asked, F.array_join(pieces, "")).otherwise(text)


def page_text(html: Column) -> Column:
    """Plain text of a whole page: markup out, references resolved, blanks collapsed."""
    out = html
    for pattern in MARKUP:
        out = F.regexp_replace(out, pattern, " ")
    out = _other_names(_numeric_references(out))
    for name, char in NAMED_REFERENCES[:-1]:
        out = F.regexp_replace(out, f"&{name};?", char)
    out = F.regexp_replace(out, AMPERSAND, "&")
    return F.trim(F.regexp_replace(out, r"[ \t\r\n]+", " "))
