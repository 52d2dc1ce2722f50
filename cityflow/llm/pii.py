"""Personal data by anchor expansion.

An Aho-Corasick automaton runs over each text once and finds anchors: at-signs,
plus signs, digits, schemes and the words that announce an identifier. From
every anchor a small deterministic parser expands left and right to the
boundaries of an address or number and validates it. Work is linear in the text.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from cityflow.llm.common import map_texts

#: Kinds in the order in which spans are listed; the last two are this method's own.
KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = KINDS[:4]

_DIGITS = frozenset("0123456789")
_ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_DIALLED = _DIGITS | frozenset(" ().-")
_URL = _ALNUM | frozenset("-._~:/?#[]@!$&'()*+,;=%")
#: Words that announce an account or identity number, any case, as whole words.
CUES = ("iban", "account", "acct", "ssn", "passport", "konto", "cuenta", "compte")
SCHEMES = ("http", "https", "ftp", "ftps", "mailto", "ssh", "sftp")


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    built.add_word("@", ("email", 1))
    built.add_word("+", ("phone", 1))
    built.add_word("://", ("url", 3))
    for d in _DIGITS:
        built.add_word(d, ("digit", 1))
    for cue in CUES:
        built.add_word(cue, ("account", len(cue)))
        built.add_word(cue.upper(), ("account", len(cue)))
        built.add_word(cue.title(), ("account", len(cue)))
    built.make_automaton()
    return built


def run(text: str, at: int, allowed: frozenset) -> int:
    """End of the run of allowed characters that starts at ``at``."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """Expand an at-sign: a local part to the left, two or more labels to the right."""
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    if start == at:
        return None
    end = run(text, at + 1, _LABEL)
    if end == at + 1:
        return None
    labels = 1
    while end < len(text) and text[end] == ".":
        further = run(text, end + 1, _LABEL)
        if further == end + 1:
            break
        end, labels = further, labels + 1
    return (start, end) if labels > 1 else None


def ip(text: str, at: int) -> tuple[int, bool] | None:
    """Four dotted runs of digits from ``at``: their end, and if each is 255 at most."""
    end, good = at, True
    for part in range(4):
        if part:
            if end >= len(text) or text[end] != ".":
                return None
            end += 1
        stop = run(text, end, _DIGITS)
        if stop == end:
            return None
        digits = text[end:stop].lstrip("0")
        good = good and len(digits) <= 3 and int(digits or "0") <= 255
        end = stop
    return end, good


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def card(text: str, at: int) -> tuple[int, bool]:
    """Digits with single blanks or hyphens between from ``at``: their end, and if they make a card."""
    end, n = at + 1, len(text)
    while end < n:
        if text[end] in _DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in _DIGITS:
            end += 2
        else:
            break
    if not 16 <= end - at <= 37:
        return end, False
    digits = text[at:end].replace(" ", "").replace("-", "")
    return end, 16 <= len(digits) <= 19 and luhn(digits)


def phone(text: str, at: int) -> tuple[int, bool] | None:
    """A plus sign, a digit, then digits and separators up to the last digit."""
    if at + 1 >= len(text) or text[at + 1] not in _DIGITS:
        return None
    end = run(text, at + 2, _DIALLED)
    while end > at + 2 and text[end - 1] not in _DIGITS:
        end -= 1
    if end < at + 4:  # a separator or digit must lie between the two digits
        return None
    digits = sum(c in _DIGITS for c in text[at:end])
    return end, 8 <= digits <= 15


def url(text: str, at: int) -> tuple[int, int] | None:
    """Expand ``://`` to a known scheme on the left and a host with its path on the right."""
    start = at
    while start > 0 and text[start - 1] in _ALNUM and at - start < 12:
        start -= 1
    if text[start:at].lower() not in SCHEMES:
        return None
    end = run(text, at + 3, _URL)
    while end > at + 3 and text[end - 1] in ".,;:!?'()[]":
        end -= 1
    return (start, end) if end > at + 3 and text[at + 3] in _ALNUM else None


def iban(compact: str) -> bool:
    if not (15 <= len(compact) <= 34 and compact[:2].isalpha() and compact[2:4].isdigit()):
        return False
    moved = compact[4:] + compact[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def account(text: str, at: int, size: int) -> tuple[int, int] | None:
    """The number after a cue word that starts at ``at``: an IBAN that checks, or 6 to 18 digits."""
    end = at + size
    if at and text[at - 1] in _ALNUM or end < len(text) and text[end] in _ALNUM:
        return None
    limit = end + 12
    while end < len(text) and end < limit and text[end] in " :#=.-nNoO":
        end += 1
    if end >= len(text) or text[end] not in _ALNUM:
        return None
    start, stop = end, run(text, end, _ALNUM)
    if text[start] in _DIGITS:
        while stop + 1 < len(text) and text[stop] in " -" and text[stop + 1] in _DIGITS and stop - start < 24:
            stop = run(text, stop + 1, _DIGITS)
        token = text[start:stop].replace(" ", "").replace("-", "")
        return (start, stop) if token.isascii() and token.isdigit() and 6 <= len(token) <= 18 else None
    best = None
    while True:
        compact = text[start:stop].replace(" ", "").upper()
        if len(compact) > 34:
            break
        if iban(compact):
            best = (start, stop)
        if stop + 1 >= len(text) or text[stop] != " " or text[stop + 1] not in _ALNUM:
            break
        stop = run(text, stop + 1, _ALNUM)
    return best


def spans(text: str | None) -> dict[str, list[tuple[int, int]]]:
    """All spans of a whole text by kind, in code points, end exclusive; null is read as empty."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not text:
        return found
    past = dict.fromkeys(KINDS, 0)  # end of the last match of a kind, kept or dropped
    for last, (kind, size) in automaton().iter(text):
        at = last - size + 1
        if kind == "digit":
            # where a run's first digit starts no address, none of its digits does
            starts = not at or text[at - 1] not in _DIGITS
            if starts and at >= past["ip"] and (hit := ip(text, at)):
                past["ip"] = hit[0]
                if hit[1]:
                    found["ip"].append((at, hit[0]))
            if at >= past["card"]:
                end, good = card(text, at)
                past["card"] = end
                if good:
                    found["card"].append((at, end))
        elif kind == "email":
            if hit := email(text, at, past["email"]):
                past["email"] = hit[1]
                found["email"].append(hit)
        elif kind == "phone":
            if at >= past["phone"] and (hit := phone(text, at)):
                past["phone"] = hit[0]
                if hit[1]:
                    found["phone"].append((at, hit[0]))
        elif kind == "url":
            if (hit := url(text, at)) and hit[0] >= past["url"]:
                past["url"] = hit[1]
                found["url"].append(hit)
        elif (hit := account(text, at, size)) and hit[0] >= past["account"]:
            past["account"] = hit[1]
            found["account"].append(hit)
    return found


def listed(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts of the base kinds, ``base_sha256``, ``spans``, ``n_url``, ``n_account``.

    One row per row of ``docs``, without a shuffle. Spans of different kinds may
    overlap. Null and empty texts have no span (and the hash of an empty string);
    long texts are searched whole, repeated rows stay repeated, null ids are carried.
    """
    fields = [f"n_{k}" for k in BASE]

    def make():
        def work(ids, texts):
            out = {f: [] for f in ("doc_id", *fields, "base_sha256", "spans", "n_url", "n_account")}
            out["doc_id"] = ids
            for text in texts:
                found = spans(text)
                for k in KINDS:
                    out[f"n_{k}"].append(len(found[k]))
                base = listed(found, BASE)
                out["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
                out["spans"].append(listed(found, KINDS))
            return out

        return work

    counts = ", ".join(f"{f} long" for f in fields)
    return map_texts(
        docs, make,
        f"doc_id long, {counts}, base_sha256 string, spans string, n_url long, n_account long",
    )
