"""Quality rules against counting words, lines and tokens one by one."""

import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from cityflow.llm import fertility

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_base(text):
    words = WORD.findall(text or "")
    lines = (text or "").split("\n")
    seen, duplicates = set(), 0
    for line in lines:
        if WORD.search(line):
            duplicates += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), duplicates, len(covered)


def texts(rng, count):
    words = ["the", "of", "and", "maison", "été", "Größe", "#tag", "a|b", "日本", "x\x1cy", "<p>", "$5", "Привет"]
    for _ in range(count):
        row = rng.choices(words, k=rng.choice([0, 3, 7, 8, 19, 20, 60, 300]))
        if len(row) > 20 and rng.random() < 0.6:  # a passage again, sometimes overlapping itself
            at = rng.randrange(len(row) - 15)
            row += row[at : at + rng.randrange(7, 15)] * rng.choice([1, 1, 3])
        yield "".join(w + rng.choice([" ", " ", "\n", "  ", "\t", " \n"]) for w in row)


def test_base_counts_and_verdicts(spark, documents):
    rng = random.Random(4)
    rows = [*enumerate(texts(rng, 250)), (300, None), (301, ""), (302, "same line\nsame line\n\n\n same line"), (303, "w " * 40), (304, "w " * 40)]
    work = fertility.vocabularies(public_tokenizers.path(fertility.BYTE_VOCABULARY), public_tokenizers.path(fertility.PIECE_VOCABULARY))
    got = {r.doc_id: r for r in fertility.judge(documents(*rows)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        r, base = got[i], plain_base(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 20 or 100 * base[4] > 30 * base[0])
        ids, spelled = work.pieces.encode(text or ""), work.bytes.encode_ordinary(text or "")
        assert b"".join(map(work.bytes.decode_single_token_bytes, spelled)).decode() == (text or "")
        counts = Counter(ids)
        entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in counts.values())
        level = entropy / math.log2(len(ids)) if len(ids) > 1 else len(ids)
        assert r.chars_per_piece == pytest.approx(len(text or "") / max(1, len(ids)))
        assert r.chars_per_byte_token == pytest.approx(len(text or "") / max(1, len(spelled)))
        assert r.fallback_share == pytest.approx(sum(work.pieces.IsByte(t) for t in ids) / max(1, len(ids)))
        assert r.token_entropy == pytest.approx(level, abs=1e-12)
        band = fertility.SCRIPT_BANDS[r.script]
        fits = band.least <= max(r.chars_per_piece, r.chars_per_byte_token) <= band.most
        fits = fits and r.fallback_share <= band.fallback and r.token_entropy >= band.entropy
        assert r.kept == (not r.base_failed and fits)


def test_noise_goes_and_prose_stays(spark, documents):
    rng = random.Random(0)
    prose = ("The harbour was quiet in the early morning and only two boats were moving slowly towards the open sea, "
             "while the keeper of the lighthouse wrote down the wind and the height of the water in his book.")
    german = ("Am frühen Morgen lag der Hafen still, und nur zwei Boote fuhren langsam auf das offene Meer hinaus, während "
              "der Wärter des Leuchtturms den Wind und die Höhe des Wassers in sein Buch eintrug.")
    russian = ("Ранним утром гавань была тиха, и только две лодки медленно выходили в открытое море, а смотритель маяка "
               "записывал в свою книгу ветер и высоту воды, как он делал это каждый день много лет подряд.")
    noise = " ".join("".join(rng.choices("bcdfghjklmnpqrstvwxzBCDFGHJKLMNPQRSTVWXZ0123456789", k=9)) for _ in range(60))
    emoji = " ".join("".join(rng.choices("🎉🦀🧪🛠🪐🧭", k=4)) for _ in range(60))
    one = " ".join(f"the{rng.choice(['', ','])}" for _ in range(2000))
    rows = documents((1, prose), (2, german), (3, russian), (4, noise), (5, emoji), (6, one))
    got = {r.doc_id: r for r in fertility.judge(rows).collect()}
    assert [got[k].kept for k in range(1, 7)] == [True, True, True, False, False, False]
    assert got[3].script == "cyrillic" and got[4].chars_per_piece < 1.9 and not got[4].base_failed
    # a band of a language goes before that of the script
    wide = fertility.Bands(by_lang={"zz": fertility.Band(0.0, entropy=0.0)})
    named = rows.withColumn("lang", rows["text"].substr(1, 0)).drop("lang").selectExpr("*", "'zz' AS lang")
    assert {r.doc_id: r.kept for r in fertility.judge(named, wide).collect()}[4]


def test_windows_of_one_hash_are_compared():
    rng = np.random.default_rng(0)
    ids, document = rng.integers(0, 3, 4000), np.sort(rng.integers(0, 40, 4000))
    said = [b"w%d" % i for i in ids]
    got = fertility.repeated_words(said, document)
    want = np.zeros(4000, dtype=bool)
    for d in range(40):
        at = np.flatnonzero(document == d)
        windows = [tuple(ids[at[i : i + 8]]) for i in range(len(at) - 7)]
        counts = Counter(windows)
        for i, w in enumerate(windows):
            if counts[w] > 1:
                want[at[i : i + 8]] = True
    assert (got == want).all() and want.any() and not want.all()


def test_long_texts_are_measured_in_parts():
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abcdefgé", k=rng.randrange(1, 9))) for _ in range(3000)) + "  x" * 100
    assert "".join(fertility.parts(text, 500)) == text and "".join(fertility.parts("y" * 1234, 500)) == "y" * 1234
    work = fertility.vocabularies(public_tokenizers.path(fertility.BYTE_VOCABULARY), public_tokenizers.path(fertility.PIECE_VOCABULARY))
    whole = work.bytes.encode_ordinary(text)
    parts = [t for p in fertility.parts(text, 500) for t in work.bytes.encode_ordinary(p)]
    assert parts == whole


ODD = ["", "a", "  a", " a", "a ", "a  b", "a\n b", "a\nb", "\na", "a\n", "a\nb\n\nc", "\u2581a b\u2581 \u2581", "it's 'll a\n's", "\x1ca b\x1c",
       "日本 語\nです", "a\u00a0b c", "\u3000 a", "<s> </s>\n<0x0A>", "a<|endoftext|> b"]


@pytest.mark.parametrize("remembered", [fertility.REMEMBERED, 60])
def test_words_give_the_tokens_of_the_whole(remembered):
    rng = random.Random(remembered)
    paths = (public_tokenizers.path(p) for p in (fertility.BYTE_VOCABULARY, fertility.PIECE_VOCABULARY))
    work = fertility.Vocabularies(*paths, remembered)
    bits = ["the", " ", " ", "  ", ",", "'s", "É", "\n", "9", "!", "Word", "\t", "\u2581", "\u3000", "🎉", "x\x1c"]
    texts = ODD + ["".join(rng.choices(bits, k=30)) for _ in range(1500)]
    for start in range(0, len(texts), 50):
        part = texts[start : start + 50]
        for text, (byte_tokens, tokens, fallback, level) in zip(part, work.measure(part)):
            ids = work.pieces.encode(text)
            assert byte_tokens == len(work.bytes.encode_ordinary(text)), text
            assert (tokens, fallback) == (len(ids), sum(map(work.pieces.IsByte, ids))), text
            share = np.array(list(Counter(ids).values())) / max(len(ids), 1)
            want = -(share * np.log2(share)).sum() / math.log2(len(ids)) if len(ids) > 1 else len(ids)
            assert level == pytest.approx(want), text
