"""Collocations against plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from auditloom.llm import collocations as co
from auditloom.llm.common import ready

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "text string, lang string, f string, number int, phrase string"


def expected(rows, least, longest, inside, first):
    """By counting every phrase."""
    total, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    good = {key: n for key, n in f.items() if len(key[1]) > 1 and n >= least}
    out = []
    for (lang, phrase), a in good.items():
        longer = [n for (other, q), n in good.items() if other == lang and len(q) > len(phrase)
                  and any(q[i : i + len(phrase)] == phrase for i in range(len(q)))]
        if any(100 * n >= inside * a for n in longer):
            continue
        cuts = []
        for k in range(1, len(phrase)):
            le, r = f[lang, phrase[:k]], f[lang, phrase[k:]]
            cuts.append((1000 * a * total[lang] // (le * r), k, le, r))
        score, _, le, r = min(cuts)
        out.append((lang, -score, -a, " ".join(phrase).encode(), le, r, total[lang]))
    out.sort()
    seen, rows = Counter(), []
    for lang, score, a, phrase, le, r, n in out:
        seen[lang] += 1
        if seen[lang] <= first:
            rows.append((lang, seen[lang], phrase.decode(), -a, le, r, n, -score))
    return rows


def found(spark, rows, **more):
    df = ready(spark).createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in co.collocations(df, **more).collect())


def texts(seed, count):
    picked = random.Random(seed)
    stock = ["new york city", "ice cream", "state of the art machine", "of the", "a", "b", "é", "Z"]
    rows = []
    for i in range(count):
        words = [picked.choice(stock) + picked.choice([" ", "  ", "\t", ". ", ",", "\n"]) for _ in range(picked.randrange(40))]
        rows.append(("".join(words), picked.choice(["en", "de", None, ""])))
    return rows


@pytest.mark.parametrize(("least", "inside", "first", "most"), [(5, 100, 50, 500), (20, 80, 2000, 7), (3, 100, 9, 40)])
def test_equals_counting(spark, least, inside, first, most):
    """Also with many small tries."""
    rows = texts(least, 150)
    got = found(spark, rows, least=least, inside=inside, first=first, most=most)
    assert got == sorted(expected(rows, least, 5, inside, first)) and got


def test_small_slices_and_held_rows(spark, monkeypatch):
    monkeypatch.setattr(co, "POSITIONS", 17)
    monkeypatch.setattr(co, "HELD", 10)
    rows = texts(8, 100)
    assert found(spark, rows, least=4) == sorted(expected(rows, 4, 5, 100, 2000))


def test_edges(spark):
    """Nulls, empty texts, repeated rows, a very long text, overlaps, upper case beyond A-Z, ties of all orders."""
    rows = [(None, "en"), ("", "en"), ("...", None), ("a a a a a a", "en"), ("É x É x", "en")] * 3
    rows += [("b a. " * 4, "en"), ("a b. " * 4, "en"), ("one Two THREE " * 30_000, "de"), ("x\x0by\x0cz\rx y", None)]
    assert found(spark, rows, least=3) == sorted(expected(rows, 3, 5, 100, 2000))


def test_nothing(spark):
    assert found(spark, []) == []
    assert found(spark, [("a b c", "en"), (None, None)]) == []


def test_scores_pass_64_bits(spark):
    """The products of a score, not the score itself."""
    from pyspark.sql import functions as F

    values = ready(spark).range(1).select(F.lit(9 * 10**14).alias("a"), F.lit(9 * 10**14).alias("x"))
    score = F.expr("(1000 * cast(a as decimal(19, 0)) * cast(a as decimal(19, 0))) div (cast(a as decimal(19, 0)) * cast(x as decimal(19, 0)))")
    assert values.select(score).first()[0] == 1000


def test_colliding_hashes_are_hashed_anew(spark, monkeypatch):
    real = co._hash
    monkeypatch.setattr(co, "_hash", lambda word, seed: real(word, seed) if seed > 1 else real(word, 0) % 3)
    rows = texts(2, 60)
    assert found(spark, rows, least=5) == sorted(expected(rows, 5, 5, 100, 2000))


def test_words_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(co, "HELD_WORDS", 3)
    rows = texts(3, 40)
    assert found(spark, rows, least=3) == sorted(expected(rows, 3, 5, 100, 2000))


def test_double_array_finds_its_phrases_and_no_others():
    made = np.random.default_rng(6)
    for length in (1, 2, 4):
        phrases = np.unique(made.integers(1, 40, (600, length)), axis=0)
        langs = [["de", "en"][i] for i in made.integers(0, 2, len(phrases))]
        trie = co.DoubleArray(langs, phrases, np.arange(len(phrases)) * 10)
        wanted = {(lang, *p): n * 10 for n, (lang, p) in enumerate(zip(langs, phrases.tolist()))}
        line = made.integers(0, 45, 5000)
        batch = pa.record_batch({"lang": ["en", "fr"], "hashes": [line[:4000], line[4000:]]})
        hashes, roots = co._positions(batch, trie.roots)
        place, bins = trie.walk(roots, hashes, 0, len(hashes))
        got = dict(zip(place.tolist(), trie.numbers[bins].tolist()))
        hit = {}
        for i in range(4000):
            key = ("en", *line[i : i + length].tolist())
            if key in wanted:
                hit[i] = wanted[key]
        assert got == hit


def test_one_pass_a_length(spark, monkeypatch):
    """Candidates are counted, and the words after them summed, by the same tries."""
    passes, tries = [], co._tries
    monkeypatch.setattr(co, "_tries", lambda phrases, length, most: passes.append(length) or tries(phrases, length, most))
    rows = [("one two three four five six", "en")] * 5
    assert found(spark, rows, least=3) == sorted(expected(rows, 3, 5, 100, 2000))
    assert passes == [1, 2, 3, 4, 5]
