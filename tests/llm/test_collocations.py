"""Phrase mining against plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from lurewatch.llm import collocations


def brute_counts(rows, longest):
    found, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            own = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(own)
            for size in range(1, longest + 1):
                found.update((lang, tuple(own[i:i + size])) for i in range(len(own) - size + 1))
    return found, total


def brute(found, total, least, longest, keep, absorb=100):
    found = {k: v for k, v in found.items() if v >= least}
    out = {}
    for (lang, words), a in found.items():
        if len(words) < 2:
            continue
        score, _, left, right = min((1000 * a * total[lang] // (found[lang, words[:k]] * found[lang, words[k:]]), k,
                                     found[lang, words[:k]], found[lang, words[k:]]) for k in range(1, len(words)))
        if any(tuple(other[i:i + len(words)]) == words and 100 * n >= absorb * a
               for (o, other), n in found.items() if o == lang and len(other) > len(words)
               for i in range(len(other) - len(words) + 1)):
            continue
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted((lang, n + 1, p.decode(), -a, left, right, total[lang], -s) for lang, rows in out.items()
                  for n, (s, a, p, left, right) in enumerate(sorted(rows)[:keep]))


def documents(seed=3, n=300):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "New", "york", "city", "é", "Hall", "a-b", "x", "日本", "don't"]
    fixed = ["new york city hall opens today", "New\tYork  City", "of the", "the the the the the the"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else " ".join(rng.choices(vocabulary, [9, 7, 2, 2, 2, 1, 1, 1, 1, 1, 1],
                 k=rng.randint(0, 9))) for _ in range(rng.randint(0, 5))]
        rows.append((rng.choice(["en", "en", "de", None]), rng.choice([". ", ", ", "\n", " ", "!?", "\x0b"]).join(parts)))
    return rows + [("en", None), ("en", ""), ("en", " \t "), ("fr", "too few words"), ("en", "the new york city " * 500)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "p") for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, n int, phrase string").repartition(3)


@pytest.mark.parametrize("sample, lowered, keep", [(4, 0.5, 2000), (10 ** 9, 0.5, 7), (2, 5.0, 2000), (1, 0.2, 2000)])
def test_phrases_equal_brute_force(spark, monkeypatch, sample, lowered, keep):
    """Whatever the sample proposes: nothing, too little, too much."""
    monkeypatch.setattr(collocations, "CHUNK", 700)
    rows = documents()
    found = collocations.frequent(frame(spark, rows), least=12, sample=sample, lowered=lowered)
    counts, total = brute_counts(rows, 5)
    got = {(r.lang, tuple(r.phrase.split(" "))): r.n for r in found.filter("size > 0").collect()}
    assert got == {k: v for k, v in counts.items() if v >= 12}
    got = collocations.top(collocations.scored(found), keep)
    assert sorted(map(tuple, got.collect())) == brute(counts, total, 12, 5, keep)


def test_shared_bits_lose_nothing(spark):
    """With few bits most phrases look proposed: more is counted than must be, and the result is the same."""
    rows = documents(5, 60)
    counts, total = brute_counts(rows, 4)
    got = collocations.mine(frame(spark, rows), least=5, longest=4, sample=3, space=1 << 15)
    assert sorted(map(tuple, got.collect())) == brute(counts, total, 5, 4, 2000)
    found = collocations.Bitmap(1 << 15, [(1, b"\xff" * 4096)])
    assert found.has(np.arange(0, 1 << 62, 1 << 55, dtype=np.uint64)).all()


def test_other_bounds(spark):
    rows = documents(7, 80)
    counts, total = brute_counts(rows, 3)
    got = collocations.mine(frame(spark, rows), least=4, longest=3, keep=10, absorb=60)
    assert sorted(map(tuple, got.collect())) == brute(counts, total, 4, 3, 10, 60)


def test_products_pass_64_bits(spark):
    big = 10 ** 12
    found = spark.createDataFrame([("en", 0, "", 9 * 10 ** 17), ("en", 1, "x", 3 * big), ("en", 1, "y", 7 * big),
                                   ("en", 2, "x y", 2 * big)], collocations.COUNTS)
    row = collocations.scored(found).first()
    assert row.score == 1000 * 2 * big * 9 * 10 ** 17 // (3 * big * 7 * big)


def test_empty_table(spark):
    assert collocations.mine(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_long_texts_are_cut_at_marks(monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 10)
    for text in (b"one two. three four five six seven, eight", b"no mark here at all and on", b"a.b.c.d.e.f.g.h.i.j.k.l", b""):
        tiles = list(collocations._tiles(text))
        assert b"".join(tiles) == text and all(t[-1:] in b".," for t in tiles[:-1])
