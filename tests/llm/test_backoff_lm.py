"""Scores of the backoff automaton against the model's definition in plain Python."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lurewatch.llm import backoff_lm, queries

ORDER = 3


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [None]


class Brute:
    def __init__(self, texts, order):
        self.order, self.counts, self.begins = order, Counter(), len(texts)
        self.own = [tokens(t) for t in texts]
        for own in self.own:
            for i in range(len(own)):
                for n in range(1, order + 1):
                    if gram := self.gram(own, i, n):
                        self.counts[gram] += 1
        first = [c for g, c in self.counts.items() if len(g) == 1]
        self.n, self.v = sum(first), len(first)
        once, twice = first.count(1), first.count(2)
        self.loss = (once + 1) / (once + 2 * twice + 2)
        total, single = Counter(), Counter()
        for own in self.own:
            for i in range(len(own)):
                for n in range(2, order + 1):
                    if gram := self.gram(own, i, n):
                        at = n, int(math.log2(self.held(gram[:-1])))
                        total[at] += 1
                        single[at] += self.counts[gram] == 1
        self.share = {k: 1 - (single[k] + 0.5) / (total[k] + 1) for k in total}

    def gram(self, own, i, n):
        if i - n + 1 >= 0:
            return tuple(own[i - n + 1:i + 1])
        return ("<s>", *own[:i + 1]) if i - n + 1 == -1 else None

    def held(self, context):
        return self.begins if context == ("<s>",) else self.counts[context]

    def p(self, context, word):
        if not context:
            if not self.n:
                return 1.0
            c = self.counts[word,]
            return (c - self.loss) / self.n if c else self.loss * self.v / self.n
        c, lower = self.held(context), self.p(context[1:], word)
        if not c:
            return lower
        share = self.share[len(context) + 1, int(math.log2(c))]
        return share * self.counts[*context, word] / c + (1 - share) * lower

    def score(self, text):
        own, total, base, known = tokens(text), 0.0, 0.0, 0
        for i, word in enumerate(own):
            gram = next(g for n in range(self.order, 0, -1) if (g := self.gram(own, i, n)))
            total += math.log10(self.p(gram[:-1], word))
            base += math.log10((self.counts[word,] + 1) / (self.n + self.v + 1))
            known += self.counts[word,] > 0
        return len(own), known, self.n, base, total


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def compare(spark, rows, order=ORDER):
    docs = spark.createDataFrame([(i, t, 7, 0.5) for i, t in rows], "doc_id long, text string, n long, score double")
    got = backoff_lm.score(docs.repartition(3), queries.lm_training(F.col("doc_id")), order=order).collect()
    model = Brute([t for i, t in rows if not held_out(i)], order)
    want = sorted(((i, held_out(i), *model.score(t)) for i, t in rows), key=repr)
    assert len(got) == len(want)
    for a, b in zip(sorted((tuple(r) for r in got), key=repr), want):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-9) and a[6] == pytest.approx(b[6], abs=1e-9)
    return model


LINES = ["The cat sat on the mat", "the cat sat on the hat", "The CAT\tran\x0bhome", "a dog sat on É é the mat",
         "ünseen words only here", "", None, "   ", "the the the the the", "cat " * 300, "the cat sat"]


def test_scores_equal_the_definition(spark, monkeypatch):
    monkeypatch.setattr(backoff_lm, "CHUNK", 60)
    monkeypatch.setattr(backoff_lm, "BUCKET", 50)
    rows = [(i, LINES[i % len(LINES)] and LINES[i % len(LINES)] + (f" w{i % 13} end" if i % 3 else "")) for i in range(60)]
    rows += [(3, "the cat sat on the mat"), (3, "the cat sat on the mat"), (None, "a text without an id")]
    model = compare(spark, rows)
    for context in ((), ("the",), ("cat", "sat"), ("<s>",), ("<s>", "the")):   # probabilities sum to one
        known = {g[0] for g in model.counts if len(g) == 1}
        assert sum(model.p(context, w) for w in known) + model.p(context, "never") == pytest.approx(1)


@pytest.mark.parametrize("order", [1, 2, 4])
def test_other_orders(spark, order):
    compare(spark, [(i, LINES[i % len(LINES)]) for i in range(30)], order)


def test_no_training_text_and_empty_table(spark):
    out = [i for i in range(40) if held_out(i)]
    compare(spark, [(i, "some words here") for i in out])
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert backoff_lm.score(docs, F.lit(True)).count() == 0


def test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in queries.QUERIES["op11_lm_score"](spark, "/root/testdata/sf0.001").collect()}
    model = Brute([t for i, t in rows if not held_out(i)], backoff_lm.ORDER)
    for i, t in rows[:40]:
        n, known, total, base, score = model.score(t)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens, got[i].held_out) == (n, known, total, held_out(i))
        assert got[i].base_score == pytest.approx(base, rel=1e-9) and got[i].score == pytest.approx(score, rel=1e-9)
    unseen = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in unseen) > 0.9 * sum(r.base_score for r in unseen)   # better on texts not learnt from
