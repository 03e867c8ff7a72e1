"""Toxicity scores from a learned lexicon, misspellings included, and the context of each hit.

A lexicon of words and word beginnings is learned from labelled documents.  It is held as a trie.  A
word of a text is run through the intersection of that trie with a Levenshtein automaton of one edit,
made deterministic as far as words ask for it: most words leave it after a few letters.  A hit counts
by the term's log-odds; a misspelled one by what such hits were worth in the labelled documents.  The
window around a hit tells quotation (quotation marks, words of reporting) from abuse (address in the
second person).  A logistic model over the hits of the whole text gives the score.

The model is fitted on a bounded sample of labelled documents (``SAMPLE``, by hash of the id); every
document is scored over its whole text.

Defined results: a null or empty text has no hits and gets the score of that; null ids and null labels
are not learned from; a document labelled twice counts as toxic if one label says so; without labelled
documents of both kinds every score is 0; rows that repeat are scored each; other columns are not read.
"""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, stored, tidy, whole_row

SAMPLE = 20_000      # labelled documents that the model is fitted on, about
TERMS = 1_000        # terms of the lexicon
LEAST_DOCS = 4       # toxic documents that a term must be in
LEAST_Z = 3.5        # standard errors by which a term's log-odds must exceed zero
LEAST_ODDS = math.log(4)
STEMS = range(4, 8)  # lengths of word beginnings that can be terms
FUZZY_LENGTH = 5     # shorter terms are matched exactly
WINDOW = 6           # words on either side of a hit
REMEMBERED = 300_000

# What marks a quotation, and what marks an address.
REPORTING = {"said", "says", "called", "wrote", "quoted", "quote", "quotes", "word", "term", "means", "meaning",
             "insult", "slur", "definition", "headline", "zitat", "sagte", "wort", "citation", "disait", "mot",
             "cita", "dijo", "palabra"}
ADDRESS = {"you", "your", "youre", "yourself", "u", "ur", "du", "dein", "deine", "dich", "tu", "toi", "vous", "tus",
           "eres"}
MARKS = "\"“”„«»‘’"
QUOTED, ADDRESSED = 0.3, 1.25

WORD = re.compile(r"[^\W_]+(?:[*@$][^\W_]+)*")
OTHER = "\0"         # any letter that no term has


class Lexicon(dict):
    """word -> (weight, is misspelled), remembered; ``terms``: {term: (weight, weight when misspelled)}.

    A term that ends in "*" is a word beginning.
    """

    def __init__(self, terms: dict):
        self.terms = list(terms)
        self.weights = list(terms.values())
        self.children, self.word, self.stem = [{}], [-1], [-1]
        for number, term in enumerate(self.terms):
            node = 0
            for letter in term.rstrip("*"):
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.word.append(-1)
                    self.stem.append(-1)
                node = self.children[node][letter]
            (self.stem if term.endswith("*") else self.word)[node] = number
        self.letters = {x for kids in self.children for x in kids}
        self._forget()

    def _forget(self):
        self.states, self.steps, self.ends = {}, [], []
        self.start = self._state({(0, 0)})

    def _state(self, places) -> int:
        """The number of a set of places (trie node, edits so far), closed under skipped letters."""
        places = set(places)
        for node, edits in list(places):
            if not edits:
                places.update((kid, 1) for kid in self.children[node].values())
        places = frozenset((n, e) for n, e in places if not e or (n, 0) not in places)
        if not places:
            return -1
        if places not in self.states:
            self.states[places] = len(self.steps)
            self.steps.append({})
            self.ends.append([self._best(places, self.word), self._best(places, self.stem), places])
        return self.states[places]

    def _best(self, places, terminal):
        """Best (weight, misspelled, term) among the places where a term ends."""
        found = [(0.0, False, -1)]
        for node, edits in places:
            number = terminal[node]
            if number >= 0 and (not edits or len(self.terms[number].rstrip("*")) >= FUZZY_LENGTH):
                found.append((self.weights[number][edits], bool(edits), number))
        return max(found, key=lambda x: (x[0], not x[1], -x[2]))

    def _step(self, state, letter) -> int:
        after = set()
        for node, edits in self.ends[state][2]:
            kid = self.children[node].get(letter)
            if kid is not None:
                after.add((kid, edits))
            if not edits:
                after.add((node, 1))
                after.update((other, 1) for other in self.children[node].values())
        self.steps[state][letter] = out = self._state(after)
        return out

    def find(self, word: str):
        """Best (weight, misspelled, term number) of a word."""
        state, best = self.start, (0.0, False, -1)
        for letter in word:
            if letter not in self.letters:
                letter = OTHER
            after = self.steps[state].get(letter)
            state = self._step(state, letter) if after is None else after
            if state < 0:
                return best
            if self.ends[state][1][0] > best[0]:
                best = self.ends[state][1]
        return max(best, self.ends[state][0], key=lambda x: x[0])

    def __missing__(self, word):
        if len(self) >= REMEMBERED:
            self.clear()
        if len(self.steps) >= REMEMBERED // 10:
            self._forget()
        found = self.find(word)
        self[word] = out = found if found[0] > 0 else None
        return out

    def hits(self, text: str):
        """Number of words, and (weight, misspelled, term, context) per hit."""
        text = text.lower()
        words = WORD.findall(text)
        at = [i for i, found in enumerate(map(self.__getitem__, words)) if found]
        if not at:
            return len(words), []
        spans, wanted = {}, set(at)
        for i, m in enumerate(WORD.finditer(text)):
            if i in wanted:
                spans[i] = m.span()
        out = []
        for i in at:
            first, last = spans[i]
            near = set(words[max(0, i - WINDOW):i + WINDOW + 1])
            quoted = text[max(0, first - 1):first] in MARKS and first > 0 or _inside(text, first, last)
            context = QUOTED if quoted or near & REPORTING else ADDRESSED if near & ADDRESS else 1.0
            out.append((*self[words[i]], context))
        return len(words), out


def _inside(text, first, last):
    """Quotation marks close by on both sides, in the same line."""
    left = text[max(0, first - 60):first].rpartition("\n")[2]
    right = text[last:last + 60].partition("\n")[0]
    return sum(left.count(m) for m in MARKS) % 2 == 1 and any(m in right for m in MARKS)


def features(words: int, hits: list) -> list:
    exact = sum(w * c for w, fuzzy, _, c in hits if not fuzzy)
    fuzzy = sum(w * c for w, fuzzy, _, c in hits if fuzzy)
    size = words + 10.0
    quoted = sum(c == QUOTED for *_, c in hits)
    return [min(100 * exact / size, 30.0), min(100 * fuzzy / size, 30.0), math.log1p(exact), math.log1p(fuzzy),
            math.log1p(100 * exact / size), quoted / (len(hits) + 1.0)]


N_FEATURES = 6


def _terms(text):
    words = set(WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


def _count(of):
    """Documents of either label that each key of ``of(text)`` is in."""
    def run(batches):
        for batch in batches:
            seen = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[toxic].update(of(text or ""))
            keys = sorted(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([seen[1][k] for k in keys], pa.int64()),
                 pa.array([seen[0][k] for k in keys], pa.int64())], ["term", "toxic", "clean"])
    return run


def _specific(found):
    """Without word beginnings that say no more than a longer term: nine in ten of their documents hold it."""
    held = {r["term"]: r["a"] for r in found}

    def idle(stem):
        return any(t != stem and t.startswith(stem[:-1]) and (len(t.rstrip("*")) > len(stem) - 1 or not t.endswith("*"))
                   and n >= 0.9 * held[stem] for t, n in held.items())
    return [r for r in found if not (r["term"].endswith("*") and idle(r["term"]))]


def _features(lexicon_terms, label):
    def run(batches):
        lexicon = Lexicon(lexicon_terms)
        for batch in batches:
            rows = [features(*lexicon.hits(t or "")) for t in batch.column(0).to_pylist()]
            table = np.array(rows, float).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(list(table), pa.list_(pa.float64()))], [label, "features"])
    return run


def _logistic(x, y, ridge=0.1, steps=30):
    """Weights with the intercept first, and the scaling of the features."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    w, penalty = np.zeros(z.shape[1]), ridge * np.diag([0.0] + [1.0] * x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + penalty + 1e-9 * np.eye(len(w))
        w = w + np.linalg.solve(h, z.T @ (y - p) - penalty @ w)
    return w, mean, scale


def training_rows(labels: DataFrame, docs: DataFrame, learn_from, sample=SAMPLE, doc_id="doc_id", text="text",
                  label="toxic") -> DataFrame:
    """text, toxic of a bounded sample of the labelled documents that satisfy ``learn_from`` (of the id)."""
    known = (labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & learn_from(F.col(doc_id)))
             .groupBy(F.col(doc_id).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("toxic")))
    share = min(1.0, sample / max(1, known.count()))
    part = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # The sample has about ``sample`` rows of two numbers, whatever the corpus holds.
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(F.broadcast(part), "_id")
    return stored(rows.select("text", (F.col("toxic") > 0).cast("int").alias("toxic")), "toxic-sample")


def fit(rows: DataFrame):
    """Lexicon and logistic model from ``rows`` (text, toxic); None without both kinds of documents."""
    ship(rows.sparkSession)
    sizes = dict(rows.groupBy("toxic").count().collect())
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return None
    counts = "term string, toxic long, clean long"

    def odds(a, b):
        return math.log((a + 0.5) / (n_toxic + 1)) - math.log((b + 0.5) / (n_clean + 1))

    stats = rows.mapInArrow(tidy(_count(_terms)), counts).groupBy("term").agg(
        F.sum("toxic").alias("a"), F.sum("clean").alias("b")).filter(F.col("a") >= LEAST_DOCS)
    gain = (F.log((F.col("a") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("b") + 0.5) / (n_clean + 1.0)))
    z = gain / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    best = (stats.withColumn("gain", gain).withColumn("z", z).filter((F.col("z") >= LEAST_Z) & (F.col("gain") >= LEAST_ODDS))
            .orderBy(F.col("z").desc(), "term").limit(TERMS).collect())
    terms = {r["term"]: (r["gain"], 0.5 * r["gain"]) for r in _specific(best)}

    # What a misspelling of a term was worth in the sample; half the term's weight where none was seen.
    def misspelled(text, lexicon=[]):  # noqa: B006  one lexicon per worker
        if not lexicon:
            lexicon.append(Lexicon(terms))
        return {lexicon[0].terms[n] for _, fuzzy, n, _ in lexicon[0].hits(text)[1] if fuzzy}

    seen = rows.mapInArrow(tidy(_count(misspelled)), counts).groupBy("term").agg(
        F.sum("toxic").alias("a"), F.sum("clean").alias("b")).collect()
    for r in seen:
        if r["a"] + r["b"] >= LEAST_DOCS:
            weight = terms[r["term"]][0]
            terms[r["term"]] = (weight, min(max(odds(r["a"], r["b"]), 0.0), 0.8 * weight))

    table = rows.mapInArrow(tidy(_features(terms, "toxic")), "toxic int, features array<double>").collect()
    x = np.array([r["features"] for r in table], float).reshape(-1, N_FEATURES)
    y = np.array([r["toxic"] for r in table], float)
    return terms, _logistic(x, y)


def _score(model):
    def run(batches):
        lexicon = Lexicon(model[0]) if model else None
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            if model and batch.num_rows:
                weights, mean, scale = model[1]
                x = np.array([features(*lexicon.hits(t or "")) for t in batch.column(0).to_pylist()], float)
                scores = 1 / (1 + np.exp(-np.clip(weights[0] + ((x - mean) / scale) @ weights[1:], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(scores)], ["row", "score"])
    return run


def scored(rows: DataFrame, model) -> DataFrame:
    """``row`` and ``score`` of rows with the columns text and row."""
    ship(rows.sparkSession)
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    return rows.select("text", "row").mapInArrow(tidy(_score(model)), schema)


def score(docs: DataFrame, model, doc_id="doc_id", text="text") -> DataFrame:
    """doc_id and score of every row of ``docs``."""
    rows = docs.select(F.col(text).alias("text"), F.col(doc_id).alias("row"))
    return scored(rows, model).select(F.col("row").alias("doc_id"), "score")


def keep_clean(docs: DataFrame, model, limit=0.5, text="text") -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, with all their columns."""
    rows = docs.select(F.col(text).alias("text"), whole_row(docs))
    return scored(rows, model).filter(F.col("score") < limit).select("row.*")
