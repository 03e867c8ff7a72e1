"""Scores by an n-gram model that is a weighted backoff automaton.

States are the word sequences seen in training, up to ``order - 1`` words; an arc by a word leads to the longest seen
sequence that ends with it and carries the word's log-probability.  Where a state has no arc for a word,
its failure arc leads to the state without the oldest word and costs the state's backoff weight.  A text
is one traversal from left to right, which carries the state and sums up weights.

Smoothing: p(w | h) = L * c(hw) / c(h) + (1 - L) * p(w | shorter h).  L depends on the order and on the
power of two below c(h); it is one minus the share of training tokens whose n-gram occurs once, which is what
would be unseen if the token were left out.  At the root, seen words lose D = (n1 + 1) / (n1 + 2 n2 + 2) of an
occurrence each (n1, n2: words seen once, twice), which is the probability of an unseen word.

The model grows with the corpus and is in no task whole.  A chunk of documents asks for the counts of its distinct
n-grams, one entry each, together with what it has itself of them in training; a bucket of n-grams sums
up and answers.  So a chunk gets the part of the automaton that its texts can reach, and an n-gram
in every document is one entry per chunk.  Words are compared as text, longer n-grams by a hash that has ``SPARE`` bits
more than it takes to number the corpus's tokens: about one n-gram in a million shares its count with another.

Defined results: a null text is empty, so it is the end token alone; repeated rows are documents of their own; a
null id is kept; without any training text the model gives each token probability one, as the base does; an empty
table gives an empty result; other columns are not read.  A text of any length is one traversal.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .chunks import numbered, pack, pack_planes, pack_sorted, sliced, unpack, unpack_planes, unpack_sorted
from .common import ship, stored, tidied, tidy

ORDER = 3
CHUNK = 2_000_000     # bytes of text in a chunk, about
BUCKET = 1_000_000    # tokens of the corpus that a bucket of n-grams stands for
TILE = 15_000         # tokens of the texts for which an automaton is built at a time, about
SPARE = 20            # bits of an n-gram's hash beyond those that number all tokens
BINS = 64             # classes of context counts, one for each power of two
END = b""             # no word is empty
START = np.uint64(0x243F6A8885A308D3)

CHUNKS = ("chunk long, doc_id array<long>, train array<boolean>, sizes binary, tokens binary, words binary, "
          "n long, train_tokens long, train_docs long")
ASKED = "kind int, bucket int, chunk long, entries binary, counts binary"
REPLIES = "chunk long, kind int, bucket int, counts binary, types long, once long, twice long"
JOINED = "doc_id array<long>, train array<boolean>, sizes binary, tokens binary, words binary, counts binary"
RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")


def _names(schema):
    return [c.split()[0] for c in schema.split(", ")]


def _chunks(batches):
    for number, batch in numbered(sliced(batches, 1, CHUNK)):
        texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
        codes, known, owner, _, _ = words.split(texts, words.WHITE)
        sizes = np.bincount(owner, minlength=len(texts)) + 1
        distinct = [*known.to_pylist(), END]
        # Words are numbered by how often they occur, so that most numbers are small.
        order = np.argsort(-np.append(np.bincount(codes, minlength=len(known)), len(texts)), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        tokens = np.full(sizes.sum(), rank[-1], np.int64)
        tokens[np.arange(len(codes)) + owner] = rank[codes]
        train = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([batch.column(0)], pa.list_(pa.int64())),
             pa.array([train], pa.list_(pa.bool_())), pa.array([pack_planes(sizes)], pa.binary()),
             pa.array([pack_planes(tokens)], pa.binary()), pa.array([pack(np.frombuffer(
                 b"\n".join(distinct[i] for i in order), np.uint8))], pa.binary()),
             pa.array([len(tokens)], pa.int64()), pa.array([int(sizes[train].sum())], pa.int64()),
             pa.array([int(train.sum())], pa.int64())], _names(CHUNKS))


class Chunk:
    """The tokens of a chunk, and its distinct n-grams by order, sorted by key."""

    def __init__(self, row, order, bits):
        self.train, self.sizes = np.array(row["train"], bool), unpack_planes(row["sizes"])
        self.tokens = unpack_planes(row["tokens"])
        self.words = unpack(row["words"], np.uint8).tobytes().split(b"\n")
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes
        place = np.arange(len(self.tokens)) - self.starts[self.owner]
        hashes = words.hashes(self.words)
        own = hashes[self.tokens]
        self.sorted = np.argsort(hashes, kind="stable")
        # Per order: keys of the distinct n-grams, and the place of each token's n-gram there (-1: it has none).
        self.keys, self.index, key = [hashes], [self.tokens], own
        for n in range(2, order + 1):
            before = np.concatenate([[START], key[:-1]])
            if n == 2:
                before[self.starts] = START
            key = words.chained(before, own)
            has = place >= n - 2
            distinct, at = np.unique(key[has] >> np.uint64(64 - bits), return_inverse=True)
            index = np.full(len(key), -1)
            index[has] = at
            self.keys.append(distinct)
            self.index.append(index)

        # Per token the place of its n-gram's context among the n-grams of n - 1 words; -1 is a text's beginning.
        self.contexts = [None, None]
        for index in self.index[:-1]:
            before = np.concatenate([[-1], index[:-1]])
            before[self.starts] = -1
            self.contexts.append(before)


def _rows(batches):
    for batch in batches:
        yield from batch.to_pylist()


def _bucket(keys, buckets, bits):
    """Equal ranges of keys, in order."""
    return ((keys >> np.uint64(bits - 32)) * np.uint64(buckets)) >> np.uint64(32)


def _ask(order, bits, buckets):
    def run(batches):
        for row in _rows(batches):
            chunk, out = Chunk(row, order, bits), []
            trained = chunk.train[chunk.owner]
            for kind, (keys, index) in enumerate(zip(chunk.keys, chunk.index)):
                counts, of = np.bincount(index[trained & (index >= 0)], minlength=len(keys)), chunk.words
                if not kind:
                    keys, counts, of = keys[chunk.sorted], counts[chunk.sorted], [of[i] for i in chunk.sorted]
                edges = np.searchsorted(_bucket(keys, buckets, bits if kind else 64), np.arange(buckets + 1, dtype=np.uint64))
                for bucket in np.flatnonzero(np.diff(edges)).tolist():
                    own = slice(edges[bucket], edges[bucket + 1])
                    entries = pack_sorted(keys[own]) if kind else pack(np.frombuffer(b"\n".join(of[own]), np.uint8))
                    out.append((kind, bucket, row["chunk"], entries, pack_planes(counts[own])))
            for some in range(0, len(out), 1000):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[some:some + 1000]), (
                    pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))], _names(ASKED))
    return run


@tidied
def _answer(key, asked):
    """The sums of one bucket, for each chunk in the order of its entries."""
    kind, bucket = (k.as_py() for k in key)
    own = [unpack_planes(x.as_py()) for x in asked.column("counts")]
    if kind:
        keys = np.concatenate([unpack_sorted(x.as_py()) for x in asked.column("entries")])
        place = np.unique(keys, return_inverse=True)[1]
    else:
        texts = [w for x in asked.column("entries") for w in unpack(x.as_py(), np.uint8).tobytes().split(b"\n")]
        place = pa.array(texts, pa.binary()).dictionary_encode().indices.to_numpy()
    totals = np.bincount(place, np.concatenate(own)).astype(np.int64)
    ends = np.cumsum([len(x) for x in own])
    counts = [pack_planes(part) for part in np.split(totals[place], ends[:-1])]
    once = lambda *about: pa.array([sum(np.count_nonzero(x) for x in about)] + [0] * (len(own) - 1), pa.int64())
    return pa.table([asked.column("chunk"), pa.array([kind] * len(own), pa.int32()), pa.array([bucket] * len(own), pa.int32()),
                     pa.array(counts, pa.binary()), once(totals > 0), once(totals == 1), once(totals == 2)],
                    names=_names(REPLIES))


@tidied
def _join(chunks, replies):
    """A chunk with the corpus counts of its n-grams, orders one behind the other."""
    parts = sorted(zip(*(replies.column(c).to_pylist() for c in ("kind", "bucket", "counts"))))
    counts = pack_planes(np.concatenate([unpack_planes(x) for *_, x in parts]))
    return chunks.select(_names(JOINED)[:-1]).append_column("counts", pa.array([counts], pa.binary()))


def _counted(row, order, bits):
    chunk = Chunk(row, order, bits)
    ends = np.cumsum([len(k) for k in chunk.keys])
    counts = np.split(unpack_planes(row["counts"]), ends[:-1])
    of_words = np.empty_like(counts[0])
    of_words[chunk.sorted] = counts[0]
    return chunk, [of_words, *counts[1:]]


def _context_counts(chunk, counts, n, docs):
    return np.append(counts[n - 2], docs)[chunk.contexts[n]]


def _bin(counts):
    return np.frexp(np.maximum(counts, 1).astype(float))[1] - 1


def _left_out(order, bits, docs):
    """Per order and class of context: training tokens, and those whose n-gram occurs once."""
    def run(batches):
        total = np.zeros((2, order + 1, BINS), np.int64)
        for row in _rows(batches):
            chunk, counts = _counted(row, order, bits)
            trained = chunk.train[chunk.owner]
            for n in range(2, order + 1):
                some = trained & (chunk.index[n - 1] >= 0)
                bins = _bin(_context_counts(chunk, counts, n, docs)[some])
                single = counts[n - 1][chunk.index[n - 1][some]] == 1
                total[0, n] += np.bincount(bins, minlength=BINS)
                total[1, n] += np.bincount(bins[single], minlength=BINS)
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0].ravel()[at]), pa.array(total[1].ravel()[at])],
                                         ["at", "tokens", "single"])
    return run


def _firsts(index, some=None):
    """Places, in order, where a number of ``index`` (at ``some`` places) stands for the first time; without sorting."""
    at = np.arange(len(index)) if some is None else np.flatnonzero(some)
    own = index[at]
    first = np.empty(int(own.max(initial=-1)) + 1, np.int64)   # only entries that are set are read
    first[own[::-1]] = at[::-1]
    return at[first[own] == at]


class Automaton:
    """The part of the automaton that some texts of a chunk can reach: those of the tokens from ``a`` to ``b``.

    ``counts`` of each order end with the number of documents, which is the count of a text's beginning.
    """

    def __init__(self, chunk, counts, model, a, b):
        first, order, tokens = counts[0], len(counts), chunk.tokens[a:b]
        self.width = len(first) - 1
        known = first[tokens] > 0
        p = np.where(known, np.maximum(first[tokens] - model["loss"], 0) / max(model["tokens"], 1), model["unseen"])
        # States: the root, the beginning of a text, then the seen n-grams of each order but the last.
        states, index, shorter = 2, tokens, np.zeros(len(tokens), int)
        arcs, to, weight, fail, cost = [], [], [], [], []
        place = self._numbered(index, known, states) if order > 1 else shorter
        for n in range(1, order + 1):
            # So far per token: its n-gram (``index``), whether it was seen, its probability ``p``, its context's state.
            one = _firsts(index, known if n > 1 else None)
            arcs.append(shorter[one] * self.width + tokens[one])
            weight.append(np.log10(p[one]))
            to.append(place[one])
            if n == order:
                break
            states = max(states, int(place.max(initial=0)) + 1)
            index = chunk.index[n][a:b]
            context = chunk.contexts[n + 1][a:b]
            held = np.where(index >= 0, counts[n - 1][context], 0)
            seen = held > 0
            before = np.concatenate([[0], place[:-1]])
            state = np.where(seen, np.where(context < 0, 1, before), shorter)
            share = model["share"][n + 1][_bin(held)]
            at = _firsts(state, seen)
            fail.append(np.stack([state[at], shorter[at]]))
            cost.append(np.log10(1 - share[at]))
            have = np.where(index >= 0, counts[n][index], 0)
            p = np.where(seen, share * have / np.maximum(held, 1) + (1 - share) * p, p)
            known, shorter = have > 0, state
            if n + 1 < order:   # an n-gram of the last order leads to the state of its last words
                place = self._numbered(index, known, states)
        # A state is told by its first key; the word is added to it.
        self.arcs = dict(zip(np.concatenate(arcs).tolist(), range(sum(map(len, arcs)))))
        self.to, self.weight = (np.concatenate(to) * self.width).tolist(), np.concatenate(weight).tolist()
        pairs = np.concatenate([*fail, np.empty((2, 0), int)], 1)
        self.fail, self.cost = np.zeros(states, np.int64), np.zeros(states)
        self.fail[pairs[0]] = pairs[1] * self.width
        self.cost[pairs[0]] = np.concatenate([*cost, np.empty(0)])
        self.fail, self.cost = self.fail.tolist(), self.cost.tolist()
        self.start = self.width if order > 1 else 0

    @staticmethod
    def _numbered(index, known, states):
        """Per token the state of its n-gram: numbers from ``states`` on for seen ones, the root for others."""
        out, one = np.zeros(len(index), np.int64), _firsts(index, known)
        of = np.empty(int(index.max(initial=-1)) + 1, np.int64)   # only entries of known n-grams are set and read
        of[index[one]] = states + np.arange(len(one))
        out[known] = of[index[known]]
        return out

    def traverse(self, tokens) -> float:
        state, total = self.start, 0.0
        arc_of, fail, cost, to, weight, width = self.arcs.get, self.fail, self.cost, self.to, self.weight, self.width
        for word in tokens:
            arc = arc_of(state + word)
            while arc is None:
                total += cost[state // width]
                state = fail[state // width]
                arc = arc_of(state + word)
            total += weight[arc]
            state = to[arc]
        return total


def _score(order, model):
    def run(batches):
        bits = model["bits"]
        for row in _rows(batches):
            chunk, counts = _counted(row, order, bits)
            starts, ends = chunk.starts, np.cumsum(chunk.sizes)
            closed = [np.append(c, model["docs"]) for c in counts]
            scores, first = [], 0
            while first < len(ends):   # some texts at a time
                last = max(first + 1, int(np.searchsorted(ends, starts[first] + TILE, "right")))
                a, b = int(starts[first]), int(ends[last - 1])
                own, tokens = Automaton(chunk, closed, model, a, b), chunk.tokens[a:b].tolist()
                scores += [own.traverse(tokens[x - a:y - a]) for x, y in zip(starts[first:last].tolist(), ends[first:last].tolist())]
                first = last
            c = counts[0][chunk.tokens]
            base = np.log10((c + 1) / (model["tokens"] + model["types"] + 1))
            per_text = lambda values: np.add.reduceat(values, chunk.starts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_id"], pa.int64()), pa.array(~chunk.train), pa.array(chunk.sizes),
                 pa.array(per_text((c > 0).astype(np.int64))), pa.array([model["tokens"]] * len(scores), pa.int64()),
                 pa.array(per_text(base)), pa.array(scores, pa.float64())], _names(RESULT))
    return run


def trained(docs: DataFrame, train: Column, doc_id="doc_id", text="text", order=ORDER):
    """The chunks of ``docs`` with the counts of their n-grams in the rows where ``train`` is true, and the model's totals.

    The totals are a few hundred numbers whatever the corpus holds; the n-grams stay in files.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       F.coalesce(train, F.lit(False)).alias("train"))
    chunks = stored(rows.mapInArrow(tidy(_chunks), CHUNKS), "lm-chunks")
    n, tokens, docs_read = chunks.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "train_tokens", "train_docs"))).first()
    buckets, bits = math.ceil(n / BUCKET) or 1, min(64, max(48, n.bit_length() + SPARE))
    asked = chunks.select("chunk", "train", "sizes", "tokens", "words").mapInArrow(tidy(_ask(order, bits, buckets)), ASKED)
    replies = stored(asked.groupBy("kind", "bucket").applyInArrow(_answer, REPLIES), "lm-counts")
    types, once, twice = replies.filter("kind = 0").agg(
        *(F.coalesce(F.sum(c), F.lit(0)) for c in ("types", "once", "twice"))).first()
    replies = replies.select(F.col("chunk").alias("asker"), "kind", "bucket", "counts")
    joined = stored(chunks.groupBy("chunk").cogroup(replies.groupBy("asker")).applyInArrow(_join, JOINED), "lm-joined")
    left_out = joined.mapInArrow(tidy(_left_out(order, bits, docs_read)), "at long, tokens long, single long").groupBy("at").agg(
        F.sum("tokens").alias("tokens"), F.sum("single").alias("single")).collect()
    share = np.full(((order + 1) * BINS), 0.5)
    for row in left_out:
        share[row.at] = 1 - (row.single + 0.5) / (row.tokens + 1)
    loss = (once + 1) / (once + 2 * twice + 2)
    return joined, {"tokens": tokens, "types": types, "docs": docs_read, "loss": loss, "bits": bits, "share": share.reshape(-1, BINS),
                    "unseen": loss * types / tokens if tokens else 1.0}


def score(docs: DataFrame, train: Column, doc_id="doc_id", text="text", order=ORDER) -> DataFrame:
    """One row per document of ``docs``, scored by the model of its rows where ``train`` is true (null: they are not)."""
    joined, model = trained(docs, train, doc_id, text, order)
    return joined.mapInArrow(tidy(_score(order, model)), RESULT)
