"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is its shingles of five words (lower case, split at white space), each weighted by how often it
occurs times ln(1 + documents / document frequency), with the exact frequency of every shingle.
Consistent weighted samples are banded; texts that agree in a band are candidates, and a pair is a link
if the weighted Jaccard similarity of the whole texts is at least the threshold.  Classes are the
connected components of the links.

The frequencies grow with the corpus and are in no task whole.  A chunk of documents asks for those of its
distinct shingles, one entry each, together with how many of its documents hold them; a bucket of shingles
sums up and answers.  So a shingle in every document is one entry per chunk.  A text's frequencies then
travel with it, to sampling and to the comparison of pairs.

Within a bucket pairs are not spread out.  First all texts of a bucket are compared with one pivot,
its oldest text.  Then what is still in different components is compared, except for pairs that
exact bounds rule out: the triangle inequality over the pivot (one minus the similarity is a metric),
and the weight that two texts can have in common.  Shingles that no other unsettled text holds are
not common to any pair, and the others are summed in groups by hash, of which the smaller sums count.
So no link between candidates is lost.

Defined results: a null text counts as empty; texts with the same words are one class, and so are
texts without words; a text of fewer than five words is one shingle; a null id sorts last; rows that
repeat id and text are one row of the result each, of which one is kept; an empty table gives an
empty result; other columns are not read.
"""

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keyed import top_per_key
from .chunks import numbered, pack, pack_planes, pack_sorted, sliced, unpack, unpack_planes, unpack_sorted
from .common import keep_rows, raw_hash, ship, stored, tidied, tidy

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 10, 3   # a pair at the threshold is missed with a chance of 0.1 %
LAST_ID = 2 ** 63 - 1  # stands for a null id
TILE = 1_000_000      # bytes of text that are worked on at a time
USUAL = 1 << 20       # bytes of the texts of a tile, joined, at most
CHUNK = 4_000_000     # bytes of text in a chunk, about
BUCKET = 10_000_000   # bytes of the corpus whose shingles a bucket stands for
FEW = 8               # frequencies up to this one have a table of their own in sampling
GROUPS = 64           # sums of a text's weights that pairs are bounded by
CENTRAL = 4           # texts closest to the pivot that a bucket's other texts are compared with first
SLACK = 1e-6          # of bounds, for rounding

_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32

CHUNKS = "chunk long, doc_id array<long>, r array<long>, sizes binary, texts binary, documents long, size long"
ASKED = "bucket int, chunk long, entries binary, counts binary"
REPLIES = "chunk long, bucket int, counts binary"
SIGNED = "doc_id long, r long, node binary, bands array<long>, df binary"


def _names(schema):
    return [c.split()[0] for c in schema.split(", ")]


def _mixed(x):
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(33))


def _powers(n):
    """Powers of the base and of its inverse; only the usual size is kept."""
    return _usual_powers() if n == USUAL else _all_powers(n)


@lru_cache(maxsize=1)
def _usual_powers():
    return _all_powers(USUAL)


def _all_powers(n):
    base = np.full(n, _BASE, np.uint64)
    back = np.full(n, pow(_BASE, -1, 2 ** 64), np.uint64)
    base[0] = back[0] = 1
    return np.cumprod(base, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)


def words(texts: list):
    """Hashes of the words of all texts, and the text of each word."""
    joined = b" ".join(texts)
    buffer = np.frombuffer(joined, np.uint8)
    if not len(buffer):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    # One size of table serves all tiles but those with a very long text.
    up, back = _powers(max(USUAL, 1 << len(buffer).bit_length()))
    solid = ~_WHITE[buffer]
    edge = np.flatnonzero(np.diff(solid.astype(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum((_LOWER[buffer] + np.uint64(1)) * up[:len(buffer)], out=sums[1:])
    hashes = _mixed((sums[ends] - sums[starts]) * back[starts])
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.concatenate([[0], np.cumsum(sizes[:-1] + 1)])
    return hashes, np.searchsorted(first, starts, "right") - 1


def shingles(hashes, owner, n):
    """Hashes of the shingles, and the text of each; ``n`` texts."""
    if not len(hashes):
        return hashes, owner
    factor = [np.uint64(pow(_BASE, i + 1, 2 ** 64)) for i in range(SHINGLE)]
    counts = np.bincount(owner, minlength=n)
    m = len(hashes) - SHINGLE + 1
    out, at = np.empty(0, np.uint64), np.empty(0, np.int64)
    if m > 0:
        whole = owner[:m] == owner[SHINGLE - 1:]
        total = hashes[:m] * factor[0]
        for i in range(1, SHINGLE):
            total = total + hashes[i:m + i] * factor[i]
        out, at = total[whole], owner[:m][whole]
    few = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(few):
        short = np.isin(owner, few)
        place = np.arange(len(owner)) - np.concatenate([[0], np.cumsum(counts)])[owner]
        part = hashes[short] * np.array(factor, np.uint64)[place[short]]
        sums = np.zeros(n, np.uint64)
        np.add.at(sums, owner[short], part)
        out, at = np.concatenate([out, sums[few]]), np.concatenate([at, few])
    return _mixed(out), at


def counted(texts: list):
    """Distinct shingles sorted by text and hash: (text, hash, times), and the words' hashes and owners."""
    hashes, owner = words(texts)
    marks, at = shingles(hashes, owner, len(texts))
    order = np.lexsort((marks, at))
    marks, at = marks[order], at[order]
    new = np.ones(len(marks), bool)
    new[1:] = (marks[1:] != marks[:-1]) | (at[1:] != at[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(marks)))
    return at[first], marks[first], times, hashes, owner


def tiles(column):
    """Slices of a column of texts, as bytes; a very long text is a tile of its own."""
    return tiled(column.cast(pa.binary()).to_pylist())


def tiled(texts):
    values, held, size = [], 0, 0
    for i, value in enumerate(texts):
        value = value or b""
        if values and size + len(value) > TILE:
            yield held, values
            values, held, size = [], i, 0
        values.append(value)
        size += len(value) + 1
    if values:
        yield held, values


class Weights:
    """Weights of shingles whose frequencies are at hand; others count as ``rare``."""

    def __init__(self, common, rare: float):
        common = sorted(common)
        self.marks = np.array([m for m, _ in common], np.int64).view(np.uint64)
        order = np.argsort(self.marks)
        self.marks = self.marks[order]
        self.idf = np.array([w for _, w in common], np.float64)[order]
        self.rare = rare

    def of(self, marks, times, _=None):
        out = times * self.rare
        if len(self.marks):
            at = np.minimum(np.searchsorted(self.marks, marks), len(self.marks) - 1)
            hit = self.marks[at] == marks
            out[hit] = times[hit] * self.idf[at[hit]]
        return out


class Carried:
    """Weights of shingles whose frequencies travel with their texts."""

    def __init__(self, documents: int):
        self.documents = documents

    def of(self, _, times, held):
        """``held``: the packed frequencies of the texts that the shingles are from, in the order of `counted`."""
        return times * self.idf(np.concatenate([np.empty(0, np.int64), *map(_unpacked, held)]))

    def idf(self, frequencies):
        return np.log1p(self.documents / frequencies)


def _packed(frequencies) -> bytes:
    """One, two, four or eight bytes each, by the largest; the first byte says which."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or frequencies.max(initial=0) < 1 << 8 * w)
    return bytes([width]) + frequencies.astype(f"<u{width}").tobytes()


def _unpacked(data):
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


class Sampler:
    """Improved consistent weighted sampling; the random variates of an element are rows of a table."""

    def __init__(self, documents: int, samples: int, seed=11):
        rng = np.random.default_rng(seed)
        size = 1 << 16
        self.r = rng.gamma(2, 1, size)
        self.c = np.log(rng.gamma(2, 1, size))
        self.b = rng.random(size)
        self.factors = rng.integers(1, 2 ** 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.weights = Carried(documents)
        # What occurs once in its text and in few texts is most of all; its keys are looked up.
        usual = np.log(self.weights.idf(np.arange(1, FEW + 1)))
        self.plain = np.concatenate([self._key(*self._draw(np.arange(size), w)) for w in usual])

    def _draw(self, row, log_weight):
        t = np.floor(log_weight / self.r[row] + self.b[row])
        return t, self.c[row] - self.r[row] * (t - self.b[row]) - self.r[row]

    @staticmethod
    def _key(_, log_a):
        """Order-preserving unsigned numbers in the upper half."""
        bits = log_a.astype(np.float32).view(np.uint32)
        bits = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31))
        return bits.astype(np.uint64) << np.uint64(32)

    def bands(self, at, marks, times, frequencies, n, bands=BANDS):
        """Band keys (n, bands) of ``n`` texts that all have shingles."""
        log_weight = np.log(times * self.weights.idf(frequencies))
        usual = (times == 1) & (frequencies <= FEW)
        odd, table = np.flatnonzero(~usual), np.where(usual, frequencies - 1, 0).astype(np.uint64) << np.uint64(16)
        first = np.searchsorted(at, np.arange(n))
        place = np.arange(len(marks), dtype=np.uint64)
        picked = np.empty((len(self.factors), n), np.uint64)
        for i, factor in enumerate(self.factors):
            row = (marks * factor) >> np.uint64(48)
            keys = self.plain[table + row]
            if len(odd):
                keys[odd] = self._key(*self._draw(row[odd], log_weight[odd]))
            best = np.minimum.reduceat(keys | place, first) & np.uint64(0xFFFFFFFF)
            own = row[best]
            t = np.floor(log_weight[best] / self.r[own] + self.b[own]).astype(np.int64).astype(np.uint64)
            picked[i] = _mixed(marks[best] + _mixed(t + np.uint64(i + 1)))
        per = len(self.factors) // bands
        out = np.zeros((bands, n), np.uint64)
        for i, row in enumerate(picked):
            out[i // per] = _mixed(out[i // per] * _MIX[0] + row + np.uint64(i // per + 1))
        return out.T


def similarity(weights, left: list, right: list, held=None):
    """Weighted Jaccard similarity of pairs of texts; ``held``: their frequencies, if they carry them, those of ``left`` first."""
    n = len(left)
    at, marks, times, *_ = counted(left + right)
    weight = weights.of(marks, times, held)
    total = np.bincount(at, weight, 2 * n)
    side, pair = at >= n, np.where(at >= n, at - n, at)
    order = np.lexsort((side, marks, pair))
    marks, pair, weight = marks[order], pair[order], weight[order]
    same = np.flatnonzero((marks[1:] == marks[:-1]) & (pair[1:] == pair[:-1]))
    both = np.bincount(pair[same], np.minimum(weight[same], weight[same + 1]), n)
    whole = total[:n] + total[n:] - both
    return np.where(whole > 0, both / np.where(whole > 0, whole, 1), 1.0)


def _rows(docs, doc_id, text):
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("doc_id"),
                       raw_hash(text).alias("r"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def shingle_weights(rows: DataFrame, share: float = 0.0) -> Weights:
    """Exact weights of all shingles in at least ``share`` of the documents, in memory: for small tables and checks.

    `classes` does not hold them: there the frequencies travel with the texts.
    """
    def found(batches):
        for batch in batches:
            for _, texts in tiles(batch.column(0)):
                held, n = np.unique(counted(texts)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(held.view(np.int64)), pa.array(n)], ["mark", "n"])

    documents = rows.count()
    exact = rows.select("text").mapInArrow(tidy(found), "mark long, n long").groupBy("mark").agg(F.sum("n").alias("n"))
    return Weights([(r["mark"], float(np.log1p(documents / r["n"]))) for r in exact.filter(F.col("n") >= share * documents).collect()],
                   float(np.log1p(1 / share if share else documents)))


def _chunks(batches):
    for number, batch in numbered(sliced(batches, 2, CHUNK)):
        texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
        sizes = np.array([len(t) for t in texts], np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), *(pa.array([batch.column(c)], pa.list_(pa.int64())) for c in (0, 1)),
             pa.array([pack_planes(sizes)], pa.binary()), pa.array([pack(np.frombuffer(b"".join(texts), np.uint8))], pa.binary()),
             pa.array([len(texts)], pa.int64()), pa.array([int(sizes.sum())], pa.int64())], _names(CHUNKS))


def _counted_tiles(row):
    """What `counted` says of each tile of a chunk, with the number of its texts."""
    ends = np.cumsum(unpack_planes(row["sizes"])).tolist()
    joined = unpack(row["texts"], np.uint8).tobytes()
    for _, texts in tiled([joined[a:b] for a, b in zip([0, *ends[:-1]], ends)]):
        yield len(texts), counted(texts)


def _ask(buckets):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                marks = [np.empty(0, np.uint64), *(found[1] for _, found in _counted_tiles(row))]
                held, n = np.unique(np.concatenate(marks), return_counts=True)
                # Buckets are equal ranges of marks, in order.
                of = ((held >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                edges, out = np.searchsorted(of, np.arange(buckets + 1, dtype=np.uint64)), []
                for bucket in np.flatnonzero(np.diff(edges)).tolist():
                    own = slice(edges[bucket], edges[bucket + 1])
                    out.append((bucket, row["chunk"], pack_sorted(held[own]), pack_planes(n[own])))
                for some in range(0, len(out), 1000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[some:some + 1000]), (
                        pa.int32(), pa.int64(), pa.binary(), pa.binary()))], _names(ASKED))
    return run


@tidied
def _answer(key, asked):
    """The frequencies of one bucket, for each chunk in the order of its entries."""
    own = [unpack_planes(x.as_py()) for x in asked.column("counts")]
    place = np.unique(np.concatenate([unpack_sorted(x.as_py()) for x in asked.column("entries")]), return_inverse=True)[1]
    totals = np.bincount(place, np.concatenate(own)).astype(np.int64)[place]
    counts = [pack_planes(part) for part in np.split(totals, np.cumsum([len(x) for x in own])[:-1])]
    return pa.table([asked.column("chunk"), pa.array([key[0].as_py()] * len(own), pa.int32()), pa.array(counts, pa.binary())],
                    names=_names(REPLIES))


@lru_cache(maxsize=1)
def _sampler(documents, samples):
    return Sampler(documents, samples)


def _signatures(documents, bands, per):
    @tidied
    def run(chunks, replies):
        sampler, (row,) = _sampler(documents, bands * per), chunks.to_pylist()
        tiles_of = list(_counted_tiles(row))
        place = np.unique(np.concatenate([found[1] for _, found in tiles_of]), return_inverse=True)[1]
        parts = sorted(zip(*(replies.column(c).to_pylist() for c in ("bucket", "counts"))))
        answered = np.concatenate([np.empty(0, np.int64), *(unpack_planes(counts) for _, counts in parts)])[place]
        prints, rows, held, done = [], [], [], 0
        for n, (at, marks, times, hashes, owner) in tiles_of:
            own = answered[done:done + len(marks)]
            done += len(marks)
            some = np.unique(at)
            keys = np.zeros((0, bands), np.uint64)
            if len(some):
                keys = sampler.bands(np.searchsorted(some, at), marks, times, own, len(some), bands)
            spans = np.searchsorted(owner, np.arange(n + 1))
            prints += [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() for a, b in zip(spans[:-1], spans[1:])]
            signed = [None] * n
            for i, key in zip(some, keys.view(np.int64)):
                signed[i] = key
            rows += signed
            spans = np.searchsorted(at, np.arange(n + 1))
            held += [_packed(own[a:b]) for a, b in zip(spans[:-1], spans[1:])]
        return pa.table([pa.array(row["doc_id"], pa.int64()), pa.array(row["r"], pa.int64()), pa.array(prints, pa.binary()),
                         pa.array(rows, pa.list_(pa.int64())), pa.array(held, pa.binary())], names=_names(SIGNED))
    return run


def signatures(rows: DataFrame, bands: int, per: int):
    """Per row its node (a hash of its words), band keys and the frequencies of its shingles; and the weights."""
    chunks = stored(rows.mapInArrow(tidy(_chunks), CHUNKS), "near-chunks")
    documents, size = chunks.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("documents", "size"))).first()
    asked = chunks.select("chunk", "sizes", "texts").mapInArrow(tidy(_ask(math.ceil(size / BUCKET) or 1)), ASKED)
    replies = stored(asked.groupBy("bucket").applyInArrow(_answer, REPLIES), "near-frequencies")
    replies = replies.withColumnRenamed("chunk", "asker")
    signed = chunks.groupBy("chunk").cogroup(replies.groupBy("asker")).applyInArrow(_signatures(documents, bands, per), SIGNED)
    return stored(signed, "near-signatures"), Carried(documents)


def _verify(weights):
    def run(batches):
        for batch in batches:
            left, right, held, other = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("left", "right", "left_df", "right_df"))
            out, at = [], 0
            while at < len(left):
                end, size = at, 0
                while end < len(left) and (end == at or size + len(left[end]) + len(right[end]) <= TILE):
                    size += len(left[end]) + len(right[end])
                    end += 1
                out.append(similarity(weights, left[at:end], right[at:end], held[at:end] + other[at:end]))
                at = end
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(
                np.concatenate(out) if out else np.empty(0))], ["a", "b", "s"])
    return run


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node that it is connected with; for the nodes of the links (a, b)."""
    both = stored(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "near-links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("label")), "near-labels")
    while True:
        # The smallest label next door, then the label of one's label.
        heard = both.join(labels.withColumnRenamed("node", "a"), "a").groupBy(F.col("b").alias("node")).agg(
            F.min("label").alias("heard"))
        step = labels.join(heard, "node").select("node", "label", F.least("label", "heard").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("over"))
        new = stored(step.join(jump, "next").select(
            "node", F.least("next", "over").alias("label"), (F.least("next", "over") != F.col("label")).alias("moved")),
            "near-labels")
        labels = new.select("node", "label")
        if new.filter("moved").isEmpty():
            return labels


def _weighed(weights):
    """Every distinct shingle of a text, shortened to 32 bits, with its weight."""
    def run(batches):
        for batch in batches:
            frequencies = batch.column(2).to_pylist()
            for held, texts in tiles(batch.column(1)):
                at, marks, times, *_ = counted(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(held + at)), pa.array((marks >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                     pa.array(weights.of(marks, times, frequencies[held:held + len(texts)]))], ["id", "mark", "w"])
    return run


def weight_bounds(texts: DataFrame, weights) -> DataFrame:
    """node, w (weight of its text), shared (the weight that other ``texts`` can hold too, by group).

    Shingles that meet in their 32 bits count as held by both, which makes ``shared`` larger: it
    stays an upper bound.
    """
    known = texts.select("node", F.xxhash64("node").alias("id"))
    marks = texts.select(F.xxhash64("node").alias("id"), "text", "df").mapInArrow(tidy(_weighed(weights)), "id long, mark int, w double")
    group = F.pmod(F.col("mark"), F.lit(GROUPS)).alias("g")
    total = marks.groupBy("id", group).agg(F.sum("w").alias("w"))
    own = marks.groupBy("mark").agg(F.count("*").alias("n"), F.sum("w").alias("own"), F.min("id").alias("id"))
    own = own.filter("n = 1").groupBy("id", group).agg(F.sum("own").alias("own"))
    # Nodes whose ids meet keep all their weight.
    lone = known.groupBy("id").agg(F.count("*").alias("twins"))
    sums = total.join(own, ["id", "g"], "left").join(lone, "id").withColumn(
        "own", F.when(F.col("twins") == 1, F.coalesce("own", F.lit(0.0))).otherwise(0.0))
    held = sums.groupBy("id").agg(F.sum("w").alias("w"), F.map_from_entries(F.collect_list(
        F.struct("g", F.col("w") - F.col("own")))).alias("by"))
    shared = F.transform(F.sequence(F.lit(0), F.lit(GROUPS - 1)), lambda g: F.coalesce(F.try_element_at("by", g), F.lit(0.0)))
    return known.join(held.select("id", "w", shared.alias("shared")), "id").drop("id")


def links(nodes: DataFrame, texts: DataFrame, weights, threshold: float = THRESHOLD):
    """Links (a, b, s) between nodes that share a band, and the components of the linked nodes.

    ``nodes`` has node, age (the oldest of a bucket is its pivot) and bands; ``texts`` node, text and, with `Carried`
    weights, df (the packed frequencies of its shingles).
    """
    if "df" not in texts.columns:
        texts = texts.withColumn("df", F.lit(None).cast("binary"))
    reach = 1 - threshold + SLACK
    members = nodes.filter(F.size("bands") > 0).select("node", "age", F.explode("bands").alias("key"))
    firsts = members.groupBy("key").agg(F.min(F.struct("age", "node")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    members = stored(members.drop("age").join(firsts.select("key", F.col("first.node").alias("pivot")), "key"), "near-members")
    texts = stored(texts.join(members.select("node").distinct(), "node"), "near-texts")

    def verified(pairs):
        own = lambda side, c: texts.select(F.col("node").alias(side), F.col("text").alias(c), F.col("df").alias(f"{c}_df"))
        rows = pairs.join(own("b", "right"), "b").join(own("a", "left"), "a").select("a", "b", "left", "right", "left_df", "right_df")
        return stored(rows.mapInArrow(tidy(_verify(weights)), "a binary, b binary, s double"), "near-pairs")

    pair = (F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
    seen = verified(members.filter("node <> pivot").select(*pair).distinct())
    near = F.col("s") >= threshold
    labels = components(seen.filter(near))

    # What is not settled: buckets with several components.
    to_pivot = seen.select(F.col("a"), F.col("b"), (1 - F.col("s")).alias("d"))
    now = members.select("key", "node", "pivot", *pair).join(to_pivot, ["a", "b"], "left").drop("a", "b")
    now = unsettled(now.withColumn("d", F.coalesce("d", F.lit(0.0))), labels)
    if now.isEmpty():
        return seen.filter(near), labels
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda x, y: x + y)
    bounds = weight_bounds(texts.join(now.select("node").distinct(), "node"), weights)
    bounds = stored(bounds.withColumn("most", total(F.col("shared"))), "near-bounds")
    # A text that has more than its share to itself is like no other.
    now = stored(now.join(bounds.filter(F.col("most") >= F.col("w") * (threshold - SLACK)), "node"), "near-open")

    def compared(now, others):
        """New pairs of texts outside of their pivot's component with ``others``, if no bound rules them out."""
        home = now.filter("node = pivot").select("key", F.col("label").alias("home"))
        away = now.join(home, "key", "left").filter(~F.col("label").eqNullSafe(F.col("home"))).select(
            "key", *[F.col(c).alias(f"_{c}") for c in ("node", "label", "d", "w", "most", "shared")])

        def enough(common):
            return common >= (threshold - SLACK) * (F.col("w") + F.col("_w") - common)
        pairs = others.filter("node <> pivot").join(away, "key").filter(
            (F.col("label") != F.col("_label")) & (F.abs(F.col("d") - F.col("_d")) <= reach)
            & enough(F.least("most", "_most"))
            & enough(total(F.zip_with("shared", "_shared", lambda x, y: F.least(x, y)))))
        pairs = pairs.select(F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")).distinct()
        return verified(pairs.join(seen.select("a", "b"), ["a", "b"], "left_anti"))

    # First with the texts closest to the pivot, which a class gathers around; then with all.
    for few in (True, False):
        others = top_per_key(now.filter("node <> pivot"), ["key"], [F.col("d"), F.col("node")], CENTRAL, "_n") if few else now
        more = compared(now, others)
        seen = seen.unionAll(more)
        if not more.filter(near).isEmpty():
            labels = components(seen.filter(near))
        now = unsettled(now.drop("label"), labels)
    return seen.filter(near), labels


def unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members, with their labels, of buckets that hold several components and more than a pair."""
    now = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = now.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                   F.count("*").alias("n")).filter("low <> high and n > 2").select("key")
    return stored(now.join(mixed, "key"), "near-open")


def classes(docs: DataFrame, threshold=THRESHOLD, bands=BANDS, per_band=ROWS, doc_id="doc_id", text="text") -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its class), class_size, kept, r."""
    ship(docs.sparkSession)
    rows = _rows(docs, doc_id, text)
    signed, weights = signatures(rows, bands, per_band)
    # Texts with the same words are one node; rows that repeat id and text are one row with a count.
    own = signed.groupBy("node", "doc_id", "r").agg(F.count("*").alias("copies"))
    nodes = stored(signed.groupBy("node").agg(F.min(F.struct("doc_id", "r")).alias("at"), F.first("bands").alias("bands"),
                                              F.first("df").alias("df"), F.count("*").alias("size")), "near-nodes")
    where = nodes.filter(F.size("bands") > 0).select("at.doc_id", "at.r", "node", "df")
    texts = rows.join(where, ["doc_id", "r"]).dropDuplicates(["node"]).select("node", "text", "df")
    _, labels = links(nodes.select("node", F.col("at").alias("age"), "bands"), texts, weights, threshold)
    grouped = nodes.select("node", "at", "size").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    heads = grouped.groupBy("label").agg(F.min("at").alias("head"), F.sum("size").alias("class_size"))
    found = own.join(grouped.select("node", "label").join(heads, "label").drop("label"), "node")
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    kept = (F.col("doc_id") == F.col("head.doc_id")) & (F.col("r") == F.col("head.r")) & (F.col("copy") == 1)
    return found.select(F.nullif("doc_id", F.lit(LAST_ID)).alias("doc_id"),
                        F.nullif(F.col("head.doc_id"), F.lit(LAST_ID)).alias("class_id"),
                        F.col("class_size").cast("long").alias("class_size"), kept.alias("kept"), "r")


def keep_one(docs: DataFrame, threshold=THRESHOLD, doc_id="doc_id", text="text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with all their columns."""
    return keep_rows(docs, classes(docs, threshold, doc_id=doc_id, text=text).filter("kept"), doc_id, text)
