"""Phrases whose words belong together, by Toivonen's sampling method.

A sample of the documents proposes phrases: those that are frequent there at a lowered bound.  A full pass
then counts every phrase whose words without the last and without the first are both proposed: that is the proposed
phrases and their negative border (the smallest ones that were not proposed).  A phrase of the border that turns out to be
frequent is a failure of the sample.  A frequent phrase that this pass has not counted holds a failure, so the next pass
counts, besides the phrases found to be frequent, whatever holds a failure; with that the frequent phrases are closed,
whatever the sample was, since all parts of a frequent phrase are frequent.

The first full pass counts hashes, a few bytes each in shuffles: sums of hashes are never too small.  The second
counts the phrases themselves, exactly, of which by then only frequent ones and a few others are left.  Between
the passes sets of phrases go to the tasks as bitmaps of hashes, of fixed size.  Phrases that share a hash or a bit make
a task count more than it must; none is lost.

Defined results: a null text is empty; a null language is ``und``; repeated rows are documents of their own; an empty
table gives an empty result; other columns are not read, but for the id, by which the sample is drawn.  Long texts
are cut at marks; what has no mark within is worked on whole, in about 100 bytes of memory per byte.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keyed import top_per_key
from . import words
from .chunks import pack, pack_sorted, sliced, unpack, unpack_sorted
from .common import ship, stored, tidy

LONGEST = 5
LEAST = 100           # occurrences of a frequent phrase
KEEP = 2000           # phrases of a language that are reported
ABSORB = 100          # per cent of a phrase's occurrences in a longer one that make it a mere part
SAMPLE = 8            # one of so many documents is in the sample
LOWERED = 0.5         # the sample's bound, as a share of what is to be expected there
BITS = 1 << 25        # of the bitmap of proposed phrases
BITMAP_ROW = 32_768   # bits of one bitmap of Spark's bitmap functions
CHUNK = 2_000_000     # bytes of text that are worked on at a time, about
HELD = 3_000_000      # counts that a task gathers before it sends them
BUCKET = 4_000_000    # bytes of text whose phrases' hashes one bucket stands for, about
SPARE = 12            # bits of a hash beyond those that number the corpus's words
UNKNOWN = "und"

BREAKS = words.byte_set(b".,;:!?", range(0x0A, 0x0E))
BLANKS = words.byte_set(b" \t")
GAPS = BREAKS | BLANKS

COUNTS = "lang string, size int, phrase string, n long"
HASHES = "bucket int, size int, keys binary, counts binary"
PARTS = "bucket int, rows binary"


class Bitmap:
    """A set of hashes; some others share their bits."""

    def __init__(self, space: int, rows=()):
        self.bits = np.zeros(space // 8, np.uint8)
        for bucket, bitmap in rows:
            first = (bucket - 1) * (BITMAP_ROW // 8)
            self.bits[first:first + len(bitmap)] |= np.frombuffer(bitmap, np.uint8)

    def __getstate__(self):
        return pack(self.bits)

    def __setstate__(self, state):
        self.bits = unpack(state, np.uint8).copy()

    def has(self, keys):
        place = keys >> np.uint64(65 - (8 * len(self.bits)).bit_length())
        return (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def __or__(self, other):
        return self._with(self.bits | other.bits)

    def __sub__(self, other):
        return self._with(self.bits & ~other.bits)

    @staticmethod
    def _with(bits):
        out = Bitmap(8)
        out.bits = bits
        return out


def _bitmap(slots: DataFrame, space: int) -> Bitmap:
    """The bitmap of ``slots``, places in it; at most ``space`` bits reach the driver.  Spark's bitmaps count from one."""
    place = F.col("slot") + 1
    rows = slots.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    return Bitmap(space, ((r.bucket, bytes(r.bits)) for r in rows))


class Phrases:
    """The words of some texts, and where each begins."""

    def __init__(self, texts: list, langs: list):
        self.codes, self.known, owner, starts, buffer = words.split(texts, GAPS)
        # A phrase stays between two marks; texts are joined by one.
        self.piece = np.cumsum(BREAKS[buffer], dtype=np.int32)[starts]
        spoken = pa.array(langs, pa.string()).dictionary_encode()
        self.names, self.lang = spoken.dictionary, spoken.indices.to_numpy()[owner].astype(np.int64)
        self.hashes = words.hashes(self.known.to_pylist())
        self.of_names = words.hashes([x.encode() for x in self.names.to_pylist()])

    def walk(self, longest: int, proposed: Bitmap, failed=None):
        """By size: places, hashes and which are good, of all phrases whose two parts are good.

        Good are proposed phrases, and those that hold a failed one.
        """
        place = np.arange(len(self.codes))
        key = words.chained(self.of_names[self.lang], self.hashes[self.codes])
        hot = np.zeros(len(place), bool)
        for size in range(1, longest + 1):
            if failed is not None:
                hot = hot | failed.has(key)
            good = proposed.has(key) | hot
            yield size, place, key, good
            if size == longest or len(place) < 2:
                return
            at = np.flatnonzero(good[1:] & good[:-1] & (np.diff(place) == 1))
            at = at[self.piece[place[at]] == self.piece[np.minimum(place[at] + size, len(self.piece) - 1)]]
            key = words.chained(key[at], self.hashes[self.codes[np.minimum(place[at] + size, len(self.codes) - 1)]])
            place, hot = place[at], hot[at] | hot[at + 1]

    def counted(self, longest: int, proposed: Bitmap, failed: Bitmap):
        """Counts of the good phrases, as a table, and the words of each language as phrases of size 0."""
        n = np.bincount(self.lang, minlength=len(self.names))
        yield _table(self.names, 0, pa.array([""] * len(n), pa.binary()), n, np.zeros(len(n), np.uint64))
        before = None   # places of good phrases of one word less, and numbers of these phrases
        for size, place, key, good in self.walk(longest, proposed, failed):
            place, key = place[good], key[good]
            if not len(place):
                return
            if before is None:
                ids = self.lang[place] * len(self.known) + self.codes[place]
            else:
                head = np.searchsorted(before[0], place)
                ids = before[1][head] * before[2] + before[1][head + 1]
            distinct, first, again, n = np.unique(ids, return_index=True, return_inverse=True, return_counts=True)
            at = place[first]
            parts = [self.known.take(pa.array(self.codes[at + i])) for i in range(size)]
            yield _table(self.names.take(pa.array(self.lang[at])), size, pc.binary_join_element_wise(*parts, b" "), n,
                         key[first])
            before = place, again, len(distinct)


def _table(names, size, phrases, n, keys):
    return pa.table([names, pa.array(np.full(len(n), size, np.int32)), phrases.cast(pa.string()), pa.array(n, pa.int64()),
                     pa.array(keys)], names=["lang", "size", "phrase", "n", "key"])


def _tiles(text: bytes):
    """A long text, cut at marks."""
    while len(text) > CHUNK:
        cut = 1 + max(text.rfind(bytes([mark]), 0, CHUNK) for mark in np.flatnonzero(BREAKS).tolist())
        if not cut:
            found = [x for mark in np.flatnonzero(BREAKS).tolist() if (x := text.find(bytes([mark]), CHUNK)) >= 0]
            if not found:
                break
            cut = 1 + min(found)
        yield text[:cut]
        text = text[cut:]
    yield text


def _work(batches):
    """Texts and their languages, some at a time."""
    for batch in sliced(batches, 1, CHUNK):
        texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
        langs = batch.column(0).to_pylist()
        for part in [texts] if len(texts) > 1 else ([tile] for tile in _tiles(texts[0])):
            own = Phrases(part, langs)
            if len(own.codes):
                yield own


def _hash_counts(shortest, longest, proposed, bits, buckets):
    """Counts of the hashes of phrases whose parts are proposed, packed by bucket of hashes."""
    def send(held):
        for size, parts in held.items():
            keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([n for _, n in parts])).astype(np.int64)
            edges = np.searchsorted(keys >> np.uint64(bits - 32), np.ceil(np.arange(buckets + 1) * (2 ** 32 / buckets)).astype(np.uint64))
            rows = [(b, size, pack_sorted(keys[edges[b]:edges[b + 1]]), pack(counts[edges[b]:edges[b + 1]]))
                    for b in np.flatnonzero(np.diff(edges)).tolist()]
            for some in range(0, len(rows), 1000):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[some:some + 1000]), (
                    pa.int32(), pa.int32(), pa.binary(), pa.binary()))], [c.split()[0] for c in HASHES.split(", ")])

    def run(batches):
        held, n = {}, 0
        for own in _work(batches):
            for size, _, key, _ in own.walk(longest, proposed):
                if size < shortest:
                    continue
                part = np.unique(key >> np.uint64(64 - bits), return_counts=True)
                held.setdefault(size, []).append(part)
                n += len(part[0])
            if n >= HELD:
                yield from send(held)
                held, n = {}, 0
        yield from send(held)
    return run


def _frequent_hashes(least, bits, space):
    """Places in the bitmap of the hashes of a bucket that occur often enough."""
    def merged(key, rows):
        keys, place = np.unique(np.concatenate([unpack_sorted(x.as_py()) for x in rows.column("keys")]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([unpack(x.as_py(), np.int64) for x in rows.column("counts")]))
        slots = np.unique(keys[counts >= least] >> np.uint64(bits + 1 - space.bit_length())).astype(np.int64)
        return pa.table([pa.array(np.full(len(slots), key[1].as_py(), np.int32)), pa.array(slots)], names=["size", "slot"])
    return merged


def _hashes(docs: DataFrame, least: int, sizes: tuple, proposed: Bitmap, bits: int, buckets: int, label: str) -> Bitmap:
    """The hashes that occur ``least`` times, of all phrases of these sizes whose parts are proposed."""
    space = 8 * len(proposed.bits)
    counts = docs.mapInArrow(tidy(_hash_counts(*sizes, proposed, bits, buckets)), HASHES)
    slots = counts.groupBy("bucket", "size").applyInArrow(_frequent_hashes(least, bits, space), "size int, slot long")
    return _bitmap(stored(slots, label), space)


def _phrase_counts(longest, proposed, failed, buckets):
    """Counts of the good phrases, packed by bucket of their hashes."""
    def send(tables):
        table = pa.concat_tables(tables).group_by(["lang", "size", "phrase", "key"]).aggregate([("n", "sum")])
        bucket = ((table.column("key").to_numpy() >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        table, edges = table.take(pa.array(np.argsort(bucket, kind="stable"))), np.cumsum(np.bincount(bucket, minlength=buckets))
        for b in np.flatnonzero(np.diff(edges, prepend=0)).tolist():
            own = table.slice(edges[b - 1] if b else 0, edges[b] - (edges[b - 1] if b else 0)).drop_columns("key")
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, own.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(own.combine_chunks())
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([out.getvalue().to_pybytes()], pa.binary())],
                                             ["bucket", "rows"])

    def run(batches):
        held, n = [], 0
        for own in _work(batches):
            for table in own.counted(longest, proposed, failed):
                held.append(table)
                n += table.num_rows
            if n >= HELD // 4:
                yield from send(held)
                held, n = [], 0
        if held:
            yield from send(held)
    return run


def _frequent_phrases(least):
    """The phrases of a bucket that occur often enough, and the words of each language."""
    def merged(key, parts):
        table = pa.concat_tables(pa.ipc.open_stream(x.as_buffer()).read_all() for x in parts.column("rows"))
        table = table.group_by(["lang", "size", "phrase"]).aggregate([("n_sum", "sum")])
        table = table.rename_columns(["lang", "size", "phrase", "n"])
        return table.filter(pc.or_(pc.greater_equal(table.column("n"), least), pc.equal(table.column("size"), 0)))
    return merged


def frequent(docs: DataFrame, least=LEAST, longest=LONGEST, doc_id="doc_id", text="text", lang="lang",
             sample=SAMPLE, lowered=LOWERED, space=BITS) -> DataFrame:
    """Phrases of up to ``longest`` words with their occurrences ``n``, at least ``least`` of them, by language.

    Rows of size 0 hold the number of all words of a language.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"),
                       F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(sample)).alias("draw"))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    bits = min(64, max(40, size.bit_length() + SPARE))

    # The sample proposes, one size after the other.
    drawn = stored(rows.filter("draw = 0").drop("draw"), "phrases-sample")
    rows = rows.drop("draw")
    bound, proposed = max(1, int(lowered * least / sample)), Bitmap(space)
    for longer in range(1, longest):
        more = _hashes(drawn, bound, (longer, longer), proposed, bits, math.ceil(size / sample / BUCKET) or 1, "phrases-proposed")
        proposed = proposed | more

    # The proposed phrases and their border; what is frequent of the border is a failure.
    buckets = math.ceil(size / BUCKET) or 1
    known = _hashes(rows, least, (1, longest), proposed, bits, buckets, "phrases-frequent")
    parts = rows.mapInArrow(tidy(_phrase_counts(longest, known, known - proposed, buckets)), PARTS)
    return stored(parts.groupBy("bucket").applyInArrow(_frequent_phrases(least), COUNTS), "phrases-counted")


def scored(found: DataFrame, absorb=ABSORB) -> DataFrame:
    """Phrases of two words and more with their weakest cut, without those that are parts of a longer one."""
    total = found.filter("size = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    found = found.filter("size > 0")
    part = lambda first, length: F.array_join(F.slice("words", first, length), " ")
    split = found.filter("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = split.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"),
        part(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    heads = found.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = found.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(total, "lang")
    # 38 decimal digits: occurrences can be counted up to a million times a million times a million.
    score = F.expr("(cast(1000 as decimal(38,0)) * a * n) div (cast(l as decimal(38,0)) * r)")
    weakest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # A longer phrase holds this one no more often than the phrase of one more word in between.
    longer = split.filter("size > 2").select("lang", F.col("a").alias("held"), F.explode(F.array(
        part(F.lit(1), F.col("size") - 1), part(F.lit(2), F.col("size") - 1))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("held").alias("held"))
    kept = weakest.join(longer, ["lang", "phrase"], "left").filter(
        F.col("held").isNull() | (F.lit(100) * F.col("held") < F.lit(absorb) * F.col("a")))
    return kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def top(found: DataFrame, keep=KEEP) -> DataFrame:
    """The best phrases of each language by score, occurrences and text."""
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    return top_per_key(found, ["lang"], best, keep).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame, least=LEAST, longest=LONGEST, keep=KEEP, absorb=ABSORB, **names) -> DataFrame:
    """The ``keep`` best phrases of each language, of all that occur ``least`` times."""
    return top(scored(frequent(docs, least, longest, **names), absorb), keep)
