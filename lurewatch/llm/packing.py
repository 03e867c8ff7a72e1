"""Packing documents into sequences, shortest pack first over the histogram of lengths.

A document is its token ids and an end id.  Whole sequences are cut off its front; what remains has a
length below the sequence length, so the histogram of remainders has at most that many entries,
whatever the corpus holds.  Lengths are placed longest first, always into the shortest open packs, as
patterns with counts: a step moves many documents at once.  A length that fits into no open pack is
cut to fill the shortest ones if at least ``least`` tokens go in; its tail goes back into the
histogram.  Only if the open packs have no such room, new ones are opened.  Remainders are first
packed uncut; smaller and smaller cuts are allowed until the padding is at most ``padding``.

The placements join back to the documents by rank: the n-th document of a remainder length takes the
n-th place of that length.  Ranks are counted per slice of the corpus and length first, so no length
is ever sorted or numbered in one task.

Defined results: a null text is empty, so its document is the end id alone; a null id is kept; rows
that repeat an id are documents of their own; texts of any length are cut, never shortened; an empty
table gives an empty result; other columns are not read.
"""

import base64
import heapq
import json
import re
import zlib
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored, tidy

LENGTH = 2048
PADDING = 0.005     # share of padding that is good enough
CUTS = (LENGTH, 512, 128, 32, 1)  # least tokens of a piece that is cut to fill a pack; the first cuts nothing
END_ID = 1
REMEMBERED = 200_000  # words whose ids a task remembers, about 30 MB

TOKENS = "doc_id long, slice int, rest int, rank long, whole long, doc_tokens long, ids binary"
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "`offset` long, ids binary")

INNER_BLANK = re.compile(r"\s (?:\s|\Z)")

_encoders = {}   # the vocabulary stays with the worker, the words go when a task ends


class Encoder(dict):
    """The ids of a piece of text, remembered, as two bytes each.

    Pieces begin at a blank: there the vocabulary's splitting rule always cuts, unless the blank has
    white space on both sides, or before it and the end of the text behind it.  Texts with such a
    blank are encoded whole.  A text is cut at the ``added`` tokens first, as the tokenizer does: each has
    its own id, and what stands between them is a text of its own.
    """

    def __init__(self, path, added=()):
        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ids = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                     special_tokens={}).encode_ordinary
        self.added = {token: np.array([i], "<u2").tobytes() for token, i in added}
        # Of tokens that begin alike the longest is found.
        self.cut = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    def __missing__(self, piece):
        if len(self) >= REMEMBERED:
            self.clear()
        self[piece] = out = np.array(self.ids(piece), "<u2").tobytes()
        return out

    def encode(self, text: str) -> bytes:
        if self.cut is None or not self.cut.search(text):
            return self.plain(text) if text else b""
        out, at = [], 0
        for match in self.cut.finditer(text):
            if match.start() > at:
                out.append(self.plain(text[at:match.start()]))
            out.append(self.added[match.group()])
            at = match.end()
        if at < len(text):
            out.append(self.plain(text[at:]))
        return b"".join(out)

    def plain(self, text: str) -> bytes:
        if INNER_BLANK.search(text):
            return np.array(self.ids(text), "<u2").tobytes()
        first, *rest = text.split(" ")
        return self[first] + b"".join([self[" " + piece] for piece in rest])


def added_tokens(path: str) -> tuple:
    """The added tokens of a tokenizer's json file and their ids."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    odd = [t["content"] for t in tokens if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
    if odd:
        raise ValueError(f"added tokens that take more than their own text: {odd}")
    return tuple((t["content"], t["id"]) for t in tokens)


def encoder(path: str, added=()) -> Encoder:
    if (path, added) not in _encoders:
        _encoders[path, added] = Encoder(path, added)
    return _encoders[path, added]


def _tokenise(path: str, end_id: int, length: int, added=()):
    def run(batches):
        from pyspark import TaskContext
        own, end = encoder(path, added), np.array([end_id], "<u2").tobytes()
        part, seen, full = TaskContext.get().partitionId(), np.zeros(length, np.int64), 0
        for batch in batches:
            ids = [(own.encode(t) if t else b"") + end for t in batch.column(1).to_pylist()]
            tokens = [len(x) // 2 for x in ids]
            ranks, wholes = [], []
            for n in tokens:
                ranks.append(seen[n % length])
                wholes.append(full)
                seen[n % length] += 1
                full += n // length
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * len(ids), pa.int32()), pa.array([n % length for n in tokens], pa.int32()),
                 pa.array(ranks, pa.int64()), pa.array(wholes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array(ids, pa.binary())],
                ["doc_id", "slice", "rest", "rank", "whole", "doc_tokens", "ids"])
        own.clear()
    return run


def tokenised(docs: DataFrame, path: str, length=LENGTH, end_id=END_ID, doc_id="doc_id", text="text",
              added=()) -> DataFrame:
    """One row per document, on shared files: its ids, its slice of the corpus, its remainder's length.

    ``rank`` counts the earlier documents of the slice with that remainder, ``whole`` the whole
    sequences cut from earlier documents of the slice.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return stored(rows.mapInArrow(tidy(_tokenise(path, end_id, length, added)), TOKENS), "packing-tokens")


def pack(histogram: dict, length: int = LENGTH, least: int = LENGTH):
    """Placements ``(remainder, first rank, count, start, piece, sequence, offset)`` and the number of sequences.

    The documents of a remainder with ranks from ``first rank`` on have the ``piece`` tokens from
    ``start`` of their remainder in the sequences from ``sequence`` on, at ``offset``.
    """
    waiting, lengths = {}, []   # length -> [(remainder, first rank, count, start)]

    def wait(size, item):
        if size not in waiting:
            waiting[size] = []
            heapq.heappush(lengths, -size)
        waiting[size].append(item)

    for size, count in histogram.items():
        if size and count:
            wait(size, (size, 0, count, 0))
    packs, placed, sequences = [], [], 0   # packs: heap of (used, first sequence, count)
    while lengths:
        size = -heapq.heappop(lengths)
        for origin, rank, count, start in waiting.pop(size):
            while count:
                if not packs or length - packs[0][0] < min(size, least):
                    fresh = max(1, count * size // length)
                    heapq.heappush(packs, (0, sequences, fresh))
                    sequences += fresh
                used, first, held = heapq.heappop(packs)
                many, piece = min(held, count), min(size, length - used)
                placed.append((origin, rank, many, start, piece, first, used))
                if held > many:
                    heapq.heappush(packs, (used, first + many, held - many))
                if used + piece < length:
                    heapq.heappush(packs, (used + piece, first, many))
                if piece < size:
                    wait(size - piece, (origin, rank, many, start + piece))
                rank, count = rank + many, count - many
    return placed, sequences


def pack_well(histogram: dict, length: int = LENGTH, padding: float = PADDING, cuts=CUTS):
    """``pack`` with the fewest cuts that keep the padding within ``padding``."""
    tokens = sum(size * count for size, count in histogram.items())
    for least in cuts:
        placed, sequences = pack(histogram, length, least)
        if sequences * length - tokens <= max(padding * sequences * length, length):
            break
    return placed, sequences


def _cut(placed: list, sequences: int, length: int):
    """Pieces of documents; ``rank`` and ``whole`` are those of the corpus."""
    by_length = {}
    for origin, rank, count, *rest in placed:
        by_length.setdefault(origin, []).append((rank, rank + count, *rest))
    plans = {}
    for size, items in by_length.items():
        bounds = sorted({a for a, *_ in items} | {b for _, b, *_ in items})
        table = [[] for _ in bounds]
        for first, last, *rest in sorted(items):
            for i in range(bisect_left(bounds, first), bisect_left(bounds, last)):
                table[i].append((first, *rest))
        plans[size] = (bounds, table)

    def run(batches):
        for batch in batches:
            out = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "ids", "rank", "whole")))
            for doc_id, tokens, ids, rank, whole in rows:
                full = tokens // length
                pieces = [(i * length, length, sequences + whole + i, 0) for i in range(full)]
                if tokens % length:
                    bounds, table = plans[tokens % length]
                    for first, start, piece, sequence, offset in table[bisect_right(bounds, rank) - 1]:
                        pieces.append((full * length + start, piece, sequence + rank - first, offset))
                for start, size, sequence, offset in pieces:
                    own = ids[2 * start:2 * (start + size)]
                    wide = np.frombuffer(own, "<u2").astype("<u4").tobytes()
                    out.append((doc_id, start, size, zlib.crc32(wide), tokens, sequence, offset, own))
            columns = list(zip(*out)) or [[]] * 8
            kinds = [pa.int64()] * 7 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                                              "offset", "ids"])
    return run


def packed(tokens: DataFrame, length: int = LENGTH, padding: float = PADDING) -> DataFrame:
    """One row per piece of the documents in ``tokens`` (from ``tokenised``), with its ids."""
    full = F.floor(F.col("doc_tokens") / length).cast("long")
    counts = stored(tokens.groupBy("slice", "rest").agg(F.count("*").alias("n"), F.sum(full).alias("full")),
                    "packing-counts")
    # At most ``length`` rows reach the driver, whatever the corpus holds.
    histogram = dict(counts.groupBy("rest").agg(F.sum("n").alias("n")).collect())
    placed, sequences = pack_well(histogram, length, padding)

    earlier = Window.partitionBy("rest").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select("slice", "rest", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rank0"))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = counts.groupBy("slice").agg(F.sum("full").alias("full")).select(
        "slice", F.coalesce(F.sum("full").over(before), F.lit(0)).alias("whole0"))
    first = ranks.join(slices, "slice")
    rows = tokens.join(first, ["slice", "rest"]).select(
        "doc_id", "doc_tokens", "ids", (F.col("rank") + F.col("rank0")).alias("rank"),
        (F.col("whole") + F.col("whole0")).alias("whole"))
    return rows.mapInArrow(tidy(_cut(placed, sequences, length)), PIECES)


def pack_documents(docs: DataFrame, path: str, length=LENGTH, padding=PADDING, end_id=END_ID, doc_id="doc_id",
                   text="text", added=()) -> DataFrame:
    """Tokenise and pack; ``ids`` holds a piece's ids, two bytes each.

    ``added`` are (token, id) of strings that are one token each (``added_tokens``); without them a
    text is encoded as plain text throughout.
    """
    return packed(tokenised(docs, path, length, end_id, doc_id, text, added), length, padding)
