"""Alignment of two tokenizers' tokens over the bytes of the same texts.

Both sides are laid over the bytes of a blank and the text.  ``merge_asof`` gives each token the token
of the other side that covers its first byte; two tokens overlap exactly if the later of their first
bytes lies in both, so the union of both directions is all links.  Where tokens of both sides end at
one byte, a group ends.

A link's id pair is counted over the corpus: how many documents hold it.  A chunk of documents asks for
each pair it holds once, however many documents hold it; the pairs are counted and joined by pair, and
the replies meet the chunk again.  So a pair in every document is one row per chunk, and no table of
pairs is sent to all tasks.

Defined results: texts that are null or empty, or whose tokens do not give back their bytes on either
side, have no tokens (zeros, an empty string of groups, and no part in the counts); rows that repeat
an id are documents of their own; a null id is kept; an empty table gives an empty result; other
columns are not read.  A text is aligned whole, in about 300 bytes of memory per byte of text.
"""

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import numbered, pack, sliced, unpack
from .common import ship, stored, tidy
from .packing import Encoder

CHUNK = 2_000_000   # bytes of text that are aligned at a time, about
MARK = "▁"     # stands for a blank in the pieces of side B

CHUNKS = ("chunk long, doc_id array<long>, numbers binary, groups array<string>, sizes binary, links binary, "
          "times binary, pairs array<int>, holders array<int>")
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


class Side:
    """A tokenizer's ids of a list of texts, and the bytes of each id."""

    def __init__(self, encode, tokens):
        self.encode = encode
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        # The ids as text, followed by a comma or by what closes their side of a group.
        self.inner = np.array([f"{i}," for i in range(len(tokens))], object)

    def last(self, close):
        return np.array([x[:-1] + close for x in self.inner], object)

    def joined(self, ids):
        sizes = self.sizes[ids]
        return self.bytes[np.repeat(self.places[ids] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]


def ranked_side(path: str) -> Side:
    """Byte-level pairs from a file of ranks; nothing in a text is a special token."""
    own = Encoder(path)
    with open(path, "rb") as f:
        ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}

    def encode(texts):
        return [np.frombuffer(own.encode(" " + t), "<u2").astype(np.int64) for t in texts]
    return Side(encode, [ranks.get(i, b"") for i in range(max(ranks) + 1)])


def piece_side(path: str) -> Side:
    """Pieces with byte fallback; the model itself puts a blank before a text."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def token(i):
        if model.is_byte(i):
            return bytes([int(model.id_to_piece(i)[3:-1], 16)])
        return model.id_to_piece(i).replace(MARK, " ").encode()

    def encode(texts):
        return [np.array(x, np.int64) for x in model.encode(texts, num_threads=1)]
    return Side(encode, [token(i) for i in range(model.get_piece_size())])


def pieces(path: str) -> int:
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()


_sides = {}


def sides(a_path: str, b_path: str):
    """Loaded once per Python worker."""
    if (a_path, b_path) not in _sides:
        a, b = ranked_side(a_path), piece_side(b_path)
        _sides[a_path, b_path] = a, b, a.last("|"), b.last(";")
    return _sides[a_path, b_path]


def _whole(side: Side, tokens: list, raw: list):
    """Which texts the tokens give back."""
    ids = np.concatenate([*tokens, np.empty(0, np.int64)])
    ends = np.concatenate([[0], np.cumsum(side.sizes[ids])])[np.cumsum([len(t) for t in tokens])]
    fine = np.diff(ends, prepend=0) == np.fromiter(map(len, raw), np.int64, len(raw))
    got = side.joined(np.concatenate([*(t for t, ok in zip(tokens, fine) if ok), np.empty(0, np.int64)]))
    told = np.frombuffer(b"".join(r for r, ok in zip(raw, fine) if ok), np.uint8)
    wrong = np.flatnonzero(got != told)
    if len(wrong):
        at = np.cumsum([len(r) for r, ok in zip(raw, fine) if ok])
        fine[np.flatnonzero(fine)[np.searchsorted(at, wrong, "right")]] = False
    return fine


def _laid(side: Side, tokens: list):
    """Ids, texts, first and last bytes of all tokens; the texts lie one behind the other."""
    ids = np.concatenate(tokens)
    ends = np.cumsum(side.sizes[ids])
    return ids, np.repeat(np.arange(len(tokens)), [len(t) for t in tokens]), ends - side.sizes[ids], ends


def aligned(texts: list, a_path: str, b_path: str, keep_groups: bool = False):
    """Per text its four counts and its groups (or their digest); the distinct (text, pair) and how often."""
    a, b, a_last, b_last = sides(a_path, b_path)
    numbers, groups = np.zeros((len(texts), 4), np.int64), [""] * len(texts)
    places = np.array([i for i, t in enumerate(texts) if t], np.int64)
    of_a, of_b = a.encode([texts[i] for i in places]), b.encode([texts[i] for i in places])
    raw = [(" " + texts[i]).encode() for i in places]
    fine = np.flatnonzero(_whole(a, of_a, raw) & _whole(b, of_b, raw)) if len(places) else places
    none = np.empty(0, np.int64)
    if not len(fine):
        return numbers, groups, none, none, none
    places, n = places[fine], len(fine)
    a_ids, a_text, a_start, a_end = _laid(a, [of_a[i] for i in fine])
    b_ids, b_text, b_start, b_end = _laid(b, [of_b[i] for i in fine])

    left = pd.DataFrame({"text": a_text, "start": a_start, "a": np.arange(len(a_ids))})
    right = pd.DataFrame({"text": b_text, "start": b_start, "b": np.arange(len(b_ids))})
    over = pd.merge_asof(left, right, on="start", by="text")
    under = pd.merge_asof(right, left, on="start", by="text")
    # A pair with one first byte is found in both directions; it counts once.
    under = under[a_start[under["a"].to_numpy()] != under["start"].to_numpy()]
    link_a = np.concatenate([over["a"].to_numpy(), under["a"].to_numpy()])
    link_b = np.concatenate([over["b"].to_numpy(), under["b"].to_numpy()])

    common = np.intersect1d(a_end, b_end, assume_unique=True)
    a_group, b_group = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
    a_in, b_in = np.bincount(a_group, minlength=len(common)), np.bincount(b_group, minlength=len(common))
    out = np.empty(len(a_ids) + len(b_ids), object)
    out[np.arange(len(a_ids)) + (np.cumsum(b_in) - b_in)[a_group]] = np.where(
        common[a_group] == a_end, a_last[a_ids], a.inner[a_ids])
    out[np.arange(len(b_ids)) + np.cumsum(a_in)[b_group]] = np.where(
        common[b_group] == b_end, b_last[b_ids], b.inner[b_ids])
    per_text = lambda owner: np.bincount(owner, minlength=n)
    bound = np.concatenate([[0], np.cumsum(per_text(a_text) + per_text(b_text))])
    for i, place in enumerate(places.tolist()):
        joined = "".join(out[bound[i]:bound[i + 1]].tolist())[:-1]
        groups[place] = joined if keep_groups else hashlib.sha256(joined.encode()).hexdigest()
    link_text = a_text[link_a]
    numbers[places] = np.stack([per_text(a_text), per_text(b_text), per_text(a_text[np.searchsorted(a_end, common)]),
                                per_text(link_text)], 1)
    pairs = a_ids[link_a] * len(b.sizes) + b_ids[link_b]
    keys, times = np.unique(link_text * (len(a.sizes) * len(b.sizes)) + pairs, return_counts=True)
    return numbers, groups, places[keys // (len(a.sizes) * len(b.sizes))], keys % (len(a.sizes) * len(b.sizes)), times


def _chunks(a_path, b_path, keep_groups):
    names = [c.split()[0] for c in CHUNKS.split(", ")]

    def run(batches):
        for number, batch in numbered(sliced(batches, 1, CHUNK)):
            texts = batch.column(1).to_pylist()
            numbers, groups, owner, pairs, times = aligned(texts, a_path, b_path, keep_groups)
            distinct, holders = np.unique(pairs, return_counts=True)
            listed = lambda x, kind: pa.array([x], pa.list_(kind))
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), listed(batch.column(0), pa.int64()),
                 pa.array([pack(numbers)], pa.binary()), listed(groups, pa.string()),
                 pa.array([pack(np.bincount(owner, minlength=len(texts)).astype(np.int64))], pa.binary()),
                 pa.array([pack(pairs.astype(np.int32))], pa.binary()),
                 pa.array([pack(times.astype(np.int32))], pa.binary()),
                 listed(distinct.astype(np.int32), pa.int32()), listed(holders.astype(np.int32), pa.int32())], names)
    return run


def _answered(chunks: pa.Table, replies: pa.Table) -> pa.Table:
    """The documents of one chunk, with what the replies say about their pairs."""
    order = np.argsort(known := replies.column("pair").to_numpy())
    known, n, best = known[order], replies.column("n").to_numpy()[order], replies.column("best").to_numpy()[order]
    row = {c: chunks.column(c)[0] for c in chunks.column_names}
    numbers = unpack(row["numbers"].as_py(), np.int64).reshape(-1, 4)
    sizes, times = unpack(row["sizes"].as_py(), np.int64), unpack(row["times"].as_py(), np.int32).astype(np.int64)
    at = np.searchsorted(known, unpack(row["links"].as_py(), np.int32))
    ends = np.cumsum(sizes)

    def per_text(values):
        total = np.concatenate([[0], np.cumsum(values)])
        return total[ends] - total[ends - sizes]
    return pa.table([row["doc_id"].values, *(pa.array(numbers[:, i]) for i in range(4)),
                     pa.array(per_text(times * (n[at] == best[at]))), pa.array(per_text(times * n[at])), row["groups"].values],
                    names=[c.split()[0] for c in RESULT.split(", ")])


def align(docs: DataFrame, a_path: str, b_path: str, doc_id="doc_id", text="text", keep_groups=True) -> DataFrame:
    """One row per document: tokens of both sides, groups, links, and the links' counts over the corpus.

    ``n_best`` are the links whose count is the highest of their A id, ``count_sum`` the sum over all links.
    ``groups`` holds the ids of both sides by group (``a1,a2|b1;a3|b2``), or without ``keep_groups``
    its SHA-256 in hex, which is never written out whole.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    chunks = stored(rows.mapInArrow(tidy(_chunks(a_path, b_path, keep_groups)), CHUNKS), "alignment-chunks")
    asked = chunks.select("chunk", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("holders").alias("held"))))
    counts = stored(asked.groupBy("pair").agg(F.sum("held").alias("n")), "alignment-pairs")
    counts = counts.withColumn("a", F.floor(F.col("pair") / F.lit(pieces(b_path))))
    # An A id has at most as many pairs as side B has ids.
    best = counts.groupBy("a").agg(F.max("n").alias("best"))
    replies = asked.select(F.col("chunk").alias("asker"), "pair").join(counts.join(best, "a").drop("a"), "pair")
    chunks = chunks.drop("pairs", "holders")
    return chunks.groupBy("chunk").cogroup(replies.groupBy("asker")).applyInArrow(_answered, RESULT)
