"""Cross-tokenizer alignment against plain Python and the tokenizers' own libraries."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest

from lurewatch.llm import alignment, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def byte_table():
    """The characters that stand for bytes in byte-level entries."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {chr(b): b for b in plain}, 0
    for b in range(256):
        if b not in plain:
            table[chr(256 + extra)] = b
            extra += 1
    return table


def brute(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    table = byte_table()

    def b_bytes(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    found = []
    for doc_id, text in rows:
        spans = [], []
        if text:
            for side, ids, get in ((0, a.encode(" " + text, add_special_tokens=False).ids,
                                    lambda i: bytes(table[c] for c in a.id_to_token(i))), (1, b.encode(text), b_bytes)):
                at, joined = 0, b""
                for i in ids:
                    spans[side].append((i, at, at + len(get(i))))
                    joined += get(i)
                    at = len(joined)
                if joined != (" " + text).encode():
                    spans = [], []
                    break
        links = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if s < f and t < e]
        ends = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, last = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, s, e in side if last < e <= end) for side in spans))
            last = end
        found.append((doc_id, links, len(spans[0]), len(spans[1]), groups))
    count = Counter(p for _, links, *_ in found for p in set(links))
    best = {}
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    return sorted(((d, na, nb, len(g), len(k), sum(count[p] == best[p[0]] for p in k), sum(count[p] for p in k), ";".join(g))
                   for d, k, na, nb, g in found), key=repr)


TEXTS = [None, "", " ", "   ", "a", "Hello, world!  Two  blanks \n\n\ttab", "▁piece mark", "naïve café ééé",
         "日本語の文 \U0001f600\U0001f468‍\U0001f469 x", "<s> a </s> <unk> <|endoftext|> <0x41>", "a\x00b\x01�", "ȩ́",
         "don't we'll 12345 678.90", "x" * 300, "The cat sat on the mat. " * 40, " nbsp　wide", "same text", "same text"]


def test_alignment_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK", 200)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "other text"), (3, "other text"), (None, "no id here")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, pair int, groups string")
    got = alignment.align(docs.repartition(3), RANKS, B).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_tables_and_empty_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
            .select("doc_id", "text").orderBy("doc_id").limit(25).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in alignment.align(docs, RANKS, B).collect()), key=repr)
    assert got == brute(rows)
    assert alignment.align(docs.limit(0), RANKS, B).count() == 0


def test_a_long_text_is_aligned_whole(spark):
    text = "alpha beta, gammaé " * 40_000
    row = alignment.align(spark.createDataFrame([(1, text)], "doc_id long, text string"), RANKS, B).collect()[0]
    import sentencepiece
    assert row.n_b == len(sentencepiece.SentencePieceProcessor(model_file=B).encode(text))
    pairs = [g.split("|") for g in row.groups.split(";")]
    assert len(pairs) == row.n_groups and sum(a.count(",") + 1 for a, _ in pairs) == row.n_a


def test_registered_query(spark):
    got = queries.QUERIES["op13_alignment"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    whole = {r.doc_id: r.groups for r in alignment.align(docs, RANKS, B).collect()}
    digest = {r.doc_id: r.groups for r in alignment.align(docs, RANKS, B, keep_groups=False).collect()}
    assert digest == {1: hashlib.sha256(whole[1].encode()).hexdigest(), 2: ""}
