"""Exact search, packing and near duplicates, against plain Python; the pipeline; the registered queries."""

import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from lurewatch.llm import near_dedup, packing, queries, topk

SMALL = "/root/testdata/sf0.001"


# --- exact search -------------------------------------------------------------------------------

def brute_top(rows, k):
    fine = [(i, [int(np.floor(256.0 * x)) for x in v]) for i, v in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, v) in enumerate(fine):
        if i is None or i % 50:
            continue
        scores = [(-sum(x * y for x, y in zip(v, w)), 2 ** 63 if j is None else j, j) for b, (j, w) in enumerate(fine) if a != b]
        out += [(i, n + 1, j, -s) for n, (s, _, j) in enumerate(sorted(scores, key=lambda x: x[:2])[:k])]
    return sorted(out, key=repr)


def found(spark, rows, k=5):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, copies int")
    got = topk.top_k(frame, lambda c: c % 50 == 0, k).collect()
    return sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got), key=repr)


def test_top_k(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, rng.uniform(-1, 1)]) for _ in range(6)]) for i in range(700)]
    rows += [(700 + i, [0.5] * 6) for i in range(30)]                    # ties
    rows += [(50, rows[50][1]), (51, rows[51][1]), (100, [1.0] * 6)]     # repeated rows and ids
    rows += [(None, [0.9] * 6), (2000, None), (2050, [None] * 6), (2100, [float("nan")] * 6), (2150, [float("inf")] * 6),
             (2200, []), (2250, [0.1, 0.2])]
    assert found(spark, rows) == brute_top(rows, 5)


def test_fewer_candidates_than_k(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.0, 1.0])]
    assert found(spark, rows) == brute_top(rows, 5) and len(found(spark, rows)) == 1
    assert found(spark, [(0, [1.0])]) == [] and found(spark, []) == []


# --- packing ------------------------------------------------------------------------------------

@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 31), st.integers(1, 50), max_size=20), st.sampled_from([32, 8, 1]))
def test_pack_places_every_token_once(histogram, least):
    placed, sequences = packing.pack(histogram, 32, least)
    covered, filled = Counter(), defaultdict(list)
    for size, rank, count, start, piece, sequence, offset in placed:
        for n in range(count):
            covered.update((size, rank + n, start + i) for i in range(piece))
            filled[sequence + n].append((offset, piece))
    assert covered == Counter((s, r, i) for s, n in histogram.items() for r in range(n) for i in range(s))
    assert set(filled) == set(range(sequences))
    for pieces in filled.values():
        at = 0
        for offset, piece in sorted(pieces):
            assert offset == at
            at += piece
        assert at <= 32


WORDS = "the of and thing Ééß don't 12 3.5 x\ny \u00a0 日本語 <|endoftext|> $$$ \t".split(" ")


def check_pieces(rows, ids, length):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            own = ids[doc_id][r["start"]:r["start"] + r["length"]]
            assert r["start"] == at and r["doc_tokens"] == len(ids[doc_id])
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(own)}I", *own)) and struct.pack(f"<{len(own)}H", *own) == r["ids"]
            at += r["length"]
        assert at == len(ids[doc_id])
    assert set(by_doc) == set(ids)
    for pieces in by_sequence.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= length
    return len(by_sequence)


def test_packed_documents_hold_the_tokenizers_ids(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rng = random.Random(4)
    rows = [(i, rng.choice([" ", "  ", "\n", " \n"]).join(rng.choices(WORDS, k=rng.randrange(1, 400)))) for i in range(80)]
    rows += [(i, " ".join(rng.choices(WORDS, k=rng.randrange(1, 60)))) for i in range(100, 160)]
    rows += [(200, None), (201, ""), (202, " "), (203, "a " * 9000), (204, "   x"), (205, "x \n "), (206, "\n\n  \n")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, rank int").repartition(4)
    got = packing.pack_documents(frame, queries.vocabulary_path(), length=256).collect()
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows}
    sequences = check_pieces(got, ids, 256)
    assert sequences * 256 <= 1.02 * sum(map(len, ids.values())) + 256


def test_query_has_the_ids_of_the_tokenizers_default_setting(spark, tmp_path):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert tokenizer.encode("a<|endoftext|>b", add_special_tokens=False).ids == [64, 50256, 65]
    rng = random.Random(5)
    end = "<|endoftext|>"
    texts = [rng.choice(["", " ", "  "]).join(rng.choices([*WORDS, end], k=rng.randrange(1, 60))) for _ in range(80)]
    texts += [end, end * 3, f"a{end}b", f"a {end} b", f"x  {end}", f"{end}  x", f" {end} \n {end}", "<|endoftext|", f"<{end}>", "", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    by_doc = defaultdict(list)
    for r in queries.op9_packing(spark, str(tmp_path)).collect():
        by_doc[r["doc_id"]].append(r)
    for i, text in enumerate(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for r in by_doc[i]:
            own = ids[r["start"]:r["start"] + r["length"]]
            assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(own)}I", *own))
        assert sum(r["length"] for r in by_doc[i]) == len(ids)


def test_repeated_rows_and_null_ids_are_packed_each(spark):
    frame = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "x"), (None, None)], "doc_id long, text string")
    got = packing.pack_documents(frame, queries.vocabulary_path()).collect()
    assert len(got) == 4 and len({(r["sequence_id"], r["offset"]) for r in got}) == 4
    assert packing.pack_documents(frame.limit(0), queries.vocabulary_path()).count() == 0


# --- near duplicates ----------------------------------------------------------------------------

def jaccard_classes(spark, rows, threshold=0.8):
    """Classes by the similarity of all pairs."""
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    weights = near_dedup.shingle_weights(near_dedup._rows(frame, "doc_id", "text"))
    texts = [(t or "").encode() for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(rows)):
        sims = near_dedup.similarity(weights, [texts[a]] * (len(rows) - a - 1), texts[a + 1:]) if a + 1 < len(rows) else []
        for b, s in enumerate(sims, a + 1):
            if s >= threshold:
                parent[root(b)] = root(a)
    out = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        out[root(i)].append(k)
    return sorted(sorted(v) for v in out.values())


def near_rows():
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(2000)]
    common = rng.choices(words, k=12)
    rows = []
    for _ in range(25):
        base = rng.choices(words, k=rng.randrange(30, 200)) + common
        for _ in range(rng.randrange(1, 6)):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), rng.choice([" ", "  ", "\n"]).join(text)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "one two"), (1004, "One  two"), (1005, "one two three"),
             (1006, rows[0][1].upper()), (1007, "w " * 20_000)]
    return rows


def test_near_classes(spark):
    rows = near_rows()
    got = near_dedup.classes(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int").repartition(4)).collect()
    classes = defaultdict(list)
    for r in got:
        classes[r["class_id"]].append(r["doc_id"])
        assert r["kept"] == (r["doc_id"] == r["class_id"])
    assert all(min(v) == k for k, v in classes.items())
    assert all(r["class_size"] == len(classes[r["class_id"]]) for r in got)
    assert sorted(sorted(v) for v in classes.values()) == jaccard_classes(spark, rows)


def test_a_chain_in_one_bucket_is_not_torn(spark):
    """Neighbours of a chain are similar, its ends are not; all texts share their bands."""
    words = [f"w{i:03d}" for i in range(160)]
    rows = [(i, " ".join(words[4 * i:4 * i + 60])) for i in range(20)] + [(50 + i, " ".join(f"x{j}{i}" for j in range(40))) for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    weights = near_dedup.shingle_weights(near_dedup._rows(frame, "doc_id", "text"))
    nodes = frame.select(F.col("text").cast("binary").alias("node"), F.col("doc_id").alias("age"),
                         F.array(F.lit(1).cast("long")).alias("bands"))
    texts = frame.select(F.col("text").cast("binary").alias("node"), "text")
    _, labels = near_dedup.links(nodes, texts, weights)
    name = {t.encode(): i for i, t in rows}
    groups = defaultdict(list)
    for r in labels.collect():
        groups[bytes(r["label"])].append(name[bytes(r["node"])])
    assert sorted(map(sorted, groups.values())) == [c for c in jaccard_classes(spark, rows) if len(c) > 1]


def test_repeated_rows_nulls_and_empty_table(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "z")]
    got = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 4 and sum(r["kept"] for r in got) == 2 and {r["class_size"] for r in got} == {3, 1}
    left = near_dedup.keep_one(spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, text string, _r string"))
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 2] and left.columns == ["doc_id", "text", "_r"]
    assert near_dedup.classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_common_shingles_are_counted_exactly(spark):
    rng = random.Random(8)
    rows = [(i, " ".join([f"a{rng.randrange(500)}" for _ in range(20)] + ["one", "two", "three", "four", "five"] * (i % 7 == 0)))
            for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    weights = near_dedup.shingle_weights(near_dedup._rows(frame, "doc_id", "text"), 0.1)
    held = Counter(m for _, t in rows for m in set(near_dedup.counted([t.encode()])[1].tolist()))
    assert dict(zip(weights.marks.tolist(), weights.idf.tolist())) == pytest.approx(
        {m: np.log1p(300 / n) for m, n in held.items() if n >= 30})


def test_every_frequency_has_its_own_weight(spark):
    """A passage that a twentieth of the texts share does not make texts alike that have little else in common."""
    shared = " ".join(f"notice{i}" for i in range(60))
    rows = [(i, shared + " " + " ".join(f"own{i}x{j}" for j in range(5))) for i in range(20)]
    rows += [(100 + i, " ".join(f"other{i}x{j}" for j in range(30))) for i in range(380)]
    rows += [(1000, " ".join(f"pair{j}" for j in range(68))), (1001, " ".join([*(f"pair{j}" for j in range(65)), "a", "b", "c"]))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: (r["class_id"], r["class_size"]) for r in near_dedup.classes(frame).collect()}
    assert all(got[k] == (k, 1) for k, _ in rows[:-2]) and got[1000] == got[1001] == (1000, 2)

    signed, weights = near_dedup.signatures(near_dedup._rows(frame, "doc_id", "text"), near_dedup.BANDS, near_dedup.ROWS)
    texts, held = dict(rows), Counter(m for _, t in rows for m in set(near_dedup.counted([t.encode()])[1].tolist()))
    for r in signed.collect():
        marks, times = near_dedup.counted([texts[r["doc_id"]].encode()])[1:3]
        assert weights.of(marks, times, [bytes(r["df"])]) == pytest.approx([np.log1p(len(rows) / held[m]) for m in marks.tolist()])


# --- pipeline and queries -----------------------------------------------------------------------

def test_pipeline_stages(spark, tmp_path):
    docs, columns = spark.read.parquet(f"{SMALL}/documents.parquet"), None
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        before = docs
        docs = stage(spark, docs, SMALL)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        sizes.append(docs.count())
        if name != "packing":
            assert docs.columns == columns and docs.join(before, "doc_id", "left_anti").count() == 0
        if name == "exact_dedup":
            squeezed = F.regexp_replace("text", "[\\x20\\x09-\\x0D]", "")
            assert docs.count() == before.select(squeezed).distinct().count() == docs.select(squeezed).distinct().count()
        if name == "near_dedup":
            rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(c[0] for c in jaccard_classes(spark, rows))
    assert sizes[0] >= sizes[1] > sizes[2] >= sizes[3] > sizes[4]
    assert docs.agg(F.sum("length")).first()[0] > 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    from tools.check_oracle import compare, database
    equal, _, message = compare(spark, database(SMALL), name, SMALL)
    assert equal, message
