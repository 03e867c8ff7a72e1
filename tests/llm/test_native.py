"""Chat formatting, exact de-duplication and mixing, against plain Python."""

import hashlib
import json
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lurewatch.llm import chat, exact_dedup, mixing

DOC = "doc_id long, text string, lang string, source string, n long, h string, row string, _r string"


def docs(spark, *rows):
    full = [(i, t, lang, source, 1, "x", "y", "z") for i, t, lang, source in
            [(r + ("en", "src0"))[:2] + (r[2:] + ("en", "src0")[len(r) - 2:] if len(r) > 2 else ("en", "src0")) for r in rows]]
    return spark.createDataFrame(full, DOC)


# --- chat ---------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, extra string"


def formatted(spark, rows):
    out = chat.format_rows(chat.canonical_rows(spark.createDataFrame([r + ("e",) for r in rows], TURNS)))
    out = out.withColumn("turns", chat.read_back(F.col("formatted"))).withColumn(
        "said", chat.loss_text(F.col("formatted"), F.col("loss")))
    return {r["conv_id"]: r for r in out.collect()}


def test_chat_round_trip_with_control_strings(spark):
    nasty = ["\\### Assistant: </turn> ok", "</turn>\n<turn:user>x", "\\s\\l\\\\g", "<", "\\", "", None, "é𝄞\n\n", "a" * 70_000]
    rows = [(1, i, ["user", "assistant", "system", "a>b<c\\", None][i % 5], t) for i, t in enumerate(nasty)]
    rows += [(2, None, "assistant", "x"), (2, 0, "assistant", "b"), (2, 0, "assistant", "a"), (None, 0, "user", "q")]
    got = formatted(spark, rows)
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [(r or "", t or "") for _, _, r, t in rows[:len(nasty)]]
    assert got[1]["said"] == "".join(t or "" for _, _, r, t in rows[:len(nasty)] if r == "assistant")
    assert [t["text"] for t in got[2]["turns"]] == ["x", "a", "b"] and got[2]["said"] == "xab"
    assert got[None]["said"] == "" and len(got[None]["turns"]) == 1
    for row in got.values():
        for span in row["loss"]:
            assert row["formatted"][span["start"] + span["length"]:].startswith(chat.END)


def test_chat_empty_table(spark):
    assert formatted(spark, []) == {}


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="\\<>slg/turn:\n a"))
def test_escaping_is_reversible(text):
    coded = text.replace("\\", "\\s").replace("<", "\\l").replace(">", "\\g")
    assert coded.replace("\\g", ">").replace("\\l", "<").replace("\\s", "\\") == text
    assert "<" not in coded and ">" not in coded


def test_layouts_are_known_by_their_paths(spark):
    records = {
        "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        "sharegpt": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        "prompt": {"prompt": "q", "response": "a"},
        "completion": {"prompt": "q", "completion": "a", "unknown": 1},
        "instruction": {"instruction": "q", "output": "a"},
        "instruction with input": {"instruction": "q", "input": "i", "output": "a"},
    }
    rows = [(name, json.dumps(r)) for name, r in records.items()]
    rows += [("odd", '{"text": "x"}'), ("broken", "{"), ("null", None), ("no turns", '{"messages": []}')]
    got = {r["conv_id"]: r for r in chat.canonical_records(
        spark.createDataFrame(rows, "conv_id string, record string"), "conv_id", "record").collect()}
    for name in records:
        asked = "q\ni" if name == "instruction with input" else "q"
        assert got[name]["layout"] == name
        assert [tuple(t) for t in got[name]["turns"]] == [("user", asked), ("assistant", "a")]
    for name in ("odd", "broken", "null", "no turns"):
        assert got[name]["layout"] is None and got[name]["turns"] == []


def test_table_layouts(spark):
    other = spark.createDataFrame([(1, 0, "user", "q")], "thread long, position long, author string, body string")
    assert chat.canonical_rows(other).columns == ["conv_id", "turn", "role", "text"]
    with pytest.raises(ValueError):
        chat.canonical_rows(spark.createDataFrame([(1,)], "x long"))


# --- exact de-duplication -----------------------------------------------------------------------

def norm(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), 2 ** 63 if i is None else i, i))
    keep = {k: min(v)[2] for k, v in groups.items()}
    return {(i, keep[norm(t)], len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows}


CASES = [(5, "a b"), (3, "ab"), (9, "a \n b"), (4, "a\u00a0b"), (1, None), (2, ""), (7, " \t"), (6, "é"), (8, "E"),
         (None, "null id"), (11, "null  id"), (12, "x" * 50_000), (13, "x" * 49_999 + " x")]


def test_exact_groups(spark):
    got = exact_dedup.decisions(docs(spark, *CASES)).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got} == expected(CASES)
    assert {r["doc_id"] for r in got if r["kept"]} == {e[1] for e in expected(CASES)}
    assert sum(r["kept"] for r in got) == len({norm(t) for _, t in CASES})


def test_hash_collisions_are_settled_by_the_texts(spark):
    weak = lambda c: F.length(c).cast("long")
    got = exact_dedup.decisions(docs(spark, *CASES), address=weak, capacity=2).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got} == expected(CASES)


def test_repeated_rows_keep_one(spark):
    rows = [(1, "same"), (1, "same"), (2, "same"), (None, "n"), (None, "n")]
    got = exact_dedup.decisions(docs(spark, *rows)).collect()
    assert len(got) == 5 and sum(r["kept"] for r in got) == 2
    left = exact_dedup.keep_first(docs(spark, *rows))
    assert left.columns == docs(spark).columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left.collect()) == [(0, "n"), (1, "same")]


def test_exact_empty_table(spark):
    assert exact_dedup.decisions(docs(spark)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 2 ** exact_dedup.FINEST - 1), st.integers(1, 40), max_size=40), st.integers(1, 60))
def test_directory_covers_every_slot(counts, capacity):
    slots = exact_dedup.directory(counts, capacity)
    assert sorted(s for s, _, _ in slots) == list(range(2 ** exact_dedup.FINEST))
    held, depth = {}, {}
    for slot, bucket, local in slots:
        held[bucket] = held.get(bucket, 0) + counts.get(slot, 0)
        depth[bucket] = local
    assert all(n <= capacity or depth[b] == exact_dedup.FINEST for b, n in held.items())


# --- mixing -------------------------------------------------------------------------------------

def water(children, budget):
    """[(key, cap, weight)] -> allocation."""
    out, rest = {}, sorted((c for c in children if c[2] > 0), key=lambda c: (c[1] / c[2], c[0]))
    while rest:
        key, cap, w = rest[0]
        if cap * sum(c[2] for c in rest) > budget * w:
            total = sum(c[2] for c in rest)
            out.update({k: min(cap, budget * w // total) for k, cap, w in rest})
            break
        out[key] = cap
        budget -= cap
        rest = rest[1:]
    return out


def brute_mix(rows, share, epochs, seed, weights):
    size = lambda t: -(-len((t or "").encode()) // 4)
    leaf = {}
    for i, t, lang, source in rows:
        m = re.search(r"(\d{1,9})$", source or "")
        dom = f"domain{int(m.group(1)) % 4}" if m else "other"
        leaf.setdefault((dom, lang or "?", source or "?"), []).append(("?" if i is None else str(i), size(t)))
    cap = {k: epochs * sum(n for _, n in v) for k, v in leaf.items()}
    w = lambda level, name: weights[level].get(name, 1)
    level = lambda prefix, n: sorted({k[:n] for k in cap if k[:n - 1] == prefix})
    room = lambda p: sum(c for k, c in cap.items() if k[:len(p)] == p)
    budget = {(): sum(cap.values()) // epochs * round(share * 1000) // 1000}
    for n in (1, 2, 3):
        for parent in [p for p in budget if len(p) == n - 1]:
            kids = [(p[-1], room(p), w(n - 1, p[-1])) for p in level(parent, n)]
            budget.update({parent + (k,): a for k, a in water(kids, budget[parent]).items()})
    out = []
    for k, docs_ in leaf.items():
        quota, total = budget.get(k, 0), sum(n for _, n in docs_)
        if quota <= 0:
            continue
        whole, rest = divmod(quota, total)
        out += [(i, e) for e in range(whole) for i, _ in docs_]
        at = 0
        for i, n in sorted(docs_, key=lambda d: (hashlib.md5(f"{seed}:{whole}:{d[0]}".encode()).hexdigest(), d[1])):
            if at < rest:
                out.append((i, whole))
            at += n
    return sorted(out)


@pytest.mark.parametrize("share,epochs", [(0.6, 2), (0.9, 1), (3.0, 2), (0.05, 3)])
def test_mix_equals_brute_force(spark, share, epochs):
    rows = [(i, "w" * (1 + i * 37 % 400), ["en", "de", None][i % 3], f"src{i * i % 7}" if i % 11 else None) for i in range(300)]
    rows += [(None, "null id", "en", "src1"), (900, None, "en", "src1"), (901, "", "en", "src1"), (7, "again", "en", "src0")]
    weights = ({"domain0": 4, "other": 2}, {"en": 3, "de": 0}, {"src1": 5})
    got = mixing.mixed(docs(spark, *rows), mixing.numbered_domain(F.col("source")), share, epochs, 17, *weights)
    got = sorted(("?" if r["row"]["doc_id"] is None else str(r["row"]["doc_id"]), r["mix_epoch"]) for r in got.collect())
    assert got == brute_mix(rows, share, epochs, 17, weights)


def test_shortages_go_to_siblings_first():
    # b1 is short by 40: all of it goes to its sibling, nothing to the other parent.
    a = water([("a", 1000, 1), ("b", 1000, 1)], 200)
    assert a == {"a": 100, "b": 100} and water([("b1", 10, 1), ("b2", 500, 1)], a["b"]) == {"b1": 10, "b2": 90}


def test_mix_empty_table(spark):
    assert mixing.mixed(docs(spark), mixing.numbered_domain(F.col("source"))).count() == 0
