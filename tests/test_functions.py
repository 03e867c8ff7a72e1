import pytest
from pyspark.sql import functions as F

from lurewatch.functions import address, codec, lexicon, risk, similarity, text
from lurewatch.operators import extensions


def values(spark, rows, expression, schema="x string"):
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)],
                               "i int, " + schema)
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_simple_lower(spark):
    assert values(spark, ["WİRE ΣΑΣ", "ÉTÉ", "ABC", None], text.simple_lower("x")) == [
        "wire σας".replace("ς", "σ"), "été", "abc", None]


def test_domain_of(spark):
    assert values(spark, ["a@B.com", "a@b@c", "nobody", "", None, "@x.org", "a@"], address.domain_of("x")) == [
        "b.com", "", "", "", "", "x.org", ""]


def test_address_of(spark):
    cases = {"Billing Desk <billing@companyy.com>": "billing@companyy.com",
             "plain@x.org": "plain@x.org", "  plain@x.org ": "plain@x.org", "<a@b.c>": "a@b.c",
             '"Doe, Jane" <jane@x.org>': "jane@x.org",
             "Doe, Jane <jane@x.org>": "Doe, Jane <jane@x.org>",
             "Boss <nobody>": "Boss <nobody>", "two@at@signs.com": "two@at@signs.com", "": "",
             '"a \\" < b" <q@x.org>': "q@x.org", "José <josé@x.org>": "josé@x.org",
             "a" * 3000: "a" * 3000}
    assert values(spark, list(cases), address.address_of("x")) == list(cases.values())


def test_valid_address(spark):
    cases = {"a@b.com": True, "a.b+c%d@x-y.co.uk": True, "a@b.c": False, "a@b": False, "@b.com": False,
             "a@b.com\n": False, "a b@c.com": False, "": False, "a@b.c0m": False}
    assert values(spark, list(cases), address.is_valid_address("x")) == list(cases.values())


def test_byte_distance(spark):
    pairs = {("", ""): 0, ("abc", "abc"): 0, ("abc", "ab"): 1, ("microsoft", "micros0ft"): 1,
             ("paypal", "paypa1"): 1, ("google", "g00gle"): 2, ("micrоsoft.com", "microsoft.com"): 2}
    assert values(spark, list(pairs), similarity.byte_distance("x", "y"), "x string, y string") == list(pairs.values())


def test_fixed_point_rounds_ties_to_even(spark):
    assert values(spark, [91.25, 0.125, 13.3, 1.5000000000000002], text.fixed_point("x", 1), "x double") == [
        "91.2", "0.1", "13.3", "1.5"]
    assert values(spark, [0.125, 2.1], text.fixed_point("x", 2), "x double") == ["0.12", "2.10"]


def test_risk_level(spark):
    cases = {0.0: "none", 0.29: "none", 0.30: "low", 0.50: "medium", 0.70: "high", 0.8499999: "high", 0.85: "critical"}
    assert values(spark, list(cases), risk.risk_level("x"), "x double") == list(cases.values())


def test_weighted_maximum(spark):
    def score(*threats, weights=None):
        array = F.array(*[F.struct(F.lit(t).alias("type"), F.lit(float(c)).alias("confidence")) for t, c in threats]) \
            if threats else F.array().cast("array<struct<type:string,confidence:double>>")
        return spark.range(1).select(risk.weighted_maximum(array, weights)).first()[0]

    assert score() == 0.0
    assert score(("DOMAIN_TYPOSQUATTING", 0.90)) == 1.0
    assert score(("URGENCY_FINANCIAL_LANGUAGE", 0.70), ("REPLY_TO_MISMATCH", 0.75)) == pytest.approx(0.825)
    assert score(("BEC_HR_PAYROLL_SCAM", 0.80)) == 0.80       # its weight belongs to another name
    assert score(("AUTH_FAILURES", 0.80), weights={"AUTH_FAILURES": 0}) == 0.80
    # More detections never lower the score.
    assert score(("AUTH_FAILURES", 0.8), ("REPLY_TO_MISMATCH", 0.75)) >= score(("REPLY_TO_MISMATCH", 0.75))


def test_word_lists_agree_with_single_tests(spark):
    from lurewatch import fixed_values as V
    lists = {"money": V.FINANCIAL_TERMS, "pay roll": V.ROLE_PAYROLL_TERMS, "none": (), "empty": ("", "x"),
             "nested": ("a", "aa", "aaa", "baab", "aab", "a"), "odd": ("é", "日本", "\U0001f600", "o'\\")}
    texts = ["pay", "payment", "urgent payment", "wire transfer", "transfer wire", "attached", "nothing", "", "aaa baab",
             " ".join(V.FINANCIAL_TERMS), "prepaid cards and gift cards", "é 日本語 \U0001f600 o'\\", "x" * 100_000 + "payment", None]
    want = [None if t is None else tuple(sum(term in t for term in set(listed)) for listed in lists.values()) for t in texts]
    got = values(spark, texts, lexicon.counts(F.col("x"), lists))
    assert [r if r is None else tuple(r) for r in got] == want
    every = [t for listed in lists.values() for t in listed]
    want = [None if t is None else [term for term in dict.fromkeys(every) if term in t] for t in texts]
    assert values(spark, texts, lexicon.found(F.col("x"), every)) == want
    short = [t for t in texts if t is not None]
    assert values(spark, short, text.contains_any("x", V.FINANCIAL_TERMS)) == [any(f in t for f in V.FINANCIAL_TERMS) for t in short]
    assert values(spark, short, text.contains_any("x", ())) == [False] * len(short)


def test_json_and_ids(spark):
    df = spark.createDataFrame([(["a", "b"], {"K": "v"}), ([], {}), (None, None)], "n array<string>, h map<string,string>")
    enc = df.select(codec.encode_json("n").alias("n"), codec.encode_json("h").alias("h"))
    assert [tuple(r) for r in enc.collect()] == [('["a","b"]', '{"K":"v"}'), ("[]", "{}"), ("null", "null")]
    back = enc.select(codec.decode_names("n"), codec.decode_headers("h")).collect()
    assert [tuple(r) for r in back] == [(["a", "b"], {"K": "v"}), ([], {}), (None, None)]
    bad = spark.createDataFrame([("{broken",)], "n string")
    assert bad.select(codec.decode_names("n")).first()[0] in (None, [])
    ids = values(spark, [("a", "b"), ("a", "b"), ("ab", "")], codec.derived_id("k", "x", "y"), "x string, y string")
    assert ids[0] == ids[1] != ids[2]


def test_recipients_of_several_kinds(spark):
    df = spark.createDataFrame([("1", "t", ["a", "b"], ["c"], None)],
                               "email_id string, tenant_id string, to_list array<string>, cc_list array<string>, bcc_list array<string>")
    got = extensions.recipients_table(df, to="to_list", cc="cc_list", bcc="bcc_list").collect()
    assert [(r["address"], r["type"]) for r in got] == [("a", "to"), ("b", "to"), ("c", "cc")]
