"""Curves, calibration, experiments, digests and word lists by tenant, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lurewatch import fixed_values as V
from lurewatch.operators import extensions, tenant_lexicon, tuning


def judged(spark, n=200, seed=1):
    rng = random.Random(seed)
    rows = [(str(i), rng.choice([0.0, 0.25, 0.5, 0.75, 1.0, rng.random()]), rng.random() < 0.4) for i in range(n)]
    scores = spark.createDataFrame([(i, s) for i, s, _ in rows] + [("unreviewed", 0.9)], "email_id string, risk_value double")
    return rows, scores, spark.createDataFrame([(i, c) for i, _, c in rows] + [("gone", True)], "email_id string, confirmed boolean")


@pytest.mark.parametrize("slices", [1, 4, 50])
def test_curve_at_every_score(spark, slices):
    rows, scores, reviews = judged(spark)
    got = {r.bound: (r.flagged, r.confirmed, r.missed) for r in tuning.curve(scores, reviews, slices).collect()}
    want = {}
    for bound in {s for _, s, _ in rows}:
        hits = [c for _, s, c in rows if s >= bound]
        want[bound] = len(hits), sum(hits), sum(c for *_, c in rows) - sum(hits)
    assert got == want


def test_curve_without_reviews(spark):
    _, scores, reviews = judged(spark, 3)
    assert tuning.curve(scores, reviews.limit(0)).count() == 0
    none = reviews.withColumn("confirmed", F.lit(False))
    assert {r.recall for r in tuning.curve(scores, none).collect()} == {None}


def test_calibration_never_falls(spark):
    rows, scores, reviews = judged(spark)
    got = sorted((r.risk_value, r.probability) for r in tuning.calibrated(scores, reviews).collect())
    assert len(got) == 201 and all(a[1] <= b[1] + 1e-12 for a, b in zip(got, got[1:]))
    # Pool adjacent violators in plain Python.
    blocks = []
    for score in sorted({s for _, s, _ in rows}):
        own = [c for _, s, c in rows if s == score]
        blocks.append([sum(own), len(own), [score]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2] + last[2]]
    want = {s: hits / n for hits, n, scores_ in blocks for s in scores_}
    assert all(p == pytest.approx(want[s]) for s, p in got if s in want)


def test_arms_are_steady_and_scored_by_their_weights(spark, make):
    mail = make.emails(*[{"email_id": str(i), "subject": "urgent wire transfer, confidential, ceo approved today"} for i in range(300)])
    heavy = {**V.WEIGHTS, "URGENCY_FINANCIAL_LANGUAGE": 0.01}
    rows = tuning.experiment(mail, None, heavy, share=0.25).collect()
    assert 40 < sum(r.arm == "b" for r in rows) < 110
    values = {arm: {r.risk_value for r in rows if r.arm == arm} for arm in "ab"}
    assert len(values["a"]) == len(values["b"]) == 1 and min(values["a"]) > max(values["b"])
    row = tuning.compared(tuning.experiment(mail, None, heavy, share=0.25)).first()
    assert row.n_a + row.n_b == 300 and row.share_b < row.share_a and row.z < -5
    assert tuning.compared(tuning.experiment(mail.limit(0), None, heavy)).first().z is None


def test_digests_join_bursts(spark):
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    rows = [("t", "a", at(0), 0.7), ("t", "a", at(20), 0.9), ("t", "a", at(44), 0.8), ("t", "a", at(69), 0.6), ("t", "b", at(1), 0.5),
            ("u", "a", at(2), 0.5)]
    got = extensions.alert_digests(spark.createDataFrame(rows, "tenant_id string, sender_email string, received_at timestamp, risk_value double"))
    assert sorted((r.tenant_id, r.sender_email, r.messages, r.risk_value) for r in got.collect()) == [
        ("t", "a", 1, 0.6), ("t", "a", 3, 0.9), ("t", "b", 1, 0.5), ("u", "a", 1, 0.5)]


@pytest.mark.parametrize("at_a_time", [1, 2, 1000])
def test_each_tenant_has_its_own_words(spark, make, at_a_time):
    terms = [("t", "money", "Wire"), ("t", "money", "wire transfer"), ("t", "haste", "now"), ("u", "money", "now"), ("u", "x", ""),
             ("u", "x", None), ("t", "money", "wire")]
    mail = make.emails({"subject": "WIRE transfer now"}, {"tenant_id": "u", "subject": "wire transfer know"}, {"subject": "nothing"},
                       {"tenant_id": "v", "subject": "wire"}, {"subject": None, "body_preview": None})
    listed = spark.createDataFrame(terms, "tenant_id string, list string, term string")
    got = sorted(tuple(r) for r in tenant_lexicon.counts(mail, listed, at_a_time).collect())
    assert got == [("0", "t", "haste", 1), ("0", "t", "money", 2), ("1", "u", "money", 1)]
    assert tenant_lexicon.counts(mail, listed.limit(0)).count() == 0
