"""The piece-wise join finds exactly what comparing all pairs finds."""

import random

import pytest

from lurewatch.config import DEFAULT
from lurewatch.operators import detection, lookalikes


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


def similar(a, b):
    x, y = a.encode(), b.encode()
    s = (1.0 - float(distance(x, y)) / float(max(len(x), len(y)))) * 100
    return a != b and 85 < s < 100


def mutate(rng, domain, edits):
    chars = list(domain)
    for _ in range(edits):
        i = rng.randrange(len(chars) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            chars.insert(i, rng.choice("abcxyz0é"))
        elif kind == 1 and len(chars) > 1:
            del chars[min(i, len(chars) - 1)]
        else:
            chars[min(i, len(chars) - 1)] = rng.choice("abcxyz0é")
    return "".join(chars)


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_all_pairs(spark, seed):
    rng = random.Random(seed)
    trusted = sorted({"".join(rng.choice("abcde") for _ in range(rng.randint(1, 40))) + rng.choice(
        [".com", ".org", ".co.uk", ""]) for _ in range(60)})
    domains = sorted({mutate(rng, rng.choice(trusted), rng.randint(0, 7)) for _ in range(400)} - {""})
    want = {(d, i) for d in domains for i, t in enumerate(trusted) if similar(d, t)}
    assert len(want) > 50
    got = lookalikes.similar_domains(spark.createDataFrame([(d,) for d in domains], "domain string"),
                                     lookalikes.trusted_frame(spark, trusted))
    assert {(r["domain"], r["pos"]) for r in got.collect()} == want
    first = lookalikes.first_match(spark.createDataFrame([(d,) for d in domains], "domain string"),
                                   lookalikes.trusted_frame(spark, trusted))
    best = {}
    for d, i in want:
        best[d] = min(i, best.get(d, i))
    assert {(r["domain"], r["pos"]) for r in first.collect()} == set(best.items())


def test_join_form_of_the_rule_equals_the_inline_form(spark, make):
    import dataclasses
    senders = ["help@micr0soft.com", "a@paypol.com", "b@gooogle.com", "x@y.org", "nobody", "info@micrоsoft.com"]
    emails = make.emails(*[{"sender_email": s} for s in senders * 3])
    config = dataclasses.replace(DEFAULT, rules=("typosquatting",))
    inline = detection.rule_columns(emails, None, config)
    joined = detection.rule_columns(emails, None, config,
                                    trusted=lookalikes.trusted_frame(spark, config.trusted_domains))
    key = lambda df: sorted((r["email_id"], str(r["_threat_typosquatting"])) for r in df.collect())
    assert key(inline) == key(joined) and len(key(inline)) == 18
