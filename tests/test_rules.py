"""Every rule on small messages: one detection type or none per case."""

import dataclasses

import pytest

from lurewatch import fixed_values as V
from lurewatch.config import DEFAULT
from lurewatch.operators import detection

ONE_DOMAIN = dataclasses.replace(DEFAULT, internal_domains=("company.com",))


def run(make, rule, cases, config=ONE_DOMAIN, users=None, **options):
    """[(type, confidence, evidence) or None] in the order of the cases."""
    emails = make.emails(*[c[0] for c in cases])
    config = dataclasses.replace(config, rules=(rule,))
    rows = detection.rule_columns(emails, users, config, **options).collect()
    column = f"_threat_{rule}"
    found = {r["email_id"]: r[column] for r in rows}
    assert len(rows) == len(cases)
    return [None if found[str(i)] is None else tuple(found[str(i)]) for i in range(len(cases))]


def check(make, rule, cases, **options):
    got = run(make, rule, cases, **options)
    assert [g and g[0] for g in got] == [c[1] for c in cases]
    return got


BEC = [
    ("CEO", "m@outer-mail.org", "URGENT, about the deposit",
     "The wire transfer for the deposit has to leave immediately", "BEC_CSUITE_TARGETING", 0.90),
    ("CFO", "n@elsewhere.net", "urgent: one payment is open",
     "send the wire transfer asap", "BEC_CSUITE_TARGETING", 0.90),
    ("Finance Manager", "o@elsewhere.net", "our invoice",
     "the payment can go out as a wire transfer", "BEC_FINANCE_TARGETING", 0.85),
    ("HR Director", "p@gmail.com", "bulletin de paie",
     "il manque le bulletin de salaire de deux personnes", "BEC_HR_PAYROLL_SCAM", 0.80),
    ("Software Engineer", "q@elsewhere.net", "urgent payment today",
     "the wire transfer is due immediately", None, None),
    ("CEO", "nina@company.com", "urgent wire transfer for you", "the payment waits for a signature", None, None),
    (None, "r@elsewhere.net", "an urgent wire transfer", "payment by noon", None, None),
    # Substrings: the role holds "coo", the text holds "now".
    ("Coordinator", "a@external.com", "know", "", "BEC_HIGH_VALUE_TARGET", 0.70),
    ("", "a@external.com", "urgent payment", "", None, None),
    ("Budget Analyst", "a@external.com", "urgent", "", "BEC_HIGH_VALUE_TARGET", 0.70),
    ("DRH", "a@external.com", "déclaration de revenus", "", "BEC_HR_PAYROLL_SCAM", 0.80),
    ("Président Directeur Général", "nobody", "Virement", "à faire immédiatement", "BEC_CSUITE_TARGETING", 0.90),
    ("Comptable", "a@external.com", "relevé d'identité bancaire", "", "BEC_FINANCE_TARGETING", 0.85),
]


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_role_targeting(spark, make, threshold):
    users = make.users(*[{"email": f"r{i}@company.com", "role": c[0]} for i, c in enumerate(BEC) if c[0] is not None])
    cases = [({"recipient_email": f"r{i}@company.com" if c[0] is not None else "ghost@company.com",
               "sender_email": c[1], "subject": c[2], "body_preview": c[3]}, c[4]) for i, c in enumerate(BEC)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = check(make, "role_targeting", cases, users=users)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [g and g[1] for g in got] == [c[5] for c in BEC]
    assert got[0][2].startswith("Executive recipient (CEO) + external sender")
    assert got[11][2].startswith("Executive recipient (Président Directeur Général)")


def test_display_name(make):
    hit = "DISPLAY_NAME_MISMATCH"
    got = check(make, "display_name", [
        ({"sender_name": "Rita Lund CEO", "sender_email": "m@outer-mail.org"}, hit),
        ({"sender_name": "Rita Lund CEO", "sender_email": "rita@company.com"}, None),
        ({"sender_name": "Omar Haddad", "sender_email": "omar@elsewhere.net"}, None),
        ({"sender_name": "Nils Berg, CFO", "sender_email": "nils@elsewhere.net"}, hit),
        ({"sender_name": "CEO", "sender_email": "ops@eu.company.com"}, hit),
        ({"sender_name": "Director", "sender_email": "nobody"}, hit),
        ({"sender_name": "Marceo Rossi", "sender_email": "m@x.org"}, hit),
        ({"sender_name": "CTO", "sender_email": "m@x.org"}, None),
        ({"sender_name": None, "sender_email": None}, None),
    ])
    assert got[0][1] == 0.85
    assert got[0][2] == ("Display name 'Rita Lund CEO' contains executive title but sender domain "
                         "'outer-mail.org' is external")


def test_typosquatting(make):
    hit = "DOMAIN_TYPOSQUATTING"
    config = dataclasses.replace(ONE_DOMAIN, trusted_domains=("microsoft.com", "paypal.com"))
    cases = [({"sender_email": s}, t) for s, t in (
        ("news@microsoft.com", None), ("help@micr0soft.com", hit), ("help@micorsoft.com", None),
        ("desk@paypol.com", hit), ("one@far-away.net", None),
        ("info@micrоsoft.com", hit),    # Cyrillic о: 2 of 14 bytes
        ("Desk@MICR0SOFT.com", hit), ("one@two@micr0soft.com", None), ("nobody", None))]
    got = check(make, "typosquatting", cases, config=config)
    assert got[1][2] == ("Sender domain 'micr0soft.com' is 92.3% similar to trusted domain "
                         "'microsoft.com' (potential typosquatting)")
    assert "85.7%" in got[5][2]


def test_typosquatting_takes_the_first_and_goes_on_after_an_exact_match(make):
    config = dataclasses.replace(ONE_DOMAIN, trusted_domains=("paypal1.com", "paypal.com", "paypall.com"))
    got = run(make, "typosquatting", [({"sender_email": "a@paypal.com"},), ({"sender_email": "a@paypal1.com"},)],
              config=config)
    assert "'paypal1.com' (pot" in got[0][2] and "'paypal.com' (pot" in got[1][2]


def test_auth_failures(make):
    hit = "AUTH_FAILURES"
    got = check(make, "auth_failures", [
        ({"headers": {"Received-SPF": "fail"}}, None),
        ({"headers": {"Received-SPF": "softfail", "Authentication-Results": "dkim=fail"}}, hit),
        ({"headers": {"Authentication-Results": "spf=fail dmarc=fail"}}, None),
        ({"headers": {"Authentication-Results": "DKIM=FAIL DMARC=FAIL"}}, hit),
        ({"headers": {"received-spf": "fail", "Authentication-Results": "dkim=fail"}}, None),
        ({"headers": {"Received-SPF": "Fail", "Authentication-Results": "dkim=fail; dmarc=fail"}}, hit),
        ({"headers": None}, None),
    ])
    assert got[1][1:] == (0.80, "Email authentication failures: SPF_FAIL, DKIM_FAIL")
    assert got[5][2].endswith("SPF_FAIL, DKIM_FAIL, DMARC_FAIL")


def test_urgency_financial(make):
    hit = "URGENCY_FINANCIAL_LANGUAGE"
    every = " ".join([*V.URGENCY_TERMS, *V.FINANCIAL_TERMS, *V.AUTHORITY_TERMS])
    got = check(make, "urgency_financial", [
        ({"subject": "URGENT deposit",
          "body_preview": "The wire transfer to the bank account has to leave immediately"}, hit),
        ({"subject": "Invoice of May", "body_preview": "The invoice for the garden work is attached."}, None),
        ({"subject": "before lunch today", "body_preview":
          "Get four gift card codes for iTunes, it is urgent: asap, says the CEO"}, hit),
        ({"subject": "Urgent: can we talk today", "body_preview": "The plan for the garden is late."}, None),
        # The threshold case that fires only in double arithmetic.
        ({"subject": "urgent ceo president director approved authorized confidential"}, hit),
        ({"subject": "swift fund invoice"}, None),
        ({"subject": every}, hit),
        ({"subject": None, "body_preview": None}, None),
        ({"subject": "wire", "body_preview": "x" * 5000 + " wire transfer invoice ceo"}, hit),
    ])
    assert got[0][1] > 0.6
    assert got[4][1] == pytest.approx(0.70) and got[6][1] == 0.95
    assert got[4][2] == ("High-risk language detected (score: 1.50): 1 urgency, 0 financial, 6 authority keywords")


def test_reply_to(make):
    hit = "REPLY_TO_MISMATCH"
    got = check(make, "reply_to", [({"sender_email": s, "headers": h}, t) for s, h, t in (
        ("nina@company.com", {"Reply-To": "nina@company.com"}, None),
        ("rita@company.com", {"Reply-To": "drop@gmail.com"}, hit),
        ("nina@company.com", {"Reply-To": "info@firm-office.com"}, None),
        ("nina@company.com", {}, None),
        ("nina@company.com", {"Reply-To": "Chief <c@gmail.com>"}, None),
        ("a@gmail.com", {"Reply-To": "b@gmail.com"}, None),
        ("Rita@Company.com", {"Reply-To": "DROP@Yahoo.com"}, hit),
        ("nobody", {"Reply-To": "x@aol.com"}, hit))])
    assert got[6][1:] == (0.75, "Sender: rita@company.com, Reply-To: drop@yahoo.com"
                                " (free email service, redirects responses)")


def test_attachments(make):
    high, odd, macro = ("HIGH_RISK_ATTACHMENT", "SUSPICIOUS_ATTACHMENT_NAME",
                        "MEDIUM_RISK_ATTACHMENT_WITH_URGENCY")

    def case(names, expected, subject="", flag=True):
        return ({"attachment_names": names, "has_attachments": flag, "subject": subject}, expected)

    got = check(make, "attachments", [
        case(["scan.pdf.exe"], high), case(["notes.v1.pdf"], odd),
        case(["a.doc"], None), case(["a.doc"], macro, "today"), case(["a.docx"], None, "today"),
        case(["a.doc", "b.tar.gz"], odd), case(["r.v1.pdf", "x.exe"], odd),
        case(["a.exe"], None, flag=False), case(None, None), case([], None),
        case(["Plan.PDF", "X.EXE"], high), case([None, "run.bat"], high),
        case(["a.xlsm"], macro, "right away"), case(["a.doc"], None, "hurry"),
    ])
    assert got[0][1:] == (0.90, "High-risk attachment type: scan.pdf.exe")
    assert got[10][2] == "High-risk attachment type: X.EXE"


def test_integration_message(make):
    emails = make.emails({
        "subject": "Urgent wire transfer of today", "sender_name": "Rita Lund, CEO",
        "sender_email": "rita@outer-mail.org",
        "body_preview": "The wire transfer has to leave immediately, the payment is late.",
        "headers": {"Reply-To": "drop@gmail.com", "Received-SPF": "fail"}})
    row = detection.analyse(emails, None, ONE_DOMAIN).first()
    assert [t["type"] for t in row["detected_threats"]] == [
        "DISPLAY_NAME_MISMATCH", "URGENCY_FINANCIAL_LANGUAGE", "REPLY_TO_MISMATCH"]
    assert row["risk_value"] == 1.0 and row["risk_level"] == "critical"
    assert str(row["risk_score"]) == "1.0000"


def test_no_threat_gives_zero_and_an_empty_list(make):
    row = detection.analyse(make.emails({"subject": "lunch"}), make.users({})).first()
    assert (row["risk_value"], row["risk_level"], row["detected_threats"]) == (0.0, "none", [])


def test_added_rule_counts_with_default_weight(make):
    from pyspark.sql import functions as F

    from lurewatch.operators import rules
    from lurewatch.operators.rules.base import Rule
    rule = Rule("everything", ("EVERYTHING",), lambda config: F.struct(
        F.lit("EVERYTHING").alias("type"), F.lit(0.5).alias("confidence"), F.lit("x").alias("evidence")))
    rules.register(rule)
    try:
        row = detection.analyse(make.emails({}), None).first()
        assert row["risk_value"] == 0.5 and row["risk_level"] == "medium"
    finally:
        del rules.REGISTRY["everything"]
