"""Merges, constraints and purges."""

import datetime as dt

from pyspark.sql import functions as F

from lurewatch.operators import merge, purge, recipients, reports, validation
from lurewatch.session import save


def test_first_delivery_wins_and_stored_keys_are_skipped(make):
    day = dt.datetime(2024, 1, 1)
    batch = make.emails(
        {"provider_message_id": "a", "subject": "second", "ingested_at": day + dt.timedelta(1)},
        {"provider_message_id": "a", "subject": "first", "ingested_at": day},
        {"provider_message_id": "b", "subject": "known"},
        {"provider_message_id": "a", "tenant_id": "other", "subject": "other tenant"})
    stored = make.emails({"provider_message_id": "b"})
    got = merge.insert_if_absent(batch, stored).collect()
    assert sorted(r["subject"] for r in got) == ["first", "other tenant"]


def test_tied_deliveries_do_not_depend_on_row_order(make):
    rows = [{"provider_message_id": "a", "email_id": s, "subject": s, "headers": {"h": s}} for s in "pqrst"]
    pick = lambda rs: merge.insert_if_absent(make.emails(*rs), None).first()["subject"]
    assert pick(rows) == pick(rows[::-1])


def test_one_key_with_very_many_copies(spark, make):
    many = (make.emails({"provider_message_id": "hot"})
            .withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20000)))).drop("n"))
    mixed = many.unionByName(make.emails(*[{"provider_message_id": f"m{i}"} for i in range(50)]))
    assert merge.insert_if_absent(mixed, None).count() == 51


def test_upsert(make):
    day = dt.datetime(2024, 1, 1)
    stored = make.users({"provider_user_id": "a", "role": "old", "user_id": "u-a"},
                        {"provider_user_id": "c", "role": "stays", "user_id": "u-c"})
    batch = make.users(
        {"provider_user_id": "a", "role": "new", "user_id": "x", "created_at": day + dt.timedelta(1)},
        {"provider_user_id": "b", "role": "first", "user_id": "u-b", "created_at": day},
        {"provider_user_id": "b", "role": None, "user_id": "y", "created_at": day + dt.timedelta(2)})
    got = {r["provider_user_id"]: r for r in merge.upsert_users(stored, batch).collect()}
    assert {k: (r["user_id"], r["role"]) for k, r in got.items()} == {
        "a": ("u-a", "new"), "b": ("u-b", None), "c": ("u-c", "stays")}
    assert got["b"]["created_at"] == day
    again = merge.upsert_users(merge.upsert_users(stored, batch), batch)
    assert {r["provider_user_id"]: (r["user_id"], r["role"]) for r in again.collect()} == {
        k: (r["user_id"], r["role"]) for k, r in got.items()}


def test_tenant_insert_refuses_taken_ids(spark):
    new, refused = merge.insert_new(spark.createDataFrame([("1",), ("2",)], "tenant_id string"),
                                    spark.createDataFrame([("2",)], "tenant_id string"))
    assert [r[0] for r in new.collect()] == ["1"] and [r[0] for r in refused.collect()] == ["2"]


def test_rejects_name_every_reason(spark, make):
    emails = make.emails({}, {"sender_email": None, "sender_name": "x" * 101}, {"tenant_id": "nowhere"},
                         {"user_id": None}, {"user_id": "gone"}, {"received_at": None})
    tenants = spark.createDataFrame([("t",)], "tenant_id string")
    users = spark.createDataFrame([("u",)], "user_id string")
    checked = validation.check(emails, "emails", [("tenant_id", tenants, "tenant_id"), ("user_id", users, "user_id")])
    assert sorted(r["email_id"] for r in validation.accepted(checked).collect()) == ["0", "3"]
    reasons = {r["row_key"]: r["reason"] for r in validation.rejected(checked, "emails", "email_id").collect()}
    assert reasons == {"1": "sender_email is missing; sender_name is longer than 100",
                       "2": "tenant_id is unknown", "4": "user_id is unknown", "5": "received_at is missing"}
    bad = spark.createDataFrame([("1", "n", "yahoo", "active"), ("2", None, "google", "active")],
                                "tenant_id string, name string, provider string, status string")
    checked = validation.check(bad, "tenants")
    assert {r["row_key"]: r["reason"] for r in validation.rejected(checked, "tenants", "tenant_id").collect()} == {
        "1": "unknown provider", "2": "name is missing"}


def test_shared_mailbox_does_not_multiply_messages(make):
    users = make.users({"email": "r@company.com", "role": "late", "created_at": dt.datetime(2024, 2, 1)},
                       {"email": "r@company.com", "role": "early"}, {"email": "R@company.com", "role": "other case"})
    rows = recipients.with_recipient(make.emails({}, {"recipient_email": "nobody@company.com"}), users).collect()
    assert sorted((r["email_id"], r["recipient_role"]) for r in rows) == [("0", "early"), ("1", None)]


def test_queue_and_marks(make, spark):
    emails = make.emails({"received_at": dt.datetime(2024, 1, 3)}, {"received_at": dt.datetime(2024, 1, 1)},
                         {"processed_at": dt.datetime(2024, 1, 5)}, {"tenant_id": "z", "received_at": dt.datetime(2024, 1, 2)})
    assert [r["email_id"] for r in merge.oldest_unprocessed(emails, 2).collect()] == ["1", "3"]
    assert [r["email_id"] for r in merge.oldest_unprocessed(emails, 5, "t").collect()] == ["1", "0"]
    done = spark.createDataFrame([("0", dt.datetime(2024, 1, 9)), ("0", dt.datetime(2024, 1, 8))],
                                 "email_id string, analyzed_at timestamp_ntz")
    marked = {r["email_id"]: r["processed_at"] for r in merge.mark_processed(emails, done).collect()}
    assert marked == {"0": dt.datetime(2024, 1, 8), "1": None, "2": dt.datetime(2024, 1, 5), "3": None}


def test_purge_takes_dependents(spark, make):
    emails = make.emails({"user_id": "a"}, {"user_id": "b"}, {"tenant_id": "x", "user_id": "c"})
    tables = {"tenants": spark.createDataFrame([("t",), ("x",)], "tenant_id string"),
              "users": make.users({"user_id": "a"}, {"user_id": "b"}, {"user_id": "c", "tenant_id": "x"}),
              "emails": emails, "analyses": emails.select("email_id")}
    left = purge.purge(tables, spark.createDataFrame([("x",)], "tenant_id string"),
                       spark.createDataFrame([("b",)], "user_id string"))
    assert [r[0] for r in left["tenants"].collect()] == ["t"]
    assert [r["user_id"] for r in left["users"].collect()] == ["a"]
    assert [r["email_id"] for r in left["analyses"].collect()] == ["0"]


def test_retention(make):
    emails = purge.with_month(make.emails({"received_at": dt.datetime(2023, 10, 31)}, {"received_at": dt.datetime(2023, 11, 1)}))
    assert [r["email_id"] for r in purge.retained(emails, "2024-01-15", 2).collect()] == ["1"]


def test_level_counts(spark):
    df = spark.createDataFrame([("t", "low"), ("t", "medium"), ("t", "medium"), ("u", "none")], "tenant_id string, risk_level string")
    rows = {r["tenant_id"]: r.asDict() for r in reports.level_counts(df, "tenant_id").collect()}
    assert rows["t"]["medium"] == 2 and rows["t"]["low"] == 1 and rows["u"]["none"] == 1 and rows["u"]["messages"] == 1


def test_dead_letters(spark):
    from lurewatch.operators import extensions
    rows = [("emails", "a", "1", "bad"), ("emails", "a", "2", "bad"), ("emails", "b", "1", "bad")]
    rej = spark.createDataFrame(rows, "table string, tenant_id string, row_key string, reason string")
    again = rej.filter("row_key = '1' and tenant_id = 'a'")
    got = extensions.dead_letters(rej, again.unionByName(again))
    assert {(r["tenant_id"], r["row_key"]): (r["attempts"], r["dead"]) for r in got.collect()} == {
        ("a", "1"): (3, True), ("a", "2"): (1, False), ("b", "1"): (1, False)}


def test_bad_rows_without_a_key_stay_apart(make):
    rows = make.emails({"provider_message_id": None, "subject": "x"}, {"provider_message_id": None, "subject": "y"})
    got = validation.rejected(validation.check(rows, "emails"), "emails", "provider_message_id").collect()
    assert len({r["row_key"] for r in got}) == 2 and {r["tenant_id"] for r in got} == {"t"}


def test_several_settings_for_one_rule(spark, make):
    from lurewatch.operators import detection
    rows = detection.rule_columns(make.emails({"sender_name": "The CEO"}), None)
    rules = spark.createDataFrame([("t", "display_name", True, 1.0), ("t", "display_name", False, 0.5)],
                                  "tenant_id string, rule_id string, enabled boolean, weight double")
    assert detection.apply_tenant_rules(rows, rules).first()["risk_value"] == 0.0
    on = rules.withColumn("enabled", F.lit(True)).withColumn("weight", F.col("weight") / 2)
    assert detection.apply_tenant_rules(rows, on).first()["risk_value"] == 0.85 * 0.5


def test_attachment_hashes(spark):
    from lurewatch.operators import extensions
    rows = spark.createDataFrame([("1", "a", ["x.pdf", "y.pdf"], ["same", "other"]), ("2", "b", ["z.pdf"], ["same"])],
                                 "email_id string, tenant_id string, attachment_names array<string>, bodies array<string>")
    found = extensions.attachments_table(rows, "bodies")
    copies = {r["copies"]: r["tenants"] for r in extensions.repeated_attachments(found, "content_hash").collect()}
    assert copies == {2: 2, 1: 1}


def test_lookups_skip_files_by_their_bloom_filters(spark, make, tmp_path):
    from lurewatch.sources import tables
    mail = make.emails(*[{"email_id": f"{i % 2}{i:05d}", "sender_email": f"s{i % 7}@x.org"} for i in range(400)])
    tables.write(mail, str(tmp_path), "emails", "r")

    def scanned(rows):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            execution = rows.select("email_id")._jdf.queryExecution()
            execution.executedPlan().executeCollect()
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
        return execution.executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()

    stored = tables.read(spark, str(tmp_path), "emails")
    # The absent ids and addresses lie between the smallest and the largest, so only a filter can tell.
    assert scanned(tables.email_by_id(stored, "0001x")) == 0 and scanned(tables.email_by_id(stored, "000002")) > 0
    assert scanned(stored.filter("sender_email = 's3@a.org'")) == 0
    assert [r["email_id"] for r in tables.email_by_id(stored, "000002").collect()] == ["000002"]


def test_messages_are_filed_in_parts_and_count_when_all_are_there(spark, make, tmp_path, monkeypatch):
    import pytest

    from lurewatch.sources import tables
    root, sizes, write = str(tmp_path), [], tables.save
    days = [None, *[dt.datetime(2024, 1 + i % 5, 1 + i % 20) for i in range(60)], *[dt.datetime(2024, 7, 1)] * 40]
    mail = make.emails(*[{"email_id": str(i), "received_at": d} for i, d in enumerate(days)])

    def noted(df, path, *parts, **options):
        sizes.append(df.count())
        if len(sizes) == 3 and root.endswith("broken"):
            raise OSError("disk")
        write(df, path, *parts, **options)

    monkeypatch.setattr(tables, "save", noted)
    monkeypatch.setattr(tables, "PART_ROWS", 10)
    tables.write(mail, root, "emails", "a")
    assert len(sizes) > 4 and sum(sizes) == 101 and max(sizes) < 30
    got = tables.read(spark, root, "emails")
    assert sorted(int(r["email_id"]) for r in got.collect()) == list(range(101))
    assert {r["received_month"] for r in got.collect()} == {None, *[f"2024-0{m}" for m in (1, 2, 3, 4, 5, 7)]}
    tables.write(mail.limit(0), root, "emails", "none")
    assert set(tables.versions(spark, root, "emails")) == {"a", "none"}
    sizes.clear()
    root = str(tmp_path / "broken")
    with pytest.raises(OSError):
        tables.write(mail, root, "emails", "a")
    assert tables.versions(spark, root, "emails") == {}
    tables.write(mail, root, "emails", "a")
    assert tables.read(spark, root, "emails").count() == 101


def test_a_file_keeps_repeated_texts_once(spark, tmp_path):
    """Far apart and together beyond the usual limit of a dictionary, as the bodies of a campaign are."""
    text = F.concat(*[F.sha2(F.concat(F.lit(f"{i}-"), F.col("n")), 512) for i in range(16)])
    rows = spark.range(40_000).select("id", F.pmod(F.xxhash64("id"), F.lit(2_000)).alias("n"))
    save(rows.repartition(1).select("id", text.alias("body")), str(tmp_path / "many"))
    save(rows.dropDuplicates(["n"]).repartition(1).select("id", text.alias("body")), str(tmp_path / "once"))
    many, once = (sum(f.stat().st_size for f in (tmp_path / n).glob("*.parquet")) for n in ("many", "once"))
    assert many < 1.5 * once and spark.read.parquet(str(tmp_path / "many")).select("body").distinct().count() == 2_000
