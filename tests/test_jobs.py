"""The batch jobs on landed files: repeatable, complete, and tolerant of bad rows."""

import dataclasses
import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lurewatch import schemas
from lurewatch.config import DEFAULT
from lurewatch.operators import detection, extensions
from lurewatch.plans import jobs
from lurewatch.sources import landing, tables
from lurewatch.workload import queries

NOW = dt.datetime(2024, 1, 10)


@pytest.fixture
def landed(spark, tmp_path):
    """The demonstration tenants: two people in one, one in the other, and some bad rows."""
    root = str(tmp_path / "landed")
    users = {
        "microsoft": [("ms", "user-1", "nils.berg@company.com", "Nils Berg", "CFO", NOW),
                      ("ms", "user-2", "nina.falk@company.com", "Nina Falk", "HR Director", NOW),
                      ("nowhere", "user-9", "x@y.org", "X", "", NOW)],
        "google": [("go", "g-7", "rita@second.example", "Rita Lund", "CEO", NOW)]}
    ms = {"provider_message_id": "a-1", "subject": "Urgent: the deposit",
          "sender_email": "leo@outer-mail.org", "sender_name": "CEO Leo Stern",
          "recipient_email": "nils.berg@company.com", "received_at": NOW - dt.timedelta(hours=1),
          "body_preview": "The wire transfer has to leave immediately", "tenant_id": "ms"}
    go = {"provider_message_id": "b-1", "subject": "An invoice is open",
          "from_header": "Billing Desk <billing@companyy.com>", "sender_name": "billing@companyy.com",
          "recipient_email": "rita@second.example", "received_at": NOW - dt.timedelta(hours=2), "tenant_id": "go",
          "body_preview": "The invoice of March waits for its payment, an immediate one. "
                          "A wire transfer is best, it is urgent.",
          "headers": {"Reply-To": "drop@gmail.com"}, "provider_user_id": "g-7"}
    # Both mailboxes of the first tenant deliver the same message id.
    messages = {"microsoft": [{**ms, "provider_user_id": "user-1", "ingested_at": NOW},
                              {**ms, "provider_user_id": "user-2", "ingested_at": NOW + dt.timedelta(seconds=1)},
                              {**ms, "provider_message_id": "bad", "provider_user_id": "user-1", "sender_email": None},
                              {**ms, "provider_message_id": "stray", "provider_user_id": "user-7"},
                              {**ms, "provider_message_id": "old", "provider_user_id": "user-1",
                               "received_at": NOW - dt.timedelta(days=8)}],
                "google": [go]}
    for p in users:
        spark.createDataFrame(users[p], schemas.LANDED_USERS).write.parquet(f"{root}/users/provider={p}")
        schema = schemas.LANDED_MESSAGES[p]
        rows = [tuple({"has_attachments": False, "headers": {}, "ingested_at": NOW, **m}.get(f) for f in schema.fieldNames())
                for m in messages[p]]
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/messages/provider={p}")
    return root


@pytest.fixture
def tenants(spark):
    rows = [("ms", "First Co.", "microsoft", "active", NOW, NOW), ("go", "Second Co.", "google", "active", NOW, NOW)]
    return spark.createDataFrame(rows, schemas.TENANTS)


def test_whole_run(spark, landed, tenants, tmp_path):
    root = str(tmp_path / "tables")
    top = jobs.run_all(spark, landed, root, "0001", tenants, as_of="2024-01-10 00:00:00").collect()
    by_tenant = {r["tenant_id"]: r for r in top}
    assert len(top) == 2 and all(r["risk_level"] == "critical" and r["risk_value"] == 1.0 for r in top)
    threats = {t: {x["type"]: round(x["confidence"], 2) for x in r["detected_threats"]} for t, r in by_tenant.items()}
    assert threats == {
        "ms": {"DISPLAY_NAME_MISMATCH": 0.85, "URGENCY_FINANCIAL_LANGUAGE": 0.76, "BEC_CSUITE_TARGETING": 0.9},
        "go": {"URGENCY_FINANCIAL_LANGUAGE": 0.88, "REPLY_TO_MISMATCH": 0.75, "BEC_CSUITE_TARGETING": 0.9}}
    mail = tables.read(spark, root, "emails")
    assert {(r["tenant_id"], r["sender_email"]) for r in mail.collect()} == {
        ("ms", "leo@outer-mail.org"), ("go", "billing@companyy.com")}
    rejects = {(r["table"], r["tenant_id"], r["row_key"]): r["reason"] for r in tables.read(spark, root, "rejects").collect()}
    assert rejects == {("users", "nowhere", "user-9"): "tenant_id is unknown", ("emails", "ms", "bad"): "sender_email is missing",
                       ("emails", "ms", "stray"): "user_id is unknown"}
    assert [tuple(r)[:2] for r in tables.read(spark, root, "skipped").collect()] == [("ms", 1)]
    alerts = spark.read.json(f"{root}/alerts")
    assert alerts.count() == 6 and alerts.filter("type = 'BEC_CSUITE_TARGETING'").count() == 2

    # A second sync adds nothing, keeps the users and finds nothing to analyse twice.
    before = {tuple(r) for r in tables.current(spark, root, "users").collect()}
    jobs.seed_tenants(spark, root, "0002", tenants)
    jobs.ingest(spark, landed, root, "0002", as_of="2024-01-10 00:00:00")
    assert tables.read(spark, root, "tenants").count() == 2
    assert tables.read(spark, root, "emails").count() == 2
    assert {tuple(r) for r in tables.current(spark, root, "users").collect()} == before
    assert jobs.detect(spark, root) == ["0002"] and jobs.detect(spark, root) == []
    assert tables.read(spark, root, "fraud_analyses").count() == 2

    # Repeating the first run replaces its own folder.
    jobs.ingest(spark, landed, root, "0001", as_of="2024-01-10 00:00:00")
    assert tables.read(spark, root, "emails").count() == 2
    mail = tables.read(spark, root, "emails")
    one = mail.first()["email_id"]
    assert tables.email_by_id(mail, one).count() == 1 and tables.tenant_by_id(tenants, "zz").count() == 0


def test_unfinished_runs_are_not_read(spark, make, tmp_path):
    root = str(tmp_path)
    tables.write(make.emails({}), root, "emails", "0001")
    (tmp_path / "emails" / "run=0002" / "v=2" / "received_month=2024-01").mkdir(parents=True)
    assert tables.complete_runs(spark, root, "emails") == ["0001"]
    assert tables.read(spark, root, "emails").count() == 1


def contents(spark, root):
    return {t: sorted(tuple(map(str, r)) for r in tables.read(spark, root, t).drop("run").collect())
            for t in ("tenants", "emails", "fraud_analyses")}


def test_a_repeat_changes_nothing(spark, landed, tenants, tmp_path):
    root = str(tmp_path / "tables")
    doubled = tenants.unionByName(tenants)
    jobs.run_all(spark, landed, root, "0001", doubled).collect()
    once = contents(spark, root)
    assert len(once["tenants"]) == 2 and len(once["emails"]) == 3
    top = jobs.run_all(spark, landed, root, "0001", doubled)
    assert contents(spark, root) == once and top.count() == 3
    assert tables.read(spark, root, "tenant_rejects").count() == 2
    for table in ("emails", "fraud_analyses"):
        assert len(tables.drop_replaced(spark, root, table)) == 1
    assert contents(spark, root) == once and jobs.detect(spark, root) == []


def test_a_repeated_ingest_is_analysed_again(spark, landed, tenants, tmp_path):
    root = str(tmp_path / "tables")
    jobs.seed_tenants(spark, root, "9", tenants)
    jobs.ingest(spark, landed, root, "9", providers=("google",))
    assert jobs.detect(spark, root) == ["9"] and tables.read(spark, root, "fraud_analyses").count() == 1
    jobs.ingest(spark, landed, root, "10")
    jobs.ingest(spark, landed, root, "9")
    assert jobs.detect(spark, root) == ["10", "9"]
    assert tables.read(spark, root, "fraud_analyses").count() == tables.read(spark, root, "emails").count() == 3
    # The users are those of the run written last, whatever its id.
    assert tables.complete_runs(spark, root, "users") == ["10", "9"]
    assert tables.current(spark, root, "users").count() == 3


def test_a_failure_between_analyses_and_alerts_is_made_up_for(spark, landed, tenants, tmp_path, monkeypatch):
    root = str(tmp_path / "tables")
    jobs.seed_tenants(spark, root, "1", tenants)
    jobs.ingest(spark, landed, root, "1")

    def fail(*_):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(tables, "write_alerts", fail)
        with pytest.raises(OSError):
            jobs.detect(spark, root)
    assert jobs.detect(spark, root) == ["1"] and spark.read.json(f"{root}/alerts").count() > 0
    assert tables.read(spark, root, "fraud_analyses").count() == 3


def test_alerts_are_packed_in_parts_and_replaced_ones_go(spark, landed, tenants, tmp_path, monkeypatch):
    root = str(tmp_path / "tables")
    jobs.seed_tenants(spark, root, "1", tenants)
    jobs.ingest(spark, landed, root, "1")
    jobs.detect(spark, root)
    once = sorted(map(str, spark.read.json(f"{root}/alerts").collect()))
    monkeypatch.setattr(tables, "PART_ROWS", 1)
    for _ in range(2):
        jobs.ingest(spark, landed, root, "1")
        jobs.detect(spark, root)
    folders = list((tmp_path / "tables" / "alerts").glob("run=*/v=*"))
    assert len(folders) == 1 and (folders[0] / "_SUCCESS").exists()
    files = list(folders[0].glob("part-*"))
    assert len(files) > 1 and all(f.name.endswith(".json.gz") for f in files)
    repeated = spark.read.json(f"{root}/alerts")
    assert sorted(map(str, repeated.drop("run", "v").collect())) == sorted(
        map(str, spark.read.json(str(folders[0])).collect()))
    assert len(once) > 1 and repeated.count() == len(once) and jobs.detect(spark, root) == []


def test_alerts_in_parts_pair_all_rows_of_an_id(spark, make, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "PART_ROWS", 1)
    root, lure = str(tmp_path), {"email_id": "0", "sender_email": "help@micr0soft.com", "subject": "urgent wire transfer",
                                 "headers": {"Authentication-Results": "spf=fail; dkim=fail; dmarc=fail"}}
    tables.write(make.emails(lure, {**lure, "received_at": dt.datetime(2023, 1, 1)}, {}), root, "emails", "1")
    tables.write(make.users({}), root, "users", "1")
    jobs.detect(spark, root)
    whole = extensions.alerts(tables.read(spark, root, "fraud_analyses"), tables.read(spark, root, "emails"))
    assert spark.read.json(f"{root}/alerts").count() == whole.count() > 0


def test_exports_read_once_are_removed(spark, landed, tenants, tmp_path):
    import shutil
    root, copy = str(tmp_path / "tables"), str(tmp_path / "copy")
    shutil.copytree(landed, copy)
    jobs.seed_tenants(spark, root, "1", tenants)
    queries._ingest_once(spark, copy, root, "1")
    assert not (tmp_path / "copy").exists() and tables.read(spark, root, "emails").count() == 3


def test_missing_and_unknown_provider_folders_are_rejects(spark, landed, tenants, tmp_path):
    import shutil
    root, part = str(tmp_path / "tables"), str(tmp_path / "part")
    shutil.copytree(f"{landed}/users/provider=google", f"{part}/users/provider=google")
    shutil.copytree(f"{landed}/messages/provider=google", f"{part}/messages/provider=carrier")
    jobs.seed_tenants(spark, root, "1", tenants)
    for _ in range(2):
        jobs.ingest(spark, part, root, "1")
    rejects = {(r["table"], r["row_key"], r["reason"]) for r in tables.read(spark, root, "rejects").collect()}
    assert rejects == {("users", "microsoft", "nothing landed"), ("emails", "microsoft", "nothing landed"),
                       ("emails", "google", "nothing landed"), ("emails", "carrier", "unknown provider")}
    assert tables.read(spark, root, "users").count() == 1 and tables.read(spark, root, "emails").count() == 0
    for run in ("2", "3"):
        jobs.ingest(spark, part, root, run)
    dead = tables.current(spark, root, "dead_letters").collect()
    assert {(r["row_key"], r["attempts"], r["dead"]) for r in dead if r["table"] == "emails"} == {
        ("microsoft", 3, True), ("google", 3, True), ("carrier", 3, True)}


def test_purge_and_retention_of_the_stored_tables(spark, landed, tenants, tmp_path):
    root = str(tmp_path / "tables")
    jobs.run_all(spark, landed, root, "1", tenants).collect()
    jobs.purge_stored(spark, root, tenants=tenants.filter("tenant_id = 'go'"))
    assert {r[0] for t in ("tenants", "users", "emails", "fraud_analyses")
            for r in tables.read(spark, root, t).select("tenant_id").collect()} == {"ms"}
    assert spark.read.json(f"{root}/alerts").filter("tenant_id = 'go'").count() == 0 and jobs.detect(spark, root) == []
    one = tables.current(spark, root, "users").filter("provider_user_id = 'user-1'")
    jobs.purge_stored(spark, root, users=one)
    assert tables.read(spark, root, "emails").count() == tables.read(spark, root, "fraud_analyses").count() == 0
    assert tables.current(spark, root, "users").count() == 1


def test_retention(spark, make, tmp_path):
    root = str(tmp_path)
    tables.write(make.emails({}, {"received_at": dt.datetime(2023, 1, 1)}), root, "emails", "1")
    tables.write(make.users({}), root, "users", "1")
    jobs.detect(spark, root)
    jobs.retain_stored(spark, root, "2024-02-01", 3)
    assert [r["email_id"] for r in tables.read(spark, root, "fraud_analyses").collect()] == ["0"]
    assert tables.read(spark, root, "emails").count() == 1 and jobs.detect(spark, root) == []
    assert {r["rule_version"] for r in tables.read(spark, root, "fraud_analyses").collect()} == {"1"}


def test_look_back_is_strict_and_reaches_the_scan(spark, landed):
    bound = landing.look_back("2024-01-10 00:00:00")
    rows = landing.all_messages(spark, landed, received_after=bound)
    assert {r["provider_message_id"] for r in rows.collect()} == {"a-1", "bad", "stray", "b-1"}
    plan = spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")
    assert "GreaterThan(received_at" in plan


def test_preview_is_optional(spark, landed):
    full = landing.all_messages(spark, landed).agg(F.max(F.length("body_preview"))).first()[0]
    cut = landing.all_messages(spark, landed, preview_characters=10).agg(F.max(F.length("body_preview"))).first()[0]
    assert full > 10 and cut == 10


def test_sync_position_per_user(spark, make):
    stored = make.emails({"user_id": "a", "received_at": dt.datetime(2024, 1, 2)})
    new = make.emails({"user_id": "a", "received_at": dt.datetime(2024, 1, 2)},
                      {"user_id": "a", "received_at": dt.datetime(2024, 1, 3)},
                      {"user_id": "b", "received_at": dt.datetime(2024, 1, 1)},
                      {"user_id": "b", "received_at": dt.datetime(2023, 1, 1)})
    bound = F.lit("2023-12-31 00:00:00").cast("timestamp_ntz")
    assert sorted(r["email_id"] for r in landing.newer_than_stored(new, stored, bound).collect()) == ["1", "2"]


def test_queue_batch(make):
    emails = make.emails(*[{"received_at": dt.datetime(2024, 1, 30 - i)} for i in range(5)])
    got = jobs.detect_oldest(emails, make.users({}), n=2).collect()
    assert sorted(r["email_id"] for r in got) == ["3", "4"]
    rest = jobs.detect_oldest(emails, make.users({}), emails.limit(0).select("email_id"), n=10).collect()
    assert len(rest) == 5


def test_own_analyses_can_be_stored(spark, make, tmp_path):
    config = dataclasses.replace(DEFAULT, version="mine")
    tables.write(detection.analyse(make.emails({"subject": "urgent wire transfer"}), None, config), str(tmp_path), "fraud_analyses", "r")
    assert [r["rule_version"] for r in tables.read(spark, str(tmp_path), "fraud_analyses").collect()] == ["mine"]


def test_benchmark_runs(spark):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import bench
    times, _, messages = bench.measured(spark, "/root/testdata/sf0.001", 1)
    assert messages > 0 and {"detect", "insert_absent_only", "alerts"} <= times.keys()


def _land(spark, landed, kind, provider, rows, schema):
    full = [tuple({"has_attachments": False, "headers": {}, "ingested_at": NOW, **m}.get(f) for f in schema.fieldNames()) for m in rows]
    spark.createDataFrame(full, schema).write.mode("append").parquet(f"{landed}/{kind}/provider={provider}")


def _mail(**columns):
    return {"tenant_id": "ms", "provider_user_id": "user-1", "subject": "s", "sender_email": "a@b.org", "sender_name": "n",
            "recipient_email": "nils.berg@company.com", "received_at": NOW, "body_preview": "b", **columns}


def test_a_rejected_message_is_stored_when_its_user_arrives(spark, landed, tenants, tmp_path):
    root = str(tmp_path / "tables")
    jobs.seed_tenants(spark, root, "1", tenants)
    jobs.ingest(spark, landed, root, "1")
    held = {r["row_key"] for r in jobs.quarantined(spark, root).collect()}
    assert {"bad", "stray", "user-9"} <= held
    jobs.replay(spark, root, "2")
    assert tables.read(spark, root, "emails", ["2"]).count() == 0 and len(held) == jobs.quarantined(spark, root).count()
    _land(spark, landed, "users", "microsoft", [{"tenant_id": "ms", "provider_user_id": "user-7", "email": "late@company.com",
                                                 "display_name": "Late", "role": "", "created_at": NOW}], schemas.LANDED_USERS)
    nowhere = spark.createDataFrame([("nowhere", "Third", "microsoft", "active", NOW, NOW)], schemas.TENANTS)
    jobs.seed_tenants(spark, root, "3", nowhere)
    before = tables.read(spark, root, "emails").count()
    for _ in range(2):   # a replay can be repeated
        jobs.ingest(spark, landed, root, "4", as_of="2000-01-01 00:00:00", look_back_days=-10_000)  # users only
        jobs.replay(spark, root, "5")
        stored = tables.read(spark, root, "emails")
        assert [r["provider_message_id"] for r in stored.filter("run = '5'").collect()] == ["stray"]
        assert stored.count() == before + 1
        row = stored.filter("run = '5'").first()
        assert row["received_at"] == NOW - dt.timedelta(hours=1) and row["body_preview"].startswith("The wire transfer")
    assert {r["row_key"] for r in jobs.quarantined(spark, root).collect()} == {"bad"}
    assert "x@y.org" in {r["email"] for r in tables.current(spark, root, "users").collect()}
    jobs.ingest(spark, landed, root, "6")      # delivered again: known
    assert tables.read(spark, root, "emails", ["6"]).count() == 0
    assert "stray" not in {r["row_key"] for r in tables.read(spark, root, "dead_letters", ["6"]).collect()}


def test_sync_positions_and_late_mail(spark, landed, tenants, tmp_path, monkeypatch):
    root, schema = str(tmp_path / "tables"), schemas.LANDED_MESSAGES["microsoft"]
    jobs.seed_tenants(spark, root, "1", tenants)
    jobs.ingest(spark, landed, root, "1", incremental=True)
    stored = lambda: sorted(r["provider_message_id"] for r in tables.read(spark, root, "emails").collect())
    assert stored() == ["a-1", "b-1", "old"]
    marks = {r["user_id"]: r["synced_to"] for r in jobs.positions(spark, root).collect()}
    assert sorted(marks.values()) == [NOW - dt.timedelta(hours=h) for h in (2, 1, 1)]
    _land(spark, landed, "users", "microsoft", [{"tenant_id": "ms", "provider_user_id": "user-3", "email": "third@company.com",
                                                 "display_name": "Third", "role": "", "created_at": NOW}], schemas.LANDED_USERS)
    _land(spark, landed, "messages", "microsoft", [
        _mail(provider_message_id="new", received_at=NOW + dt.timedelta(days=1)),
        _mail(provider_message_id="late", received_at=NOW - dt.timedelta(days=2)),
        _mail(provider_message_id="too late", received_at=NOW - dt.timedelta(days=30)),
        _mail(provider_message_id="fresh user", provider_user_id="user-3", received_at=NOW - dt.timedelta(days=300)),
        _mail(provider_message_id="untimed", received_at=None)], schema)
    write = tables.write
    monkeypatch.setattr(tables, "write", lambda df, root, table, *a, **k: (_ for _ in ()).throw(OSError("stopped"))
                        if table == "positions" else write(df, root, table, *a, **k))
    with pytest.raises(OSError):   # stopped between the rows and the marks
        jobs.ingest(spark, landed, root, "2", incremental=True, overlap_days=7)
    monkeypatch.undo()
    assert {r["user_id"]: r["synced_to"] for r in jobs.positions(spark, root).collect()} == marks
    jobs.ingest(spark, landed, root, "3", incremental=True, overlap_days=7)
    assert stored() == ["a-1", "b-1", "fresh user", "late", "new", "old"]
    assert max(r["synced_to"] for r in jobs.positions(spark, root).collect()) == NOW + dt.timedelta(days=1)
    assert "untimed" in {r["row_key"] for r in tables.read(spark, root, "rejects", ["3"]).collect()}


def test_keys_that_a_failure_kept_out_are_added(spark, landed, tenants, tmp_path):
    from lurewatch.sources import keys
    root = str(tmp_path / "tables")
    jobs.seed_tenants(spark, root, "1", tenants)
    jobs.ingest(spark, landed, root, "1")
    assert keys.origins(spark, f"{root}/email_keys") == {"1/1"}
    for mark in (Path(root) / "email_keys" / "_marks").iterdir():
        mark.unlink()
    jobs.ingest(spark, landed, root, "2")
    assert tables.read(spark, root, "emails", ["2"]).count() == 0
    assert keys.origins(spark, f"{root}/email_keys") == {"1/1", "2/2"}


def test_a_purge_leaves_nothing_anywhere(spark, landed, tenants, tmp_path, make):
    from lurewatch.sources import keys
    from lurewatch.streaming import jobs as streams
    root, store = str(tmp_path / "tables"), str(tmp_path / "store")
    jobs.run_all(spark, landed, root, "1", tenants)
    only = str(tmp_path / "only")
    _land(spark, only, "messages", "google", [{**_mail(provider_message_id="b-9", provider_user_id="g-7", tenant_id="go"),
                                               "from_header": "a@b.org"}], schemas.LANDED_MESSAGES["google"])
    jobs.ingest(spark, only, root, "2", providers=("google",))
    jobs.detect(spark, root)
    for n, tenant in enumerate(("go", "ms", "both")):
        rows = [{"tenant_id": t, "provider_message_id": f"{n}{t}{i}", "sender_email": None if i == 2 else "a@b.org"}
                for t in (("go", "ms") if tenant == "both" else (tenant,)) for i in range(3)]
        make.emails(*rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "land"))
        stream = streams.read_stream(spark, str(tmp_path / "land"), schemas.EMAILS)
        streams.start_store(stream, make.users({}), store, str(tmp_path / "check")).awaitTermination()
    files = lambda *parts: {p.relative_to(Path(root).parent): p.stat().st_mtime for part in parts
                            for p in Path(part).rglob("*.parquet")}
    run_2 = files(f"{root}/emails/run=2", f"{root}/fraud_analyses/run=2")
    batches = files(f"{store}/analyses")
    jobs.purge_stored(spark, root, spark.createDataFrame([("ms",)], "tenant_id string"), streams=[store])
    for table in ("tenants", "users", "emails", "fraud_analyses", "rejects", "quarantine", "dead_letters", "positions", "released"):
        rows = tables.current(spark, root, table) if table == "users" else tables.read(spark, root, table)
        assert rows.filter("tenant_id = 'ms'").count() == 0, table
    assert {r["tenant_id"] for r in keys.stored(spark, f"{root}/email_keys").collect()} == {"go"}
    assert {r["tenant_id"] for r in keys.stored(spark, f"{store}/keys").collect()} == {"go"}
    for table in ("analyses", "rejects"):
        assert {r["tenant_id"] for r in spark.read.parquet(f"{store}/{table}").collect()} == {"go"}
    # Runs and batches without the tenant keep their files.
    assert files(f"{root}/emails/run=2", f"{root}/fraud_analyses/run=2") == run_2
    untouched = [p for p in batches if files(f"{store}/analyses").get(p) == batches[p]]
    assert untouched and len(untouched) < len(batches)
    assert not [p for p in Path(root).rglob("*.parquet") if "ms" in p.read_bytes().decode("latin1").split("nils.berg")[1:]]
    streams.start_store(streams.read_stream(spark, str(tmp_path / "land"), schemas.EMAILS), make.users({}), store,
                        str(tmp_path / "check2")).awaitTermination()


def test_repeats_keep_one_replaced_version(spark, landed, tenants, tmp_path):
    root = str(tmp_path / "tables")
    jobs.run_all(spark, landed, root, "0001", tenants)
    once = contents(spark, root)
    for _ in range(2):
        jobs.run_all(spark, landed, root, "0001", tenants)
    assert contents(spark, root) == once
    for table in ("emails", "fraud_analyses"):
        assert len(tables.folders(spark, f"{root}/{table}/run=0001/v=*")) == 2
