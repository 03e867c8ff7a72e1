"""Streams give what the batch gives, over several micro-batches and restarts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lurewatch import schemas
from lurewatch.operators import detection, merge
from lurewatch.streaming import jobs as streams

SENDERS = ["help@micr0soft.com", "omar@elsewhere.net", "nina@company.com"]


def messages(make, start, stop, **more):
    return make.emails(*[{
        "email_id": str(i), "provider_message_id": f"m{i}", "sender_email": SENDERS[i % 3],
        "subject": "urgent wire transfer invoice" if i % 2 else "lunch", "recipient_email": f"r{i % 4}@company.com",
        "received_at": dt.datetime(2024, 1, 1) + dt.timedelta(minutes=7 * i), **more} for i in range(start, stop)])


@pytest.fixture
def users(make):
    return make.users({"role": "CEO"}, {"role": "HR"}, {"role": ""}, {"role": "Finance"})


def result(df):
    return sorted((r["email_id"], r["risk_value"], r["risk_level"]) for r in df.collect())


def test_store_equals_batch_and_resumes(spark, make, users, tmp_path):
    land, root, check = (str(tmp_path / n) for n in ("land", "store", "check"))
    first, second = messages(make, 0, 40), messages(make, 20, 60, subject="delivered again")

    def go():
        stream = streams.read_stream(spark, land, schemas.EMAILS, files_per_trigger=1)
        streams.start_store(stream, users, root, check).awaitTermination()
        return spark.read.parquet(f"{root}/analyses")

    first.repartition(3).write.parquet(land)
    assert result(go()) == result(detection.analyse(first, users))
    second.coalesce(1).write.mode("append").parquet(land)
    got = go()
    new = merge.insert_if_absent(second, first)
    assert result(got) == result(detection.analyse(first.unionByName(new), users))
    assert got.count() == 60
    assert got.select("batch_id").distinct().count() > 2


def test_dedupe_over_micro_batches(spark, make, tmp_path):
    land, out, check = (str(tmp_path / n) for n in ("land", "out", "check"))
    messages(make, 0, 30).repartition(2).write.parquet(land)
    messages(make, 10, 40).repartition(2).write.mode("append").parquet(land)
    stream = streams.with_event_time(streams.read_stream(spark, land, schemas.EMAILS, files_per_trigger=1))
    streams.start_append(streams.dedupe(stream).drop("headers"), out, check).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 40 and got.select("email_id").distinct().count() == 40


def test_alerts_and_counts(spark, make, users, tmp_path):
    land = str(tmp_path / "land")
    mail = messages(make, 0, 60)
    mail.repartition(4).write.parquet(land)
    batch = detection.analyse(mail, users)

    stream = streams.with_event_time(streams.read_stream(spark, land, schemas.EMAILS, files_per_trigger=2))
    analysed = streams.analyse(stream, users, carry=("email_id", "tenant_id", "received_at", "event_time"))
    streams.start_append(streams.alert_rows(analysed), str(tmp_path / "alerts"), str(tmp_path / "c1")).awaitTermination()
    want = streams.alert_rows(batch)
    key = lambda df: sorted((r["email_id"], r["type"]) for r in df.collect())
    assert key(spark.read.parquet(str(tmp_path / "alerts"))) == key(want) != []

    streams.start_update(streams.risk_counts(analysed), str(tmp_path / "counts"), str(tmp_path / "c2")).awaitTermination()
    state = streams.latest_state(spark, str(tmp_path / "counts"), ("window_start", "tenant_id", "risk_level"))
    counted = batch.groupBy(F.date_trunc("hour", F.col("received_at").cast("timestamp")).alias("w"), "risk_level").count()
    assert sorted((r["window_start"], r["risk_level"], r["messages"]) for r in state.collect()) == sorted(
        (r["w"], r["risk_level"], r["count"]) for r in counted.collect())


def test_two_checkpoints_share_a_store_and_bad_rows_are_kept_apart(spark, make, users, tmp_path):
    land, root = str(tmp_path / "land"), str(tmp_path / "store")
    mail = messages(make, 0, 30).unionByName(make.emails({"provider_message_id": "bad", "sender_email": None}))
    mail.repartition(2).write.parquet(land)
    for check in ("a", "b"):
        stream = streams.read_stream(spark, land, schemas.EMAILS, files_per_trigger=1)
        streams.start_store(stream, users, root, str(tmp_path / check)).awaitTermination()
    got = spark.read.parquet(f"{root}/analyses")
    assert result(got) == result(detection.analyse(messages(make, 0, 30), users))
    rejects = {(r["row_key"], r["reason"]) for r in spark.read.parquet(f"{root}/rejects").collect()}
    assert rejects == {("bad", "sender_email is missing")}


@pytest.mark.parametrize("size", [3, 64, 65, 5000])
def test_long_trusted_lists_on_streams_and_in_batches(spark, make, tmp_path, size):
    import dataclasses

    from lurewatch.config import DEFAULT
    listed = (*(f"company{i}.example.org" for i in range(size - 2)), "microsoft.com", "paypal.com")
    config = dataclasses.replace(DEFAULT, rules=("typosquatting",), trusted_domains=listed)
    senders = ["a@micr0soft.com", "b@paypol.com", "c@microsoft.com", "d@company0.exemple.org", "e@else.net", "f@" + "x" * 200 + ".com"]
    mail = make.emails(*[{"email_id": str(i), "sender_email": s} for i, s in enumerate(senders)])
    mail.write.parquet(str(tmp_path / "land"))
    stream = streams.read_stream(spark, str(tmp_path / "land"), schemas.EMAILS)
    out = str(tmp_path / "out")
    streams.start_append(streams.analyse(stream, None, config), out, str(tmp_path / "check")).awaitTermination()
    facts = lambda df: sorted((r["email_id"], [tuple(t) for t in r["detected_threats"]]) for r in df.collect())
    want = facts(detection.analyse(mail, None, config))
    assert facts(spark.read.parquet(out)) == want
    assert [bool(t) for _, t in want] == [True, True, False, size > 2, False, False]


def test_distinct_keeps_late_rows_and_counts_repeats(spark, make, tmp_path):
    land, root = str(tmp_path / "land"), str(tmp_path / "store")
    arrivals = [messages(make, 20, 60), messages(make, 0, 30), messages(make, 0, 60)]
    for n, mail in enumerate(arrivals):
        mail.coalesce(1).write.mode("append").parquet(land)
        stream = streams.read_stream(spark, land, schemas.EMAILS)
        streams.start_distinct(stream, root, str(tmp_path / "check")).awaitTermination()
    rows, counts = spark.read.parquet(f"{root}/rows"), spark.read.parquet(f"{root}/counts")
    assert sorted(int(r["email_id"]) for r in rows.collect()) == list(range(60))
    total = counts.agg(F.sum("arrived"), F.sum("kept"), F.sum("repeated")).first()
    assert tuple(total) == (130, 60, 70)


def test_snapshots_replace_older_batches(spark, tmp_path):
    path = str(tmp_path / "counts")
    state = lambda: sorted((r["k"], r["v"]) for r in streams.latest_state(spark, path, ("k",)).collect())
    put = lambda batch, *rows: spark.createDataFrame(rows, "k string, v int").write.parquet(f"{path}/batch_id={batch}")
    put(0, ("a", 1), ("b", 1))
    put(1, ("a", 2))
    assert state() == [("a", 2), ("b", 1)] and streams.snapshot_state(spark, path, ("k",)) == 1
    put(2, ("c", 5), ("b", 7))
    want = [("a", 2), ("b", 7), ("c", 5)]
    assert state() == want
    read = streams.latest_state(spark, path, ("k",)).inputFiles()
    assert not [f for f in read if "batch_id=0" in f or "batch_id=1" in f] and [f for f in read if "batch_id=2" in f]
    assert streams.snapshot_state(spark, path, ("k",)) == 2 == streams.snapshot_state(spark, path, ("k",))
    put(3, ("a", 9))
    streams.snapshot_state(spark, path, ("k",))
    assert state() == [("a", 9), ("b", 7), ("c", 5)]
    assert not (tmp_path / "counts_snapshot" / "upto=1").exists()
