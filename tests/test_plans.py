"""The plans have the shape they are meant to have."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from lurewatch.operators import detection, merge, recipients, reports
from lurewatch.session import shared_dir
from lurewatch.workload import derive


def plan(df, mode="formatted"):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture(scope="module")
def stored(spark):
    root = shared_dir(spark, "plans")
    derive.emails(spark, SMALL).write.parquet(f"{root}/emails")
    derive.users(spark, SMALL).write.parquet(f"{root}/users")
    return spark.read.parquet(f"{root}/emails"), spark.read.parquet(f"{root}/users")


def test_detection_is_one_narrow_stage_if_the_directory_is_small(stored):
    text = plan(detection.analyse(*stored))
    assert "BroadcastHashJoin LeftOuter BuildRight" in text and "SortMergeJoin" not in text
    message_side = text[:text.index("BroadcastExchange")]
    assert "Exchange" not in re.sub("BroadcastExchange", "", message_side.split("== Physical Plan ==")[1])
    # All word lists are one pass over the text, before the join.
    assert len(re.findall(r"\(\d+\) ArrowEvalPython", text)) == 1 and "Contains(_text" not in text


def test_text_is_dropped_before_a_shuffle(stored, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(detection.analyse(*stored))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in text
    exchanges = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: (\[.*?\])", text)
    assert exchanges and not any("body_preview" in e or "_text" in e or "headers" in e for e in exchanges)


def test_a_filter_on_the_tenant_reaches_the_scan(stored):
    text = plan(detection.analyse(*stored).filter("tenant_id = '7'"))
    assert "EqualTo(tenant_id,7)" in text
    assert "EqualTo(tenant_id,7)" in plan(reports.top_of_tenant(detection.analyse(*stored), "7"))


def test_weights_are_broadcast(stored, spark):
    weights = spark.createDataFrame([("AUTH_FAILURES", 1.0)], "type string, weight double")
    threats = detection.threats_long(detection.analyse(*stored))
    text = plan(detection.score_long(stored[0], threats, weights), "simple")
    assert "BroadcastHashJoin [type" in text and "SortMergeJoin [type" not in text


def test_long_top_lists_rank_in_slices_first(stored, spark):
    emails, _ = stored
    top = reports.latest_of_tenants(emails, 1001)
    assert plan(top).count("Window") > plan(reports.latest_of_tenants(emails, 5000)).count("Window") / 2
    many = emails.select(F.lit("t").alias("tenant_id"), "email_id", "received_at")
    got = [r["email_id"] for r in reports.latest_of_tenants(many, 1001).orderBy("rank").collect()]
    want = [r["email_id"] for r in many.orderBy(F.col("received_at").desc(), "email_id").limit(1001).collect()]
    assert got == want


def test_a_filter_on_the_level_does_not_scan_texts_again(stored):
    once = plan(detection.analyse(*stored))
    filtered = plan(detection.analyse(*stored).filter("risk_level = 'high'"))
    for_text = lambda p: len(re.findall(r"\(\d+\) ArrowEvalPython", p))
    assert for_text(filtered) == for_text(once) == 1


def test_only_needed_columns_are_read(stored):
    emails, _ = stored
    text = plan(reports.senders(emails))
    schema = re.search(r"ReadSchema: struct<(.*?)>\n", text).group(1)
    assert schema == "tenant_id:string,sender_email:string,received_at:timestamp_ntz,has_attachments:boolean"


def test_filters_reach_the_scan(stored):
    emails, _ = stored
    assert "EqualTo(sender_email" in plan(reports.messages_of_sender(emails, "3", "x@y.org"))
    analyses = emails.select(F.col("email_id"), F.col("tenant_id"), F.col("subject").alias("risk_level"))
    assert "In(subject" in plan(reports.high_risk(analyses)) or "subject IN" in plan(reports.high_risk(analyses))


def test_top_lists_do_not_sort_everything(stored):
    emails, users = stored
    assert "TakeOrderedAndProject" in plan(merge.oldest_unprocessed(emails, 100))
    text = plan(reports.latest_of_tenants(emails))
    assert text.count("WindowGroupLimit") >= 2
    assert plan(recipients.directory(users)).count("WindowGroupLimit") >= 2


def test_insert_if_absent_shuffles_no_wide_rows_but_those_that_repeat(stored):
    emails, _ = stored
    text = plan(merge.insert_if_absent(derive.deliveries(emails), emails.limit(10)))
    exchanges = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: (\[.*?\])", text)
    # One exchange ranks the repeated rows, after the join with the keys that repeat.
    assert sum("body_preview" in e for e in exchanges) == 1
    assert text.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in text


def test_insert_if_absent_moves_no_column_that_nobody_asks_for(spark, stored):
    emails, _ = stored
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # as with more keys than Spark broadcasts
    try:
        rows = merge.insert_if_absent(derive.deliveries(emails), emails.limit(10)).select("email_id", "subject")
        exchanges = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: (\[.*?\])", plan(rows))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert exchanges and not any("body_preview" in e or "headers" in e for e in exchanges)
