"""The key store: same answers as a plain comparison, no shuffle of what is stored, reads that do not grow."""

import pytest
from pyspark.sql import functions as F

from lurewatch.operators import merge
from lurewatch.sources import keys as key_store


def batch(spark, first, last, **extra):
    return spark.range(first, last).select(
        F.lit("t").alias("tenant_id"), F.concat(F.lit("m"), "id").alias("provider_message_id"), F.col("id").alias("ingested_at"),
        F.lit("x" * 10).alias("body"))


def plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def ids(df):
    return sorted(int(r["provider_message_id"][1:]) for r in df.collect())


@pytest.mark.parametrize("small", [0, key_store.SMALL])
def test_known_keys_equal_a_plain_join(spark, tmp_path, small):
    folder = str(tmp_path / "keys")
    assert key_store.stored(spark, folder) is None
    odd = spark.createDataFrame([(None, "m1"), ("t", None), (None, None), ("u", "m3")], "tenant_id string, provider_message_id string")
    key_store.add(batch(spark, 0, 50), folder, "a/1")
    key_store.add(odd, folder, "b/1")
    key_store.add(batch(spark, 40, 60), folder, "a/1")     # a repeat replaces what the origin had
    stored = key_store.stored(spark, folder)
    asked = batch(spark, 30, 70).select("tenant_id", "provider_message_id").unionByName(odd)
    got = key_store.known(asked, stored, small=small)
    assert got.count() == 24 and {r[0] for r in got.collect()} == {"t", None, "u"}
    assert ids(merge.insert_if_absent(batch(spark, 30, 70), stored)) == [*range(30, 40), *range(60, 70)]
    assert ids(merge.insert_if_absent(batch(spark, 41, 59), stored)) == []
    assert key_store.known(asked, key_store.stored(spark, folder, ["a/1"])).count() == 20
    assert key_store.origins(spark, folder) == {"a/1", "b/1"}


def test_compaction_keeps_live_keys_in_one_segment(spark, tmp_path):
    folder = str(tmp_path / "keys")
    for i in range(4):
        key_store.add(batch(spark, 10 * i, 10 * i + 10), folder, f"r{i}/1")
    assert not key_store.compact(spark, folder)
    assert key_store.compact(spark, folder, ["r0/1", "r2/1", "r3/1"], least=3)
    stored = key_store.stored(spark, folder)
    assert ids(stored) == [*range(10), *range(20, 40)] and stored.select("segment").distinct().count() == 1
    assert key_store.origins(spark, folder) == {"r0/1", "r2/1", "r3/1"}
    key_store.add(batch(spark, 100, 101), folder, "r9/1")
    assert key_store.compact(spark, folder, least=1, keep=lambda rows: rows.filter("provider_message_id <> 'm100'"))
    assert 100 not in ids(key_store.stored(spark, folder))


def test_the_stored_side_is_not_shuffled(spark, tmp_path):
    folder = str(tmp_path / "keys")
    key_store.add(batch(spark, 0, 100), folder, "a/1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = batch(spark, 50, 150).withColumn("key_hash", key_store.key_hash())
        text = plan(asked.join(key_store.stored(spark, folder).select("key_hash"), "key_hash", "left_semi"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and text.count(") Exchange\n") == 1 and "Bucketed: true" in text


def test_lookups_read_no_more_as_the_store_grows(spark, tmp_path):
    """Ten equal batches into a growing store: the rows that the scan of the store gives stay about the same."""
    folder, read = str(tmp_path / "keys"), []
    for i in range(10):
        key_store.add(batch(spark, 20_000 * i, 20_000 * (i + 1)), folder, f"r{i}/1")
        key_store.compact(spark, folder, least=2)
        hashes = [r[0] for r in batch(spark, 1_000_000 + 8 * i, 1_000_000 + 8 * i + 8).select(key_store.key_hash()).collect()]
        found = key_store.stored(spark, folder).filter(F.col("key_hash").isin(hashes))
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            execution = found.select("key_hash")._jdf.queryExecution()
            execution.executedPlan().executeCollect()
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
        scan = execution.executedPlan().collectLeaves().head()
        read.append(scan.metrics().apply("numOutputRows").value())
    # Eight keys open eight pages in each of their buckets at the most, of a store that is ten times as large in the end.
    assert max(read) <= 8 * 8 * key_store.PAGE_ROWS and max(read[-3:]) <= 1.5 * max(read[2:5])
