"""The keys of what is stored, in hash buckets: batches find repeats without shuffling or rereading all of them.

``<folder>/segment=<name>/`` holds the keys of one write (its origin), in ``BUCKETS`` files sorted by the key's hash; a
compaction writes many segments as one.  The folder is declared to Spark as a bucketed external table, so a join
by the hash needs no exchange of the stored side.  A small batch looks its hashes up: the list reaches the scan,
which opens the buckets and pages that can hold them: at most a page for each hash and bucket, however large the store.

A segment is written before its mark, and a repeated write replaces it, so a failure leaves nothing half known.
Keys are told apart by the key itself; NULL equals NULL.
"""

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MESSAGE_KEY
from ..session import materialised, shuffles_removed

BUCKETS = 32
PAGE_ROWS = 200        # keys of a page, the least that a lookup reads
SMALL = 200            # keys of a batch that are looked up one by one; Parquet filters nest as deep as their lists are long
COMPACT_FROM = 16      # segments from which on they are written as one
IN_LIST = "spark.sql.parquet.pushdown.inFilterThreshold"


def key_hash(keys=MESSAGE_KEY):
    return F.xxhash64(*keys)


def _name(folder: str) -> str:
    return "stored_keys_" + hashlib.sha256(folder.rstrip("/").encode()).hexdigest()[:20]


def _path(spark, path):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _segments(spark, folder) -> list[str]:
    """Names of the segments that were written completely."""
    path, fs = _path(spark, f"{folder}/_marks/*")
    return sorted(s.getPath().getName() for s in fs.globStatus(path) or [])


def _declared(spark: SparkSession, folder: str, keys) -> str:
    name = _name(folder)
    path, fs = _path(spark, folder)
    fs.mkdirs(path)
    columns = ", ".join(f"`{k}` STRING" for k in keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (key_hash BIGINT, {columns}, origin STRING, segment STRING) USING parquet "
              f"OPTIONS ('parquet.page.row.count.limit'='{PAGE_ROWS}') PARTITIONED BY (segment) CLUSTERED BY (key_hash) "
              f"SORTED BY (key_hash) INTO {BUCKETS} BUCKETS LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)
    return name


def stored(spark: SparkSession, folder: str, origins=None, keys=MESSAGE_KEY) -> DataFrame | None:
    """Keys of complete segments, of the given origins only; None if there are none."""
    segments = _segments(spark, folder)
    if not segments:
        return None
    rows = spark.table(_declared(spark, folder, keys)).filter(F.col("segment").isin(segments))
    return rows if origins is None else rows.filter(F.col("origin").isin(list(origins)))


def origins(spark: SparkSession, folder: str) -> set[str]:
    """Origins whose keys are stored, as their marks tell."""
    found = set()
    for segment in _segments(spark, folder):
        path, fs = _path(spark, f"{folder}/_marks/{segment}")
        stream = fs.open(path)
        found.update(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split("\n"))
        stream.close()
    return found


def _write(rows: DataFrame, folder: str, segment: str, told, keys) -> None:
    spark = rows.sparkSession
    name = _declared(spark, folder, keys)
    view = f"{name}_{segment}"
    rows.select("key_hash", *keys, "origin").repartition(BUCKETS, "key_hash").createOrReplaceTempView(view)
    with shuffles_removed(spark):
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (segment = '{segment}') SELECT * FROM {view}")
    spark.catalog.dropTempView(view)
    path, fs = _path(spark, f"{folder}/_marks/{segment}")
    out = fs.create(path, True)
    out.write("\n".join(sorted(told)).encode())
    out.close()


def add(rows: DataFrame, folder: str, origin: str, keys=MESSAGE_KEY) -> None:
    """Store the keys of ``rows`` as those of ``origin``, instead of what it had."""
    segment = "s" + hashlib.sha256(origin.encode()).hexdigest()[:20]
    _write(rows.select(key_hash(keys).alias("key_hash"), *keys, F.lit(origin).alias("origin")), folder, segment, [origin], keys)


def compact(spark: SparkSession, folder: str, live=None, keys=MESSAGE_KEY, least=COMPACT_FROM, keep=None) -> bool:
    """Write all segments as one if there are ``least`` of them, keeping the ``live`` origins, and what ``keep`` leaves, only.

    The new segment is complete before the old ones go; until then keys are there twice, which is harmless.
    """
    segments = _segments(spark, folder)
    if len(segments) < max(1, least):
        return False
    told = origins(spark, folder)
    kept = told if live is None else told & set(live)
    rows = stored(spark, folder, kept, keys).dropDuplicates(["key_hash", *keys, "origin"])
    rows = rows if keep is None else keep(rows)
    merged = "m" + hashlib.sha256("\n".join(segments).encode()).hexdigest()[:20]
    # Spark does not write into a table that it reads from.
    _write(materialised(rows, "merged-keys"), folder, merged, kept, keys)
    name = _name(folder)
    for segment in segments:
        if segment != merged:
            mark, fs = _path(spark, f"{folder}/_marks/{segment}")
            fs.delete(mark, False)
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (segment = '{segment}')")
            old, fs = _path(spark, f"{folder}/segment={segment}")
            fs.delete(old, True)
    return True


def known(batch_keys: DataFrame, stored_keys: DataFrame, keys=MESSAGE_KEY, small=SMALL) -> DataFrame:
    """Those of ``batch_keys`` that are stored, written."""
    spark = batch_keys.sparkSession
    batch = batch_keys.select(*keys, key_hash(keys).alias("key_hash"))
    same = reduce(lambda x, y: x & y, [F.col(f"b.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys],
                  F.col("b.key_hash") == F.col("s.key_hash"))
    few = [r[0] for r in batch.select("key_hash").limit(small + 1).collect()]
    if len(few) <= small:
        stored_keys = stored_keys.filter(F.col("key_hash").isin(few))
    before = spark.conf.get(IN_LIST)
    spark.conf.set(IN_LIST, str(small))   # lists of that length reach the pages of the files
    try:
        return materialised(batch.alias("b").join(stored_keys.alias("s"), same, "left_semi").drop("key_hash"), "known-keys")
    finally:
        spark.conf.set(IN_LIST, before)
