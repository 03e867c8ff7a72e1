"""The same work on streams of landed files.

The file source's checkpoint is the sync position.  `start_store` is the exact path: each
micro-batch is validated, reduced to first arrivals, compared with everything stored, analysed and
written to a folder of its own, so a repeated batch replaces itself.  Folders are named by stream
and batch, so streams with checkpoints of their own share a store.
"""

import hashlib
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import fixed_values as V
from ..config import DEFAULT
from ..operators import detection, merge, validation
from ..operators.keyed import first_per_key
from ..schemas import MESSAGE_KEY
from ..session import PART_ROWS, removed, save, shared_dir
from ..sources import keys as key_store
from ..sources import places, tables

# Copies of one message spread over this many tasks before they meet.
SALTS = 32
BATCH_PARTS = 5


def read_stream(spark: SparkSession, path: str, schema, *, fmt="parquet", files_per_trigger=None,
                pattern=None) -> DataFrame:
    """A stream over landed files, a bounded number of files per micro-batch if wanted."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def with_event_time(stream: DataFrame, column="received_at", delay="1 day",
                    name="event_time") -> DataFrame:
    """Watermarks need a zoned timestamp."""
    return stream.withColumn(name, F.col(column).cast("timestamp")).withWatermark(name, delay)


def dedupe(stream: DataFrame, keys=MESSAGE_KEY) -> DataFrame:
    """Drop repeated keys within the watermark; the state stays bounded.

    Two steps, as streaming de-duplication has no map-side step: the first one keeps a row per
    key and slice of the input, so a message with very many copies does not end in one task.
    """
    sliced = stream.withColumn("_slice", F.spark_partition_id() % SALTS)
    return (sliced.dropDuplicatesWithinWatermark([*keys, "_slice"]).drop("_slice")
            .dropDuplicatesWithinWatermark(list(keys)))


def analyse(stream: DataFrame, users: DataFrame, config=DEFAULT, **options) -> DataFrame:
    """Detection on a stream: narrow apart from the lookup of the targeted people."""
    return detection.analyse(stream, users, config, **options)


def stream_name(checkpoint: str) -> str:
    """One name per checkpoint: with a new one, batches are counted from 0 again."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


@contextmanager
def _landed(batch: DataFrame):
    """The rows of a micro-batch in files for as long as it is worked on: made once, and chosen by their places."""
    spark, path = batch.sparkSession, shared_dir(batch.sparkSession, "batch")
    save(batch, path)
    try:
        yield places.placed(spark.read.schema(batch.schema).parquet(path))
    finally:
        removed(spark, path)


def start_store(stream: DataFrame, users: DataFrame, root: str, checkpoint: str, *,
                config=DEFAULT, as_of=None, carry=("email_id", "tenant_id", "received_at"),
                references=(), trigger=None, **options) -> StreamingQuery:
    """Store new messages' keys and analyses below ``root``, and bad rows as rejects.

    ``references`` are those of `validation.check`.  The analyses are written before the keys:
    after a failure in between, the batch is repeated and replaces its own folders, so nothing is
    lost and nothing doubles.  A batch is compared with the key store, which no batch reads whole.

    What is delivered is analysed before repeats are left out: the analyses are slim, so no text is written or shuffled.
    """
    keys, name = list(MESSAGE_KEY), stream_name(checkpoint)
    carry = (*carry, *keys)
    helpers = ("ingested_at", *[column for column, _, _ in references], "_tie", "_row_key", "reasons")

    def store(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, f"stream={name}/batch_id={batch_id}"
        key_store.compact(spark, f"{root}/keys")
        seen = key_store.stored(spark, f"{root}/keys")
        if seen is not None:
            seen = seen.filter(F.col("origin") != folder)
        judged = batch.withColumns({"_tie": merge.payload_hash(batch, keys), "_row_key": validation.row_key(batch, "provider_message_id"),
                                    "reasons": validation.violations("emails")})
        judged = detection.analyse(judged, users, config, as_of=as_of, carry=(*carry, *helpers), **options)
        with _landed(judged) as landed:
            checked = validation.with_unknown(landed, references)
            save(validation.rejected(checked, "emails", "_row_key"), f"{root}/rejects/{folder}")
            new = merge.insert_if_absent(validation.accepted(checked), seen)
            save(new.drop(*set(helpers).difference(carry, ("email_id", "received_at"))), f"{root}/analyses/{folder}")
        written = spark.read.parquet(f"{root}/analyses/{folder}")
        key_store.add(written, f"{root}/keys", folder)

    return (stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def alert_rows(analyses: DataFrame) -> DataFrame:
    """High-risk messages, one row per threat."""
    return (analyses.filter(F.col("risk_level").isin(*V.ALERT_LEVELS))
            .select("email_id", "tenant_id", "risk_value", "risk_level",
                    F.explode("detected_threats").alias("t"))
            .select("email_id", "tenant_id", "risk_value", "risk_level", "t.type", "t.confidence",
                    "t.evidence"))


def start_append(stream: DataFrame, path: str, checkpoint: str, *, fmt="parquet",
                 trigger=None) -> StreamingQuery:
    """Append a stream to files, exactly once by the file sink's log."""
    return (stream.writeStream.format(fmt).outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def risk_counts(analyses: DataFrame, event_time="event_time", span="1 hour") -> DataFrame:
    """Messages per tenant, level and time window; counted on the map side first."""
    return (analyses.groupBy(F.window(event_time, span).alias("w"), "tenant_id", "risk_level")
            .agg(F.count("*").alias("messages"))
            .select(F.col("w.start").alias("window_start"), "tenant_id", "risk_level", "messages"))


def start_update(stream: DataFrame, path: str, checkpoint: str, trigger=None) -> StreamingQuery:
    """Write the changed groups of every micro-batch to a folder of its own."""
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (stream.writeStream.outputMode("update").foreachBatch(save)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _complete_snapshots(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(f.split("/")[-2].split("=")[1]) for f in tables.folders(spark, f"{path}_snapshot/upto=*/_SUCCESS"))


def latest_state(spark: SparkSession, path: str, keys) -> DataFrame:
    """The newest value of every group written by `start_update`: the last snapshot and the batches after it."""
    snapshots = _complete_snapshots(spark, path)
    upto = snapshots[-1] if snapshots else -1
    later = [f for f in tables.folders(spark, f"{path}/batch_id=*") if int(f.rsplit("=", 1)[1]) > upto]
    parts = []
    if snapshots:
        parts.append(spark.read.parquet(f"{path}_snapshot/upto={upto}").withColumn("batch_id", F.lit(upto)))
    if later or not parts:
        parts.append(spark.read.option("basePath", path).parquet(*(later or [path])))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return first_per_key(rows, keys, (F.col("batch_id").desc(),)).drop("batch_id")


def snapshot_state(spark: SparkSession, path: str, keys, keep: int = 1) -> int:
    """Write the newest value of every group as one snapshot, so that older batches are read no more; returns its batch.

    A snapshot counts when it is complete.  The ``keep`` ones before it stay for readers that have begun.
    """
    batches = [int(f.split("/")[-2].rsplit("=", 1)[1]) for f in tables.folders(spark, f"{path}/batch_id=*/_SUCCESS")]
    upto = max(batches)
    before = _complete_snapshots(spark, path)
    if upto not in before:
        latest_state(spark, path, keys).write.mode("overwrite").parquet(f"{path}_snapshot/upto={upto}")
    for old in before[:-keep]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}_snapshot/upto={old}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return upto


def start_distinct(stream: DataFrame, root: str, checkpoint: str, *, keys=MESSAGE_KEY, arrival="ingested_at",
                   trigger=None) -> StreamingQuery:
    """Store the first row of every key, however late it comes, and count what arrived and what was a repeat.

    Unlike `dedupe` it needs no watermark: keys are kept in the key store, not in state, so no row is lost.
    """
    name = stream_name(checkpoint)

    def store(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, f"stream={name}/batch_id={batch_id}"
        key_store.compact(spark, f"{root}/keys", keys=keys)
        seen = key_store.stored(spark, f"{root}/keys", keys=keys)
        if seen is not None:
            seen = seen.filter(F.col("origin") != folder)
        # By the hash of the key, a part at a time: rows are landed to be chosen from, and a batch can be large.
        # Each part makes the batch anew.  The tie-break is made with the rows, so that they are not read whole for it.
        arrived = batch.count()
        parts = max(1, min(BATCH_PARTS, arrived // PART_ROWS))
        for i in range(parts):
            part = batch.filter(F.pmod(key_store.key_hash(keys), F.lit(parts)) == i)
            with _landed(part.withColumn("_tie", merge.payload_hash(batch, keys))) as landed:
                save(merge.insert_if_absent(landed, seen, keys, arrival).drop("_tie"), f"{root}/rows/{folder}",
                     mode="append" if i else "overwrite")
        kept = spark.read.parquet(f"{root}/rows/{folder}")
        counts = kept.agg(F.lit(arrived).cast("long").alias("arrived"), F.count("*").alias("kept"))
        save(counts.withColumn("repeated", F.col("arrived") - F.col("kept")), f"{root}/counts/{folder}")
        key_store.add(kept, f"{root}/keys", folder, keys)

    return (stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
