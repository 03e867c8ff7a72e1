"""The stored tables: Parquet folders, one version per write of a run.

``<root>/<table>/run=<id>/v=<number>/`` holds what one run added.  A write that failed left no
``_SUCCESS`` mark and is not read.  Repeating a run writes a new version, which replaces the
older one when it is complete; numbers grow over all runs of a table, so they also tell which
run was written last.  What is derived from a table (analyses, alerts) carries the number of the
version it was derived from: a version without its analyses is waiting.

Messages and analyses are filed by month of receipt and sorted by tenant within the files, so that
reports skip files by tenant statistics; a folder per tenant would make very many small files.
Users are a full version per run, of which the last written is current.
"""

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.purge import with_month
from ..session import PART_ROWS, PARTS, save, shuffles_removed
from . import places

MARKED = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
LEAST_SPLITS = "spark.sql.files.minPartitionNum"
ID_PARTS = 4
UNSHUFFLED_PARTS = 10    # messages from files that are more parts than that are not shuffled; each task then writes a file a month
TASK_ROWS = 500_000    # messages that a task sorts by month, at most or so
RUN, VERSION, MONTH = "run", "v", "received_month"
ORDER = (MONTH, "tenant_id", "received_at")
FILED = {
    "emails": schemas.EMAILS,
    "fraud_analyses": T.StructType([*schemas.ANALYSES.fields,
                                    T.StructField("received_at", T.TimestampNTZType()),
                                    T.StructField("risk_value", T.DoubleType()),
                                    T.StructField("rule_version", T.StringType())]),
}
PLAIN = {"tenants": schemas.TENANTS, "users": schemas.USERS}
REJECTS = T.StructType([T.StructField(n, T.StringType()) for n in ("table", "tenant_id", "row_key", "reason")])
SKIPPED = T.StructType([T.StructField("tenant_id", T.StringType()), T.StructField("messages", T.LongType())])
DEAD = T.StructType([*REJECTS.fields[:3], T.StructField("attempts", T.LongType()),
                     T.StructField("reason", T.StringType()), T.StructField("dead", T.BooleanType())])
# Columns that single rows are looked up by: their files get Bloom filters.
LOOKED_UP = {"emails": ("email_id", "sender_email"), "fraud_analyses": ("email_id",)}
# Rejected rows whole, as they would have been stored, and those that were taken later.
QUARANTINE = T.StructType([*REJECTS.fields, T.StructField("row", T.VariantType())])
RELEASED = T.StructType([*REJECTS.fields[:3], T.StructField("row_hash", T.LongType())])
POSITIONS = T.StructType([T.StructField("tenant_id", T.StringType()), T.StructField("user_id", T.StringType()),
                          T.StructField("synced_to", T.TimestampNTZType())])
OTHER = {"skipped": SKIPPED, "dead_letters": DEAD, "quarantine": QUARANTINE, "released": RELEASED, "positions": POSITIONS}


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Existing paths that match."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return [s.getPath().toString() for s in found]


def versions(spark: SparkSession, root: str, table: str) -> dict[str, int]:
    """The number of the newest complete version of every run, in the order they were written."""
    newest = {}
    for mark in folders(spark, f"{root}/{table}/{RUN}=*/{VERSION}=*/_SUCCESS"):
        run, version = mark.split("/")[-3].split("=", 1)[1], int(mark.split("/")[-2].split("=", 1)[1])
        newest[run] = max(version, newest.get(run, 0))
    return dict(sorted(newest.items(), key=lambda x: (x[1], x[0])))


def complete_runs(spark: SparkSession, root: str, table: str) -> list[str]:
    """Ids of the runs that were written completely, the last written at the end."""
    return list(versions(spark, root, table))


def _schema(table):
    fields = FILED[table].fields if table in FILED else (
        PLAIN.get(table) or OTHER.get(table) or REJECTS).fields
    extra = [T.StructField(RUN, T.StringType()), T.StructField(VERSION, T.IntegerType())]
    month = [T.StructField(MONTH, T.StringType())] if table in FILED else []
    return T.StructType([*fields, *extra, *month])


def read(spark: SparkSession, root: str, table: str, runs=None, with_places=False) -> DataFrame:
    """The rows of the given runs (default all complete ones), with ``run`` and month columns, and places if wanted."""
    known = versions(spark, root, table)
    runs = [r for r in (known if runs is None else runs) if r in known]
    if not runs:
        none = spark.createDataFrame([], _schema(table)).drop(VERSION)
        return places.nowhere(none) if with_places else none
    rows = (spark.read.option("basePath", f"{root}/{table}").schema(_schema(table))
            .parquet(*[f"{root}/{table}/{RUN}={r}/{VERSION}={known[r]}" for r in runs]))
    return (places.placed(rows) if with_places else rows).drop(VERSION)


def current(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The last written version of a table that is rewritten per run."""
    return read(spark, root, table, complete_runs(spark, root, table)[-1:]).drop(RUN)


def _parts(rows: DataFrame, parts=None, least=None, by="email_id") -> list:
    """Conditions that cut ``rows`` into up to ``parts`` parts: runs of months, and large months by their messages' ids."""
    parts, least = parts or PARTS, least or PART_ROWS
    months = sorted(map(tuple, rows.groupBy(MONTH).agg(F.count("*")).collect()), key=lambda m: (m[0] or "", m[1]))
    size = max(least, -(-sum(n for _, n in months) // parts))
    conditions, open_run, held = [], [], 0
    for month, n in months:
        if n > size:
            cuts = -(-n // size)
            slot = F.pmod(F.xxhash64(by), F.lit(cuts))
            conditions += [F.col(MONTH).eqNullSafe(F.lit(month)) & (slot == i) for i in range(cuts)]
            continue
        if open_run and held + n > size:
            conditions.append(_one_of(open_run))
            open_run, held = [], 0
        open_run.append(month)
        held += n
    return [*conditions, _one_of(open_run)] if open_run or not conditions else conditions


def file_parts(filed: DataFrame) -> list[DataFrame]:
    """Filed rows with places in parts of whole files, so that no file is read twice: runs of months, and large months by file."""
    return [filed.filter(part) for part in _parts(filed, by=places.FILE)]


def id_parts(rows: DataFrame) -> list:
    """Conditions that cut messages, and what belongs to them, into up to ``ID_PARTS`` parts by the message's id.

    Each part reads all rows, so that there are fewer of them.
    """
    cuts = max(1, min(ID_PARTS, -(-rows.count() // PART_ROWS)))
    slot = F.pmod(F.xxhash64("email_id"), F.lit(cuts))
    return [slot == i for i in range(cuts)]


def _one_of(months):
    some = F.col(MONTH).isin([m for m in months if m is not None])
    return F.coalesce(some, F.lit(False)) | F.col(MONTH).isNull() if None in months else some


@contextmanager
def _tasks(spark, n):
    """Scans are divided for as many tasks as it gives: few, as each writes a file a month, but none of far too many rows."""
    cores = spark.sparkContext.defaultParallelism
    tasks = cores * -(-n // (cores * TASK_ROWS))
    before = spark.conf.get(LEAST_SPLITS, None)
    spark.conf.set(LEAST_SPLITS, str(tasks))
    try:
        yield tasks
    finally:
        if before is None:
            spark.conf.unset(LEAST_SPLITS)
        else:
            spark.conf.set(LEAST_SPLITS, before)


def write(df: DataFrame | list[DataFrame], root: str, table: str, run_id: str, version: int | None = None) -> int:
    """Write a version of one run's rows, which may come in parts; returns its number.

    Filed tables are rebalanced by month: adaptive execution splits a large month over many
    files and merges small ones.  Messages are filed in parts, of which the last one marks the version as complete.
    Rows with places, which come straight from files, are read once: they are filed in one part or, if they are many,
    without being shuffled, each task sorting its own.
    """
    frames = df if isinstance(df, list) else [df]
    spark = frames[0].sparkSession
    if version is None:
        version = 1 + max(versions(spark, root, table).values(), default=0)
    target = f"{root}/{table}/{RUN}={run_id}/{VERSION}={version}"
    if table in FILED:
        options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in LOOKED_UP[table]}
        options["parquet.bloom.filter.adaptive.enabled"] = "true"   # as large as its values need
        placed = len(frames) == 1 and places.has_place(frames[0])
        if placed and (n := frames[0].count()) > UNSHUFFLED_PARTS * PART_ROWS:
            with _tasks(spark, n) as tasks:
                save(_by_month(frames[0], table).coalesce(tasks).sortWithinPartitions(*ORDER), target, MONTH, **options)
            return version
        parts = []
        for frame in frames:
            rows = _by_month(frame, table)
            parts += [rows.filter(part) for part in _parts(rows)] if table == "emails" and not placed else [rows]
        for i, part in enumerate(parts):
            save(part.hint("rebalance", F.col(MONTH)).sortWithinPartitions(*ORDER), target, MONTH, mode="append" if i else "overwrite",
                 **{MARKED: str(i == len(parts) - 1).lower()}, **options)
    else:
        save(df, target)
    return version


def _by_month(rows, table):
    return with_month(rows).select(*FILED[table].fieldNames(), MONTH)


def write_alerts(alerts: list[DataFrame], root: str, run_id: str, version: int) -> None:
    """Alerts as JSON lines for whatever notifies people, packed: a message's lines repeat most of each other.

    They come in parts, of which the last one marks the version as complete.
    """
    for i, part in enumerate(alerts):
        with shuffles_removed(part.sparkSession):
            writer = part.select("*").write.mode("append" if i else "overwrite").options(
                **{"compression": "gzip", MARKED: str(i == len(alerts) - 1).lower()})
            writer.json(f"{root}/alerts/{RUN}={run_id}/{VERSION}={version}")


def drop_run(spark: SparkSession, root: str, table: str, run_id: str) -> None:
    """Delete all versions of a run."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{table}/{RUN}={run_id}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_replaced(spark: SparkSession, root: str, table: str) -> list[str]:
    """Delete versions that a newer complete one has replaced; returns their folders."""
    known, gone = versions(spark, root, table), []
    for folder in folders(spark, f"{root}/{table}/{RUN}=*/{VERSION}=*"):
        run, version = (part.split("=", 1)[1] for part in folder.split("/")[-2:])
        if int(version) < known.get(run, 0):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
            gone.append(folder)
    return gone


def _move(spark, source, target):
    """Put the complete folder ``source`` in the place of ``target``."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (target, source))
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(old, True)
    if not fs.rename(new, old):
        raise OSError(f"cannot move {source}")


def rewrite_folders(spark: SparkSession, base: str, pattern: str, keep, affected) -> None:
    """Write those folders anew that hold rows to be removed; the others are not touched.

    What is left is written beside and then takes the folder's place; a move that a failure stopped is done first.
    """
    staging = f"{base.rstrip('/')}_rewritten"
    for mark in folders(spark, f"{staging}/{pattern}/_SUCCESS"):
        done = mark.rsplit("/", 1)[0]
        _move(spark, done, base.rstrip("/") + done.split(staging, 1)[1])
    for folder in folders(spark, f"{base}/{pattern}"):
        rows = spark.read.parquet(folder)
        if affected(rows):
            part = folder.split(base.rstrip("/"), 1)[1]
            keep(rows).write.mode("overwrite").parquet(f"{staging}{part}")
            _move(spark, f"{staging}{part}", f"{base.rstrip('/')}{part}")


def tenant_by_id(tenants: DataFrame, tenant_id) -> DataFrame:
    """No row or one."""
    return tenants.filter(F.col("tenant_id") == tenant_id)


def email_by_id(emails: DataFrame, email_id) -> DataFrame:
    """No row or one; the test reaches the file scan, where Bloom filters skip what cannot hold it."""
    return emails.filter(F.col("email_id") == email_id)
