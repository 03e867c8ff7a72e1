"""Session helpers: the shared scratch folder and tables kept there for a while."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Only a local session may do without that setting; it then gets a temporary
    folder, which is recorded as the session's checkpoint folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


# Wide rows are worked on in up to so many parts, so that only one part's working files are there at a time.
PARTS = 8
PART_ROWS = 100_000    # rows of a part at least
# Texts come again and again (campaigns, second deliveries): a file keeps each once, if they are up to so many bytes.
# Parquet decides by the first page (1 MB) of a column: where no text comes again within it, texts are written as before.
DICTIONARY = 32 << 20
# Row groups are what a scan can be divided into, and packed texts would let them become very long.
GROUP_ROWS = 250_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Shuffle files of the queries planned within are removed when a query ends, not when the driver collects garbage."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def save(df: DataFrame, path: str, *parts: str, mode="overwrite", **options) -> None:
    """Write ``df`` as Parquet in the place of what is there, leaving no shuffle files behind.

    Texts are most of a message, and zstd packs them in about two thirds of what the default takes.
    """
    with shuffles_removed(df.sparkSession):
        # The setting is read when a query is planned, so the plan is made anew under it.
        writer = df.select("*").write.mode(mode).options(
            **{"compression": "zstd", "parquet.dictionary.page.size": str(DICTIONARY),
               "parquet.block.row.count.limit": str(GROUP_ROWS), **options})
        (writer.partitionBy(*parts) if parts else writer).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder that this job has written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def for_a_while(df: DataFrame, label: str):
    """``df`` written to the shared folder and read back, until the block ends."""
    path = shared_dir(df.sparkSession, label)
    save(df, path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        removed(df.sparkSession, path)


def materialised(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    It is computed once, and Spark then knows its size: it broadcasts a small one by itself and
    shuffles a large one.
    """
    path = shared_dir(df.sparkSession, label)
    save(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
