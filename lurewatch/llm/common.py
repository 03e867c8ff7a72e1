"""What the operators share: tables in the shared folder, and the package on the executors."""

import ctypes
import functools
import gc
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed import first_per_key
from ..session import shared_dir

PACKAGE = Path(__file__).resolve().parents[1]
_shipped = set()


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: later steps start from files.

    The shuffle files of the write are removed when it ends; nothing reads them again.
    """
    spark = df.sparkSession
    path, before = shared_dir(spark, label), spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        # The setting is read when a query is planned, so the plan is made anew under it.
        df.select("*").write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, as ``--py-files`` would; once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    path = Path(tempfile.mkdtemp()) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(PACKAGE.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def _give_back(collect=True):
    if collect:
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run):
    """``run``, a function of batches, as a task that gives its memory back when it ends.

    Python workers outlive their tasks and wait for later stages; what they hold meanwhile counts with the
    executor's memory.
    """
    def task(batches):
        try:
            yield from run(batches)
        finally:
            _give_back()
    return task


def tidied(of_group):
    """A function of two arguments, a group's, that gives its memory back when it ends."""
    @functools.wraps(of_group)
    def call(a, b):
        try:
            return of_group(a, b)
        finally:
            _give_back(collect=False)
    return call


def raw_hash(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def whole_row(df: DataFrame):
    """All columns as one, so that names of the operators' own columns cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def keep_rows(docs: DataFrame, stay: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows of ``docs`` whose id and raw text hash (``doc_id``, ``r``) are in ``stay``; repeated rows once."""
    rows = docs.select(whole_row(docs), F.col(doc_id).alias("_id"), raw_hash(text).alias("_r"))
    stay = stay.select(F.col("doc_id").alias("_stay"), F.col("r").alias("_stay_r"))
    rows = rows.join(stay, F.col("_id").eqNullSafe(F.col("_stay")) & (F.col("_r") == F.col("_stay_r")), "left_semi")
    return first_per_key(rows, ["_id", "_r"], [F.col("_r")]).select("row.*")
