"""Rows of Parquet files by their place, so that wide rows are chosen where they are read.

A place is a file and a row number in it.  Which rows are wanted is found on slim columns; the places found are
packed to one bit per row, and these bitmaps are broadcast to the scan instead of shuffling the rows to the keys.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialised

FILE, ROW = "_file", "_row"
PLACE = (FILE, ROW)
BLOCK = 32768          # rows of a bitmap, as Spark's bitmap functions have them


def placed(files: DataFrame) -> DataFrame:
    """The rows of Parquet files with their places."""
    return files.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW))


def nowhere(none: DataFrame) -> DataFrame:
    """The columns of `placed` for a table without rows."""
    return none.select("*", F.lit(None).cast("string").alias(FILE), F.lit(None).cast("long").alias(ROW))


def has_place(rows: DataFrame) -> bool:
    return set(PLACE) <= set(rows.columns)


def _with_bit(rows, chosen, flag, how, labels=()):
    block = (F.col(ROW) - F.pmod(F.col(ROW), F.lit(BLOCK))).alias("_block")
    maps = (chosen.select(FILE, ROW, block, *labels).repartition(FILE, "_block").groupBy(FILE, "_block", *labels)
            .agg(F.bitmap_construct_agg(F.pmod(F.col(ROW), F.lit(BLOCK))).alias("_bits")))
    maps = F.broadcast(materialised(maps, "places"))
    at = F.pmod(F.col(ROW), F.lit(BLOCK))
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    bit = F.coalesce(F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1, F.lit(False))
    return rows.withColumn("_block", block).join(maps, [FILE, "_block"], how).select(*rows.columns, *labels, bit.alias(flag))


def marked(rows: DataFrame, chosen: DataFrame, flag: str) -> DataFrame:
    """``rows`` with a boolean column: whether their place is one of ``chosen``."""
    return _with_bit(rows, chosen, flag, "left")


def taken(rows: DataFrame, chosen: DataFrame, labels=()) -> DataFrame:
    """Those of ``rows`` whose place is one of ``chosen``; if none is, Spark does not read the files.

    They get the ``labels``, columns of ``chosen`` with few different values.
    """
    return _with_bit(rows, chosen, "_taken", "inner", labels).filter("_taken").drop("_taken")
