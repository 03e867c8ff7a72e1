"""First rows per key, and a barrier for costly columns."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark plans the filter ``row_number = 1`` as a group limit on both sides of the shuffle:
    each task sends at most one row per key, so a key with very many copies is cheap.
    """
    ranked = df.withColumn("_rn", F.row_number().over(
        Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


# Spark plans a group limit before the shuffle for bounds up to this one only.
GROUP_LIMIT = 1000
SLICES = 64


def top_per_key(df: DataFrame, keys, order, n: int, rank_name="rank") -> DataFrame:
    """The first ``n`` rows per key with their rank.

    Up to ``GROUP_LIMIT`` a task sends at most n rows per key.  Beyond it the rows of a key are
    ranked in slices first, so that no task sorts all rows of a hot key.
    """
    def ranked(rows, *by):
        return rows.withColumn(rank_name, F.row_number().over(
            Window.partitionBy(*by).orderBy(*order))).filter(F.col(rank_name) <= n)

    if n > GROUP_LIMIT:
        whole = F.xxhash64(*[f.name for f in df.schema.fields if f.dataType.typeName() != "map"])
        df = ranked(df.withColumn("_slice", F.pmod(whole, F.lit(SLICES))), *keys, "_slice").drop(
            rank_name, "_slice")
    return ranked(df, *keys)


def settled(df: DataFrame, costly) -> DataFrame:
    """The same rows, with the ``costly`` columns computed before any later filter on them.

    A filter on a computed column is normally moved below the projection, with the column's
    expression in its place, and the expression runs twice.  For columns that scan whole texts
    that is far too dear.  A generator over one row stops the move.  The other columns stay
    outside of it, so filters on them still reach the scan.
    """
    others = [c for c in df.columns if c not in set(costly)]
    return df.select(*others, F.inline(F.array(F.struct(*costly)))).select(*df.columns)
