"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are sparse rows of integer weights: a component is a term.  A block of candidates is turned
into postings, term by term.  For each non-zero term of a query the weighted postings are added to a
dense row of scores, one per candidate of the block; the best k of the row are found by partition
selection, and the bests of all blocks are merged.

Defined results: vectors that are null or hold a null or non-finite component take no part; an empty
vector scores 0; a shorter vector counts as padded with zeros; a null id sorts last and is never a
query; rows repeating id and vector are searched once and counted as often as they occur, and of the
copies of a query's own row one is left out; fewer than k candidates give fewer rows; other columns
are not read.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored

SCALE = 256.0
LAST_ID = 2 ** 63 - 1  # stands for a null id
CANDIDATES = 8192      # rows of a candidate block, about
QUERIES = 4096         # rows of a query block, about
TILE = 64              # queries that accumulate at a time

FOUND = "q_id long, q_key long, vec_id long, score long, copies long"


def quantised(df: DataFrame, vec_id="vec_id", vector="embedding") -> DataFrame:
    """vec_id, ints, key (hash of ints), copies: distinct rows that take part."""
    def bad(x):
        x = x.cast("double")
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = df.select(F.coalesce(F.col(vec_id).cast("long"), F.lit(LAST_ID)).alias("vec_id"), F.col(vector).alias("v"))
    rows = rows.filter(F.col("v").isNotNull() & ~F.coalesce(F.exists("v", bad), F.lit(True)))
    rows = rows.select("vec_id", F.transform("v", lambda x: F.floor(
        F.lit(SCALE) * x.cast("double")).cast("long")).alias("ints"))
    return rows.groupBy("vec_id", "ints").agg(F.count("*").alias("copies")).withColumn("key", F.xxhash64("ints"))


def _matrix(column) -> np.ndarray:
    """Rows of weights, padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = np.asarray(column.offsets)
    values = np.asarray(column.values)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = values
    return out


def _search(k: int):
    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {name: [] for name in ("q_id", "q_key", "vec_id", "score", "copies")}
        if left.num_rows and right.num_rows:
            ids, keys, copies = (right[c].to_numpy() for c in ("vec_id", "key", "copies"))
            by_id = np.argsort(ids, kind="stable")  # position is then the order of ties
            ids, keys, copies = ids[by_id], keys[by_id], copies[by_id]
            weights = _matrix(right["ints"])[by_id]
            q_ids, q_keys, queries = left["vec_id"].to_numpy(), left["key"].to_numpy(), _matrix(left["ints"])
            postings = []
            for term in range(min(weights.shape[1], queries.shape[1])):
                held = np.flatnonzero(weights[:, term])
                postings.append((slice(None) if len(held) == len(ids) else held, weights[held, term]))
            take = min(k + 1, len(ids))
            for at in range(0, len(q_ids), TILE):
                tile = queries[at:at + TILE]
                scores = np.zeros((len(tile), len(ids)), np.int64)
                for term, (held, weight) in enumerate(postings):
                    asked = np.flatnonzero(tile[:, term])
                    if len(asked) and len(weight):
                        if isinstance(held, slice) and len(asked) == len(tile):
                            scores += tile[:, term, None] * weight
                        else:
                            span = np.arange(len(ids)) if isinstance(held, slice) else held
                            scores[np.ix_(asked, span)] += tile[asked, term, None] * weight
                for row, score in enumerate(scores):
                    left_over = copies
                    own = np.flatnonzero((ids == q_ids[at + row]) & (keys == q_keys[at + row]))
                    if len(own):
                        left_over = copies.copy()
                        left_over[own[0]] -= 1
                    # The k-th best score, counted with ties; ties are cut by position, which is by id.
                    bound = np.partition(score, len(score) - take)[len(score) - take]
                    near = np.flatnonzero(score >= bound)
                    near = near[np.lexsort((near, -score[near]))]
                    near = near[left_over[near] > 0][:k]
                    out["q_id"].append(np.full(len(near), q_ids[at + row]))
                    out["q_key"].append(np.full(len(near), q_keys[at + row]))
                    out["vec_id"].append(ids[near])
                    out["score"].append(score[near])
                    out["copies"].append(left_over[near])
        return pa.table({n: np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64)
                         for n, x in out.items()})
    return block


def top_k(df: DataFrame, is_query, k: int = 5, vec_id="vec_id", vector="embedding") -> DataFrame:
    """query_id, rank, vec_id, score for the rows where ``is_query`` (a condition on vec_id) holds."""
    ship(df.sparkSession)
    rows = stored(quantised(df, vec_id, vector), "topk-rows")
    asked = rows.filter((F.col("vec_id") != LAST_ID) & is_query(F.col("vec_id")))
    n_rows, n_asked = rows.count(), asked.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    blocks = max(-(-n_rows // CANDIDATES), min(2 * cores, -(-n_rows // 256)), 1)
    asked_blocks = max(-(-n_asked // QUERIES), 1)
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select("vec_id", "key", "ints", F.pmod(F.xxhash64("vec_id", "key"), F.lit(asked_blocks)).cast("int").alias("q"))
    left = left.withColumn("b", spread(blocks))
    right = rows.select("vec_id", "key", "ints", "copies",
                        F.pmod(F.xxhash64("vec_id", "key"), F.lit(blocks)).cast("int").alias("b"))
    right = right.withColumn("q", spread(asked_blocks))
    found = left.groupBy("b", "q").cogroup(right.groupBy("b", "q")).applyInArrow(_search(k), FOUND)
    found = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(k)).cast("int"))))
    order = Window.partitionBy("q_id", "q_key").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    times = asked.select(F.col("vec_id").alias("q_id"), F.col("key").alias("q_key"), F.col("copies").alias("_times"))
    best = best.join(times, ["q_id", "q_key"]).withColumn(
        "_time", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
    return best.select(F.col("q_id").alias("query_id"), "rank",
                       F.nullif("vec_id", F.lit(LAST_ID)).alias("vec_id"), "score")
