"""Exact de-duplication through an extendible-hash index on shared files.

Every distinct normalised text is one entry of the index.  Its address is the top bits of a 64-bit
hash.  The directory starts with one bucket and doubles until no bucket is overfull; a bucket that
is not overfull keeps its smaller local depth, so several slots share it.  Entries are filed by
bucket, and the rows probe them by hash.  Entries with the same hash form a chain, which is settled
by comparing the texts themselves.

Defined results: a null text counts as empty and empty texts equal each other; a null id sorts last;
of rows that repeat id and text one stays; an empty table gives an empty result; columns other than
the id and the text are not read.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, stored

# Fixed values of the contract: the characters that do not count.
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")

FINEST = 16           # bits of the largest directory: at most 65,536 slots
CAPACITY = 50_000     # entries a bucket holds before it is split
LAST_ID = 2 ** 63 - 1  # stands for a null id


def normalised(text: Column) -> Column:
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def _keyed(docs: DataFrame, doc_id: str, text: str, address) -> DataFrame:
    """doc_id, r (hash of the raw text), n (code points), norm, h (address)."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("r"), F.char_length("text").cast("long").alias("n"),
                       normalised(F.col("text")).alias("norm"))
    return rows.withColumn("h", address(F.col("norm")))


def _groups(keyed: DataFrame, *keys) -> DataFrame:
    """Size, longest length and winner per group; copies collapse before the shuffle.

    Length and id share one number, so that the aggregate needs no sort: the longest row is the
    largest, and of equally long ones the smallest id.
    """
    scale = F.lit(str(2 ** 64)).cast("decimal(20,0)")
    best = F.max((F.col("n").cast("decimal(12,0)") * scale).cast("decimal(38,0)")
                 + (F.lit(LAST_ID).cast("decimal(20,0)") - F.col("doc_id").cast("decimal(20,0)")))
    got = keyed.groupBy(*keys).agg(F.count("*").alias("group_size"), best.cast("decimal(38,0)").alias("best"))
    longest = F.floor(F.col("best") / scale).cast("decimal(12,0)")
    rest = F.col("best") - (longest * scale).cast("decimal(38,0)")
    return got.select(
        *keys, "group_size", longest.cast("long").alias("longest"),
        (F.lit(LAST_ID).cast("decimal(20,0)") - rest.cast("decimal(38,0)")).cast("long").alias("keep_id"))


def slot_of(address: Column) -> Column:
    return F.shiftrightunsigned(address, 64 - FINEST).cast("int")


def directory(counts: dict, capacity: int = CAPACITY) -> list:
    """Double until nothing is overfull: (slot at the finest depth, bucket, local depth) for every slot."""
    depth, done, open_ = 0, [], [(0, sorted(counts.items()))]
    while open_:
        overfull = []
        for prefix, held in open_:
            if sum(n for _, n in held) <= capacity or depth == FINEST:
                done.append((prefix, depth))
            else:
                bit = FINEST - depth - 1
                for half in (0, 1):
                    overfull.append((2 * prefix + half, [(s, n) for s, n in held if (s >> bit) & 1 == half]))
        open_, depth = overfull, depth + 1
    out = []
    for prefix, local in done:
        first = prefix << (FINEST - local)
        out += [(slot, first, local) for slot in range(first, first + (1 << (FINEST - local)))]
    return out


def build_index(docs: DataFrame, doc_id="doc_id", text="text", address=F.xxhash64, capacity=CAPACITY) -> DataFrame:
    """The index on shared files: bucket, h, sha, group_size, longest, keep_id; one row per distinct text."""
    keyed = _keyed(docs, doc_id, text, address)
    entries = stored(_groups(keyed, "h", "norm").select(
        "h", F.sha2("norm", 256).alias("sha"), "group_size", "longest", "keep_id"), "dedup-entries")
    # At most 2**FINEST rows reach the driver, whatever the corpus holds.
    counts = dict(entries.groupBy(slot_of(F.col("h")).alias("slot")).count().collect())
    ranges = sorted({(bucket, bucket + (1 << (FINEST - depth))) for _, bucket, depth in directory(counts, capacity)})
    bucket = F.element_at(F.array(*[F.lit(b) for b, _ in ranges]), F.lit(1)) if len(ranges) == 1 else None
    if bucket is None:
        spark = docs.sparkSession
        slots = spark.createDataFrame([(s, b) for s, b, _ in directory(counts, capacity)], "slot int, bucket int")
        # The directory has 2**FINEST rows of two numbers.
        filed = entries.withColumn("slot", slot_of(F.col("h"))).join(F.broadcast(slots), "slot").drop("slot")
    else:
        filed = entries.withColumn("bucket", bucket)
    return stored(filed.repartitionByRange("bucket", "h").sortWithinPartitions("bucket", "h"), "dedup-index")


def decisions(docs: DataFrame, doc_id="doc_id", text="text", address=F.xxhash64, capacity=CAPACITY) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and r (hash of its raw text)."""
    index = build_index(docs, doc_id, text, address, capacity)
    keyed = _keyed(docs, doc_id, text, address)
    # Rows repeating id and text are one row with a count until the end.
    rows = keyed.groupBy("doc_id", "r", "n", "h").agg(F.count("*").alias("copies"))
    chains = index.groupBy("h").count().filter("count > 1").select("h")
    if chains.isEmpty():
        found = rows.join(index.drop("bucket"), "h")
    else:
        single = rows.join(chains, "h", "left_anti").join(index.drop("bucket"), "h")
        chained = keyed.join(chains, "h", "left_semi")
        texts = _groups(chained, "h", "norm")
        rest = (chained.groupBy("doc_id", "r", "n", "h", "norm").agg(F.count("*").alias("copies"))
                .join(texts, ["h", "norm"]).withColumn("sha", F.sha2("norm", 256)).drop("norm"))
        found = single.unionByName(rest)
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    own = (F.col("doc_id") == F.col("keep_id")) & (F.col("n") == F.col("longest")) & (F.col("copy") == 1)
    return found.select(
        F.nullif("doc_id", F.lit(LAST_ID)).alias("doc_id"), F.nullif("keep_id", F.lit(LAST_ID)).alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"), own.alias("kept"),
        F.col("sha").alias("text_sha256"), "r")


def keep_first(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return keep_rows(docs, decisions(docs, doc_id, text).filter("kept"), doc_id, text)
