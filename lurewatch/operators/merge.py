"""Idempotent writes as set operations: insert if absent, upsert, mark processed."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import MESSAGE_KEY, USER_KEY
from ..session import materialised
from ..sources import keys as key_store
from ..sources import places
from .keyed import first_per_key, settled


def payload_hash(df: DataFrame, skip=()):
    """Tie-break that depends on the row's content only, not on file or task order."""
    columns = []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        c = F.col(f.name)
        columns.append(F.map_entries(c) if f.dataType.typeName() == "map" else c)
    return F.xxhash64(*columns)


def first_deliveries(incoming: DataFrame, keys=MESSAGE_KEY, arrival="ingested_at") -> DataFrame:
    """First arrival per key within the batch."""
    tie = "_tie"
    tied = incoming.withColumn(tie, payload_hash(incoming, keys))
    return first_per_key(tied, keys, (F.col(arrival), F.col(tie))).drop(tie)


def _same(left, right, keys):
    return reduce(lambda x, y: x & y, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def _earliest(incoming, whole, keys, arrival) -> DataFrame:
    """Keys and place of the first arrival of every key.

    Two rows of a key tell whether more than one arrived first.  Only then whole rows are read, to hash them.
    """
    slim = incoming.select(*keys, F.col(arrival).alias("_arrival"), *places.PLACE)
    order = Window.partitionBy(*keys).orderBy("_arrival", *places.PLACE)
    two = slim.withColumn("_rn", F.row_number().over(order)).filter("_rn <= 2")
    # A next row without an arrival differs from no next row.
    two = two.withColumn("_next", F.lead(F.struct("_arrival")).over(order)).filter("_rn = 1")
    one = materialised(two.withColumn("_shared", F.col("_next").eqNullSafe(F.struct("_arrival"))).drop("_rn", "_next"), "earliest")
    shared = one.filter("_shared")
    if shared.isEmpty():
        return one.select(*keys, *places.PLACE)
    meet = slim.alias("i").join(shared.alias("m"), _same("i", "m", (*keys, "_arrival")), "left_semi")
    hashed = places.taken(whole, materialised(meet.select(*places.PLACE), "shared-places"))
    hashed = settled(hashed.withColumn("_tie", payload_hash(hashed, (*keys, *places.PLACE))), ["_tie"])
    decided = first_per_key(hashed.select(*keys, "_tie", *places.PLACE), keys, ("_tie", *places.PLACE))
    return one.filter("not _shared").select(*keys, *places.PLACE).unionByName(decided.drop("_tie"))


def first_places(incoming: DataFrame, stored_keys: DataFrame | None, keys=MESSAGE_KEY, arrival="ingested_at",
                 whole: DataFrame | None = None) -> DataFrame:
    """Places of the rows that `insert_if_absent` takes, found on the keys and the arrival.

    Rows that arrived together are told apart by a hash of the row in ``whole``, which is ``incoming`` itself if not given.
    """
    if "_tie" in incoming.columns:
        slim = incoming.select(*keys, F.col(arrival).alias("_arrival"), "_tie", *places.PLACE)
        first = first_per_key(slim, keys, ("_arrival", "_tie", *places.PLACE)).select(*keys, *places.PLACE)
    else:
        first = _earliest(incoming, incoming if whole is None else whole, keys, arrival)
    if stored_keys is None:
        return first
    first = materialised(first, "first-places")
    found = key_store.known(first.select(*keys), stored_keys, keys) if "key_hash" in stored_keys.columns \
        else stored_keys.select(*keys)
    return first.alias("f").join(found.alias("s"), _same("f", "s", keys), "left_anti")


def insert_if_absent(incoming: DataFrame, stored_keys: DataFrame | None, keys=MESSAGE_KEY,
                     arrival="ingested_at") -> DataFrame:
    """Rows of the batch to append: the first per key, unless the key is stored already.

    Which keys repeat or are stored is found on the keys alone and written.  The keys to leave out or the
    keys to take, whichever are fewer, meet the wide rows; Spark broadcasts them if they are small, whether the batch
    is all new or all known.  Only rows of repeated keys are ranked.  ``stored_keys`` is any table of keys, or that
    of `sources.keys`, which is joined without a shuffle of its own.  NULL equals NULL here.

    Rows with places (`sources.places`) are never shuffled whole: only keys and arrivals are, and the places go.
    Such rows may bring their tie-break (`payload_hash` of what they were made from) as ``_tie``.
    """
    if places.has_place(incoming):
        return places.taken(incoming, first_places(incoming, stored_keys, keys, arrival)).drop(*places.PLACE)

    def same(left, right):
        return _same(left, right, keys)

    status = incoming.groupBy(*keys).agg(F.count("*").alias("_copies"), F.lit(False).alias("_stored"))
    if stored_keys is not None:
        found = key_store.known(status.select(*keys), stored_keys, keys) if "key_hash" in stored_keys.columns \
            else stored_keys.select(*keys).distinct()
        marked = found.withColumn("_known", F.lit(True))
        status = status.alias("c").join(marked.alias("s"), same("c", "s"), "left").select(
            *[F.col(f"c.{k}") for k in keys], "_copies", F.coalesce("_known", F.lit(False)).alias("_stored"))
    status = materialised(status, "key-status")
    fresh, others = status.filter("_copies = 1 and not _stored"), status.filter("_copies > 1 or _stored")
    take = status.agg(F.count_if(F.expr("_copies = 1 and not _stored")) < F.count_if(F.expr("_copies > 1 or _stored"))).first()[0]
    rows = incoming.alias("i")
    # The tie-break reads the whole row, so it is settled before the join: wide columns that the caller
    # does not ask for then stay behind, however many keys repeat.
    tied = settled(incoming.withColumn("_tie", payload_hash(incoming, keys)), ["_tie"])
    repeated = tied.alias("i").join(status.filter("_copies > 1 and not _stored").alias("m"), same("i", "m"), "left_semi")
    repeated = first_per_key(repeated, keys, (F.col(arrival), F.col("_tie"))).drop("_tie")
    if take:
        once = rows.join(fresh.alias("m"), same("i", "m"), "left_semi")
    else:
        once = rows.join(others.alias("m"), same("i", "m"), "left_anti")
    return once.unionByName(repeated)


def insert_new(incoming: DataFrame, stored: DataFrame, key="tenant_id"):
    """Plain insert on a primary key: (rows to append, rows refused for their key).

    Of several rows with one key in the batch the first by content is taken.
    """
    taken = stored.select(key)
    ranked = incoming.withColumn("_tie", payload_hash(incoming)).withColumn(
        "_n", F.row_number().over(Window.partitionBy(key).orderBy("_tie")))
    first, more = (ranked.filter(c).drop("_tie", "_n") for c in ("_n = 1", "_n > 1"))
    return (first.join(taken, key, "left_anti"),
            first.join(taken, key, "left_semi").unionByName(more))


def upsert_users(stored: DataFrame, incoming: DataFrame, keys=USER_KEY, arrival="created_at",
                 updated=("email", "display_name", "role")) -> DataFrame:
    """The user table after the batch.

    Known users keep id and creation time and take the other columns from the last delivery.
    For a new user the first delivery gives id and creation time, as if the deliveries had
    come one by one.
    """
    tie = "_tie"
    kept = [c for c in stored.columns if c not in keys and c not in updated]
    tied = incoming.withColumn(tie, payload_hash(incoming, keys))
    order = F.struct(arrival, tie)
    batch = tied.groupBy(*keys).agg(
        F.min_by(F.struct(*kept), order).alias("_first"), F.max_by(F.struct(*updated), order).alias("_last"))
    batch = batch.select(*keys, *[F.col("_first")[c].alias(f"_n_{c}") for c in kept],
                         *[F.col("_last")[c].alias(f"_n_{c}") for c in updated], F.lit(True).alias("_delivered"))
    merged = stored.join(batch, list(keys), "full_outer")
    delivered = F.coalesce(F.col("_delivered"), F.lit(False))
    known = F.coalesce(*[F.col(c).isNotNull() for c in kept[:1]]) if kept else F.lit(False)
    return merged.select(
        *keys,
        *[F.when(delivered, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) for c in updated],
        *[F.when(known, F.col(c)).otherwise(F.col(f"_n_{c}")).alias(c) for c in kept],
    ).select(*stored.columns)


def unprocessed(emails: DataFrame, analyses: DataFrame | None = None, tenant_id=None) -> DataFrame:
    """Messages without a time of processing and, if given, without an analysis."""
    waiting = emails.filter(F.col("processed_at").isNull())
    if tenant_id is not None:
        waiting = waiting.filter(F.col("tenant_id") == tenant_id)
    if analyses is not None:
        waiting = waiting.join(analyses.select("email_id"), "email_id", "left_anti")
    return waiting


def mark_processed(emails: DataFrame, analyses: DataFrame) -> DataFrame:
    """Set the time of processing of every message that has an analysis."""
    done = (analyses.groupBy("email_id").agg(F.min("analyzed_at").alias("_done")))
    return (emails.join(done, "email_id", "left")
            .withColumn("processed_at", F.coalesce(F.col("processed_at"), F.col("_done")))
            .drop("_done").select(*emails.columns))


def oldest_unprocessed(emails: DataFrame, n: int, tenant_id=None) -> DataFrame:
    """The batch form of the queue: the ``n`` oldest messages waiting, of all tenants by default."""
    return unprocessed(emails, tenant_id=tenant_id).orderBy("received_at", "email_id").limit(n)
