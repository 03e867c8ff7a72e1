"""Normalised tables and follow-up analyses around the core."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions import address, similarity, text
from . import lookalikes


def recipients_table(emails: DataFrame, **address_columns) -> DataFrame:
    """(email_id, address, type): one row per addressee.

    ``address_columns`` maps a type (to, cc, bcc) to an array column; without any, the single
    recipient is the one ``to`` entry.
    """
    lists = {k: F.col(c) for k, c in address_columns.items()} or {
        "to": F.array("recipient_email")}

    def typed(kind, addresses):
        return F.transform(F.coalesce(addresses, F.array().cast("array<string>")),
                           lambda a: F.struct(a.alias("address"), F.lit(kind).alias("type")))

    entries = F.concat(*[typed(k, c) for k, c in lists.items()])
    return (emails.select("email_id", "tenant_id", F.explode(entries).alias("r"))
            .select("email_id", "tenant_id", "r.address", "r.type"))


def attachments_table(emails: DataFrame, contents: str | None = None) -> DataFrame:
    """(email_id, pos, filename, extension, content_hash) of every attachment.

    ``contents`` is an array column with the bytes or text of the attachments, in the order of
    their names; without it, and for a missing content, the hash is null.
    """
    lowered = text.simple_lower(text.or_empty(F.col("filename")))
    body = F.lit(None).cast("array<string>") if contents is None else F.col(contents)
    return (emails.select("email_id", "tenant_id", body.alias("_bodies"),
                          F.posexplode("attachment_names").alias("pos", "filename"))
            .withColumn("extension", F.regexp_extract(lowered, r"(\.[^.]*)\z", 1))
            .withColumn("content_hash", F.sha2(F.get("_bodies", F.col("pos")), 256)).drop("_bodies"))


def repeated_attachments(attachments: DataFrame, key="filename") -> DataFrame:
    """How often the same attachment (by content hash or name) arrived."""
    return attachments.groupBy(key).agg(F.count("*").alias("copies"),
                                        F.count_distinct("tenant_id").alias("tenants"),
                                        F.min("email_id").alias("first_email_id"))


def headers_table(emails: DataFrame) -> DataFrame:
    """(email_id, header, value) of every header."""
    return emails.select("email_id", "tenant_id", F.explode("headers").alias("header", "value"))


def header_search(emails: DataFrame, header, mark) -> DataFrame:
    """Messages whose header value has the mark, such as all with a failed DMARC."""
    value = text.simple_lower(text.or_empty(F.col("headers")[header]))
    return emails.filter(value.contains(mark))


def threats_by_period(threats: DataFrame, time="analyzed_at", period="week") -> DataFrame:
    """Detections per type and period."""
    return (threats.groupBy("type", F.date_trunc(period, time).alias("period"))
            .agg(F.count("*").alias("detections"), F.avg("confidence").alias("mean_confidence")))


def precision_by_type(threats: DataFrame, reviews: DataFrame) -> DataFrame:
    """Share of confirmed detections per type among the reviewed messages.

    ``reviews`` has (email_id, confirmed).
    """
    return (threats.join(reviews.select("email_id", "confirmed"), "email_id")
            .groupBy("type").agg(F.count("*").alias("reviewed"),
                                 F.count(F.when(F.col("confirmed"), 1)).alias("confirmed"))
            .withColumn("precision", F.col("confirmed") / F.col("reviewed")))


def precision_by_level(analyses: DataFrame, reviews: DataFrame) -> DataFrame:
    """Flagged, confirmed and missed messages at each level's bound, in one pass."""
    scored = analyses.join(reviews.select("email_id", "confirmed"), "email_id")
    totals = scored.agg(*[
        F.struct(F.count(F.when(F.col("risk_value") >= bound, 1)).alias("flagged"),
                 F.count(F.when((F.col("risk_value") >= bound) & F.col("confirmed"), 1)).alias("confirmed"),
                 F.count(F.when((F.col("risk_value") < bound) & F.col("confirmed"), 1)).alias("missed")
                 ).alias(level) for level, bound in V.RISK_LEVELS])
    rows = F.array(*[F.struct(F.lit(level).alias("level"), F.lit(bound).alias("bound"),
                              F.col(level)["flagged"].alias("flagged"),
                              F.col(level)["confirmed"].alias("confirmed"),
                              F.col(level)["missed"].alias("missed")) for level, bound in V.RISK_LEVELS])
    return totals.select(F.inline(rows))


def compare_versions(left: DataFrame, right: DataFrame) -> DataFrame:
    """Messages two rule versions judge differently."""
    a = left.select("email_id", F.col("risk_level").alias("level_a"), F.col("risk_value").alias("score_a"))
    b = right.select("email_id", F.col("risk_level").alias("level_b"), F.col("risk_value").alias("score_b"))
    return (a.join(b, "email_id", "full_outer")
            .filter(~F.col("level_a").eqNullSafe(F.col("level_b"))
                    | ~F.col("score_a").eqNullSafe(F.col("score_b"))))


def dead_letters(rejects: DataFrame, history: DataFrame | None = None, attempts: int = 3) -> DataFrame:
    """Rejects with their number of attempts; ``dead`` from the given number on."""
    seen = rejects if history is None else history.unionByName(rejects)
    return (seen.groupBy("table", "tenant_id", "row_key")
            .agg(F.count("*").alias("attempts"), F.max("reason").alias("reason"))
            .withColumn("dead", F.col("attempts") >= attempts))


def trigram_lookalikes(emails: DataFrame, trusted=V.TRUSTED_DOMAINS, at_least=0.5) -> DataFrame:
    """Sender domains that share many trigrams with a trusted domain, with their edit similarity.

    An equi-join on trigrams over distinct domains.  A pair that shares at least that part of all
    its trigrams shares one of the first few of the trusted domain's: of t trigrams, that many must
    be common at the least, so the last of them need not be looked for.
    """
    domains = (emails.select(address.domain_of("sender_email").alias("domain"))
               .filter("domain != ''").groupBy("domain").agg(F.count("*").alias("messages")))
    listed = lookalikes.trusted_frame(emails.sparkSession, trusted).select(F.col("domain").alias("trusted"))
    listed = listed.withColumn("grams", similarity.trigrams("trusted"))
    first = F.size("grams") - F.ceil(F.size("grams") * F.lit(float(at_least)) - F.lit(1e-9)).cast("int") + 1
    index = listed.select("trusted", F.explode(F.slice("grams", F.lit(1), F.greatest(first, F.lit(1)))).alias("gram"))
    probes = domains.select("domain", "messages", F.explode(similarity.trigrams("domain")).alias("gram"))
    pairs = probes.join(index, "gram").filter(F.col("domain") != F.col("trusted")).select(
        "domain", "trusted", "messages").distinct()
    longest = F.greatest(F.octet_length("domain"), F.octet_length("trusted"))
    return (pairs.withColumn("shared", similarity.trigram_similarity("domain", "trusted"))
            .filter(F.col("shared") >= at_least)
            .withColumn("similarity", similarity.similarity(similarity.byte_distance("domain", "trusted"), longest)))


def alerts(analyses: DataFrame, emails: DataFrame) -> DataFrame:
    """One row per threat of a high-risk message, with what a reader needs to act on it."""
    facts = emails.select("email_id", "subject", "sender_name", "sender_email", "recipient_email")
    risky = analyses.filter(F.col("risk_level").isin(*V.ALERT_LEVELS))
    # Messages are joined, not threats: what a message's threats share goes through the shuffle once.
    return (risky.select("email_id", "tenant_id", "risk_score", "risk_level", "detected_threats")
            .join(facts, "email_id")
            .select("email_id", "tenant_id", "risk_score", "risk_level",
                    F.size("detected_threats").cast("bigint").alias("threats"),
                    F.posexplode("detected_threats").alias("pos", "t"), *facts.columns[1:])
            .select("email_id", "tenant_id", "risk_score", "risk_level", "threats", "pos",
                    "t.type", "t.confidence", "t.evidence", *facts.columns[1:]))


def alert_digests(alerted: DataFrame, gap="1 day", time="received_at") -> DataFrame:
    """One row per burst of alerts: messages of a tenant's sender that follow each other within ``gap`` (or just that).

    ``alerted`` has one row per risky message with tenant, sender, time and score.  Works on batches, and on
    streams with a watermark on a zoned time column.
    """
    return (alerted.groupBy("tenant_id", "sender_email", F.session_window(time, gap).alias("w"))
            .agg(F.count("*").alias("messages"), F.max("risk_value").alias("risk_value"), F.min(time).alias("first_at"),
                 F.max(time).alias("last_at")).drop("w"))
