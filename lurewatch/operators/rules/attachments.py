"""Suspicious attachment names: the first file that yields decides."""

from pyspark.sql import functions as F

from ...functions import text
from .base import LEXICON, THREAT_TYPE, Rule, threat

TYPES = ("HIGH_RISK_ATTACHMENT", "SUSPICIOUS_ATTACHMENT_NAME",
         "MEDIUM_RISK_ATTACHMENT_WITH_URGENCY")
URGENT = "_attachment_urgency"


def lists(config):
    return {URGENT: config.attachment_urgency_terms}


def with_urgency(messages, config):
    """The urgency flag as a column; it counts only where a macro document is attached."""
    lowered = F.transform("attachment_names", lambda n: text.simple_lower(text.or_empty(n)))
    macro = F.exists(lowered, lambda n: text.ends_with_any(n, config.macro_suffixes))
    relevant = F.coalesce(F.col("has_attachments") & macro, F.lit(False))
    return messages.withColumn(URGENT, relevant & (F.col(LEXICON)[URGENT] > 0))


def detect(config):
    def of_file(file):
        shown, lowered = file["shown"], file["lowered"]
        high = text.ends_with_any(lowered, config.high_risk_suffixes)
        macro = text.ends_with_any(lowered, config.macro_suffixes) & F.col(URGENT)
        return F.coalesce(threat(high, TYPES[0], shown),
                          threat(text.dots(lowered) > 1, TYPES[1], shown),
                          threat(macro, TYPES[2], shown))

    files = F.transform("attachment_names", lambda n: F.struct(
        text.or_empty(n).alias("shown"), text.simple_lower(text.or_empty(n)).alias("lowered")))
    hits = F.filter(F.transform(files, of_file), lambda t: t.isNotNull())
    return F.when(F.col("has_attachments"), F.get(hits, F.lit(0))).otherwise(
        F.lit(None).cast(THREAT_TYPE))


RULE = Rule("attachments", TYPES, detect)
