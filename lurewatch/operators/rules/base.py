"""What a rule is, and the message columns every rule may use."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ... import fixed_values as V
from ...config import DetectionConfig
from ...functions import address, text
from ...session import materialised

THREAT_TYPE = "struct<type:string,confidence:double,evidence:string>"

# Columns added by `with_message_columns`.
RAW, TEXT, SENDER_DOMAIN, EXTERNAL = "_raw", "_text", "_sender_domain", "_external"
# Column added by `detection.rule_columns`: how many terms of each word list the text holds.
LEXICON = "_lexicon"
SENDER, SENDER_NAME = "_sender", "_sender_name"
SPF, AUTH_RESULTS, REPLY_TO, REPLY_DOMAIN = "_spf", "_auth", "_reply_to", "_reply_domain"


@dataclass(frozen=True)
class Rule:
    """A named rule: message columns in, one nullable threat struct out."""

    rule_id: str
    types: tuple
    detect: Callable[[DetectionConfig], Column]


def threat(condition, type_, *evidence_args, confidence=None) -> Column:
    """The threat struct where ``condition`` holds, NULL elsewhere."""
    value = F.lit(V.CONFIDENCE[type_]) if confidence is None else confidence
    return F.when(condition, F.struct(
        F.lit(type_).alias("type"),
        value.cast("double").alias("confidence"),
        text.printf(V.EVIDENCE[type_], *evidence_args).alias("evidence")))


def header(name) -> Column:
    """Header value by exact key, lower-cased; '' if absent."""
    return text.simple_lower(text.or_empty(F.col("headers")[name]))


def _internal(emails: DataFrame, config: DetectionConfig, tenant_domains: DataFrame | None):
    """The messages, and whether their sender's domain is one of the tenant's own."""
    configured = address.is_internal(SENDER_DOMAIN, config.internal_domains)
    if tenant_domains is None:
        return emails, configured
    listed = tenant_domains.groupBy("tenant_id").agg(
        F.collect_set(text.simple_lower("domain")).alias("_domains"))
    # Written first, so that Spark knows how small it is: messages are far too wide to shuffle.
    listed = materialised(listed, "tenant-domains")
    own = F.array_contains("_domains", F.col(SENDER_DOMAIN)) & (F.col(SENDER_DOMAIN) != "")
    return (emails.join(listed, "tenant_id", "left"),
            F.when(F.col("_domains").isNull(), configured).otherwise(own))


def with_message_columns(emails: DataFrame, config: DetectionConfig,
                         tenant_domains: DataFrame | None = None) -> DataFrame:
    """Add the text, as it is and lower-cased, names, headers and domains.

    These are separate projections so that each is computed once: the optimizer does not
    inline an expression that the next projection uses more than once.  Columns that no rule
    uses are pruned.
    """
    emails, internal = _internal(emails, config, tenant_domains)
    return (emails
            .withColumn(RAW, text.message_text())
            .withColumns({TEXT: text.simple_lower(RAW),
                          SENDER: text.simple_lower(text.or_empty("sender_email")),
                          SENDER_NAME: text.simple_lower(text.or_empty("sender_name")),
                          SPF: header(V.SPF_HEADER), AUTH_RESULTS: header(V.AUTH_HEADER),
                          REPLY_TO: header(V.REPLY_TO_HEADER)})
            .withColumns({SENDER_DOMAIN: address.domain_of_lowered(SENDER),
                          REPLY_DOMAIN: address.domain_of_lowered(REPLY_TO)})
            .withColumn(EXTERNAL, ~internal))
