"""A sender domain that imitates a trusted domain."""

from pyspark.sql import functions as F

from ...functions import similarity, text
from .base import SENDER_DOMAIN, Rule, threat

# With `operators.lookalikes` the match arrives as a column instead of an expression.
MATCH = "_lookalike"


def detect_from(match):
    return threat(match.isNotNull(), "DOMAIN_TYPOSQUATTING", F.col(SENDER_DOMAIN),
                  text.fixed_point(match["similarity"], 1), match["trusted"])


def detect(config):
    return detect_from(similarity.first_lookalike(SENDER_DOMAIN, config.trusted_domains))


RULE = Rule("typosquatting", ("DOMAIN_TYPOSQUATTING",), detect)
