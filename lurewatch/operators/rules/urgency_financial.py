"""A weighted count of urgency, financial and authority vocabulary."""

from pyspark.sql import functions as F

from ... import fixed_values as V
from ...functions import text
from .base import LEXICON, Rule, threat

COUNTS = {"_urgency": "urgency_terms", "_financial": "financial_terms",
          "_authority": "authority_terms"}


def lists(config):
    return {name: getattr(config, terms) for name, terms in COUNTS.items()}


def language_score():
    """Doubles in this order of operations: the threshold has a case that depends on it."""
    urgency, financial, authority = (F.col(LEXICON)[c].cast("double") for c in COUNTS)
    return (urgency * F.lit(V.URGENCY_COEFFICIENT)
            + financial * F.lit(V.FINANCIAL_COEFFICIENT)
            + authority * F.lit(V.AUTHORITY_COEFFICIENT))


def detect(config):
    score = language_score()
    confidence = F.least(
        F.lit(V.LANGUAGE_BASE_CONFIDENCE)
        + (score - F.lit(V.LANGUAGE_THRESHOLD)) * F.lit(V.LANGUAGE_CONFIDENCE_SLOPE),
        F.lit(V.LANGUAGE_MAX_CONFIDENCE))
    return threat(score > F.lit(V.LANGUAGE_THRESHOLD), "URGENCY_FINANCIAL_LANGUAGE",
                  text.fixed_point(score, 2), *[F.col(LEXICON)[c] for c in COUNTS], confidence=confidence)


RULE = Rule("urgency_financial", ("URGENCY_FINANCIAL_LANGUAGE",), detect)
