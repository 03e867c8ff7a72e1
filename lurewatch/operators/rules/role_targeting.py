"""External mail that asks for money or payroll papers from a person in a fitting role."""

from pyspark.sql import functions as F

from ...functions import text
from .base import EXTERNAL, LEXICON, Rule, threat

TYPES = ("BEC_CSUITE_TARGETING", "BEC_FINANCE_TARGETING", "BEC_HR_PAYROLL_SCAM",
         "BEC_HIGH_VALUE_TARGET")

# Columns of the recipient (see `operators.recipients`) and of the message.
ROLE, CSUITE, FINANCE, HR = "_role", "_role_csuite", "_role_finance", "_role_hr"
URGENCY, PAYMENT, PAYROLL = "_role_urgency", "_role_payment", "_role_payroll"


def role_groups(lowered, config):
    """The three group flags of a lower-cased role; substrings, so a coordinator is a `coo`."""
    return {CSUITE: text.contains_any(lowered, config.csuite_roles),
            FINANCE: text.contains_any(lowered, config.finance_roles),
            HR: text.contains_any(lowered, config.hr_roles)}


def lists(config):
    return {URGENCY: config.role_urgency_terms, PAYMENT: config.role_payment_terms,
            PAYROLL: config.role_payroll_terms}


def signals_before_join():
    """Vocabulary flags of external messages, whoever the recipient is."""
    return {name: F.col(EXTERNAL) & (F.col(LEXICON)[name] > 0) for name in (URGENCY, PAYMENT, PAYROLL)}


def detect(config):
    role = F.col(ROLE)
    csuite, finance, hr = (F.coalesce(F.col(c), F.lit(False)) for c in (CSUITE, FINANCE, HR))
    urgency, payment, payroll = F.col(URGENCY), F.col(PAYMENT), F.col(PAYROLL)
    found = F.coalesce(
        threat(csuite & urgency & payment, TYPES[0], role),
        threat(finance & payment, TYPES[1], role),
        threat(hr & payroll, TYPES[2], role),
        threat((csuite | finance | hr) & urgency, TYPES[3], role))
    return F.when(F.col(EXTERNAL) & (text.or_empty(role) != ""), found)


RULE = Rule("role_targeting", TYPES, detect)
