"""Detection settings; the defaults are the fixed values."""

from dataclasses import dataclass, field

from . import fixed_values as V


@dataclass(frozen=True)
class DetectionConfig:
    """Domain lists, word lists, weights and the set of rules to run.

    Every field may be replaced, for instance per experiment:
    ``dataclasses.replace(DEFAULT, weights={...}, rules=("auth_failures",))``.
    """

    internal_domains: tuple = V.INTERNAL_DOMAINS
    trusted_domains: tuple = V.TRUSTED_DOMAINS
    freemail_domains: tuple = V.FREEMAIL_DOMAINS
    exec_titles: tuple = V.EXEC_TITLES
    urgency_terms: tuple = V.URGENCY_TERMS
    financial_terms: tuple = V.FINANCIAL_TERMS
    authority_terms: tuple = V.AUTHORITY_TERMS
    high_risk_suffixes: tuple = V.HIGH_RISK_SUFFIXES
    macro_suffixes: tuple = V.MACRO_SUFFIXES
    attachment_urgency_terms: tuple = V.ATTACHMENT_URGENCY_TERMS
    csuite_roles: tuple = V.CSUITE_ROLES
    finance_roles: tuple = V.FINANCE_ROLES
    hr_roles: tuple = V.HR_ROLES
    role_urgency_terms: tuple = V.ROLE_URGENCY_TERMS
    role_payment_terms: tuple = V.ROLE_PAYMENT_TERMS
    role_payroll_terms: tuple = V.ROLE_PAYROLL_TERMS
    weights: dict = field(default_factory=lambda: dict(V.WEIGHTS))
    rules: tuple = ()          # empty: every registered rule, in registry order
    version: str = "1"


DEFAULT = DetectionConfig()
