"""Values the detection results depend on, stated once.

Everything in this module is a fixed value: word lists, domain lists, weights,
confidences, thresholds and evidence wording.  Changing one changes results.
The order of the lists is significant where a rule takes the first match.
"""

# --------------------------------------------------------------- fixed values
# Domain lists.  TRUSTED_DOMAINS is ordered: the first similar domain wins.
INTERNAL_DOMAINS = ("company.com", "example.com")
TRUSTED_DOMAINS = ("microsoft.com", "google.com", "paypal.com")
FREEMAIL_DOMAINS = ("gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com")

# Provider names a tenant may have.
PROVIDERS = ("microsoft", "google")

# Titles looked for in the sender's display name.
EXEC_TITLES = ("ceo", "cfo", "president", "director", "chief", "vp", "vice president")

# Language score: three lists, one coefficient each, strict threshold.
URGENCY_TERMS = (
    "urgent", "immediately", "asap", "right away", "time sensitive",
    "today", "end of day", "eod", "quick", "need this now", "hurry",
)
FINANCIAL_TERMS = (
    "wire transfer", "payment", "invoice", "bank account", "routing number",
    "swift", "ach", "wire", "fund", "transfer", "pay", "urgent payment",
    "gift card", "itunes", "google play", "prepaid card",
)
AUTHORITY_TERMS = (
    "ceo", "president", "director", "approved", "authorized", "confidential",
    "do not discuss", "between us", "sensitive", "private",
)
URGENCY_COEFFICIENT = 0.3
FINANCIAL_COEFFICIENT = 0.5
AUTHORITY_COEFFICIENT = 0.2
LANGUAGE_THRESHOLD = 1.5
LANGUAGE_BASE_CONFIDENCE = 0.70
LANGUAGE_CONFIDENCE_SLOPE = 0.1
LANGUAGE_MAX_CONFIDENCE = 0.95

# Attachment suffixes, and the urgency terms that make a macro document count.
HIGH_RISK_SUFFIXES = (
    ".exe", ".scr", ".bat", ".cmd", ".com", ".pif",
    ".vbs", ".js", ".jar", ".msi", ".app",
)
MACRO_SUFFIXES = (".doc", ".xls", ".xlsm", ".docm", ".pptm")
ATTACHMENT_URGENCY_TERMS = ("urgent", "immediately", "asap", "right away", "today")

# Recipient role groups.
CSUITE_ROLES = (
    "ceo", "cfo", "cto", "coo", "president", "chief", "vice president", "vp",
    "pdg", "président directeur général", "directeur général", "dg",
    "daf", "directeur administratif et financier", "directeur financier",
    "dsi", "directeur des systèmes d'information",
    "directeur", "direction générale",
)
FINANCE_ROLES = (
    "finance", "accounting", "treasurer", "controller", "payroll",
    "comptabilité", "comptable", "trésorier", "trésorerie",
    "contrôleur de gestion", "contrôleur financier",
    "responsable financier", "responsable comptable",
    "service comptable", "paie",
)
HR_ROLES = (
    "hr", "human resources", "recruiting", "talent",
    "drh", "directeur des ressources humaines", "ressources humaines",
    "rh", "responsable rh", "responsable ressources humaines",
    "recrutement", "gestionnaire paie", "service rh",
)

# Message vocabulary of the role-targeting rule.
ROLE_URGENCY_TERMS = (
    "urgent", "immediately", "asap", "today", "right away", "now",
    "immédiatement", "rapidement", "aujourd'hui",
    "tout de suite", "au plus vite", "dans l'immédiat",
    "sans délai", "prioritaire", "en urgence",
)
ROLE_PAYMENT_TERMS = (
    "wire transfer", "payment", "invoice", "bank account", "routing", "iban", "swift",
    "virement", "virement bancaire", "paiement", "facture",
    "compte bancaire", "rib", "relevé d'identité bancaire",
    "bic", "coordonnées bancaires",
    "ordre de virement", "transfert de fonds",
)
ROLE_PAYROLL_TERMS = (
    "tax form", "payroll",
    "bulletin de paie", "bulletin de salaire", "fiche de paie",
    "numéro de sécurité sociale", "n° sécurité sociale",
    "cotisations sociales", "déclaration de revenus",
    "dsn", "déclaration sociale nominative",
    "attestation fiscale", "salaires",
)

# Authentication headers and the marks looked for in their lower-cased values.
SPF_HEADER = "Received-SPF"
AUTH_HEADER = "Authentication-Results"
REPLY_TO_HEADER = "Reply-To"
SPF_FAIL_MARK = "fail"
DKIM_FAIL_MARK = "dkim=fail"
DMARC_FAIL_MARK = "dmarc=fail"
MIN_AUTH_FAILURES = 2

# Look-alike window on the similarity percentage, open at both ends.
LOOKALIKE_ABOVE = 85.0
LOOKALIKE_BELOW = 100.0

# Detection types and their confidence.  The language rule computes its own.
CONFIDENCE = {
    "DISPLAY_NAME_MISMATCH": 0.85,
    "DOMAIN_TYPOSQUATTING": 0.90,
    "AUTH_FAILURES": 0.80,
    "REPLY_TO_MISMATCH": 0.75,
    "HIGH_RISK_ATTACHMENT": 0.90,
    "SUSPICIOUS_ATTACHMENT_NAME": 0.85,
    "MEDIUM_RISK_ATTACHMENT_WITH_URGENCY": 0.70,
    "BEC_CSUITE_TARGETING": 0.90,
    "BEC_FINANCE_TARGETING": 0.85,
    "BEC_HR_PAYROLL_SCAM": 0.80,
    "BEC_HIGH_VALUE_TARGET": 0.70,
}

# Weight per detection type; a type without weight, or with weight 0, counts 1.0.
# BEC_HR_W2_SCAM is never emitted, so the HR detection keeps the default.
WEIGHTS = {
    "DOMAIN_TYPOSQUATTING": 1.5,
    "DISPLAY_NAME_MISMATCH": 1.3,
    "AUTH_FAILURES": 1.2,
    "HIGH_RISK_ATTACHMENT": 1.5,
    "SUSPICIOUS_ATTACHMENT_NAME": 1.3,
    "URGENCY_FINANCIAL_LANGUAGE": 1.0,
    "REPLY_TO_MISMATCH": 1.1,
    "MEDIUM_RISK_ATTACHMENT_WITH_URGENCY": 1.0,
    "BEC_CSUITE_TARGETING": 1.6,
    "BEC_FINANCE_TARGETING": 1.5,
    "BEC_HR_W2_SCAM": 1.4,
    "BEC_HIGH_VALUE_TARGET": 1.2,
}
DEFAULT_WEIGHT = 1.0
MAX_SCORE = 1.0

# Risk levels, highest first: score >= bound gives the level, else "none".
RISK_LEVELS = (("critical", 0.85), ("high", 0.70), ("medium", 0.50), ("low", 0.30))
NO_RISK = "none"
ALERT_LEVELS = ("high", "critical")

# Evidence wording (printf style).
EVIDENCE = {
    "DISPLAY_NAME_MISMATCH":
        "Display name '%s' contains executive title but sender domain '%s' is external",
    "DOMAIN_TYPOSQUATTING":
        "Sender domain '%s' is %s%% similar to trusted domain '%s' (potential typosquatting)",
    "AUTH_FAILURES": "Email authentication failures: %s",
    "URGENCY_FINANCIAL_LANGUAGE":
        "High-risk language detected (score: %s): %d urgency, %d financial, %d authority keywords",
    "REPLY_TO_MISMATCH":
        "Sender: %s, Reply-To: %s (free email service, redirects responses)",
    "HIGH_RISK_ATTACHMENT": "High-risk attachment type: %s",
    "SUSPICIOUS_ATTACHMENT_NAME": "Suspicious attachment name (double extension): %s",
    "MEDIUM_RISK_ATTACHMENT_WITH_URGENCY": "Medium-risk attachment + urgent language: %s",
    "BEC_CSUITE_TARGETING":
        "Executive recipient (%s) + external sender + urgent wire transfer request"
        " (potential CEO fraud/Fraude au président)",
    "BEC_FINANCE_TARGETING":
        "Finance role (%s) + external sender + payment/wire transfer language"
        " (potential invoice fraud)",
    "BEC_HR_PAYROLL_SCAM":
        "HR role (%s) + external sender + payroll/tax document request"
        " (W-2/bulletin de paie phishing)",
    "BEC_HIGH_VALUE_TARGET": "High-value role (%s) + external sender + urgent language",
}
AUTH_FAILURE_NAMES = {"spf": "SPF_FAIL", "dkim": "DKIM_FAIL", "dmarc": "DMARC_FAIL"}

# Address check and column limits.
ADDRESS_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
COLUMN_LIMITS = {
    "tenants": {"name": 100, "provider": 10, "status": 20},
    "users": {"provider_user_id": 64, "email": 254, "display_name": 100, "role": 50},
    "emails": {"provider_message_id": 255, "sender_email": 254, "sender_name": 100,
               "recipient_email": 254},
}
REQUIRED_COLUMNS = {
    "tenants": ("tenant_id", "name", "provider"),
    "users": ("user_id", "provider_user_id", "email"),
    "emails": ("email_id", "provider_message_id", "sender_email", "recipient_email",
               "received_at"),
}

# Sizes and spans of the batch runs.
LOOK_BACK_DAYS = 7
DETECTION_BATCH = 100
REPORT_ROWS = 10
PREVIEW_CHARACTERS = 500
# ------------------------------------------------------------ end fixed values
