"""Thresholds, weights and enumerations of the domain (fixed values)."""

MATCH_THRESHOLD = 0.85
REVIEW_THRESHOLD = 0.70
UNRESOLVED = "UNRESOLVED"
RETENTION_YEARS = 7
TIME_ZONE = "Asia/Dubai"

PRODUCTS = ("PERSONAL_FINANCE", "BNPL", "CARD_ALT")
FRAUD_DECISIONS = ("APPROVE", "REVIEW", "DECLINE")
AML_STATUSES = ("CLEAR", "HIT", "PENDING")
OUTCOMES = ("APPROVED", "DECLINED", "REFERRED")

# Weight of each attribute in the match confidence.
MATCH_WEIGHTS = {"full_name": 0.40, "date_of_birth": 0.20, "phone": 0.15, "email": 0.15, "emirates_id": 0.10}

FRESHNESS_SLA_HOURS = {"AECB": 24.0, "FRAUD": 1.0, "AML": 6.0, "POSTGRES": 0.25}
RECENCY_HOURS = 48
MIN_COMPLETENESS = 0.75
MIN_COMPLETE_RATIO = 0.95
MAX_PENDING_RATIO = 0.05
# Survivorship: the source trusted most comes first.
SOURCE_TRUST = ("POSTGRES", "AECB", "FRAUD", "AML")
