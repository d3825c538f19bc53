"""Configuration objects and the fixed values the results depend on."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values (must equal the modelled system's for equal results) -------
# Velocity rule defaults: trailing window, count threshold, sum thresholds.
WINDOW_SECONDS = 300
COUNT_THRESHOLD = 5
SUM_THRESHOLD_VND = "2000000"
SUM_THRESHOLD_OTHER = "100"
# Namespace of the deterministic (uuid5) risk-flag id; name is
# "<account_id>:<window_end ISO-8601 with +00:00>:<reason>".
FLAG_NAMESPACE = "00000000-0000-0000-0000-000000000001"
REASON_COUNT = "VELOCITY_COUNT"
REASON_SUM = "VELOCITY_SUM"
# Enumerations.
ACCOUNT_STATUSES = ["ACTIVE", "SUSPENDED", "CLOSED"]
TRANSACTION_STATUSES = ["PENDING", "SETTLED", "DECLINED", "REVERSED", "CHARGEBACK"]
TRANSACTION_TYPES = ["PAYMENT", "TRANSFER_IN", "TRANSFER_OUT", "REFUND", "FEE"]
RISK_BANDS = ["LOW", "MEDIUM", "HIGH"]
# Field formats: country = 2 upper-case letters, currency = 3.
COUNTRY_PATTERN = "[A-Z]{2}"
CURRENCY_PATTERN = "[A-Z]{3}"
# Ingest endpoint name that is part of the canonical request hash.
TRANSACTION_ENDPOINT = "POST /v1/transactions"
# Fact partition naming: fact_transactions_yYYYYmMM, one per calendar month.
FACT_PARTITION_PREFIX = "fact_transactions_y"
# Defaults applied on create.
DEFAULT_CURRENCY = "VND"
DEFAULT_ACCOUNT_COUNTRY = "VN"
DEFAULT_KYC_LEVEL = 0
DEFAULT_RISK_BAND = "LOW"
# Clock-skew allowance of the "not in the future" expectation.
FUTURE_SKEW_SECONDS = 120
# Mart parameters: top 50 merchants over the last 7 days.
TOP_MERCHANTS_K = 50
TOP_MERCHANTS_DAYS = 7
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class VelocityConfig:
    """Velocity rule parameters (overridable like the environment settings)."""

    window_seconds: int = WINDOW_SECONDS
    count_threshold: int = COUNT_THRESHOLD
    sum_threshold_vnd: str = SUM_THRESHOLD_VND
    sum_threshold_other: str = SUM_THRESHOLD_OTHER
    # Length of the time slice used to split one account's events into
    # independent window groups (skew control).  Must be >= window_seconds.
    slice_seconds: int = 3600
    # Time to live of an idle account's stream state (None: kept for ever).
    idle_ttl_seconds: int | None = None
    # How far event time may lie behind the latest seen before an event is late
    # (None: no event is late, and no watermark is kept).
    lateness_seconds: int | None = None

    def __post_init__(self) -> None:
        if self.window_seconds <= 0:
            raise ValueError("window_seconds must be positive")
        if self.slice_seconds < self.window_seconds:
            raise ValueError("slice_seconds must be >= window_seconds")
        if self.idle_ttl_seconds and self.lateness_seconds is not None:
            raise ValueError("state ends by idle time or by the watermark, not by both")
