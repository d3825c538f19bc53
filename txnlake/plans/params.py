"""Fixed parameters of the registered queries (shared by Spark and oracle SQL).

Time is never read from the clock inside an operator: every "now" is an
explicit value, either a literal below or ``max(created_at)`` of the input.
"""

TXN_WATERMARK = "1998-01-01 00:00:00"        # incr_extract, wm_advance
CUSTOMER_WATERMARK = "1995-01-01 12:00:00"   # incr_changed_customers
ACCOUNT_WATERMARK = "1994-12-31 00:00:00"    # incr_changed_accounts
SECOND_AS_OF = "2000-01-01 00:00:00"         # customers re-fed with changed risk_band
FIXTURE_START = "1995-01-01 00:00:00"        # v1 valid_from of dims used by facts
FACT_FIRST_UNTIL = "1998-06-30 00:00:00"     # fact_insert_if_absent: run 1 takes <= this
FACT_SECOND_FROM = "1998-01-01 00:00:00"     # run 2 takes > this (overlap on purpose)
DQ_NOW = "2024-01-20 00:00:00"               # "now" of the transaction suite
SERVE_GMV_CURRENCY = "VND"
SERVE_GMV_DAYS = 30
SERVE_TOP_LIMIT = 10
SERVE_FLAG_HOURS = 24
OUTBOX_LIMIT = 10
CASCADE_MODULUS = 100                        # customers with id % 100 = 0 are deleted
# Window of the velocity rule where it is run by day
DAY_SECONDS = 86400
# Event time a velocity event may lie behind the latest one
LATENESS_SECONDS = 6 * 3600
