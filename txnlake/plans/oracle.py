"""DuckDB oracle SQL for the registered queries.

Each statement inlines the fixture views it needs as CTEs over the driver
tables (``customer orders lineitem part supplier events``), then states
the operator the plain-SQL way (window functions, correlated conditions).
It is an independent formulation used only for cross-checking.
"""

from __future__ import annotations

from txnlake import config
from txnlake.operators import quality
from txnlake.operators.ingest import ID_NAMESPACE
from txnlake.plans import params as P

# --- fixture views -----------------------------------------------------------------

FIXTURES = {
    "f_customers": """
SELECT CAST(c_custkey AS VARCHAR(20)) AS id, c_name || '@Example.com' AS email,
 CASE c_nationkey % 4 WHEN 0 THEN 'VN' WHEN 1 THEN 'SG' WHEN 2 THEN 'US' ELSE 'JP' END AS country,
 CAST(c_custkey % 4 AS SMALLINT) AS kyc_level,
 CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY','FURNITURE') THEN 'LOW' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'MEDIUM' ELSE 'HIGH' END AS risk_band,
 TIMESTAMP '1995-01-01 00:00:00' AS created_at,
 TIMESTAMP '1995-01-01 00:00:00' + INTERVAL '1' DAY * CAST(c_custkey % 3 AS INT) AS updated_at FROM customer""",
    "f_accounts": """
SELECT 'A' || CAST(c_custkey AS VARCHAR(20)) AS id, CAST(c_custkey AS VARCHAR(20)) AS customer_id,
 CASE WHEN c_custkey % 2 = 0 THEN 'VND' ELSE 'USD' END AS currency, 'VN' AS country,
 CASE c_custkey % 10 WHEN 8 THEN 'SUSPENDED' WHEN 9 THEN 'CLOSED' ELSE 'ACTIVE' END AS status,
 TIMESTAMP '1995-01-01 00:00:00' AS created_at, TIMESTAMP '1995-01-01 00:00:00' AS updated_at FROM customer""",
    "f_account_snapshots": """
SELECT 'A' || CAST(o_custkey AS VARCHAR(20)) AS id, CAST(o_custkey AS VARCHAR(20)) AS customer_id,
 CASE WHEN o_custkey % 2 = 0 THEN 'VND' ELSE 'USD' END AS currency, 'VN' AS country,
 CASE o_orderstatus WHEN 'F' THEN 'ACTIVE' WHEN 'O' THEN 'SUSPENDED' ELSE 'CLOSED' END AS status,
 o_orderdate AS as_of, o_orderkey AS seq FROM orders""",
    "f_transactions": """
SELECT CAST(l_orderkey AS VARCHAR(20)) || '-' || CAST(l_linenumber AS VARCHAR(20)) AS id,
 'A' || CAST(o_custkey AS VARCHAR(20)) AS account_id,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'PAYMENT' WHEN '2-HIGH' THEN 'TRANSFER_IN' WHEN '3-MEDIUM' THEN 'TRANSFER_OUT' WHEN '4-NOT SPECIFIED' THEN 'REFUND' ELSE 'FEE' END AS type,
 CASE l_returnflag WHEN 'A' THEN 'SETTLED' WHEN 'R' THEN 'REVERSED' ELSE 'PENDING' END AS status,
 CAST(l_extendedprice AS DECIMAL(20,6)) AS amount,
 CASE WHEN o_custkey % 2 = 0 THEN 'VND' ELSE 'USD' END AS currency,
 CASE WHEN l_linenumber % 2 = 0 THEN '  ' || upper(p_name) ELSE p_name || ' ' END AS merchant_name,
 CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type END AS merchant_category,
 CASE s_nationkey % 4 WHEN 0 THEN 'VN' WHEN 1 THEN 'SG' WHEN 2 THEN 'US' ELSE 'JP' END AS country,
 l_shipdate AS created_at,
 CASE WHEN l_returnflag = 'A' THEN l_shipdate + INTERVAL '2' DAY ELSE NULL END AS settled_at,
 l_partkey, l_suppkey, l_quantity, l_discount, l_tax
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
    "f_cdc": """
SELECT event_id AS seq, CAST(event_id AS VARCHAR(20)) AS id, 'A' || CAST(user_id AS VARCHAR(20)) AS account_id,
 CAST(value AS DECIMAL(20,6)) AS amount, CASE WHEN user_id % 2 = 0 THEN 'VND' ELSE 'USD' END AS currency, ts AS created_at,
 CASE WHEN event_type = 'error' THEN 'u' ELSE 'c' END AS op FROM events""",
    "f_requests": """
SELECT e.event_id AS seq,
 CASE WHEN e.event_id % 50 = 46 THEN NULL WHEN e.event_id % 5 >= 3 THEN 'k' || CAST(e.event_id - e.event_id % 5 AS VARCHAR(20)) ELSE 'k' || CAST(e.event_id AS VARCHAR(20)) END AS idem_key,
 'A' || CAST(CASE WHEN b.event_id % 31 = 0 THEN 999999 ELSE b.user_id END AS VARCHAR(20)) AS account_id,
 CASE b.event_type WHEN 'purchase' THEN 'PAYMENT' WHEN 'click' THEN 'FEE' WHEN 'view' THEN 'REFUND' WHEN 'signup' THEN 'TRANSFER_IN' ELSE 'BAD' END AS type,
 CAST(CAST(b.value AS DECIMAL(20,2)) AS VARCHAR(30)) AS amount,
 CASE WHEN b.event_id % 17 = 0 THEN 'EUR' WHEN b.user_id % 2 = 0 THEN 'VND' ELSE 'USD' END AS currency,
 'Cafe ' || CAST(b.user_id % 20 AS VARCHAR(20)) AS merchant_name,
 CASE WHEN b.event_id % 3 = 0 THEN NULL ELSE 'coffee' END AS merchant_category, CAST(NULL AS VARCHAR(20)) AS description,
 CASE WHEN b.event_id % 23 = 0 THEN 'vn' ELSE 'VN' END AS country, e.ts AS created_at
FROM events e JOIN events b ON b.event_id = CASE WHEN e.event_id % 5 = 4 THEN e.event_id - 4 ELSE e.event_id END""",
    "f_customer_requests": """
SELECT c_custkey AS seq,
 CASE WHEN c_custkey % 10 = 9 THEN upper('customer') || CAST(c_custkey - 9 AS VARCHAR(20)) ELSE 'customer' || CAST(c_custkey AS VARCHAR(20)) END || '@example.com' AS email,
 CASE WHEN c_custkey % 19 = 0 THEN 'v1' ELSE 'VN' END AS country, CAST(c_custkey % 6 AS SMALLINT) AS kyc_level,
 CASE WHEN c_custkey % 13 = 0 THEN 'EXTREME' ELSE 'LOW' END AS risk_band FROM customer""",
    "f_account_requests": """
SELECT o_orderkey AS seq, CAST(o_custkey + CASE WHEN o_orderkey % 40 = 0 THEN 1000000 ELSE 0 END AS VARCHAR(20)) AS customer_id,
 CASE o_orderkey % 3 WHEN 0 THEN 'VND' WHEN 1 THEN 'USD' ELSE CASE WHEN o_orderkey % 7 = 0 THEN 'usd' ELSE 'EUR' END END AS currency, 'VN' AS country FROM orders""",
}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


# --- derived views -------------------------------------------------------------------

DERIVED = {
    "stg": """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY
  created_at, l_partkey, l_suppkey, l_quantity, amount, l_discount, l_tax, account_id, type, status,
  currency, merchant_name NULLS FIRST, merchant_category NULLS FIRST, country NULLS FIRST,
  settled_at NULLS FIRST) AS rn FROM f_transactions) WHERE rn = 1""",
    "cand": """
SELECT merchant_name, merchant_category, country, min(created_at) AS as_of
FROM f_transactions GROUP BY merchant_name, merchant_category, country""",
    "cust_feed": f"""
SELECT id AS bk, email, country, kyc_level, risk_band, greatest(created_at, updated_at) AS as_of FROM f_customers
UNION ALL
SELECT id, email, country, kyc_level,
  CASE WHEN CAST(id AS BIGINT) % 5 = 0 THEN (CASE WHEN risk_band = 'HIGH' THEN 'LOW' ELSE 'HIGH' END) ELSE risk_band END,
  TIMESTAMP '{P.SECOND_AS_OF}' FROM f_customers""",
    "cust_chg": """
SELECT *, (row_number() OVER w = 1)
  OR (lag(lower(email)) OVER w IS DISTINCT FROM lower(email))
  OR (lag(country) OVER w IS DISTINCT FROM country)
  OR (lag(kyc_level) OVER w IS DISTINCT FROM kyc_level)
  OR (lag(risk_band) OVER w IS DISTINCT FROM risk_band) AS chg
FROM cust_feed WINDOW w AS (PARTITION BY bk ORDER BY as_of)""",
    "dim_customer": """
SELECT bk AS customer_bk, email, country, kyc_level, risk_band, as_of AS valid_from,
  lead(as_of) OVER w AS valid_to, (lead(as_of) OVER w) IS NULL AS is_current,
  CAST(row_number() OVER w AS INTEGER) AS version
FROM cust_chg WHERE chg WINDOW w AS (PARTITION BY bk ORDER BY as_of)""",
    "acc_chg": """
SELECT *, (row_number() OVER w = 1)
  OR (lag(customer_id) OVER w IS DISTINCT FROM customer_id)
  OR (lag(currency) OVER w IS DISTINCT FROM currency)
  OR (lag(country) OVER w IS DISTINCT FROM country)
  OR (lag(status) OVER w IS DISTINCT FROM status) AS chg
FROM f_account_snapshots WINDOW w AS (PARTITION BY id ORDER BY as_of, seq)""",
    "dim_account": """
SELECT id AS account_bk, customer_id AS customer_bk, currency, country, status, as_of AS valid_from,
  lead(as_of) OVER w AS valid_to, (lead(as_of) OVER w) IS NULL AS is_current,
  CAST(row_number() OVER w AS INTEGER) AS version
FROM acc_chg WHERE chg WINDOW w AS (PARTITION BY id ORDER BY as_of, seq)""",
    "mer_chg": """
SELECT *, lower(trim(merchant_name)) AS bk, (row_number() OVER w = 1)
  OR (lag(coalesce(merchant_category, '')) OVER w IS DISTINCT FROM coalesce(merchant_category, ''))
  OR (lag(coalesce(country, '')) OVER w IS DISTINCT FROM coalesce(country, '')) AS chg
FROM cand WINDOW w AS (PARTITION BY lower(trim(merchant_name)) ORDER BY as_of,
  merchant_category NULLS FIRST, country NULLS FIRST, merchant_name NULLS FIRST)""",
    "dim_merchant": """
SELECT bk AS merchant_name_norm, merchant_category, country, as_of AS valid_from,
  lead(as_of) OVER w AS valid_to, (lead(as_of) OVER w) IS NULL AS is_current,
  CAST(row_number() OVER w AS INTEGER) AS version
FROM mer_chg WHERE chg WINDOW w AS (PARTITION BY bk ORDER BY as_of,
  merchant_category NULLS FIRST, country NULLS FIRST, merchant_name NULLS FIRST)""",
    "dim_account_b": f"""
SELECT * REPLACE (CASE WHEN version = 1 THEN TIMESTAMP '{P.FIXTURE_START}' ELSE valid_from END AS valid_from)
FROM dim_account""",
    "dim_customer_b": f"""
SELECT * REPLACE (CASE WHEN version = 1 THEN TIMESTAMP '{P.FIXTURE_START}' ELSE valid_from END AS valid_from)
FROM dim_customer""",
    "dim_merchant_b": f"""
SELECT * REPLACE (CASE WHEN version = 1 THEN TIMESTAMP '{P.FIXTURE_START}' ELSE valid_from END AS valid_from)
FROM dim_merchant""",
    "dim_account_k": "SELECT *, row_number() OVER (ORDER BY account_bk, version) AS account_sk FROM dim_account_b",
    "dim_customer_k": "SELECT *, row_number() OVER (ORDER BY customer_bk, version) AS customer_sk FROM dim_customer_b",
    "dim_merchant_k": "SELECT *, row_number() OVER (ORDER BY merchant_name_norm, version) AS merchant_sk FROM dim_merchant_b",
    "fact": """
SELECT t.id AS transaction_bk, c.customer_sk, a.account_sk, m.merchant_sk, t.type, t.status, t.amount,
  t.currency, t.country, t.created_at, t.settled_at, CAST(t.created_at AS DATE) AS created_date
FROM stg t
JOIN dim_account_k a ON a.account_bk = t.account_id AND a.valid_from <= t.created_at
  AND (a.valid_to IS NULL OR t.created_at < a.valid_to)
JOIN dim_customer_k c ON c.customer_bk = a.customer_bk AND c.valid_from <= t.created_at
  AND (c.valid_to IS NULL OR t.created_at < c.valid_to)
JOIN dim_merchant_k m ON m.merchant_name_norm = lower(trim(t.merchant_name)) AND m.valid_from <= t.created_at
  AND (m.valid_to IS NULL OR t.created_at < m.valid_to)""",
    "mart_gmv": """
SELECT CAST(created_at AS DATE) AS day_utc, currency, count(*) AS tx_count,
  CAST(sum(amount) AS DECIMAL(38,6)) AS total_amount FROM stg GROUP BY 1, 2""",
    "mart_top": f"""
SELECT m.merchant_name_norm, count(*) AS tx_count, CAST(sum(f.amount) AS DECIMAL(38,6)) AS total_amount
FROM fact f JOIN dim_merchant_k m ON m.merchant_sk = f.merchant_sk AND m.is_current
WHERE f.created_at >= (SELECT max(created_at) FROM f_transactions) - INTERVAL {config.TOP_MERCHANTS_DAYS} DAY
GROUP BY 1 ORDER BY total_amount DESC, merchant_name_norm LIMIT {config.TOP_MERCHANTS_K}""",
    # velocity: trailing window minus later-arriving ties, rule, flags
    "vwin": f"""
SELECT seq, id, account_id, currency, amount, created_at,
  count(*) OVER wr - count(*) OVER wt AS count_5m,
  CAST(sum(amount) OVER wr - coalesce(sum(amount) OVER wt, 0) AS DECIMAL(38,6)) AS sum_5m
FROM f_cdc WHERE op = 'c'
WINDOW wr AS (PARTITION BY account_id ORDER BY created_at
              RANGE BETWEEN INTERVAL {config.WINDOW_SECONDS} SECONDS PRECEDING AND CURRENT ROW),
       wt AS (PARTITION BY account_id, created_at ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)""",
    "valerts": f"""
SELECT *, make_timestamp((epoch_us(created_at) // {config.WINDOW_SECONDS * 1_000_000}) * {config.WINDOW_SECONDS * 1_000_000}) AS window_start,
  make_timestamp((epoch_us(created_at) // {config.WINDOW_SECONDS * 1_000_000} + 1) * {config.WINDOW_SECONDS * 1_000_000}) AS window_end
FROM (SELECT *, CASE WHEN count_5m >= {config.COUNT_THRESHOLD} THEN '{config.REASON_COUNT}'
  WHEN sum_5m >= (CASE WHEN currency = 'VND' THEN {config.SUM_THRESHOLD_VND} ELSE {config.SUM_THRESHOLD_OTHER} END)
  THEN '{config.REASON_SUM}' END AS reason FROM vwin) WHERE reason IS NOT NULL""",
    "vflags": """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY account_id, window_end, reason ORDER BY seq) AS rn
FROM valerts) WHERE rn = 1""",
}


# the same views over the requested transactions as change events
DERIVED["r_cdc"] = """
SELECT seq, CAST(seq AS VARCHAR) AS id, account_id, CAST(amount AS DECIMAL(20,6)) AS amount, currency, created_at,
  'c' AS op FROM f_requests"""
for _view, _name in (("vwin", "rwin"), ("valerts", "ralerts"), ("vflags", "rflags")):
    DERIVED[_name] = DERIVED[_view].replace("f_cdc", "r_cdc").replace("FROM vwin", "FROM rwin").replace(
        "FROM valerts", "FROM ralerts")


def _uuid5_sql(name_expr: str, namespace: str) -> str:
    """uuid5 in DuckDB text functions (sha1 over namespace bytes + name)."""
    ns = namespace.replace("-", "")
    h = f"sha1(unhex('{ns}') || encode({name_expr}))"
    variant = f"substr('89ab', ((strpos('0123456789abcdef', substr({h}, 17, 1)) - 1) & 3) + 1, 1)"
    return (f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
            f"{variant} || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))")


TXN_FIELD_ERRORS = f"""concat_ws(',',
  CASE WHEN account_id IS NULL THEN 'account_id' END,
  CASE WHEN type IS NULL OR type NOT IN {_in(config.TRANSACTION_TYPES)} THEN 'type' END,
  CASE WHEN TRY_CAST(amount AS DECIMAL(20,6)) IS NULL OR TRY_CAST(amount AS DECIMAL(20,6)) <= 0 THEN 'amount' END,
  CASE WHEN currency IS NULL OR NOT regexp_full_match(currency, '[A-Z]{{3}}') THEN 'currency' END,
  CASE WHEN merchant_name IS NULL THEN 'merchant_name' END,
  CASE WHEN country IS NULL OR NOT regexp_full_match(country, '[A-Z]{{2}}') THEN 'country' END)"""

REQUEST_HASH = f"""sha256(CAST(json_object('body', json_object('account_id', account_id, 'amount', amount,
  'country', country, 'currency', currency, 'description', description, 'merchant_category', merchant_category,
  'merchant_name', merchant_name, 'type', type), 'endpoint', {_q(config.TRANSACTION_ENDPOINT)}) AS VARCHAR))"""

DERIVED["req_r"] = f"""
SELECT q.*, a.id IS NOT NULL AS has_acc, a.currency AS acc_cur
FROM (SELECT *, {TXN_FIELD_ERRORS} AS errors, {REQUEST_HASH} AS h FROM f_requests) q
LEFT JOIN f_accounts a ON a.id = q.account_id"""
DERIVED["req_reason"] = """
SELECT *, CASE WHEN errors <> '' THEN 'INVALID' WHEN NOT has_acc THEN 'UNKNOWN_ACCOUNT'
  WHEN currency <> acc_cur THEN 'CURRENCY_MISMATCH' ELSE 'OK' END AS reason FROM req_r"""
DERIVED["req_claims"] = """
SELECT idem_key, min(seq) AS cseq, arg_min(h, seq) AS chash FROM req_reason
WHERE reason = 'OK' AND idem_key IS NOT NULL GROUP BY idem_key"""
DERIVED["req_class"] = """
SELECT r.*, c.cseq, CASE WHEN reason = 'INVALID' THEN 'INVALID' WHEN idem_key IS NULL THEN 'MISSING_KEY'
  WHEN c.cseq IS NULL OR r.seq < c.cseq THEN reason WHEN r.seq = c.cseq THEN 'NEW'
  WHEN r.h = c.chash THEN 'REPLAY' ELSE 'CONFLICT' END AS outcome
FROM req_reason r LEFT JOIN req_claims c USING (idem_key)"""
DERIVED["outbox"] = f"""
SELECT 'transaction' AS aggregate_type, {_uuid5_sql(_q(config.TRANSACTION_ENDPOINT + ':') + ' || idem_key', ID_NAMESPACE)} AS aggregate_id,
  'TransactionCreated' AS event_type, account_id, type, 'PENDING' AS status, amount, currency, merchant_name,
  merchant_category, country,
  CASE WHEN epoch_us(created_at) % 1000000 = 0 THEN strftime(created_at, '%Y-%m-%dT%H:%M:%S+00:00')
       ELSE strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS iso_created_at, created_at
FROM req_class WHERE outcome = 'NEW'"""

DEPENDS = {
    "stg": ["f_transactions"], "cand": ["f_transactions"], "cust_feed": ["f_customers"],
    "cust_chg": ["cust_feed"], "dim_customer": ["cust_chg"], "acc_chg": ["f_account_snapshots"],
    "dim_account": ["acc_chg"], "mer_chg": ["cand"], "dim_merchant": ["mer_chg"],
    "dim_account_b": ["dim_account"], "dim_customer_b": ["dim_customer"],
    "dim_merchant_b": ["dim_merchant"], "dim_account_k": ["dim_account_b"],
    "dim_customer_k": ["dim_customer_b"], "dim_merchant_k": ["dim_merchant_b"],
    "fact": ["stg", "dim_account_k", "dim_customer_k", "dim_merchant_k"],
    "mart_gmv": ["stg"], "mart_top": ["fact", "dim_merchant_k", "f_transactions"],
    "r_cdc": ["f_requests"], "rwin": ["r_cdc"], "ralerts": ["rwin"], "rflags": ["ralerts"],
    "vwin": ["f_cdc"], "valerts": ["vwin"], "vflags": ["valerts"],
    "req_r": ["f_requests", "f_accounts"], "req_reason": ["req_r"], "req_claims": ["req_reason"],
    "req_class": ["req_reason", "req_claims"], "outbox": ["req_class"],
}


def with_views(body: str, *needed: str) -> str:
    """Prefix ``body`` with the CTEs it needs, dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in DEPENDS.get(name, []):
            visit(dep)
        order.append(name)

    for n in needed:
        visit(n)
    ctes = []
    for n in order:
        text = FIXTURES.get(n) or DERIVED[n]
        ctes.append(f"{n} AS ({text.strip()}\n)")
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()


def _suite_sql(view: str, suite: list[dict]) -> str:
    parts = []
    for pos, exp in enumerate(suite):
        kind = exp["expectation_type"].removeprefix("expect_column_values_to_")
        kw = exp["kwargs"]
        col = kw["column"]
        mostly = float(kw.get("mostly") or 1.0)
        head = f"SELECT {pos} AS position, {_q(exp['expectation_type'])} AS expectation, {_q(col)} AS \"column\""
        if kind == "be_unique":
            parts.append(f"""{head}, CAST(coalesce(sum(c), 0) AS BIGINT) AS total,
  CAST(coalesce(sum(c) FILTER (WHERE v IS NOT NULL AND c > 1), 0) AS BIGINT) AS unexpected,
  coalesce(sum(c) FILTER (WHERE v IS NOT NULL AND c > 1), 0) <= coalesce(sum(c) FILTER (WHERE v IS NOT NULL), 0) * {1.0 - mostly} + 1e-9 AS success
  FROM (SELECT {col} AS v, count(*) AS c FROM {view} GROUP BY {col})""")
            continue
        if kind == "not_be_null":
            bad, basis = f"{col} IS NULL", "count(*)"
        else:
            basis = f"count({col})"
            if kind == "match_regex":
                body = kw["regex"].removeprefix("^").removesuffix("$")
                bad = f"{col} IS NOT NULL AND NOT regexp_full_match({col}, {_q(body)})"
            elif kind == "be_in_set":
                bad = f"{col} IS NOT NULL AND {col} NOT IN {_in(kw['value_set'])}"
            elif kind == "be_greater_than":
                bad = f"{col} IS NOT NULL AND {col} <= {kw['value']}"
            elif kind == "be_between":
                conds = []
                for key, op in (("min_value", "<"), ("max_value", ">")):
                    v = kw.get(key)
                    if v is None:
                        continue
                    if isinstance(v, str):
                        bound = f"TIMESTAMP {_q(v)}"
                        if kw.get("max_offset_seconds"):
                            bound += f" + INTERVAL {int(kw['max_offset_seconds'])} SECOND"
                    else:
                        bound = str(v)
                    conds.append(f"{col} {op} {bound}")
                bad = f"{col} IS NOT NULL AND ({' OR '.join(conds)})"
            else:
                raise ValueError(kind)
        parts.append(f"""{head}, CAST(count(*) AS BIGINT) AS total,
  CAST(count(*) FILTER (WHERE {bad}) AS BIGINT) AS unexpected,
  count(*) FILTER (WHERE {bad}) <= {basis} * {1.0 - mostly} + 1e-9 AS success FROM {view}""")
    return "\nUNION ALL\n".join(parts)


DIRTY = {
    "dirty_customers": f"""
SELECT CAST(seq AS VARCHAR) AS id, email, country, kyc_level, risk_band,
  TIMESTAMP '1995-01-01 00:00:00' AS created_at, TIMESTAMP '1995-01-01 00:00:00' AS updated_at
FROM f_customer_requests""",
    "dirty_accounts": """
SELECT 'R' || CAST(seq AS VARCHAR) AS id, customer_id, currency, country, 'ACTIVE' AS status,
  TIMESTAMP '1995-01-01 00:00:00' AS created_at, TIMESTAMP '1995-01-01 00:00:00' AS updated_at
FROM f_account_requests""",
    "dirty_transactions": """
SELECT idem_key AS id, account_id, type, 'PENDING' AS status, TRY_CAST(amount AS DECIMAL(20,6)) AS amount,
  currency, country, created_at FROM f_requests""",
}
DERIVED.update(DIRTY)
DEPENDS.update({"dirty_customers": ["f_customer_requests"], "dirty_accounts": ["f_account_requests"],
                "dirty_transactions": ["f_requests"]})

TXN_COLS = "id, account_id, type, status, amount, currency, merchant_name, merchant_category, country, created_at, settled_at"


def _sql() -> dict[str, str]:
    s: dict[str, str] = {}
    s["incr_extract"] = with_views(
        f"SELECT {TXN_COLS} FROM f_transactions WHERE created_at > TIMESTAMP '{P.TXN_WATERMARK}'",
        "f_transactions")
    s["wm_advance"] = with_views(f"""
SELECT 'transactions' AS table_name, coalesce(max(created_at), TIMESTAMP '{P.TXN_WATERMARK}') AS next_watermark
FROM f_transactions WHERE created_at > TIMESTAMP '{P.TXN_WATERMARK}'
UNION ALL
SELECT 'customers', coalesce(max(greatest(created_at, updated_at)), TIMESTAMP '{P.CUSTOMER_WATERMARK}')
FROM f_customers WHERE greatest(created_at, updated_at) > TIMESTAMP '{P.CUSTOMER_WATERMARK}'""",
        "f_transactions", "f_customers")
    dedupe = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY
  created_at, l_partkey, l_suppkey, l_quantity, amount, l_discount, l_tax, account_id, type, status,
  currency, merchant_name NULLS FIRST, merchant_category NULLS FIRST, country NULLS FIRST,
  settled_at NULLS FIRST) AS rn FROM {src}) WHERE rn = 1"""
    s["stg_insert_if_absent"] = with_views(f"""
, pre AS ({dedupe.format(src='(SELECT * FROM f_transactions WHERE l_suppkey % 2 = 0)')})
SELECT id, account_id, amount, created_at FROM pre
UNION ALL
SELECT id, account_id, amount, created_at FROM stg WHERE id NOT IN (SELECT id FROM pre)""", "stg")
    s["stg_insert_if_absent"] = s["stg_insert_if_absent"].replace("\n, pre AS", ", pre AS", 1)
    s["incr_changed_customers"] = with_views(f"""
SELECT id, greatest(created_at, updated_at) AS as_of FROM f_customers
WHERE greatest(created_at, updated_at) > TIMESTAMP '{P.CUSTOMER_WATERMARK}'""", "f_customers")
    s["incr_changed_accounts"] = with_views(f"""
SELECT id, greatest(created_at, updated_at) AS as_of FROM f_accounts
WHERE greatest(created_at, updated_at) > TIMESTAMP '{P.ACCOUNT_WATERMARK}'""", "f_accounts")
    s["merchant_candidates"] = with_views("SELECT * FROM cand", "cand")
    s["fact_partitions"] = with_views("""
SELECT DISTINCT 'fact_transactions_y' || strftime(d, '%Y') || 'm' || strftime(d, '%m') AS partition_name,
  CAST(date_trunc('month', d) AS DATE) AS start_date,
  CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE) AS end_date
FROM (SELECT CAST(created_at AS DATE) AS d FROM f_transactions)""", "f_transactions")
    s["scalar_txn_profile"] = with_views("""
SELECT id, lower(trim(merchant_name)) AS merchant_name_norm, CAST(created_at AS DATE) AS created_date,
  CAST(date_trunc('month', CAST(created_at AS DATE)) AS DATE) AS month_start,
  CAST(date_trunc('month', CAST(created_at AS DATE)) + INTERVAL 1 MONTH AS DATE) AS next_month,
  coalesce(merchant_category, '') AS category_or_empty, CAST(amount AS VARCHAR) AS amount_text
FROM f_transactions""", "f_transactions")
    s["scd2_dim_customer"] = with_views("""
SELECT customer_bk AS bk, email, country, kyc_level, risk_band, valid_from, valid_to, is_current, version
FROM dim_customer""", "dim_customer")
    s["scd2_dim_account"] = with_views(
        "SELECT account_bk AS bk, status, valid_from, valid_to, is_current, version FROM dim_account",
        "dim_account")
    s["scd2_dim_merchant"] = with_views("SELECT * FROM dim_merchant", "dim_merchant")
    s["current_version"] = with_views(
        "SELECT account_bk AS bk, status, version FROM dim_account WHERE is_current", "dim_account")
    s["surrogate_keys"] = with_views(
        "SELECT account_bk AS bk, version, row_number() OVER (ORDER BY account_bk, version) AS sk FROM dim_account",
        "dim_account")
    viol = "SELECT {name} AS dim, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS violations FROM (SELECT {bk}, count(*) AS n FROM {dim} WHERE is_current GROUP BY {bk})"
    s["dq_scd2_current"] = with_views("\nUNION ALL\n".join([
        viol.format(name="'dim_customer'", bk="customer_bk", dim="dim_customer"),
        viol.format(name="'dim_account'", bk="account_bk", dim="dim_account"),
        viol.format(name="'dim_merchant'", bk="merchant_name_norm", dim="dim_merchant")]),
        "dim_customer", "dim_account", "dim_merchant")
    s["asof_account"] = with_views("""
SELECT t.id, a.account_bk, a.version AS account_version FROM stg t
LEFT JOIN dim_account_b a ON a.account_bk = t.account_id AND a.valid_from <= t.created_at
  AND (a.valid_to IS NULL OR t.created_at < a.valid_to)""", "stg", "dim_account_b")
    s["asof_customer"] = with_views("""
SELECT t.id, c.customer_bk, c.version AS customer_version FROM stg t
LEFT JOIN dim_account_b a ON a.account_bk = t.account_id AND a.valid_from <= t.created_at
  AND (a.valid_to IS NULL OR t.created_at < a.valid_to)
LEFT JOIN dim_customer_b c ON c.customer_bk = a.customer_bk AND c.valid_from <= t.created_at
  AND (c.valid_to IS NULL OR t.created_at < c.valid_to)""", "stg", "dim_account_b", "dim_customer_b")
    s["dim_account_customer"] = with_views("""
, acc AS (SELECT * FROM dim_account WHERE valid_to IS NULL OR valid_to > valid_from),
 cus AS (SELECT * FROM dim_customer WHERE valid_to IS NULL OR valid_to > valid_from),
 starts AS (
  SELECT account_bk, version, valid_from AS f FROM acc
  UNION
  SELECT a.account_bk, a.version, c.valid_from FROM acc a JOIN cus c ON c.customer_bk = a.customer_bk
    AND c.valid_from > a.valid_from AND (a.valid_to IS NULL OR c.valid_from < a.valid_to))
SELECT a.account_bk, a.customer_bk, a.version AS account_version, c.version AS customer_version, s.f AS valid_from,
  lead(s.f) OVER (PARTITION BY s.account_bk ORDER BY s.f) AS valid_to
FROM starts s JOIN acc a ON a.account_bk = s.account_bk AND a.version = s.version
LEFT JOIN cus c ON c.customer_bk = a.customer_bk AND c.valid_from <= s.f AND (c.valid_to IS NULL OR s.f < c.valid_to)""",
        "dim_account", "dim_customer").replace("\n, acc AS", ", acc AS", 1)
    s["asof_merchant"] = with_views("""
SELECT t.id, m.merchant_name_norm, m.version AS merchant_version FROM stg t
LEFT JOIN dim_merchant_b m ON m.merchant_name_norm = lower(trim(t.merchant_name)) AND m.valid_from <= t.created_at
  AND (m.valid_to IS NULL OR t.created_at < m.valid_to)""", "stg", "dim_merchant_b")
    s["semi_resolved"] = with_views("SELECT transaction_bk AS id FROM fact", "fact")
    s["fact_load"] = with_views("SELECT * FROM fact", "fact")
    s["fact_unresolved"] = with_views("""
SELECT t.id, a.version IS NULL AS no_account_sk, c.version IS NULL AS no_customer_sk, m.version IS NULL AS no_merchant_sk
FROM stg t
LEFT JOIN dim_account a ON a.account_bk = t.account_id AND a.valid_from <= t.created_at
  AND (a.valid_to IS NULL OR t.created_at < a.valid_to)
LEFT JOIN dim_customer c ON c.customer_bk = a.customer_bk AND c.valid_from <= t.created_at
  AND (c.valid_to IS NULL OR t.created_at < c.valid_to)
LEFT JOIN dim_merchant m ON m.merchant_name_norm = lower(trim(t.merchant_name)) AND m.valid_from <= t.created_at
  AND (m.valid_to IS NULL OR t.created_at < m.valid_to)
WHERE a.version IS NULL OR c.version IS NULL OR m.version IS NULL""", "stg", "dim_account", "dim_customer",
        "dim_merchant")
    s["fact_insert_if_absent"] = with_views(f"""
SELECT transaction_bk, created_date FROM fact WHERE created_at <= TIMESTAMP '{P.FACT_FIRST_UNTIL}'
UNION ALL
SELECT transaction_bk, created_date FROM fact f2 WHERE created_at > TIMESTAMP '{P.FACT_SECOND_FROM}'
  AND NOT EXISTS (SELECT 1 FROM fact f1 WHERE f1.created_at <= TIMESTAMP '{P.FACT_FIRST_UNTIL}'
                  AND f1.transaction_bk = f2.transaction_bk AND f1.created_date = f2.created_date)""",
        "fact")
    s["cross_current_keys"] = with_views("""
SELECT t.id, c.customer_sk, a.account_sk, m.merchant_sk FROM stg t
JOIN dim_account_k a ON a.account_bk = t.account_id AND a.is_current
JOIN dim_customer_k c ON c.customer_bk = a.customer_bk AND c.is_current
JOIN dim_merchant_k m ON m.merchant_name_norm = lower(trim(t.merchant_name)) AND m.is_current""",
        "stg", "dim_account_k", "dim_customer_k", "dim_merchant_k")
    s["mart_gmv_daily"] = with_views("SELECT * FROM mart_gmv", "mart_gmv")
    s["mart_top_merchants"] = with_views("SELECT * FROM mart_top", "mart_top")
    s["gmv_series_range"] = with_views(
        "SELECT currency, min(total_amount) AS min_total, max(total_amount) AS max_total FROM mart_gmv GROUP BY currency",
        "mart_gmv")
    s["serve_gmv_daily"] = with_views(f"""
SELECT CAST(day_utc AS VARCHAR) AS day_utc, currency, tx_count, CAST(total_amount AS VARCHAR) AS total_amount
FROM mart_gmv WHERE currency = '{P.SERVE_GMV_CURRENCY}'
  AND day_utc >= (SELECT max(day_utc) FROM mart_gmv) - {P.SERVE_GMV_DAYS}
ORDER BY day_utc""", "mart_gmv")
    s["serve_top_merchants"] = with_views(f"""
SELECT merchant_name_norm, tx_count, CAST(total_amount AS VARCHAR) AS total_amount FROM mart_top
ORDER BY mart_top.total_amount DESC, merchant_name_norm LIMIT {P.SERVE_TOP_LIMIT}""", "mart_top")
    s["dq_customers"] = with_views(_suite_sql("dirty_customers", quality.CUSTOMER_SUITE), "dirty_customers")
    s["dq_accounts"] = with_views(_suite_sql("dirty_accounts", quality.ACCOUNT_SUITE), "dirty_accounts")
    s["dq_transactions"] = with_views(
        _suite_sql("dirty_transactions", quality.transaction_suite(P.DQ_NOW)), "dirty_transactions")
    s["dq_unique"] = with_views("""
SELECT 'id' AS "column", CAST(coalesce(sum(c) FILTER (WHERE c > 1), 0) AS BIGINT) AS unexpected
FROM (SELECT id, count(*) AS c FROM f_transactions WHERE id IS NOT NULL GROUP BY id)""", "f_transactions")
    s["dq_fk_orphans"] = with_views("""
SELECT count(*) AS orphans FROM f_requests r LEFT JOIN f_accounts a ON a.id = r.account_id WHERE a.id IS NULL""",
        "f_requests", "f_accounts")
    s["ingest_checks"] = with_views(f"SELECT seq, {TXN_FIELD_ERRORS} AS errors FROM f_requests", "f_requests")
    s["ingest_customers"] = with_views(f"""
, r AS (SELECT *, concat_ws(',',
    CASE WHEN email IS NULL OR NOT regexp_full_match(email, '[^@\\s]+@[^@\\s]+\\.[^@\\s]+') THEN 'email' END,
    CASE WHEN country IS NULL OR NOT regexp_full_match(country, '[A-Z]{{2}}') THEN 'country' END,
    CASE WHEN NOT (coalesce(kyc_level, 0) BETWEEN 0 AND 3) THEN 'kyc_level' END,
    CASE WHEN coalesce(risk_band, 'LOW') NOT IN {_in(config.RISK_BANDS)} THEN 'risk_band' END) AS errors
  FROM f_customer_requests),
 firsts AS (SELECT lower(email) AS le, min(seq) AS fseq FROM r WHERE errors = '' GROUP BY 1),
 taken AS (SELECT DISTINCT lower(email) AS le FROM f_customers)
SELECT seq, CASE WHEN errors <> '' THEN 'INVALID'
  WHEN lower(email) IN (SELECT le FROM taken) OR seq <> (SELECT fseq FROM firsts WHERE le = lower(email)) THEN 'CONFLICT'
  ELSE 'CREATED' END AS outcome,
  CAST(CASE WHEN errors LIKE '%email%' OR errors LIKE '%country%' THEN 422 WHEN errors <> '' THEN 400
  WHEN lower(email) IN (SELECT le FROM taken) OR seq <> (SELECT fseq FROM firsts WHERE le = lower(email)) THEN 409
  ELSE 201 END AS INTEGER) AS code
FROM r""", "f_customer_requests", "f_customers").replace("\n, r AS", ", r AS", 1)
    s["ingest_accounts"] = with_views(f"""
, r AS (SELECT q.*, concat_ws(',',
    CASE WHEN customer_id IS NULL THEN 'customer_id' END,
    CASE WHEN currency IS NULL OR NOT regexp_full_match(currency, '[A-Z]{{3}}') THEN 'currency' END,
    CASE WHEN NOT regexp_full_match(coalesce(country, 'VN'), '[A-Z]{{2}}') THEN 'country' END) AS errors,
    EXISTS (SELECT 1 FROM f_customers c WHERE c.id = q.customer_id) AS has_cust
  FROM f_account_requests q),
 firsts AS (SELECT customer_id, currency, min(seq) AS fseq FROM r WHERE errors = '' AND has_cust GROUP BY 1, 2),
 open_acc AS (SELECT DISTINCT customer_id, currency FROM f_accounts WHERE status <> 'CLOSED'),
 o AS (SELECT r.seq, CASE WHEN errors <> '' THEN 'INVALID' WHEN NOT has_cust THEN 'UNKNOWN_CUSTOMER'
    WHEN EXISTS (SELECT 1 FROM open_acc x WHERE x.customer_id = r.customer_id AND x.currency = r.currency)
      OR r.seq <> f.fseq THEN 'CONFLICT' ELSE 'CREATED' END AS outcome
  FROM r LEFT JOIN firsts f ON f.customer_id = r.customer_id AND f.currency = r.currency)
SELECT seq, outcome, CAST(CASE outcome WHEN 'CREATED' THEN 201 WHEN 'CONFLICT' THEN 409 WHEN 'INVALID' THEN 422
  ELSE 400 END AS INTEGER) AS code
FROM o""", "f_account_requests", "f_customers", "f_accounts").replace("\n, r AS", ", r AS", 1)
    s["ingest_transactions"] = with_views("SELECT seq, reason FROM req_reason", "req_reason")
    s["ingest_idempotency"] = with_views("""
SELECT seq, idem_key, outcome, CAST(CASE WHEN outcome = 'INVALID' THEN 422 WHEN outcome IN ('NEW', 'REPLAY') THEN 201
  WHEN outcome = 'CONFLICT' THEN 409 ELSE 400 END AS INTEGER) AS code FROM req_class""", "req_class")
    s["request_hash"] = with_views(f"SELECT seq, {REQUEST_HASH} AS request_hash FROM f_requests", "f_requests")
    outbox_cols = """SELECT aggregate_type, aggregate_id, event_type, aggregate_id AS p_id, account_id AS p_account_id,
  type AS p_type, status AS p_status, amount AS p_amount, currency AS p_currency, merchant_name AS p_merchant_name,
  merchant_category AS p_merchant_category, country AS p_country, iso_created_at AS p_created_at, created_at
FROM outbox"""
    s["outbox_events"] = with_views(outbox_cols, "outbox")
    s["outbox_latest"] = with_views(outbox_cols + f" ORDER BY created_at DESC, aggregate_id DESC LIMIT {P.OUTBOX_LIMIT}",
                                    "outbox")
    s["cascade_delete"] = with_views(f"""
, cust AS (SELECT * FROM f_customers WHERE CAST(id AS BIGINT) % {P.CASCADE_MODULUS} <> 0),
 acc AS (SELECT * FROM f_accounts WHERE customer_id IN (SELECT id FROM cust))
SELECT 'customers' AS table_name, count(*) AS remaining FROM cust
UNION ALL SELECT 'accounts', count(*) FROM acc
UNION ALL SELECT 'transactions', count(*) FROM f_transactions WHERE account_id IN (SELECT id FROM acc)
UNION ALL SELECT 'risk_flags', count(*) FROM vflags WHERE account_id IN (SELECT id FROM acc)""",
        "f_customers", "f_accounts", "f_transactions", "vflags").replace("\n, cust AS", ", cust AS", 1)
    s["velocity_window"] = with_views("SELECT seq, count_5m, sum_5m FROM vwin", "vwin")
    s["velocity_alerts"] = with_views(
        "SELECT seq, account_id, window_start, window_end, count_5m, sum_5m, reason FROM valerts", "valerts")
    s["velocity_alerts_day"] = with_views("""
, w AS (SELECT seq, account_id, currency, created_at, count(*) OVER wr - count(*) OVER wt AS count_5m,
    CAST(sum(amount) OVER wr - coalesce(sum(amount) OVER wt, 0) AS DECIMAL(38,6)) AS sum_5m
  FROM f_cdc WHERE op = 'c'
  WINDOW wr AS (PARTITION BY account_id ORDER BY created_at
                RANGE BETWEEN INTERVAL 86400 SECONDS PRECEDING AND CURRENT ROW),
         wt AS (PARTITION BY account_id, created_at ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
 r AS (SELECT *, CASE WHEN count_5m >= 5 THEN 'VELOCITY_COUNT'
    WHEN sum_5m >= (CASE currency WHEN 'VND' THEN 2000000 ELSE 100 END) THEN 'VELOCITY_SUM' END AS reason FROM w)
SELECT seq, account_id, CAST(CAST(created_at AS DATE) AS TIMESTAMP) AS window_start,
  CAST(CAST(created_at AS DATE) + 1 AS TIMESTAMP) AS window_end, count_5m, sum_5m, reason
FROM r WHERE reason IS NOT NULL""", "f_cdc").replace("\n, w AS", ", w AS", 1)
    s["velocity_flags"] = with_views(
        "SELECT account_id, window_start, window_end, reason, count_5m, sum_5m FROM vflags", "vflags")
    s["flags_known_account"] = with_views("""
SELECT account_id, window_end, reason FROM rflags WHERE account_id IN (SELECT id FROM f_accounts)""",
        "rflags", "f_accounts")
    s["flags_orphans"] = with_views("""
SELECT account_id, window_end, reason, count_5m, sum_5m FROM rflags
WHERE account_id NOT IN (SELECT id FROM f_accounts)""", "rflags", "f_accounts")
    name = "account_id || ':' || strftime(window_end, '%Y-%m-%dT%H:%M:%S') || '+00:00:' || reason"
    s["serve_risk_flags"] = with_views(f"""
SELECT {_uuid5_sql(name, config.FLAG_NAMESPACE)} AS event_id, account_id, window_start, window_end, count_5m, CAST(sum_5m AS VARCHAR) AS sum_5m, reason, created_at
FROM vflags WHERE created_at >= (SELECT max(created_at) FROM f_cdc) - INTERVAL {P.SERVE_FLAG_HOURS} HOUR
ORDER BY created_at DESC, account_id, reason""", "vflags", "f_cdc")
    s["uuid5_ids"] = with_views(
        f"SELECT {_uuid5_sql(name, config.FLAG_NAMESPACE)} AS event_id, account_id, window_end, reason FROM vflags",
        "vflags")
    s["cdc_decode"] = with_views(
        "SELECT seq, account_id, amount, currency, created_at FROM f_cdc WHERE op = 'c'", "f_cdc")
    s["cdc_decode_guards"] = with_views("""
SELECT seq, account_id, amount, CASE seq % 10 WHEN 5 THEN 'VND' ELSE currency END AS currency, created_at
FROM f_cdc WHERE op = 'c' AND seq % 10 >= 5""", "f_cdc")
    # the stream's input is time-ordered per account, where it equals the batch rule
    s["velocity_stream"] = s["velocity_alerts"]
    # the watermark before an arrival: the latest event of those before it, in whole milliseconds, less the lateness
    s["velocity_late_events"] = with_views("""
, t AS (SELECT *, epoch_us(created_at) AS us FROM f_cdc),
 a AS (SELECT seq, account_id, amount, created_at, us, least(2,
      (us - (SELECT min(us) FROM t)) * 3 // ((SELECT max(us) FROM t) - (SELECT min(us) FROM t) + 1)
      + CASE WHEN seq % 10 = 3 THEN 1 ELSE 0 END) AS arrival
    FROM t WHERE op = 'c'),
 w AS (SELECT n.arrival, max(a.us) // 1000 * 1000 - 21600000000 AS mark
    FROM (SELECT DISTINCT arrival FROM a) n JOIN a ON a.arrival < n.arrival GROUP BY n.arrival)
SELECT a.seq, a.account_id, a.amount, a.created_at FROM a JOIN w ON w.arrival = a.arrival AND a.us < w.mark""",
        "f_cdc").replace("\n, t AS", ", t AS", 1)
    s["velocity_messages"] = with_views(f"""
SELECT account_id AS key, {_uuid5_sql(name, config.FLAG_NAMESPACE)} AS event_id, account_id,
  strftime(window_start, '%Y-%m-%dT%H:%M:%S+00:00') AS window_start,
  strftime(window_end, '%Y-%m-%dT%H:%M:%S+00:00') AS window_end,
  count_5m, CAST(sum_5m AS VARCHAR) AS sum_5m, reason, id AS tx_example
FROM valerts""", "valerts")
    # versions with late changes: every version again, 200 days earlier and closed after 300
    late = """late AS (
  SELECT account_bk, version, valid_from, valid_to FROM dim_account_b
  UNION ALL
  SELECT account_bk, version + 1000, valid_from - INTERVAL 200 DAY, valid_from + INTERVAL 100 DAY
  FROM dim_account_b)"""
    s["asof_late_changes"] = with_views(f"""
, {late}
SELECT t.id, (SELECT l.version FROM late l WHERE l.account_bk = t.account_id AND l.valid_from <= t.created_at
    AND (l.valid_to IS NULL OR t.created_at < l.valid_to)
    ORDER BY l.valid_from DESC, l.version DESC LIMIT 1) AS account_version
FROM stg t""", "stg", "dim_account_b").replace("\n, late AS", ", late AS", 1)
    s["dq_interval_overlaps"] = with_views(f"""
, {late},
 o AS (SELECT *, max(coalesce(valid_to, TIMESTAMP '9999-12-31')) OVER (PARTITION BY account_bk
    ORDER BY valid_from, version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM late)
SELECT count(*) FILTER (valid_to < valid_from OR reached > valid_from) AS violations FROM o""",
        "dim_account_b").replace("\n, late AS", ", late AS", 1)
    s["cdc_table_state"] = with_views("""
, acc AS (SELECT id, status, as_of, seq FROM f_account_snapshots
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1),
 txn AS (SELECT 'T' || CAST(event_id - event_id % 3 AS VARCHAR) AS id, event_type, event_id,
    CASE event_id % 3 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'SETTLED' ELSE 'REVERSED' END AS status,
    CAST(value AS DECIMAL(20,6)) AS amount, ts FROM events
    QUALIFY row_number() OVER (PARTITION BY event_id // 3 ORDER BY event_id DESC) = 1)
SELECT 'accounts' AS table_name, id, status, CAST(NULL AS DECIMAL(20,6)) AS amount, as_of AS changed_at
FROM acc WHERE seq % 11 <> 3
UNION ALL
SELECT 'transactions', id, status, amount, ts FROM txn WHERE event_type <> 'error'""",
        "f_account_snapshots").replace("\n, acc AS", ", acc AS", 1)
    s["ingest_idempotency_two_batches"] = s["ingest_idempotency"]
    s["ingest_stream"] = s["ingest_idempotency"]
    s["idempotency_records"] = with_views("""
SELECT 'POST /v1/transactions' AS endpoint, idem_key, CAST(201 AS INTEGER) AS response_code
FROM req_class WHERE outcome = 'NEW'""", "req_class")
    return s


ORACLE_SQL = _sql()
