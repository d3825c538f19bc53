"""Declarative data-quality suites evaluated as Spark aggregates.

A suite is data: a list of ``{"expectation_type", "kwargs"}`` entries.  All
row-local expectations of a table are computed in ONE aggregate pass (one
scan, partial aggregation); uniqueness needs a keyed pass per column.  The
result has one row per expectation: position, expectation, column, total,
unexpected, success.  NULLs are ignored by every expectation except
not-null, and ``mostly`` is the required fraction of non-null rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake import config
from txnlake.functions.scalar import full_match


class DataQualityError(RuntimeError):
    pass


def _e(kind: str, column: str, **kwargs) -> dict:
    return {"expectation_type": f"expect_column_values_to_{kind}", "kwargs": {"column": column, **kwargs}}


CUSTOMER_SUITE = [
    _e("not_be_null", "id"),
    _e("be_unique", "id"),
    _e("not_be_null", "email"),
    _e("match_regex", "country", regex="^[A-Z]{2}$"),
    _e("be_between", "kyc_level", min_value=0, max_value=3, mostly=1.0),
    _e("be_in_set", "risk_band", value_set=config.RISK_BANDS),
    _e("not_be_null", "created_at"),
    _e("not_be_null", "updated_at"),
]

ACCOUNT_SUITE = [
    _e("not_be_null", "id"),
    _e("be_unique", "id"),
    _e("not_be_null", "customer_id"),
    _e("match_regex", "currency", regex="^[A-Z]{3}$"),
    _e("match_regex", "country", regex="^[A-Z]{2}$"),
    _e("be_in_set", "status", value_set=config.ACCOUNT_STATUSES),
    _e("not_be_null", "created_at"),
    _e("not_be_null", "updated_at"),
]


def transaction_suite(now_literal: str) -> list[dict]:
    """Transactions suite; ``created_at`` may not exceed now + 120 s."""
    return [
        _e("not_be_null", "id"),
        _e("be_unique", "id"),
        _e("not_be_null", "account_id"),
        _e("be_in_set", "type", value_set=config.TRANSACTION_TYPES),
        _e("be_in_set", "status", value_set=config.TRANSACTION_STATUSES),
        _e("match_regex", "currency", regex="^[A-Z]{3}$"),
        _e("match_regex", "country", regex="^[A-Z]{2}$"),
        _e("be_greater_than", "amount", value=0),
        _e("not_be_null", "created_at"),
        _e("be_between", "created_at", max_value=now_literal,
           max_offset_seconds=config.FUTURE_SKEW_SECONDS),
    ]


def _regex_body(regex: str) -> str:
    body = regex
    if body.startswith("^"):
        body = body[1:]
    if body.endswith("$"):
        body = body[:-1]
    return body


def _violation(exp: dict) -> Column:
    """Predicate that marks a non-null value as unexpected."""
    kind = exp["expectation_type"].removeprefix("expect_column_values_to_")
    kw = exp["kwargs"]
    c = F.col(kw["column"])
    if kind == "match_regex":
        return ~full_match(c, _regex_body(kw["regex"]))
    if kind == "be_in_set":
        return ~c.isin(*kw["value_set"])
    if kind == "be_greater_than":
        return c <= F.lit(kw["value"])
    if kind == "be_between":
        bad = F.lit(False)
        if kw.get("min_value") is not None:
            bad = bad | (c < _bound(kw["min_value"], kw, c))
        if kw.get("max_value") is not None:
            bad = bad | (c > _bound(kw["max_value"], kw, c))
        return bad
    raise ValueError(f"unsupported expectation {exp['expectation_type']}")


def _bound(value, kw: dict, c: Column) -> Column:
    if isinstance(value, str):
        ts = F.lit(value).cast("timestamp_ntz")
        off = kw.get("max_offset_seconds")
        return ts + F.make_dt_interval(secs=F.lit(off)) if off else ts
    return F.lit(value)


def run_suite(df: DataFrame, suite: list[dict]) -> DataFrame:
    """Evaluate a suite; one output row per expectation, in suite order."""
    row_local, unique = [], []
    for pos, exp in enumerate(suite):
        (unique if exp["expectation_type"].endswith("be_unique") else row_local).append((pos, exp))

    aggs = [F.count(F.lit(1)).alias("_total")]
    for pos, exp in row_local:
        col = F.col(exp["kwargs"]["column"])
        if exp["expectation_type"].endswith("not_be_null"):
            aggs.append(F.count(F.when(col.isNull(), 1)).alias(f"_u{pos}"))
            aggs.append(F.count(F.lit(1)).alias(f"_n{pos}"))
        else:
            aggs.append(F.count(F.when(col.isNotNull() & _violation(exp), 1)).alias(f"_u{pos}"))
            aggs.append(F.count(col).alias(f"_n{pos}"))
    one = df.agg(*aggs)
    parts = [one.select(F.explode(F.array(*[
        F.struct(F.lit(pos).alias("position"), F.lit(exp["expectation_type"]).alias("expectation"),
                 F.lit(exp["kwargs"]["column"]).alias("column"),
                 F.col("_total").alias("total"), F.col(f"_n{pos}").alias("_basis"),
                 F.col(f"_u{pos}").alias("unexpected"),
                 F.lit(float(exp["kwargs"].get("mostly") or 1.0)).alias("_mostly"))
        for pos, exp in row_local])).alias("r")).select("r.*")]
    for pos, exp in unique:
        column = exp["kwargs"]["column"]
        # one keyed pass: the NULL group supplies the rows that are not judged
        per_value = df.groupBy(column).agg(F.count(F.lit(1)).alias("_c"))
        judged = F.col(column).isNotNull()
        dup = per_value.agg(
            F.coalesce(F.sum("_c"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(judged, F.col("_c"))), F.lit(0)).alias("_basis"),
            F.coalesce(F.sum(F.when(judged & (F.col("_c") > 1), F.col("_c"))), F.lit(0))
            .alias("unexpected"))
        parts.append(dup.select(
            F.lit(pos).alias("position"), F.lit(exp["expectation_type"]).alias("expectation"),
            F.lit(column).alias("column"), "total", "_basis", "unexpected",
            F.lit(float(exp["kwargs"].get("mostly") or 1.0)).alias("_mostly")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    allowed = F.col("_basis") * (F.lit(1.0) - F.col("_mostly"))
    return out.select(
        F.col("position").cast("int").alias("position"), "expectation", "column",
        F.col("total").cast("bigint").alias("total"),
        F.col("unexpected").cast("bigint").alias("unexpected"),
        (F.col("unexpected") <= allowed + F.lit(1e-9)).alias("success"))


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Count of child rows whose reference has no parent (NULL references included)."""
    orphans = child.select(F.col(fk).alias("_k")).join(
        parent.select(F.col(pk).alias("_k")).distinct(), "_k", "left_anti")
    return orphans.agg(F.count(F.lit(1)).cast("bigint").alias("orphans"))


def uniqueness(df: DataFrame, column: str) -> DataFrame:
    """Rows belonging to a duplicated value of ``column``."""
    per_value = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_c"))
    return per_value.agg(F.lit(column).alias("column"),
                         F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c"))), F.lit(0))
                         .cast("bigint").alias("unexpected"))


def gate(report: DataFrame, table_name: str) -> None:
    """Raise ``DataQualityError`` when any expectation failed (stops the load)."""
    failed = report.where(~F.col("success")).select("expectation", "column").collect()
    if failed:
        names = ", ".join(f"{r['expectation']}({r['column']})" for r in failed)
        raise DataQualityError(f"{table_name}: failed expectations: {names}")
