"""Type-2 slowly changing dimensions as a set-based merge.

A dimension row is ``(bk, attributes..., valid_from, valid_to, is_current,
version)`` with half-open validity ``[valid_from, valid_to)``.  Merging a
change feed folds, per business key and in ``(as_of, tie-break)`` order, the
current row and the changes: a change whose tracked attributes differ
(null-safe, after normalisation) from the state before it closes the open
version at its ``as_of`` and opens ``version + 1``; an equal change is a
no-op.  The fold is ``lag`` (change flag) + running count (version) +
``lead`` (valid_to) over windows partitioned by the business key.  Keys with
very many changes (``hotkeys``) are folded by key and time slice, stitched at
slice borders with per-slice summaries, so that their changes don't have to
meet in one task.  Only keys that appear in the feed are rewritten.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnlake.functions.scalar import empty_if_null, normalise_name
from txnlake.operators.hotkeys import HOT_ROWS, hot_keys

DIM_COLUMNS_TAIL = ["valid_from", "valid_to", "is_current", "version"]


@dataclass(frozen=True)
class Scd2Spec:
    name: str
    bk: str
    attrs: Sequence[str]
    # tracked attribute -> normaliser applied before the null-safe compare
    tracked: dict[str, Callable[[Column], Column]]
    # how the feed's business key is derived from its columns
    feed_key: Callable[[DataFrame], Column]
    tiebreak: Sequence[str] = field(default_factory=tuple)

    @property
    def columns(self) -> list[str]:
        return [self.bk, *self.attrs, *DIM_COLUMNS_TAIL]


def _same(x: Column) -> Column:
    return x


CUSTOMER_DIM = Scd2Spec(
    name="dim_customer", bk="customer_bk",
    attrs=["email", "country", "kyc_level", "risk_band"],
    tracked={"email": F.lower, "country": _same, "kyc_level": _same, "risk_band": _same},
    feed_key=lambda df: F.col("id"),
    tiebreak=["id"],
)

ACCOUNT_DIM = Scd2Spec(
    name="dim_account", bk="account_bk",
    attrs=["customer_bk", "currency", "country", "status"],
    tracked={"customer_bk": _same, "currency": _same, "country": _same, "status": _same},
    feed_key=lambda df: F.col("id"),
    tiebreak=["seq"],
)

MERCHANT_DIM = Scd2Spec(
    name="dim_merchant", bk="merchant_name_norm",
    attrs=["merchant_category", "country"],
    tracked={"merchant_category": empty_if_null, "country": empty_if_null},
    feed_key=lambda df: normalise_name(F.col("merchant_name")),
    tiebreak=["merchant_category", "country", "merchant_name"],
)


def empty_dim(spark, spec: Scd2Spec, like: DataFrame) -> DataFrame:
    """An empty dimension with the attribute types of a feed."""
    cols = [F.lit(None).cast("string").alias(spec.bk)]
    cols += [F.col(a) for a in spec.attrs]
    cols += [F.lit(None).cast("timestamp_ntz").alias("valid_from"),
             F.lit(None).cast("timestamp_ntz").alias("valid_to"),
             F.lit(None).cast("boolean").alias("is_current"),
             F.lit(None).cast("int").alias("version")]
    return like.select(*cols).where(F.lit(False))


def _feed_rows(changes: DataFrame, spec: Scd2Spec, now: Column | None = None) -> DataFrame:
    tb = [F.col(c).alias(f"_tb{i}") for i, c in enumerate(spec.tiebreak)]
    return changes.select(
        spec.feed_key(changes).alias(spec.bk),
        *[F.col(a) for a in spec.attrs],
        F.coalesce(F.col("as_of"), now if now is not None else run_time()).alias("as_of"),
        F.lit(1).alias("_src"),
        F.lit(None).cast("int").alias("_base_version"),
        *tb,
    )


SLICE_SECONDS = 30 * 86400


def run_time() -> Column:
    return F.current_timestamp().cast("timestamp_ntz")


def scd2_merge(current: DataFrame, changes: DataFrame, spec: Scd2Spec,
               slice_seconds: int = SLICE_SECONDS, now: Column | None = None,
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """Return the full dimension after applying ``changes``.

    ``changes`` carries the attribute columns, ``as_of`` and the tie-break
    columns of the spec.  Rows of keys absent from the feed pass through
    untouched; closed history rows are never rewritten.

    A change without ``as_of`` happened at run time (``now``).

    Skew: the fold's windows are partitioned by ``(key, time slice)`` for keys
    with more than ``hot_rows`` changes; the stitching works on per-slice
    summaries, whose number per key is bounded by the time span.
    """
    feed = _feed_rows(changes, spec, now)
    touched = feed.select(spec.bk).distinct()
    open_rows = current.where(F.col("is_current"))
    history = current.where(~F.col("is_current"))
    untouched_open = open_rows.join(touched, spec.bk, "left_anti")
    touched_open = open_rows.join(touched, spec.bk, "left_semi")

    tbs = [f"_tb{i}" for i in range(len(spec.tiebreak))]
    tb = [F.lit(None).cast(feed.schema[c].dataType).alias(c) for c in tbs]
    existing = touched_open.select(
        F.col(spec.bk), *[F.col(a) for a in spec.attrs],
        F.col("valid_from").alias("as_of"),
        F.lit(0).alias("_src"),
        F.col("version").cast("int").alias("_base_version"),
        *tb,
    )
    # the current row adds at most one to a key's count
    merged = _fold(existing.unionByName(feed), spec, slice_seconds, hot_keys(feed, spec.bk, hot_rows))
    keep = spec.columns
    return history.select(*keep).unionByName(untouched_open.select(*keep)) \
                  .unionByName(merged.select(*keep))


def _fold(rows: DataFrame, spec: Scd2Spec, slice_seconds: int, hot: DataFrame | None) -> DataFrame:
    """Fold feed rows (plus the touched current rows) into versions; rows without a key have none."""
    tbs = [f"_tb{i}" for i in range(len(spec.tiebreak))]
    state = F.struct(*[fn(F.col(a)).alias(a) for a, fn in spec.tracked.items()])
    order = [F.col("_src"), F.col("as_of")] + [F.col(c) for c in tbs]
    rows = rows.where(F.col(spec.bk).isNotNull()).withColumn("_state", state)
    if hot is None:
        return _fold_whole(rows, spec, order)
    few = F.broadcast(hot)
    return _fold_whole(rows.join(few, spec.bk, "left_anti"), spec, order).unionByName(
        _fold_by_slice(rows.join(few, spec.bk, "left_semi"), spec, order, slice_seconds))


def _versions(kept: DataFrame, spec: Scd2Spec, next_from: Column, version: Column) -> DataFrame:
    return kept.select(
        F.col(spec.bk), *[F.col(a) for a in spec.attrs],
        F.col("as_of").alias("valid_from"),
        next_from.alias("valid_to"),
        next_from.isNull().alias("is_current"),
        F.when(F.col("_src") == 0, F.col("_base_version")).otherwise(version).cast("int")
         .alias("version"))


def _fold_whole(rows: DataFrame, spec: Scd2Spec, order: list[Column]) -> DataFrame:
    w = Window.partitionBy(spec.bk).orderBy(*order)
    prev = F.lag(F.col("_state")).over(w)
    kept = rows.withColumn("_changed", prev.isNull() | ~F.col("_state").eqNullSafe(prev)).where("_changed")
    base = F.coalesce(F.max("_base_version").over(Window.partitionBy(spec.bk)), F.lit(0))
    running = F.sum("_src").over(w.rowsBetween(Window.unboundedPreceding, 0))
    kept = kept.withColumn("_next_from", F.lead("as_of").over(w)).withColumn("_version", base + running)
    return _versions(kept, spec, F.col("_next_from"), F.col("_version"))


def _fold_by_slice(rows: DataFrame, spec: Scd2Spec, order: list[Column],
                   slice_seconds: int) -> DataFrame:
    # slice ids grow along the fold order (existing current rows come first)
    slice_id = F.when(F.col("_src") == 0, F.lit(-(1 << 62)).cast("bigint")).otherwise(
        F.floor(F.unix_seconds(F.col("as_of").cast("timestamp")) / F.lit(slice_seconds))
        .cast("bigint"))
    rows = rows.withColumn("_slice", slice_id)
    key = [spec.bk, "_slice"]
    w_local = Window.partitionBy(*key).orderBy(*order)
    per_key = Window.partitionBy(spec.bk).orderBy("_slice")

    # 1. change flags: the previous state is the previous row, across slice borders
    last = rows.groupBy(*key).agg(F.max(F.struct(*order, F.col("_state"))).alias("_last"))
    prev_last = last.select(*key, F.lag(F.col("_last._state")).over(per_key).alias("_prev_last"))
    prev = F.coalesce(F.lag(F.col("_state")).over(w_local), F.col("_prev_last"))
    kept = rows.join(prev_last, key) \
               .withColumn("_changed", prev.isNull() | ~F.col("_state").eqNullSafe(prev)) \
               .where(F.col("_changed")).drop("_prev_last", "_changed")

    # 2. versions and validity across slice borders
    summary = kept.groupBy(*key).agg(
        F.sum("_src").alias("_kn"),
        F.min(F.struct(*order)).getField("as_of").alias("_kfirst"),
        F.max("_base_version").alias("_kbase"))
    summary = summary.select(
        *key,
        F.coalesce(F.sum("_kn").over(per_key.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_koff"),
        F.first("_kfirst", ignorenulls=True).over(per_key.rowsBetween(1, Window.unboundedFollowing))
         .alias("_knext"),
        F.coalesce(F.max("_kbase").over(Window.partitionBy(spec.bk)), F.lit(0)).alias("_base"))
    kept = kept.join(summary, key)
    running = F.sum(F.col("_src")).over(w_local.rowsBetween(Window.unboundedPreceding, 0))
    next_from = F.coalesce(F.lead(F.col("as_of")).over(w_local), F.col("_knext"))
    return _versions(kept, spec, next_from, F.col("_base") + F.col("_koff") + running)


def build_dim(changes: DataFrame, spec: Scd2Spec, slice_seconds: int = SLICE_SECONDS,
              now: Column | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """First load of a dimension from a feed (no existing rows to merge with)."""
    feed = _feed_rows(changes, spec, now)
    return _fold(feed, spec, slice_seconds, hot_keys(feed, spec.bk, hot_rows)).select(*spec.columns)


def current_rows(dim: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Latest version per business key (``ORDER BY valid_from DESC LIMIT 1``).

    ``max(struct(valid_from, version, ...))`` per key: partial aggregation,
    so a key with very many versions never becomes one large group.
    """
    rest = [c for c in dim.columns if c != spec.bk]
    packed = F.max(F.struct(F.col("valid_from"), F.col("version"),
                            *[F.col(c) for c in rest if c not in ("valid_from", "version")]))
    out = dim.groupBy(spec.bk).agg(packed.alias("_m"))
    return out.select(spec.bk, *[F.col(f"_m.{c}").alias(c) for c in rest]).select(*dim.columns)


def current_violations(dim: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Rows of keys with more than one current row (should be zero)."""
    per_key = dim.where(F.col("is_current")).groupBy(spec.bk).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
                       .cast("bigint").alias("violations"))


def interval_violations(dim: DataFrame, spec: Scd2Spec, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Versions that are inverted (valid_to before valid_from) or overlap an earlier version.

    A version overlaps if some version that starts before it (ties by version)
    ends after its start.  The greatest end so far is a running maximum within
    (key, time slice) plus the maximum of the key's earlier slices.
    """
    end = F.coalesce("valid_to", F.lit("9999-12-31").cast("timestamp_ntz"))
    rows = dim.select(spec.bk, "valid_from", "version", end.alias("_end"), F.floor(
        F.unix_seconds(F.col("valid_from").cast("timestamp")) / F.lit(slice_seconds)).alias("_slice"))
    key = [spec.bk, "_slice"]
    before = Window.unboundedPreceding, -1
    earlier = rows.groupBy(*key).agg(F.max("_end").alias("_e")).select(*key, F.max("_e").over(
        Window.partitionBy(spec.bk).orderBy("_slice").rowsBetween(*before)).alias("_slices"))
    within = F.max("_end").over(
        Window.partitionBy(*key).orderBy("valid_from", "version").rowsBetween(*before))
    reached = rows.withColumn("_within", within).join(earlier, key)
    bad = (F.col("_end") < F.col("valid_from")) | F.coalesce(
        F.greatest("_within", "_slices") > F.col("valid_from"), F.lit(False))
    return reached.agg(F.count(F.when(bad, 1)).cast("bigint").alias("violations"))
