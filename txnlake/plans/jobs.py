"""The hourly load as one job function (dependency order of the original
schedule: staging -> dimensions -> fact -> marts).

Warehouse layout below ``root`` (a folder on the shared file system):

    stg/<table>/                 append-only staging, insert-if-absent on id
    state/<table>/               staging of tables that come as change logs: the state per id,
                                 in hash buckets, with log positions and tombstones
    cur/dim_<name>/              SCD2 dimensions in hash buckets; only touched ones are rewritten
    cur/fact_transactions/       append-only, partitioned by created_month
    cur/fact_unresolved/v.../    rows whose keys did not resolve (retried)
    cur/mv_gmv_daily/v.../       marts: touched days recomputed, new version + pointer flip
    cur/mv_top_merchants/v.../
    meta/watermarks/v.../        (table_name, last_loaded_at)
    meta/mart_days/v.../         days whose facts the GMV mart has not seen yet
    meta/runs/<run>/             the steps this run has done
    meta/batch/<run>/<table>/    what this run extracted, stored once; removed when it is done

Every step is idempotent and recorded when it is done: a run that was cut off
continues, called again with the same ``run_ts``, at the step where it stopped,
with the batch it had extracted; a later run does what is left in any case.
The extract is stored before anything looks at it, so validation, append and
watermark see the same rows, whatever the source commits meanwhile.  It is
validated before it is appended: a batch that fails the gate reaches neither
staging nor a watermark, and the next run extracts and judges it again.

The days that a fact append touches are written ahead of it and leave the list
only after the mart's pointer flip, so a crash between the two loses no day.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.operators import changelog, marts, quality, scd2
from txnlake.operators import facts as facts_op
from txnlake.operators import incremental as inc
from txnlake.operators.surrogate import dense_rank_keys
from txnlake.session import reliable_checkpoint
from txnlake.sources.buckets import BucketedTable
from txnlake.sources.tables import (AppendTable, RunLog, VersionedTable, WatermarkTable, delete_path,
                                    path_exists)

STAGED = {
    # table -> (primary key, change columns for the dimension feed)
    "customers": ("id", ["created_at", "updated_at"]),
    "accounts": ("id", ["created_at", "updated_at"]),
    "transactions": ("id", ["created_at"]),
    "outbox": ("id", ["created_at"]),
}


#: Hash buckets of states and dimensions, fixed when a table is first written.
BUCKETS = 64


@dataclass
class HourlyResult:
    staged: dict[str, int]
    fact_appended: int
    unresolved: int
    watermarks: dict[str, _dt.datetime]


def _run_id(run_ts: str) -> str:
    return re.sub(r"\D", "", run_ts)


def _batch(spark: SparkSession, root: str, name: str, run_ts: str) -> VersionedTable:
    return VersionedTable(spark, f"{root}/meta/batch/{_run_id(run_ts)}/{name}", keep=1)


def _extract(spark: SparkSession, root: str, wm: WatermarkTable, name: str, source: DataFrame,
             run_ts: str) -> DataFrame:
    """Store the rows above the watermark once; map columns become JSON text."""
    since = wm.get(f"stg.{name}")
    rows = inc.json_columns(inc.incremental(source, since, ["created_at"])).withColumn(
        "loaded_at", F.lit(run_ts).cast("timestamp_ntz"))
    batch = _batch(spark, root, name, run_ts)
    batch.overwrite(rows)
    return batch.read()


def _append(spark: SparkSession, root: str, wm: WatermarkTable, name: str, batch: DataFrame) -> int:
    """Insert-if-absent into staging, then advance the watermark to the batch's maximum."""
    pk, _ = STAGED[name]
    path = f"{root}/stg/{name}"
    if path_exists(spark, path):
        inc.same_columns(batch, spark.read.parquet(path), f"stg.{name}")
    appended = AppendTable(spark, path, [pk]).insert_if_absent(batch, order_by=["created_at"])
    wm.set_from(f"stg.{name}", batch.agg(inc.next_watermark(batch, wm.get(f"stg.{name}"))))
    return appended


def state_table(spark: SparkSession, root: str, name: str) -> BucketedTable:
    return BucketedTable(spark, f"{root}/state/{name}", STAGED[name][0], BUCKETS)


def _apply_changes(spark: SparkSession, root: str, name: str, changes: DataFrame) -> int:
    """Merge a batch of decoded changes into the table's state; only the buckets of its keys are read."""
    table, (key, _) = state_table(spark, root, name), STAGED[name]
    buckets = table.touched(changes)
    if not buckets:
        return 0
    table.flip(table.write(changelog.merge_changes(table.read(buckets), changes, key), buckets))
    return changes.count()


def staged(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """What staging holds of a table: appended rows, or the live rows of its change log's state."""
    state = state_table(spark, root, name).read()
    if state is not None:
        return changelog.live_rows(state)
    path = f"{root}/stg/{name}"
    return spark.read.parquet(path) if path_exists(spark, path) else None


def _validate(batches: dict[str, DataFrame], accounts: DataFrame, run_ts: str) -> None:
    """The suites on what this run extracted (first copies), before it is staged."""
    suites = {"customers": quality.CUSTOMER_SUITE, "accounts": quality.ACCOUNT_SUITE,
              "transactions": quality.transaction_suite(run_ts)}
    first = {n: inc.dedupe_first(b, ["id"], ["created_at"]) for n, b in batches.items() if n in suites}
    for name, rows in first.items():
        quality.gate(quality.run_suite(rows, suites[name]), f"stg.{name}")
    if "transactions" in first:
        orphans = quality.fk_orphans(first["transactions"], "account_id", accounts, "id")
        if orphans.collect()[0].orphans:
            raise quality.DataQualityError("stg.transactions: account_id without account")


def _with_stable_keys(new_dim: DataFrame, old_dim: DataFrame | None, spec: scd2.Scd2Spec,
                      sk: str, top: int) -> DataFrame:
    """Existing versions keep their key; new versions get ``top`` (the highest so far) + dense rank."""
    if old_dim is None:
        return dense_rank_keys(new_dim, [spec.bk, "version"], out_col=sk, start_after=top)
    keyed = new_dim.join(old_dim.select(spec.bk, "version", sk), [spec.bk, "version"], "left")
    known = keyed.where(F.col(sk).isNotNull())
    fresh = keyed.where(F.col(sk).isNull()).drop(sk)
    return known.unionByName(dense_rank_keys(fresh, [spec.bk, "version"], out_col=sk, start_after=top))


def load_dim(spark: SparkSession, root: str, spec: scd2.Scd2Spec, sk: str, changes: DataFrame) -> int:
    """Fold ``changes`` into a stored dimension; only the buckets of their keys are read and rewritten."""
    table = BucketedTable(spark, f"{root}/cur/{spec.name}", spec.bk, BUCKETS)
    buckets = table.touched(changes, spec.feed_key(changes))
    known = table.manifest()
    if not buckets and known:
        return 0
    old, top = table.read(buckets), (known["facts"]["top"] if known else 0)
    current = old.drop(sk) if old is not None else scd2.empty_dim(spark, spec, changes)
    merged = scd2.scd2_merge(current.select(*spec.columns), changes, spec)
    keyed = _with_stable_keys(merged, old, spec, sk, top).persist()
    try:
        found = scd2.interval_violations(keyed, spec).first()
        if found.violations:
            raise quality.DataQualityError(
                f"{spec.name}: {found.violations} inverted or overlapping versions")
        top = max(top, keyed.agg(F.coalesce(F.max(sk), F.lit(0))).first()[0])
        table.flip(table.write(keyed, buckets, top=top))
    finally:
        keyed.unpersist()
    return len(buckets)


#: dimension -> (spec, key column, staged table, its change columns)
DIMS = {
    "dim_customer": (scd2.CUSTOMER_DIM, "customer_sk", "customers", ["created_at", "updated_at"]),
    "dim_account": (scd2.ACCOUNT_DIM, "account_sk", "accounts", ["created_at", "updated_at"]),
    "dim_merchant": (scd2.MERCHANT_DIM, "merchant_sk", "transactions", ["created_at"]),
}


def dim_feed(name: str, rows: DataFrame) -> DataFrame:
    """Changed staging rows as the change feed of a dimension."""
    if name == "dim_customer":
        return rows.select("id", "email", "country", "kyc_level", "risk_band",
                           F.greatest("created_at", "updated_at").alias("as_of"))
    if name == "dim_account":
        return rows.select("id", F.col("customer_id").alias("customer_bk"), "currency", "country",
                           "status", F.greatest("created_at", "updated_at").alias("as_of"),
                           F.lit(0).cast("bigint").alias("seq"))
    return rows.groupBy("merchant_name", "merchant_category", "country").agg(
        F.min("created_at").alias("as_of"))


class _Run:
    """The steps of one hourly run; each reads what earlier steps have stored."""

    def __init__(self, spark: SparkSession, root: str, run_ts: str) -> None:
        self.spark, self.root, self.run_ts = spark, root, run_ts
        self.wm = WatermarkTable(spark, f"{root}/meta/watermarks")
        self.days = VersionedTable(spark, f"{root}/meta/mart_days", keep=2)
        self.resolved = _batch(spark, root, "resolved", run_ts)
        self.pending = VersionedTable(spark, f"{root}/cur/fact_unresolved")
        self.fact_path = f"{root}/cur/fact_transactions"

    def batch(self, name: str) -> DataFrame:
        return _batch(self.spark, self.root, name, self.run_ts).read()

    def store_changes(self, name: str, changes: DataFrame) -> int:
        """The decoded changes of this run, stored once; map columns become JSON text."""
        table = _batch(self.spark, self.root, name, self.run_ts)
        table.overwrite(inc.json_columns(changes))
        return table.read().count()

    def validate(self, names: Sequence[str], logs: Sequence[str]) -> None:
        batches = {n: self.batch(n) for n in names}
        batches |= {n: changelog.live_rows(changelog.last_changes(self.batch(n), STAGED[n][0])) for n in logs}
        parts = [b.select("id") for n, b in batches.items() if n == "accounts"]
        known = staged(self.spark, self.root, "accounts")
        if known is not None:
            parts.append(known.select("id"))
        accounts = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
        _validate(batches, accounts.distinct(), self.run_ts)

    def load_dim(self, name: str) -> int:
        spec, sk, table, cols = DIMS[name]
        since = self.wm.get(f"cur.{name}")
        rows = inc.incremental(staged(self.spark, self.root, table), since, cols)
        n = load_dim(self.spark, self.root, spec, sk, dim_feed(name, rows))
        # what lies at or below the old mark can't raise it: the feed alone tells the new one
        self.wm.set_from(f"cur.{name}", rows.agg(inc.next_watermark(rows, since, cols)))
        return n

    def dims(self) -> dict[str, DataFrame]:
        return {n: VersionedTable(self.spark, f"{self.root}/cur/{n}").read() for n in DIMS}

    def new_transactions(self) -> DataFrame:
        """Staged rows above the fact's watermark."""
        rows = staged(self.spark, self.root, "transactions")
        return inc.incremental(rows.drop("loaded_at"), self.wm.get("cur.fact_transactions"))

    def resolve(self) -> None:
        """Keys of new and of earlier unresolved rows, resolved once and stored."""
        rows, waiting = self.new_transactions(), self.pending.read()
        if waiting is not None:
            rows = rows.unionByName(waiting.select(*rows.columns)).dropDuplicates(["id"])
        dims = self.dims()
        self.resolved.overwrite(facts_op.with_created_date(facts_op.resolve_keys(
            reliable_checkpoint(rows), dims["dim_account"], dims["dim_customer"], dims["dim_merchant"])))

    def split(self) -> tuple[DataFrame, DataFrame]:
        rows = self.resolved.read()
        return facts_op.split_resolved(rows, [c for c in rows.columns if c not in
                                              ("account_sk", "customer_sk", "merchant_sk", "created_date")])

    def append_facts(self) -> int:
        fact, _ = self.split()
        existing = AppendTable(self.spark, self.fact_path, facts_op.FACT_KEY).read()
        rows = facts_op.with_month(fact) if existing is None else facts_op.new_fact_rows(fact, existing)
        rows = rows.persist()
        try:
            appended = rows.count()
            days = rows.select("created_month", F.col("created_date").alias("day_utc"))
            waiting = self.days.read()
            self.days.overwrite((days if waiting is None else days.unionByName(waiting)).distinct())
            rows.write.mode("append").partitionBy("created_month").parquet(self.fact_path)
        finally:
            rows.unpersist()
        return appended

    def keep_unresolved(self) -> int:
        _, unresolved = self.split()
        self.pending.overwrite(unresolved)
        rows = self.new_transactions()
        self.wm.set_from("cur.fact_transactions", rows.agg(
            inc.next_watermark(rows, self.wm.get("cur.fact_transactions"))))
        return self.pending.read().count()

    def gmv(self) -> None:
        """GMV is additive per day: only days that facts were appended to are recomputed."""
        facts = self.spark.read.parquet(self.fact_path)
        table = VersionedTable(self.spark, f"{self.root}/cur/mv_gmv_daily")
        previous, touched = table.read(), self.days.read()
        if previous is None:
            table.overwrite(marts.gmv_daily(facts))
        elif not touched.isEmpty():
            # semi-joins on the touched months and days: the month prunes the fact's partitions
            fresh = marts.gmv_daily(
                facts.join(touched.select("created_month").distinct(), "created_month", "left_semi")
                .join(touched, facts.created_date == touched.day_utc, "left_semi"))
            table.overwrite(previous.join(touched, "day_utc", "left_anti").unionByName(fresh))
        self.days.overwrite(touched.where(F.lit(False)))

    def top(self) -> None:
        # the last 7 days only: the month predicate prunes the scan's partitions
        # (the month cannot be derived from created_at)
        as_of = F.lit(self.run_ts).cast("timestamp_ntz")
        since = _dt.datetime.fromisoformat(self.run_ts) - _dt.timedelta(days=7)
        recent = self.spark.read.parquet(self.fact_path).where(
            F.col("created_month") >= since.strftime("%Y-%m"))
        VersionedTable(self.spark, f"{self.root}/cur/mv_top_merchants").overwrite(
            marts.top_merchants(recent, self.dims()["dim_merchant"], as_of))


def run_hourly(spark: SparkSession, root: str, sources: dict[str, DataFrame], run_ts: str,
               validate: bool = True, changes: dict[str, DataFrame] | None = None) -> HourlyResult:
    """One scheduled run.

    ``sources`` holds the OLTP extracts (``customers``, ``accounts``,
    ``transactions`` and optionally ``outbox``).  ``changes`` holds, for
    tables that come as change logs instead, the decoded changes since the
    last run (``cdc.decode_rows``): staging then takes updates and deletes.
    A table deleted from keeps its dimension history.  ``run_ts`` is the run
    time (``NOW()``) as an explicit value and names the run.
    """
    root, changes = root.rstrip("/"), changes or {}
    run, log = _Run(spark, root, run_ts), RunLog(spark, f"{root}/meta/runs/{_run_id(run_ts)}")
    names = [n for n in STAGED if n in sources and n not in changes]
    for name in names:
        log.once(f"extract.{name}", lambda n=name: _extract(
            spark, root, run.wm, n, sources[n], run_ts).count())
    for name in changes:
        log.once(f"extract.{name}", lambda n=name: run.store_changes(n, changes[n]))
    if validate:
        log.once("validate", lambda: run.validate(names, list(changes)))
    counts = {n: log.once(f"stage.{n}", lambda n=n: _append(spark, root, run.wm, n, run.batch(n)))
              for n in names}
    counts |= {n: log.once(f"stage.{n}", lambda n=n: _apply_changes(spark, root, n, run.batch(n)))
               for n in changes}
    _together([lambda n=n: log.once(f"dim.{n}", lambda: run.load_dim(n)) for n in DIMS])
    log.once("resolve", run.resolve)
    appended = log.once("facts", run.append_facts)
    unresolved = log.once("unresolved", run.keep_unresolved)
    _together([lambda: log.once("mart.gmv", run.gmv), lambda: log.once("mart.top", run.top)])
    if "done" not in log.done():
        delete_path(spark, f"{root}/meta/batch/{_run_id(run_ts)}")
        log.mark("done", 0)
    marks = {r.table_name: r.last_loaded_at for r in run.wm.all().collect()}
    return HourlyResult(counts, appended, unresolved, marks)


def _together(steps: Sequence[Callable[[], object]]) -> None:
    """Independent steps, submitted to Spark at the same time; the first error is raised after all ended."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        running = [pool.submit(step) for step in steps]
    for step in running:
        step.result()
