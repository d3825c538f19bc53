"""As-of (point-in-time) lookup of SCD2 versions, and joins of two histories.

Semantics: for each fact row, the version of its business key with the
latest ``valid_from`` among those whose half-open interval
``[valid_from, valid_to)`` contains the fact time; exactly one, also where
intervals overlap (ties: the higher version).

``segments`` first cuts the versions into intervals that don't overlap: a
version holds from its start until it ends or the next one starts.  Where a
version ends before the next starts while an earlier one still runs, that one
takes over; such stretches exist only where late changes made intervals
overlap.  They are filled by a sweep over the ends, per key and time slice.

The lookup then is one pass: facts and segment starts of a key are ordered by
time, and each fact takes the last start before it.  Only keys with very many
rows (``hotkeys``) are cut into time slices: a slice that has no start yet takes
the segment carried in from the key's earlier slices, one row per (key, slice).
Nothing is gathered into lists, and a hot key's facts and versions are spread
over its slices.  Facts without a key or time match nothing and are dealt out
by a hash of the row.

Keys are counted ahead of the pass, so facts and versions are read twice, the
first time by their key only: hand over stored tables.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnlake.operators.hotkeys import HOT_ROWS, hot_keys
from txnlake.session import reliable_checkpoint

SLICE_SECONDS = 30 * 86400


def time_slice(ts: Column, seconds: int = SLICE_SECONDS) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("bigint")


def _sliced(rows: DataFrame, hot: DataFrame | None, time: str, seconds: int,
            whole: Column | None = None) -> DataFrame:
    """Adds ``_slice``: the time slice of a row whose ``_key`` is hot, ``whole`` (or 0) for all others."""
    whole = (F.lit(0) if whole is None else whole).cast("bigint")
    if hot is None:
        return rows.withColumn("_slice", whole)
    marked = rows.join(F.broadcast(hot.select("_key", F.lit(True).alias("_hot"))), "_key", "left")
    return marked.withColumn("_slice", F.when(
        F.col("_hot") & F.col(time).isNotNull(), time_slice(F.col(time), seconds)).otherwise(whole)).drop("_hot")


def _ahead(rows: DataFrame, key: Sequence[str], value: Column, order: Sequence[Column],
           hot: DataFrame | None) -> DataFrame:
    """Adds ``_next``: ``value`` of the row after this one within the key, across slice borders."""
    if hot is None:
        return rows.withColumn("_next", F.lead(value).over(Window.partitionBy(*key).orderBy(*order)))
    at = [*key, "_slice"]
    firsts = rows.groupBy(*at).agg(F.min(F.struct(*order, value.alias("_v"))).alias("_first"))
    later = Window.partitionBy(*key).orderBy(F.desc("_slice"))
    firsts = firsts.select(*at, F.lag("_first._v").over(later).alias("_border"))
    within = Window.partitionBy(*at).orderBy(*order)
    return rows.join(firsts, at).withColumn("_next", F.coalesce(F.lead(value).over(within), "_border")) \
        .drop("_border")


def _reached(rows: DataFrame, key: Sequence[str], end: Column, order: Sequence[Column],
             hot: DataFrame | None) -> DataFrame:
    """Adds ``_reach``: the greatest ``end`` of the rows before this one within the key."""
    at, before = [*key, "_slice"], (Window.unboundedPreceding, -1)
    if hot is None:
        return rows.withColumn("_reach", F.max(end).over(
            Window.partitionBy(*key).orderBy(*order).rowsBetween(*before)))
    most = rows.groupBy(*at).agg(F.max(end).alias("_most"))
    most = most.select(*at, F.max("_most").over(
        Window.partitionBy(*key).orderBy("_slice").rowsBetween(*before)).alias("_earlier"))
    within = F.max(end).over(Window.partitionBy(*at).orderBy(*order).rowsBetween(*before))
    return rows.join(most, at).withColumn("_reach", F.greatest(within, "_earlier")).drop("_earlier")


def segments(dim: DataFrame, key: str, take: Sequence[str], overlapping: bool = True,
             seconds: int = SLICE_SECONDS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(_key, _from, _to, _take): disjoint intervals; an open end is null.

    ``overlapping=False`` is for versions that are known not to overlap (a
    dimension whose load checked it): they are segments as they are.  Others are
    cut and stored, as every reader would sweep them again.
    """
    number = F.col("version") if "version" in dim.columns else F.lit(0)
    rows = dim.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull()).select(
        F.col(key).alias("_key"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"),
        number.alias("_number"), F.struct(*take).alias("_take"))
    # inverted intervals hold nothing
    rows = rows.where(F.col("_to").isNull() | (F.col("_to") > F.col("_from")))
    if not overlapping:
        return rows.select("_key", "_from", "_to", "_take")
    order = [F.col("_from"), F.col("_number")]
    hot = hot_keys(rows, "_key", hot_rows)
    cut = reliable_checkpoint(_ahead(_sliced(rows, hot, "_from", seconds), ["_key"], F.col("_from"), order, hot))
    own = cut.select("_key", "_from", F.least("_to", "_next").alias("_to"), "_take").unionByName(
        _fill(cut, order, seconds, hot))
    return reliable_checkpoint(own.where(F.col("_to").isNull() | (F.col("_to") > F.col("_from"))))


def _fill(cut: DataFrame, order: list[Column], seconds: int, hot: DataFrame | None) -> DataFrame:
    """Segments of versions that take over when a later one has ended.

    A gap opens at the end of a version that ends before the next start while
    an earlier version still runs, and closes at that start or when the last
    of the earlier ones ends.  A key's gaps and versions are swept in time order.
    """
    far = F.lit("9999-12-31").cast("timestamp_ntz")
    end = F.coalesce("_to", far)
    gaps = _reached(cut, ["_key"], end, order, hot).where(
        (end < F.coalesce("_next", far)) & (F.col("_reach") > end)).select(
        "_key", F.col("_to").alias("_open"), F.least(F.coalesce("_next", far), "_reach").alias("_shut"))
    none = F.lit(None)

    def together(runs: DataFrame, gaps: DataFrame) -> DataFrame:
        return runs.unionByName(gaps.select(
            "_key", "_slice", "_from", "_to", none.cast("int").alias("_number"),
            none.cast(cut.schema["_take"].dataType).alias("_take")))

    runs = cut.select("_key", "_slice", "_from", end.alias("_to"), "_number", "_take")
    spans = gaps.select("_key", F.lit(0).cast("bigint").alias("_slice"),
                        F.col("_open").alias("_from"), F.col("_shut").alias("_to"))
    if hot is None:
        rows = together(runs, spans)
    else:
        few = F.broadcast(hot)
        rows = together(*(part.join(few, "_key", "left_anti") for part in (runs, spans))).unionByName(
            together(*_cut_at_slices(cut.join(few, "_key", "left_semi"),
                                     gaps.join(few, "_key", "left_semi"), end, far, seconds)))
    return _swept(rows, cut, far)


def _cut_at_slices(cut: DataFrame, gaps: DataFrame, end: Column, far: Column,
                   seconds: int) -> tuple[DataFrame, DataFrame]:
    """Versions and gaps by time slice: gaps are cut at slice borders, and the versions
    that run into a slice with a gap, and start before it, are swept there."""
    last = time_slice(F.col("_shut") - F.expr("INTERVAL 1 MICROSECOND"), seconds)
    # an open gap (up to 9999) needs no more slices than there are versions' ends in it
    ends = cut.select("_key", time_slice(end, seconds).alias("_at")).where(F.col("_at") < time_slice(far, seconds))
    ends = ends.groupBy("_key").agg(F.max("_at").alias("_at"))
    gaps = gaps.withColumn("_first", time_slice(F.col("_open"), seconds)).join(ends, "_key").withColumn(
        "_last", F.least(last, F.greatest("_at", "_first")))
    gaps = gaps.select("_key", "_open", "_shut", F.explode(F.sequence("_first", "_last")).alias("_slice"), "_last")
    begin = lambda s: F.timestamp_micros(s * (seconds * 1_000_000)).cast("timestamp_ntz")
    gaps = gaps.select("_key", "_slice", F.greatest("_open", begin(F.col("_slice"))).alias("_from"),
                       F.when(F.col("_slice") == F.col("_last"), F.col("_shut"))
                       .otherwise(begin(F.col("_slice") + 1)).alias("_to"))
    spots = gaps.select("_key", "_slice").distinct()
    # a version belongs to the slices with gaps that it runs into
    first = time_slice(F.col("_from"), seconds)
    runs = cut.select("_key", "_from", end.alias("_to"), "_number", "_take", first.alias("_a"),
                      time_slice(end, seconds).alias("_b"))
    runs = runs.join(spots, "_key").where(F.col("_slice").between(F.col("_a"), F.col("_b"))).select(
        "_key", "_slice", "_from", "_to", "_number", "_take")
    return runs, gaps


def _swept(rows: DataFrame, cut: DataFrame, far: Column) -> DataFrame:
    """Who holds the gaps (rows without a number), as segments."""
    plain = rows.select("_key", "_slice", F.unix_micros(F.col("_from").cast("timestamp")).alias("_f"),
                        F.unix_micros(F.col("_to").cast("timestamp")).alias("_t"), "_number",
                        F.to_json("_take").alias("_json"))
    kind = cut.schema["_key"].dataType.simpleString()
    # versions before the gaps that open at their start
    dealt = plain.repartition("_key", "_slice").sortWithinPartitions(
        "_key", "_slice", "_f", F.col("_number").isNull(), "_number")
    swept = dealt.mapInPandas(_sweep, f"_key {kind}, _f bigint, _t bigint, _json string")
    back = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    to = back(F.col("_t"))
    return swept.select("_key", back(F.col("_f")).alias("_from"), F.when(to < far, to).alias("_to"),
                        F.from_json("_json", cut.schema["_take"].dataType).alias("_take"))


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each gap (no number): who holds it from when to when; latest start, then number, wins.

    Rows come by key, slice and time, many keys in a batch.
    """
    group, active = None, []
    for rows in batches:
        out = []
        for key, part, begin, shut, number, body in zip(
                rows["_key"].tolist(), rows["_slice"].tolist(), rows["_f"].tolist(), rows["_t"].tolist(),
                rows["_number"].tolist(), rows["_json"].tolist()):
            if (key, part) != group:
                group, active = (key, part), []
            if number == number and number is not None:
                heapq.heappush(active, (-begin, -number, shut, body))
                continue
            while begin < shut:
                while active and active[0][2] <= begin:
                    heapq.heappop(active)
                if not active:
                    break
                stop = min(active[0][2], shut)
                out.append((key, begin, stop, active[0][3]))
                begin = stop
        frame = pd.DataFrame(out, columns=["_key", "_f", "_t", "_json"])
        yield frame.astype({"_f": "int64", "_t": "int64"})


def lookup(facts: DataFrame, fact_key: Column, fact_ts: str, parts: DataFrame, prefix: str,
           how: str = "left", seconds: int = SLICE_SECONDS, seen: DataFrame | None = None,
           hot_rows: int = HOT_ROWS) -> DataFrame:
    """Attach the columns of ``parts`` (from ``segments``) that hold at ``fact_ts``.

    ``seen`` are rows with all keys and times of ``facts`` (and perhaps more) that
    are cheaper to read: the stored table that ``facts`` come from.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    take = parts.schema["_take"].dataType.names
    held = F.struct("_to", "_take")
    ts = F.col(fact_ts)
    row = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    known = fact_key.isNotNull() & ts.isNotNull()
    times = (facts if seen is None else seen).where(known).select(fact_key.alias("_key"), ts.alias("_at"))
    hot = hot_keys(times.select("_key").unionByName(parts.select("_key")), "_key", hot_rows)
    asked = facts.select(
        fact_key.alias("_key"), ts.alias("_at"), F.lit(1).alias("_kind"), row.alias("_row"), F.lit(None).cast(
            parts.select(held.alias("h")).schema["h"].dataType).alias("_held"))
    alone = F.when(F.col("_key").isNull() | F.col("_at").isNull(), F.xxhash64("_row")).otherwise(F.lit(0))
    asked = _sliced(asked, hot, "_at", seconds, alone)
    no_row = F.lit(None).cast(asked.schema["_row"].dataType).alias("_row")
    given = _sliced(parts.select("_key", F.col("_from").alias("_at"), F.lit(0).alias("_kind"), no_row,
                                 held.alias("_held")), hot, "_at", seconds)
    met = asked.unionByName(given)
    if hot is not None:
        # what a hot key's slice begins with: the last segment of the key's earlier slices
        few = F.broadcast(hot)
        last = given.join(few, "_key", "left_semi").groupBy("_key", "_slice").agg(
            F.max(F.struct("_at", "_held")).alias("_last"))
        needed = times.join(few, "_key", "left_semi").select(
            "_key", time_slice(F.col("_at"), seconds).alias("_slice")).distinct().withColumn(
            "_last", F.lit(None).cast(last.schema["_last"].dataType))
        spots = last.unionByName(needed).groupBy("_key", "_slice").agg(F.max("_last").alias("_last"))
        before = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        met = met.unionByName(spots.select(
            "_key", "_slice", F.last("_last", ignorenulls=True).over(before).alias("_in")).where(
            F.col("_in").isNotNull()).select(
            "_key", "_slice", F.lit(None).cast("timestamp_ntz").alias("_at"), F.lit(-1).alias("_kind"),
            no_row, F.col("_in._held").alias("_held")))
    so_far = Window.partitionBy("_key", "_slice").orderBy("_at", "_kind").rowsBetween(
        Window.unboundedPreceding, 0)
    met = met.withColumn("_hit", F.last("_held", ignorenulls=True).over(so_far)).where("_kind = 1")
    hit = F.col("_key").isNotNull() & F.col("_hit").isNotNull() & (
        F.col("_hit._to").isNull() | (F.col("_at") < F.col("_hit._to")))
    if how == "inner":
        met = met.where(hit)
    return met.select(*[F.col(f"_row.`{c}`").alias(c) for c in facts.columns],
                      *[F.when(hit, F.col(f"_hit._take.`{c}`")).alias(prefix + c) for c in take])


def asof_lookup(facts: DataFrame, fact_key: Column, fact_ts: str, dim: DataFrame,
                dim_key: str, take: Sequence[str], prefix: str, how: str = "left",
                overlapping: bool = True, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Attach ``take`` columns (renamed ``prefix + col``) of the version valid at ``fact_ts``.

    ``how="inner"`` keeps only facts that resolve.
    """
    parts = segments(dim, dim_key, take, overlapping, hot_rows=hot_rows)
    return lookup(facts, fact_key, fact_ts, parts, prefix, how, hot_rows=hot_rows)


def join_histories(left: DataFrame, via: str, right: DataFrame) -> DataFrame:
    """The history of ``left`` cut where the ``right`` version it refers to changes.

    ``left`` and ``right`` are ``segments``; field ``via`` of a left segment is
    its key in ``right``.  Returns segments of ``left`` whose ``_take`` has the
    fields of both sides; right fields are null while the reference resolves to
    nothing.  Pieces start where a left segment starts or, within one, where a
    right segment starts or ends; both kinds are looked up as of their start,
    so no pair of versions that don't meet is formed.  The pieces are written
    after either look-up (reliable checkpoint), as the next step reads them twice.
    """
    refer = F.col(f"_take.{via}")
    # keys of the left side that ever refer to a right key: as many as there are references
    refs = left.select(F.col("_key").alias("_lk"), refer.alias("_rk")).where("_rk is not null").distinct()
    edges = right.select(F.col("_key").alias("_rk"), F.explode(F.array("_from", "_to")).alias("_from")).where(
        "_from is not null").distinct()
    inner = edges.join(refs, "_rk").select(F.col("_lk").alias("_key"), "_from")
    names = left.schema["_take"].dataType.names
    held = left.select("_key", "_from", "_to", F.struct("_to", *[f"_take.{c}" for c in names]).alias("_take"))
    starts = left.select("_key", "_from", F.col("_to").alias("l__to"),
                         *[F.col(f"_take.{c}").alias(f"l_{c}") for c in names])
    pieces = reliable_checkpoint(starts.unionByName(
        lookup(inner, F.col("_key"), "_from", held, "l_", how="inner")))
    pieces = reliable_checkpoint(lookup(pieces, F.col(f"l_{via}"), "_from", right, "r_"))
    hot = hot_keys(pieces, "_key")
    cut = _ahead(_sliced(pieces, hot, "_from", SLICE_SECONDS), ["_key"], F.col("_from"), [F.col("_from")], hot)
    body = F.struct(*[F.col(f"l_{c}").alias(c) for c in names],
                    *[F.col(f"r_{c}").alias(c) for c in right.schema["_take"].dataType.names])
    out = cut.select("_key", "_from", F.least("l__to", "_next").alias("_to"), body.alias("_take"))
    # an edge that falls on a start of its own has given an empty piece
    return out.where(F.col("_to").isNull() | (F.col("_to") > F.col("_from")))
