"""Operator 1, best-fit packing under conflicts.

Documents become pieces of at most ``capacity`` units (words plus one end
mark); pieces of full length fill a bin alone, the rest are packed best-fit
in order of falling size.  Two pieces in one bin must differ in source and in
duplicate cluster.  Open bins are kept in order of residual space; each
carries a bitmap of the sources and one of the clusters it holds.  A piece
starts at the successor of its size (the tightest bin it fits) and moves on
until a bin without a conflict is found; only then a new bin is opened.

Packing runs in cells: a hash of the document spreads the pieces over as many
cells as ``cell_pieces`` asks for, whatever their source or cluster, so a
source or cluster with a third of all rows is spread like any other; copies of
one row and pieces of one text are dealt out 64 at a time.  A cell is a bounded
group; only sizes and ids are shuffled, never texts.  The number of cells
depends on the pieces alone, and bins on the rows alone, not on settings or
the layout of the files.

Defined cases: null and empty texts are one piece of size 1.  A null source
or cluster is in conflict with nothing.  Rows equal in doc_id and text are
packed each.  An empty table gives no bin.  Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm.common import read_table, ready, store, text_digest


def words(text: Column) -> Column:
    """Number of words, null texts having none."""
    trimmed = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", 0).otherwise(F.size(F.split(trimmed, " ")))


def best_fit(sizes: list[int], sources: list[int], clusters: list[int],
             capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of every piece, in input order; -1 marks no source or cluster."""
    residual: list[int] = []                  # by bin
    held_sources: list[int] = []              # bitmaps by bin
    held_clusters: list[int] = []
    ordered: list[tuple[int, int]] = []       # open bins as (residual, bin)
    out: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[k]
        source = 1 << sources[k] if sources[k] >= 0 else 0
        cluster = 1 << clusters[k] if clusters[k] >= 0 else 0
        at = bisect_left(ordered, (size, -1))
        while at < len(ordered):
            b = ordered[at][1]
            if not (held_sources[b] & source or held_clusters[b] & cluster):
                break
            at += 1
        if at < len(ordered):
            b = ordered.pop(at)[1]
        else:
            b = len(residual)
            residual.append(capacity)
            held_sources.append(0)
            held_clusters.append(0)
        out[k] = (b, capacity - residual[b])
        residual[b] -= size
        held_sources[b] |= source
        held_clusters[b] |= cluster
        if residual[b]:
            insort(ordered, (residual[b], b))
    return out


def _pack_cell(key: tuple, cell: pd.DataFrame, capacity: int) -> pd.DataFrame:
    cell = cell.sort_values(["size", "doc_id", "th", "piece", "source", "cluster"],
                            ascending=[False] + [True] * 5,
                            kind="stable", ignore_index=True)
    placed = best_fit(cell["size"].tolist(), pd.factorize(cell["source"])[0].tolist(),
                      pd.factorize(cell["cluster"])[0].tolist(), capacity)
    return cell[["doc_id", "piece", "start", "size"]].assign(
        cell=key[0], bin=[b for b, _ in placed], offset=[o for _, o in placed])


def best_fit_packing(docs: DataFrame, size: Column, source: Column, cluster: Column,
                     capacity: int = 2048, cell_pieces: int = 4096) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, piece, start, size, cell, bin, offset.

    A bin is named by (cell, bin); ``start`` is the piece's place in its document and ``offset`` its place in
    the bin, both in units of ``size``.
    """
    row = ["doc_id", "th", "n", "source", "cluster"]
    sized = store(docs.select(
        "doc_id", size.cast("long").alias("n"), source.cast("string").alias("source"),
        cluster.cast("string").alias("cluster"), F.hex(text_digest(F.col("text"))).alias("th"))
        .groupBy(*row).agg(F.count(F.lit(1)).alias("rows")), "op1-sizes")
    last = F.expr(f"(n - 1) div {capacity}")
    total = sized.agg(F.coalesce(F.sum(F.col("rows") * (last + 1)), F.lit(0))).first()[0]
    cells = max(1, -(-total // cell_pieces))
    pieces = sized.withColumn("copy", F.explode(F.expr("sequence(1L, rows)"))).withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    pieces = pieces.withColumn("start", F.col("piece") * capacity)
    pieces = pieces.withColumn("size", F.least(F.col("n") - F.col("start"), F.lit(capacity)))
    spread = pieces.withColumn("cell", F.expr(
        f"pmod(xxhash64(doc_id, th, copy div 64, piece div 64), {cells})"))

    def pack(key, cell):
        return _pack_cell(key, cell, capacity)

    return spread.groupBy("cell").applyInPandas(
        pack, "doc_id long, piece long, start long, size long, cell long, bin long, offset long")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed; equal texts are one duplicate cluster."""
    ready(spark)
    return pack_stage(spark, read_table(spark, sf_dir, "documents"), sf_dir)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the bins of all documents that are left."""
    ready(spark)
    return best_fit_packing(docs.select("doc_id", "text", "source"), words(F.col("text")) + 1,
                            F.col("source"), F.xxhash64("text"))
