"""Operator 13, embedding near-duplicates: random-hyperplane sign hashing.

Equal vectors are one class first (a power of two as a common factor doesn't
matter).  Every class gets a code per table: the signs of its products with
``bits`` random hyperplanes.  Classes with the same code in a table meet in a
bucket, where all pairs are compared by exact cosine in double precision.

Two vectors at an angle a agree in one sign with probability 1 - a / pi.  From
the number of classes follow, by one rule at every size, the bits (a bucket
has about ``bucket_rows`` classes) and the tables (a pair exactly at the
threshold shares a bucket with probability ``recall``; closer pairs share
one more often).

A bucket is never cut: one of more than ``block_rows`` classes is dealt into
blocks, and every two blocks are compared by one task, as one matrix product.
No pair leaves a task.  A pair found in several tables counts in the first
table in which its codes agree.  Each task returns, per vector, the number of
its new links and the root of its links within the block pair; components of
these stars are the components of the links.  A hot bucket of m different
vectors costs m * m / block_rows rows to deal out, and m * m products.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing: no links, their own component, kept.  Vectors of
different lengths never link.  Rows with equal vec_id are vectors of their
own.  A null vec_id comes after all others: it names a component only if all
of its ids are null.  Empty tables give an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm.common import one_thread, read_table, ready, store
from txnlake.llm.components import components

COSINE = 0.95
SEED = 20_130
_LAST = (1 << 63) - 1  # a null vec_id sorts after all others
_CELL = ["dim", "t", "code", "i", "j"]


def rule(classes: int, cosine: float, recall: float, bucket_rows: int) -> tuple[int, int]:
    """(bits, tables) for so many different vectors."""
    agree = 1 - math.acos(cosine) / math.pi
    bits = min(31, max(1, math.ceil(math.log2(max(2, classes / bucket_rows)))))
    miss = 1 - agree ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(miss))) if miss > 0 else 1


def _pack(dtype: str):
    """Rows as (id, key, v): v holds the scaled components, key its digest; null if it can't link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            sizes = np.where(lists.is_null(), 0, lists.value_lengths().fill_null(0))
            starts = np.cumsum(sizes) - sizes
            flat = lists.flatten()
            values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False)
            key: list = [None] * len(ids)
            packed: list = [None] * len(ids)
            for dim in np.unique(sizes[sizes > 0]):
                rows = np.flatnonzero(sizes == dim)
                v = values[starts[rows][:, None] + np.arange(dim)]
                top = np.abs(v).max(1)
                with np.errstate(invalid="ignore"):
                    fit = np.isfinite(v).all(1) & (top > 0)
                rows, v = rows[fit], v[fit]
                # + 0.0: minus zero is zero
                v = np.ldexp(v, -np.frexp(top[fit])[1][:, None]) + 0.0
                for r, x in zip(rows.tolist(), v.astype(dtype)):
                    packed[r] = x.tobytes()
                    key[r] = hashlib.blake2b(packed[r], digest_size=16).digest()
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(key, pa.binary()), pa.array(packed, pa.binary())], ["id", "key", "v"])
    return run


def _matrix(column: pa.Array, dtype: str) -> np.ndarray:
    """Equally long packed rows as one matrix."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype).reshape(len(rows), -1)


def _sign(dtype: str, bits: int, tables: int):
    """Adds dim and the code of every table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        width, planes = np.dtype(dtype).itemsize, {}
        for batch in batches:
            dims = pa.compute.binary_length(batch.column("v")).to_numpy() // width
            for dim in np.unique(dims):
                if dim not in planes:
                    rng = np.random.default_rng([SEED, int(dim)])
                    planes[dim] = rng.standard_normal((int(dim), tables * bits))
                part = batch.filter(pa.array(dims == dim))
                v = _matrix(part.column("v"), dtype).astype(float)
                signs = (v @ planes[dim] > 0).reshape(len(v), tables, bits)
                codes = (signs @ (1 << np.arange(bits, dtype=np.int64))).astype("<i4")
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.full(len(v), dim, np.int32)),
                     pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype=np.int32) * tables,
                                              codes.ravel())],
                    [*part.schema.names, "dim", "codes"])
    return run


def merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the trees of every a[i], b[i]; ``parent`` holds each node's least root before and after."""
    while True:
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            return parent
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def link_blocks(v: np.ndarray, codes: np.ndarray, copies: np.ndarray, side: np.ndarray, t: int,
                cosine: float, slab: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(links, root) per vector of one or two blocks: links that table ``t`` is the first to find.

    With one block (all ``side`` 0) every pair counts, with two only pairs across.
    """
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1)
    one = not len(right)
    right = left if one else right
    norm = np.sqrt((v * v).sum(1))
    links, parent = np.zeros(len(v)), np.arange(len(v))
    for at in range(0, len(left), slab):
        some = left[at:at + slab]
        with np.errstate(invalid="ignore"):
            near = v[some] @ v[right].T / (norm[some][:, None] * norm[right][None, :]) >= cosine
        a, b = np.nonzero(near)
        a, b = some[a], right[b]
        if one:
            a, b = a[a != b], b[a != b]
        if t and len(a):
            new = ~(codes[a, :t] == codes[b, :t]).any(1)
            a, b = a[new], b[new]
        if len(a):
            links += np.bincount(a, copies[b], len(v))
            if not one:
                links += np.bincount(b, copies[a], len(v))
            parent = merge(parent, a, b)
    return links, parent


def _compare(dtype: str, cosine: float):
    """Batches sorted by cell -> (id, key, root_id, root_key, n) of the vectors with new links."""
    def cell(rows: pa.Table) -> pa.RecordBatch:
        v = _matrix(rows.column("v"), dtype).astype(float)
        codes = rows.column("codes").combine_chunks().flatten().to_numpy().reshape(len(v), -1)
        n, root = link_blocks(v, codes, rows.column("copies").to_numpy(), rows.column("side").to_numpy(),
                              rows.column("t")[0].as_py(), cosine)
        linked = np.flatnonzero(n)
        ids, keys = rows.column("id").to_numpy(), rows.column("key").to_pylist()
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[linked]), pa.array([keys[x] for x in linked], pa.binary()),
             pa.array(ids[root[linked]]), pa.array([keys[x] for x in root[linked]], pa.binary()),
             pa.array(n[linked].astype(np.int64))], ["id", "key", "root_id", "root_key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = (pa.concat_tables([rest, rows]) if rest is not None else rows).combine_chunks()
            keys = [rows.column(c).to_numpy() for c in _CELL]
            cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            start = 0
            for stop in cuts.tolist():
                if stop - start > 1:
                    yield cell(rows.slice(start, stop - start))
                start = stop
            rest = rows.slice(start)
        if rest is not None and rest.num_rows > 1:
            yield cell(rest)
    return run


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                 cosine: float = COSINE, recall: float = 0.999, bucket_rows: int = 512,
                 block_rows: int = 2048) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors``."""
    exact = vectors.schema[embedding].dataType.elementType.typeName() == "float"
    dtype = "<f4" if exact else "<f8"
    rows = store(vectors.select(
        F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
        .mapInArrow(_pack(dtype), "id long, key binary, v binary"), "op13-rows")
    classes = store(rows.where("key is not null").groupBy("key").agg(
        F.min(F.coalesce("id", F.lit(_LAST))).alias("id"), F.count(F.lit(1)).alias("copies"),
        F.first("v").alias("v")).select("id", "key", "copies", "v"), "op13-classes")
    bits, tables = rule(classes.count(), cosine, recall, bucket_rows)
    signed = store(classes.mapInArrow(
        _sign(dtype, bits, tables),
        "id long, key binary, copies long, v binary, dim int, codes array<int>"), "op13-signed")
    table = F.posexplode("codes").alias("t", "code")
    sizes = (signed.select("dim", table).groupBy("dim", "t", "code")
             .agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .select("dim", "t", "code", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks")))
    met = signed.select("*", table).join(sizes, ["dim", "t", "code"]).withColumn(
        "block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
    cells = met.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "dim", "t", "code", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "id", "key", "copies", "v", "codes")
    found = store(cells.repartition(*_CELL).sortWithinPartitions(*_CELL, "id", "key").mapInArrow(
        _compare(dtype, cosine), "id long, key binary, root_id long, root_key binary, n long"),
        "op13-found")
    node, root = F.struct("id", "key"), F.struct(F.col("root_id").alias("id"), F.col("root_key").alias("key"))
    roots = components(found.select(node.alias("u"), root.alias("v")), "op13").select(
        F.col("node.key").alias("key"), F.col("root.id").alias("component_id"))
    links = found.groupBy("key").agg(F.sum("n").alias("n"))
    judged = store(classes.select("id", "key", "copies").join(links, "key", "left")
                   .join(roots, "key", "left").select(
        "key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id")), "op13-judged")
    out = rows.select("id", "key").join(judged, "key", "left")
    known = F.col("component_id").isNotNull()
    component = F.when(known, F.when(F.col("component_id") != _LAST, F.col("component_id"))).otherwise(
        F.col("id"))
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def op13_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links at cosine 0.95 or more and its component."""
    ready(spark)
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


OP13_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS uid, vec_id, [CAST(x AS DOUBLE) for x in embedding] AS v,
         embedding IS NOT NULL AND len(embedding) > 0
         AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
         AND len([x for x in embedding if x <> 0]) > 0 AS fit
  FROM embeddings),
links AS (
  SELECT a.uid AS a, b.uid AS b, a.vec_id AS a_id, b.vec_id AS b_id
  FROM v a JOIN v b ON a.uid <> b.uid AND a.fit AND b.fit AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reached AS (
  SELECT uid, uid AS at, vec_id AS at_id FROM v
  UNION
  SELECT r.uid, l.b, l.b_id FROM reached r JOIN links l ON l.a = r.at),
least AS (SELECT uid, min(at_id) AS component_id FROM reached GROUP BY uid),
counted AS (SELECT a AS uid, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN least USING (uid) LEFT JOIN counted USING (uid)
"""
