"""Operator 6, exact top-k search: norm-bucketed retrieval.

Vectors are quantised to integers, floor(256 x), and range-partitioned by
falling length, so a partition is a run of length buckets; within a
partition they are taken in buckets of at most ``bucket_rows`` vectors whose
lengths differ by at most ``ratio``.  A query has a threshold: its k-th best
score so far, at first from one bucket of longest vectors, later also from
the buckets its task has done.  Divided by the query's length and the bucket's greatest
length it is the bucket's local cosine threshold:

* above 1 (by more than rounding), the whole bucket is skipped for the query;
* low, the bucket is pruned by length: only its longest vectors, those that
  reach the threshold even at cosine 1, are candidates (a prefix);
* high, it is pruned by coordinates: a unit vector at that cosine must lie,
  in the query's strongest coordinates, within an interval around the query.

Products of the candidates are then computed exactly in integers held in
doubles.  Queries come in blocks of at most ``query_block`` vectors, each a
bounded broadcast; every task returns at most k rows per query, and a final
top-k per query is limited before its shuffle.

Defined cases: vectors that are null, empty or hold null or non-finite
components take no part; only vectors of equal dimension are compared.  A
null vec_id is a candidate (after all others in ties), never a query.  Rows
with equal vec_id are rows of their own; a query skips only itself.  Scores
must fit in 53 bits.  Empty tables give an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnlake.llm.common import read_table, ready, store

#: Local cosine thresholds from here on are pruned by coordinates.
COORDINATE_FROM = 0.3
#: Rounding slack of a local cosine threshold: equal vectors have cosine 1, which doubles may pass.
SLACK = 1e-6
FOCUS = 3
_LAST = 1 << 62  # a null vec_id sorts after all others


def quantised(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """uid, vec_id, v (integers as doubles), dim, norm of the vectors that take part."""
    floors = F.transform(F.col(embedding), lambda x: F.floor(x.cast("double") * 256).cast("double"))
    fit = F.forall(F.col(embedding), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                   & (F.abs(x.cast("double")) < float("inf")))
    used = vectors.where(F.col(embedding).isNotNull() & (F.size(embedding) > 0) & F.coalesce(
        fit, F.lit(False))).select(F.col(vec_id).cast("long").alias("vec_id"), floors.alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    return used.select(F.monotonically_increasing_id().alias("uid"), "vec_id", "v",
                       F.size("v").alias("dim"), norm.alias("norm"))


@dataclass
class Block:
    """Queries of one dimension with their running thresholds."""

    uid: np.ndarray
    ids: np.ndarray
    v: np.ndarray
    k: int

    def __post_init__(self):
        self.norm = np.sqrt((self.v ** 2).sum(1))
        self.unit = self.v / np.maximum(self.norm, 1e-300)[:, None]
        self.floor = np.full(len(self.ids), -np.inf)
        self.focus = np.argsort(-np.abs(self.unit), axis=1)[:, :FOCUS]


def _limits(block: Block, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interval of each focus coordinate of a unit vector at cosine ``theta`` or more."""
    q = np.take_along_axis(block.unit, block.focus, 1)
    mid = q * theta[:, None]
    away = np.sqrt(np.maximum(0, 1 - q ** 2) * np.maximum(0, 1 - theta ** 2)[:, None])
    return (np.where(q * 1.0 >= theta[:, None], 1.0, mid + away) + 1e-9,
            np.where(-q >= theta[:, None], -1.0, mid - away) - 1e-9)


def search_bucket(block: Block, uid: np.ndarray, ids: np.ndarray, v: np.ndarray,
                  norm: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query (positions, scores) of the bucket's vectors that may be among its best k.

    The bucket is sorted by falling length.
    """
    n = len(ids)
    unit = v / np.maximum(norm, 1e-300)[:, None]
    with np.errstate(invalid="ignore", divide="ignore"):
        theta = np.where(block.norm * norm[0] > 0, block.floor / (block.norm * norm[0]),
                         np.where(block.floor > 0, np.inf, -np.inf))
        reach = np.where(block.norm > 0, block.floor / block.norm,
                         np.where(block.floor > 0, np.inf, -np.inf))
    prefix = n - np.searchsorted(norm[::-1], reach - 1e-6 * np.maximum(1, np.abs(reach)), "left")
    by_coordinate = (theta >= COORDINATE_FROM) & (theta <= 1 + SLACK)
    # near 1 an interval is as wide as the root of what is left to 1, so the slack comes off first
    high, low = _limits(block, np.clip(theta - 1e-12, -1, 1))
    order: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    out = [(np.zeros(0, np.int64), np.zeros(0))] * len(block.ids)
    by_length = np.flatnonzero((theta < COORDINATE_FROM) & (prefix > 0))
    for at in range(0, len(by_length), 256):
        some = by_length[at:at + 256]
        most = int(prefix[some].max())
        for q, scores in zip(some, block.v[some] @ v[:most].T):
            out[q] = (np.arange(prefix[q]), scores[:prefix[q]])
    for q in np.flatnonzero(by_coordinate & (prefix > 0)):
        f = int(block.focus[q, 0])
        if f not in order:
            o = np.argsort(unit[:, f], kind="stable")
            order[f] = o, unit[o, f]
        o, values = order[f]
        near = o[np.searchsorted(values, low[q, 0], "left"):np.searchsorted(values, high[q, 0], "right")]
        near = near[near < prefix[q]]
        for j in range(1, block.focus.shape[1]):
            x = unit[near, block.focus[q, j]]
            near = near[(x >= low[q, j]) & (x <= high[q, j])]
        out[q] = (near, v[near] @ block.v[q])
    return [(p[keep], s[keep]) if len(p) else (p, s) for q, (p, s) in enumerate(out)
            for keep in [(s >= block.floor[q]) & (uid[p] != block.uid[q])]]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: high score, then small id."""
    if len(ids) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        sure = np.flatnonzero(scores >= least)
    else:
        sure = np.arange(len(ids))
    return sure[np.lexsort((ids[sure], -scores[sure]))[:k]]


def _buckets(norm: np.ndarray, rows: int, ratio: float) -> Iterator[tuple[int, int]]:
    start = 0
    while start < len(norm):
        stop = start + int(np.searchsorted(-norm[start:], -ratio * norm[start], "right"))
        stop = min(max(stop, start + 1), start + rows, len(norm))
        yield start, stop
        start = stop


def _scan(shared, k: int, bucket_rows: int, ratio: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        uid, ids, v, floor = shared.value
        block = Block(uid, ids, v, k)
        block.floor = floor.copy()
        best = [(np.zeros(0, np.int64), np.zeros(0))] * len(ids)
        for batch in batches:
            if not len(batch):
                continue
            order = np.lexsort((batch["uid"].to_numpy(), -batch["norm"].to_numpy()))
            batch = batch.iloc[order]
            p_uid = batch["uid"].to_numpy()
            p_id = batch["vec_id"].fillna(_LAST).to_numpy(np.int64)
            p_norm, p_v = batch["norm"].to_numpy(), np.stack(batch["v"].to_numpy())
            for a, b in _buckets(p_norm, bucket_rows, ratio):
                found = search_bucket(block, p_uid[a:b], p_id[a:b], p_v[a:b], p_norm[a:b])
                for q, (near, scores) in enumerate(found):
                    if len(near):
                        i = np.concatenate([best[q][0], p_id[a:b][near]])
                        s = np.concatenate([best[q][1], scores])
                        top = _best(i, s, k)
                        best[q] = i[top], s[top]
                        if len(top) == k:
                            block.floor[q] = max(block.floor[q], s[top[-1]])
        rows = [len(i) for i, _ in best]
        yield pd.DataFrame({"query_uid": np.repeat(uid, rows), "query_id": np.repeat(ids, rows),
                            "vec_id": np.concatenate([i for i, _ in best]) if best else [],
                            "score": (np.concatenate([s for _, s in best]) if best else np.zeros(0))
                            .astype(np.int64)})
    return run


def _seed(queries: np.ndarray, uid: np.ndarray, probe: list, k: int) -> np.ndarray:
    """A lower bound of each query's k-th best score, from a few known vectors."""
    if len(probe) <= k:
        return np.full(len(queries), -np.inf)
    scores = queries @ np.stack([np.array(r.v) for r in probe]).T
    scores[uid[:, None] == np.array([r.uid for r in probe])[None, :]] = -np.inf
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]


def top_k(vectors: DataFrame, is_query, k: int = 5, vec_id: str = "vec_id",
          embedding: str = "embedding", query_block: int = 4096, bucket_rows: int = 2048,
          ratio: float = 0.9, seed_rows: int = 2048) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every row where ``is_query`` (on vec_id)."""
    spark = vectors.sparkSession
    schema = "query_uid long, query_id long, vec_id long, score long"
    table = store(quantised(vectors, vec_id, embedding), "op6-quantised")
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = store(table.repartitionByRange(spread, F.desc("norm"), "uid")
                  .sortWithinPartitions(F.desc("norm"), "uid"), "op6-buckets")
    parts = []
    for (dim,) in table.select("dim").distinct().orderBy("dim").collect():
        same = table.where(F.col("dim") == dim)
        probe = same.orderBy(F.desc("norm"), "uid").limit(seed_rows).collect()
        queries = same.where(is_query).select("uid", "vec_id", "v")
        block: list = []

        def scan(block, same=same, probe=probe):
            uid, ids = np.array([r.uid for r in block]), np.array([r.vec_id for r in block])
            v = np.array([r.v for r in block], float)
            shared = spark.sparkContext.broadcast((uid, ids, v, _seed(v, uid, probe, k)))
            found = same.select("uid", "vec_id", "v", "norm").mapInPandas(
                _scan(shared, k, bucket_rows, ratio), schema)
            return store(found, "op6-found")

        for row in queries.toLocalIterator():
            block.append(row)
            if len(block) == query_block:
                parts.append(scan(block))
                block = []
        if block:
            parts.append(scan(block))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    place = F.row_number().over(Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", place).where(F.col("rank") <= k).select(
        "query_id", "rank", F.when(F.col("vec_id") != _LAST, F.col("vec_id")).alias("vec_id"), "score"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of every vector whose id is divisible by 50, against all rows."""
    ready(spark)
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP6_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
placed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 5
"""
