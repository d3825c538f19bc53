"""Operator 7, near-duplicates: BagMinHash signatures, bands, verified overlap.

A text is the multiset of its five-word shingles.  BagMinHash draws, for
every shingle, points of a Poisson process over time x weight; a text sees
the points whose weight lies below the shingle's count, so two texts agree in
a register with a probability equal to their weighted Jaccard similarity.
The weight axis is discretised by powers of two: a block [2**(j-1), 2**j) is
one process of rate 2**(j-1), and a point's place in the block is drawn with
it, so heavy shingles cost a logarithm of their count.  A process ends as
soon as its time exceeds the largest register; texts longer than the
signature therefore cost about two points per shingle.

Texts that agree on a band of ``rows`` registers meet in a bucket.  Equal texts are
merged first.  In a bucket of at most ``small`` texts all pairs are
candidates; in a larger one its pivot, the text that shares most with others,
is compared with every text.  No pair is compared twice here.  Candidates are
verified by exact multiset overlap.

Texts that are then outside the pivot's component, the strays, meet the whole
of their buckets: block by block, as one product of element matrices per two blocks,
in which every pair's overlap is exact.  The buckets around one main component
are taken together where that makes fewer pairs than one by one.  No pair
leaves a task, only the links that hold its blocks' components together.
No bucket is gathered, dropped or cut; the products of a group of m strays
and n texts are m * n, the rows dealt out (m + n) * their blocks.

A pair at similarity 0.8 misses all 24 bands of 4 with probability 3e-6.

Defined cases: null texts and texts without words are alone.  Texts of one to
four words are a single shingle.  Rows equal in doc_id and text are one
document.  The class id is the least doc_id of the class (null only if all
are null).  Empty tables give empty results.  Extra columns are ignored, or
kept by the pipeline stage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnlake.llm.common import one_thread, parts_for, read_table, ready, store, text_digest
from txnlake.llm.components import components
from txnlake.llm.sharding import ranked, with_border
from txnlake.llm.vector_dedup import merge

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1]."""
    return ((x >> _U(11)) + _U(1)).astype(np.float64) * 2.0 ** -53


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text (lower case, cut at white space)."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")), " ")
    return F.when(F.trim(F.regexp_replace(text, r"\s+", " ")) == "", F.array().cast("array<bigint>")) \
        .otherwise(F.transform(words, lambda w: F.xxhash64(w)))


def shingles(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of one text and their counts."""
    n = min(SHINGLE_WORDS, len(words))
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    w = words.astype(np.uint64, copy=False)
    h = np.full(len(w) - n + 1, n, np.uint64)
    for j in range(n):
        h = h * _U(0xD6E8FEB86659FD93) + w[j:len(w) - n + 1 + j]
    h = np.sort(mix(h))
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return h[first], np.diff(np.append(first, len(h)))


def bag_signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, texts: int,
                   registers: int) -> np.ndarray:
    """BagMinHash of many texts at once: (texts, registers) of least point times."""
    signature = np.full(texts * registers, np.inf)
    blocks = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    doc = np.repeat(owner, blocks)
    block = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    limit = np.repeat(weight, blocks).astype(np.float64)
    low = np.where(block > 0, 2.0 ** (block - 1), 0.0)
    rate = np.maximum(low, 1.0)
    state = mix(np.repeat(element, blocks) + block.astype(np.uint64) * _GOLD)
    time = np.zeros(len(doc))
    while len(doc):
        state = state + _GOLD
        a = mix(state)
        b = mix(a ^ _GOLD)
        time = time - np.log(_unit(a)) / rate
        register = (b % _U(registers)).astype(np.int64)
        # heavy blocks: the point's place on the weight axis must lie below the weight
        seen = (block == 0) | (low + rate * _unit(mix(b)) <= limit)
        np.minimum.at(signature, doc[seen] * registers + register[seen], time[seen])
        alive = time < signature.reshape(texts, registers).max(axis=1)[doc]
        doc, block, limit, low = doc[alive], block[alive], limit[alive], low[alive]
        rate, state, time = rate[alive], state[alive], time[alive]
    return signature.reshape(texts, registers)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = signatures.view(np.uint64).reshape(len(signatures), bands, rows)
    key = np.arange(bands, dtype=np.uint64)[None, :] * _GOLD
    for r in range(rows):
        key = mix(key ^ bits[:, :, r]) * _U(0xD6E8FEB86659FD93)
    return key.view(np.int64)


def _runs(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges with at most ``most`` words, one row at least."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
        yield start, min(stop, n)
        start = stop


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and flat values of a list column without nulls."""
    flat = column.flatten()
    lengths = np.asarray(column.value_lengths().fill_null(0), np.int64)
    return np.concatenate([[0], np.cumsum(lengths)]), np.asarray(flat, np.int64).view(np.uint64)


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, th, words -> doc_id, th, n (shingles), bands."""
    for batch in batches:
        offsets, values = _lists(batch.column(2))
        for a, b in _runs(offsets, 400_000):
            bags = [shingles(values[offsets[k]:offsets[k + 1]]) for k in range(a, b)]
            owner = np.repeat(np.arange(b - a), [len(h) for h, _ in bags])
            signatures = bag_signatures(owner, np.concatenate([h for h, _ in bags]),
                                        np.concatenate([c for _, c in bags]), b - a, BANDS * ROWS)
            keys = band_keys(signatures, BANDS, ROWS)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                pa.array([int(c.sum()) for _, c in bags], pa.int64()),
                pa.array([k.tolist() if len(h) else [] for k, (h, _) in zip(keys, bags)],
                         pa.list_(pa.int64()))], names=["doc_id", "th", "n", "bands"])


def pack_bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, words -> node, bag (shingle hashes, then 32-bit counts)."""
    for batch in batches:
        offsets, values = _lists(batch.column(1))
        bags = (shingles(values[offsets[k]:offsets[k + 1]]) for k in range(batch.num_rows))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
            [h.tobytes() + c.astype(np.uint32).tobytes() for h, c in bags], pa.binary())],
            names=["node", "bag"])


def overlap(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two packed bags."""
    n, m = len(a) // 12, len(b) // 12
    ha, hb = np.frombuffer(a, np.uint64, n), np.frombuffer(b, np.uint64, m)
    ca, cb = np.frombuffer(a, np.uint32, n, 8 * n), np.frombuffer(b, np.uint32, m, 8 * m)
    at = np.minimum(np.searchsorted(hb, ha), m - 1)
    both = hb[at] == ha
    common = int(np.minimum(ca[both], cb[at[both]]).sum(dtype=np.int64))
    return common / (int(ca.sum(dtype=np.int64)) + int(cb.sum(dtype=np.int64)) - common)


def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """x, y, bag_x, bag_y -> x, y, similarity."""
    for batch in batches:
        found = [overlap(a.as_buffer(), b.as_buffer())
                 for a, b in zip(batch.column(2), batch.column(3))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1),
                                          pa.array(found, pa.float64())], names=["x", "y", "j"])


def _texts(docs: DataFrame) -> DataFrame:
    """node, th, first, n, bands: the distinct texts that have words, nodes in doc_id order."""
    signed = docs.where(F.col("text").isNotNull()).select(
        "doc_id", text_digest(F.col("text")).alias("th"), word_hashes(F.col("text")).alias("words")
    ).mapInArrow(sign, "doc_id long, th binary, n long, bands array<bigint>")
    distinct = (signed.where("n > 0").groupBy("th").agg(
        F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("bands").alias("bands"))
        .withColumn("one", F.lit(1)))
    order = ["first", "th"]
    return store(with_border(ranked(store(distinct, "op7-texts"), order, "op7-ranked"), order, "one")
                 .select(F.col("border").alias("node"), "th", "first", "n", "bands"), "op7-nodes")


def _near_sizes(a: str, b: str) -> Column:
    """The similarity of texts that differ more in size can't reach the threshold."""
    return F.least(a, b) >= SIMILARITY * F.greatest(a, b)


def _small_pairs(buckets: DataFrame, counts: DataFrame, small: int) -> DataFrame:
    """All pairs of the buckets of at most ``small`` texts."""
    few = buckets.join(counts.where(f"size <= {small}").select("key"), "key")
    grouped = few.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("node", "n"))).alias("m"))
    pairs = grouped.select(F.explode(F.expr(
        "flatten(transform(m, (a, i) -> transform(slice(m, i + 2, size(m)), b -> struct(a, b))))"))
        .alias("p")).select(F.col("p.a.node").alias("x"), F.col("p.b.node").alias("y"),
                            F.col("p.a.n").alias("nx"), F.col("p.b.n").alias("ny"))
    return pairs.where(_near_sizes("nx", "ny")).select("x", "y").distinct()


def near_classes(docs: DataFrame, small: int = 8) -> tuple[DataFrame, DataFrame]:
    """(texts with node/th/first, (node, root) of the texts in classes of several texts)."""
    texts = _texts(docs)
    rows = texts.select("node", "n", F.explode("bands").alias("key"))
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = store(rows.join(counts, "key"), "op7-buckets")

    members = buckets.select("node").distinct()
    bags = store(
        docs.where(F.col("text").isNotNull())
        .select(_id("doc_id"), text_digest(F.col("text")).alias("th"), "text")
        .join(texts.join(members, "node").select("node", "th", _id("first")), ["th", "doc_id"])
        .groupBy("th", "doc_id", "node").agg(F.first("text").alias("text"))
        .select("node", word_hashes(F.col("text")).alias("words"))
        .mapInArrow(pack_bags, "node long, bag binary"), "op7-bags")

    def verified(pairs: DataFrame) -> DataFrame:
        withx = pairs.join(bags.select(F.col("node").alias("x"), F.col("bag").alias("bx")), "x")
        both = withx.join(bags.select(F.col("node").alias("y"), F.col("bag").alias("by")), "y")
        return both.select("x", "y", "bx", "by").mapInArrow(verify, "x long, y long, j double")

    few = buckets.where(f"size <= {small}")
    tested = store(verified(_small_pairs(few.select("key", "node", "n"),
                                         few.select("key", "size").distinct(), small)), "op7-tested")
    large = buckets.where(f"size > {small}").select("key", "node", "n", "size")
    if large.isEmpty():
        return texts, _roots(tested)

    # the pivot of a bucket: the text with the most company, over all its buckets
    company = large.groupBy("node").agg(F.sum("size").alias("company"))
    pivots = store(large.join(company, "node").groupBy("key").agg(
        F.max(F.struct("company", F.negative("node").alias("least"), F.col("n").alias("pivot_n")))
        .alias("p")).select("key", F.negative("p.least").alias("pivot"), "p.pivot_n"), "op7-pivots")
    large = large.select("key", "node", "n").join(pivots, "key")
    star = large.where("node <> pivot").select(
        F.least("node", "pivot").alias("x"), F.greatest("node", "pivot").alias("y")).distinct()
    tested = store(tested.union(verified(star.join(tested, ["x", "y"], "left_anti"))), "op7-tested")
    large = store(large.select("key", "node", "n", "pivot"), "op7-large")

    parts = parts_for(large.count())
    roots = _roots(tested)
    state = store(
        large.join(roots.select("node", "root"), "node", "left").coalesce(parts)
        .join(roots.select(F.col("node").alias("pivot"), F.col("root").alias("main")), "pivot", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .withColumn("main", F.coalesce("main", "pivot")).coalesce(parts), "op7-state")
    if state.where("root <> main").isEmpty():  # buckets that are one component each are done
        return texts, roots
    return texts, _roots(tested.union(stray_links(state, bags)))


def stray_links(state: DataFrame, bags: DataFrame, block_rows: int = 512,
                block_bytes: int = 16 << 20) -> DataFrame:
    """(x, y, j): links that connect strays with what they are similar to in their buckets."""
    number, stray = F.count(F.lit(1)), F.col("root") != F.col("main")
    state = state.select("main", "key", "node", "n", stray.alias("stray"))
    strays = F.sum(F.col("stray").cast("int")).alias("a")
    keys = store(state.groupBy("main", "key").agg(number.alias("b"), strays).where("a > 0"), "op7-keys")
    nodes = store(state.select("main", "node", "n", "stray").distinct(), "op7-around")
    plan = store(keys.groupBy("main").agg(F.sum(F.col("a") * F.col("b")).alias("apart")).join(
        nodes.groupBy("main").agg(number.alias("b"), strays), "main").select(
        "main", (F.col("a") * F.col("b") < F.col("apart")).alias("whole")), "op7-plan")
    group = ["main", "part"]
    together = nodes.join(plan.where("whole"), "main").select(
        "main", F.lit(0).cast("long").alias("part"), "node", "n", "stray")
    apart = state.join(keys.join(plan.where("not whole"), "main").select("main", "key"), ["main", "key"]).select(
        "main", F.col("key").alias("part"), "node", "n", "stray")
    met = store(together.unionByName(apart), "op7-met")
    ours = met.where("stray")
    blocks = F.ceil(F.greatest(number / block_rows, F.sum("n") * 12 / block_bytes)).cast("int")
    sizes = ours.groupBy(*group).agg(blocks.alias("a")).join(met.groupBy(*group).agg(blocks.alias("b")), group)
    sizes = store(sizes, "op7-blocks")
    own = lambda of: F.pmod(F.xxhash64("node"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    cell = [*group, "i", "k"]
    left = ours.join(sizes, group).select(*group, own("a").alias("i"), every("b").alias("k"),
                                          F.lit(0).alias("side"), "node")
    right = met.join(sizes, group).select(*group, every("a").alias("i"), own("b").alias("k"),
                                          F.lit(1).alias("side"), "node")
    rows = left.unionByName(right).join(bags, "node").select(*cell, "side", "node", "bag")
    return store(rows.repartition(*cell).sortWithinPartitions(*cell, "side", "node").mapInArrow(
        link_cells, "x long, y long, j double"), "op7-strays-linked")


def _elements(bags: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(elements, their text, elements per text): a bag as a set, the t-th copy an element of its own."""
    found, owner, sizes = [], [], np.zeros(len(bags), np.int64)
    for at, bag in enumerate(bags):
        n = len(bag) // 12
        h, c = np.frombuffer(bag, _U, n), np.frombuffer(bag, np.uint32, n, 8 * n).astype(np.int64)
        sizes[at] = c.sum()
        copy = np.arange(sizes[at]) - np.repeat(np.cumsum(c) - c, c)
        found.append(mix(np.repeat(h, c) + copy.astype(_U) * _GOLD))
        owner.append(np.full(sizes[at], at))
    return np.concatenate(found), np.concatenate(owner), sizes


def overlaps(a: list, b: list, columns: int = 4096, dense_from: int = 64) -> np.ndarray:
    """Weighted Jaccard similarity of every packed bag in ``a`` with every one in ``b``."""
    (ea, oa, na), (eb, ob, nb) = _elements(a), _elements(b)
    known, ca, cb = np.intersect1d(ea, eb), None, None
    common = np.zeros((len(a), len(b)), np.float32)
    if len(known):
        ca, cb = np.searchsorted(known, ea), np.searchsorted(known, eb)
        keep = known[np.minimum(ca, len(known) - 1)] == ea
        ca, oa = ca[keep], oa[keep]
        keep = known[np.minimum(cb, len(known) - 1)] == eb
        cb, ob = cb[keep], ob[keep]
        # elements of few texts are paired one by one, those of many are columns of a product
        fa, fb = np.bincount(ca, minlength=len(known)), np.bincount(cb, minlength=len(known))
        many = fa * fb >= dense_from
        place = np.cumsum(many) - 1
        for start in range(0, int(many.sum()), columns):
            wide = min(columns, int(many.sum()) - start)
            left, right = np.zeros((len(a), wide), np.float32), np.zeros((len(b), wide), np.float32)
            for out, c, o in ((left, ca, oa), (right, cb, ob)):
                here = many[c] & (place[c] >= start) & (place[c] < start + wide)
                out[o[here], place[c[here]] - start] = 1
            common += left @ right.T
        few_a, few_b = ~many[ca], ~many[cb]
        order = np.argsort(cb[few_b], kind="stable")
        cb, ob = cb[few_b][order], ob[few_b][order]
        lo, hi = np.searchsorted(cb, ca[few_a], "left"), np.searchsorted(cb, ca[few_a], "right")
        span = hi - lo
        at = np.repeat(lo, span) + np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)
        np.add.at(common, (np.repeat(oa[few_a], span), ob[at]), 1)
    return common / np.maximum(na[:, None] + nb[None, :] - common, 1)


def link_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell and side -> per cell the links that span its components."""
    def links(rows: pa.Table) -> pa.RecordBatch:
        side, node = rows.column("side").to_numpy(), rows.column("node").to_numpy()
        bags = [x.as_buffer() for x in rows.column("bag")]
        cut = int(np.searchsorted(side, 1))
        x, y = np.nonzero(overlaps(bags[:cut], bags[cut:]) >= SIMILARITY)
        y += cut
        # a stray stands on both sides: one place for both
        first = np.unique(node, return_index=True, return_inverse=True)
        place = first[1][first[2]]
        parent = merge(np.arange(len(node)), place[x], place[y])
        linked = np.flatnonzero(parent != np.arange(len(node)))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(node[linked], node[parent[linked]])),
             pa.array(np.maximum(node[linked], node[parent[linked]])),
             pa.array(np.ones(len(linked)))], ["x", "y", "j"])

    def whole(rows: pa.Table) -> bool:
        return rows.num_rows > 1 and rows.column("side")[0].as_py() == 0 and rows.column("side")[-1].as_py() == 1

    one_thread()
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = (pa.concat_tables([rest, rows]) if rest is not None else rows).combine_chunks()
        keys = [rows.column(c).to_numpy() for c in ("main", "part", "i", "k")]
        cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        start = 0
        for stop in cuts.tolist():
            if whole(part := rows.slice(start, stop - start)):
                yield links(part)
            start = stop
        rest = rows.slice(start)
    if rest is not None and whole(rest):
        yield links(rest)


def _id(name: str) -> Column:
    """A doc_id for equi-joins: null has a value, too."""
    return F.coalesce(name, F.lit(-(1 << 63))).alias("doc_id")


def _roots(tested: DataFrame) -> DataFrame:
    links = tested.where(F.col("j") >= SIMILARITY)
    return store(components(links.select(F.col("x").alias("u"), F.col("y").alias("v")), "op7"),
                 "op7-roots")


def with_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((doc_id, th, node), (node, th, first, class_id)): rows by text, texts by class."""
    texts, roots = near_classes(docs.select("doc_id", "text"))
    texts = texts.select("node", "th", "first").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    ids = texts.groupBy("root").agg(F.min("first").alias("class_id"))
    return docs.select("doc_id", text_digest(F.col("text")).alias("th")), texts.join(ids, "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id of every row of ``docs(doc_id, text)``."""
    rows, texts = with_classes(docs)
    return rows.join(texts.select("th", "class_id", F.lit(True).alias("known")), "th", "left").select(
        "doc_id", F.when(F.col("known"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the least doc_id of its near-duplicate class."""
    ready(spark)
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each near-duplicate class the first document (by doc_id, text hash) stays."""
    ready(spark)
    _, texts = with_classes(docs)
    first = texts.groupBy("root").agg(F.min("node").alias("node"))
    gone = texts.select("th", "node", _id("first")).join(
        first.select("node", F.lit(True).alias("stays")), "node", "left")
    rows = docs.select(F.struct(*docs.columns).alias("row"), text_digest(F.col("text")).alias("th"),
                       F.col("doc_id").alias("__id")).select(
        "row", F.coalesce("th", F.lit(b"")).alias("th"), _id("__id"))
    judged = rows.join(gone.select("th", F.col("doc_id").alias("first"), "stays",
                                   F.lit(True).alias("known")), "th", "left")
    alone = judged.where("known is null").select("row.*")
    kept = judged.where("stays and doc_id = first").dropDuplicates(["th", "doc_id"]).select("row.*")
    return alone.unionByName(kept)
