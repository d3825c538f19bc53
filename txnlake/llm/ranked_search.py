"""Operator 11, ranked lexical search: NRA over impact-sorted posting lists.

A first pass reads every whole text once and keeps, per document, its number
of terms and how often it holds the items' terms; from that come N, L and the
document frequencies, by partial aggregates.  The second pass takes the
documents of a task in chunks and inverts each chunk: per term a list of
(document, impact), highest impact first.  For every item the lists are read
in step, only sequentially.  After each step a document's lower bound is what
it was seen with, its upper bound adds the impact at the reading place of every
list it wasn't seen in yet.  Documents whose upper bound cannot reach the
k-th lower bound (of the task so far) are out.  Reading goes on until no
document that is still in has an open list: then membership, ties and scores
are final.  Lists in which no such document is open are not read further.

A task returns at most k documents per item; a last top-k per item merges
them.  Items come in blocks of at most ``block_bytes`` of text, each a bounded
broadcast that is released after use; the documents are read per block.

A term is a maximal run of ASCII letters and digits and of all other
non-ASCII characters; only A-Z are lower-cased.

Defined cases: null and empty texts have no term and don't count in N; items
without a term, or without a match, have no rows.  Every row of either table is
a document or an item of its own, also with an id that others have; a null
doc_id comes after all others in ties, a null item_id is an item.  Very long
texts are read in slices.  Empty tables give an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnlake.llm.common import one_thread, read_table, ready, store

_LAST = (1 << 63) - 1  # a null doc_id sorts after all others
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
              for c in range(256))
SLICE = 1 << 20


def term_slices(text: bytes, size: int = SLICE) -> Iterator[list[bytes]]:
    """The terms of a text, a slice at a time; no term is cut."""
    start = 0
    while start < len(text):
        part = text[start:start + size].translate(_TERM)
        if start + size < len(text):
            cut = part.rfind(b" ")
            while cut < 0 and start + len(part) < len(text):
                more = text[start + len(part):start + len(part) + size].translate(_TERM)
                at = more.find(b" ")
                part += more if at < 0 else more[:at + 1]
                cut = len(part) - 1 if at >= 0 else -1
            part = part if cut < 0 else part[:cut + 1]
        start += len(part)
        yield part.split()


def _count(shared):
    """Texts -> (doc_id, n, terms, tf): the items' terms in each document that has terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids, sizes, terms, tfs, ends = [], [], [], [], [0]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n, seen = 0, Counter()
                for words in term_slices(text.as_py() or b""):
                    n += len(words)
                    part = Counter(words)
                    for word in part.keys() & known.keys():
                        seen[known[word]] += part[word]
                if n:
                    ids.append(doc)
                    sizes.append(n)
                    terms.extend(seen.keys())
                    tfs.extend(seen.values())
                    ends.append(len(terms))
            ends = np.array(ends, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))],
                ["doc_id", "n", "terms", "tf"])
    return run


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


class Lists:
    """One chunk of documents, inverted: per term its places and impacts, highest first."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, doc: np.ndarray, term: np.ndarray,
                 tf: np.ndarray, docs: int, length: int, weights: np.ndarray):
        self.ids = ids
        m = 75 + np.array([(25 * int(x) * docs) // length for x in n], np.int64)
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        term = term[order]
        cuts = np.flatnonzero(np.diff(term, prepend=-1, append=-1)) if len(term) else np.zeros(1, int)
        self.at = {int(term[a]): (int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:])}

    def nra(self, query: dict[int, int], k: int, floor: int, first: int = 64):
        """(places, scores) of the documents that may be among the best k: all that reach
        ``floor`` and this chunk's k-th score, with their final scores."""
        lists = [(*self.at[t], times) for t, times in query.items() if t in self.at]
        wide = len(lists)
        place = np.array([a for a, _, _ in lists], np.int64)
        stop = np.array([b for _, b, _ in lists], np.int64)
        times = np.array([x for _, _, x in lists], np.int64)
        lower = np.zeros(len(self.ids), np.int64)
        alive, bound = np.ones(len(lower), bool), max(floor, 1)
        # the sightings of documents that are still in: (document, list)
        doc, of = np.zeros(0, np.int64), np.zeros(0, np.int64)
        reading, depth, self.read = place < stop, first, 0
        while reading.any():
            spans = [(j, place[j], min(place[j] + depth, stop[j])) for j in np.flatnonzero(reading)]
            for j, a, b in spans:
                lower[self.doc[a:b]] += times[j] * self.impact[a:b]
                place[j] = b
                self.read += int(b - a)
            doc = np.concatenate([doc, *[self.doc[a:b] for _, a, b in spans]])
            of = np.concatenate([of, np.repeat([j for j, _, _ in spans], [b - a for _, a, b in spans])])
            # what a document not yet seen in a list can still get from it
            ahead, more = np.zeros(wide, np.int64), place < stop
            ahead[more] = times[more] * self.impact[place[more]]
            left = np.flatnonzero(alive)
            if len(left) >= k:
                bound = max(bound, int(np.partition(lower[left], len(left) - k)[len(left) - k]))
            upper = lower + ahead.sum()
            np.subtract.at(upper, doc, ahead[of])
            alive &= upper >= bound
            kept = alive[doc]
            doc, of = doc[kept], of[kept]
            seen = np.bincount(of, minlength=wide)
            reading = (ahead > 0) & (seen < alive.sum())
            depth *= 2
        found = np.flatnonzero(alive & (lower >= bound))
        return found, lower[found]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _search(shared, k: int, chunk_docs: int, chunk_postings: int):
    """(doc_id, n, terms, tf) -> (item, doc_id, score): a task's best k per item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        docs, length, weights, queries = shared.value
        best = {q: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for q in queries}
        held: list[pa.RecordBatch] = []

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            sizes = table.column("terms").combine_chunks().value_lengths().to_numpy()
            flat = [table.column(c).combine_chunks().flatten().to_numpy() for c in ("terms", "tf")]
            lists = Lists(table.column("doc_id").fill_null(_LAST).to_numpy(),
                          table.column("n").to_numpy(), np.repeat(np.arange(len(sizes)), sizes),
                          flat[0], flat[1], docs, length, weights)
            for q, query in queries.items():
                ids, scores = best[q]
                floor = int(scores[-1]) if len(scores) == k else 1
                places, found = lists.nra(query, k, floor)
                if len(places):
                    ids = np.concatenate([ids, lists.ids[places]])
                    scores = np.concatenate([scores, found])
                    top = _best(ids, scores, k)
                    best[q] = ids[top], scores[top]

        rows = postings = 0
        for batch in batches:
            counts = batch.column("terms").value_lengths().fill_null(0).to_numpy()
            at = 0
            while at < batch.num_rows:
                fit = int(np.searchsorted(np.cumsum(counts[at:]), chunk_postings - postings, "right"))
                take = min(max(fit, 0 if rows else 1), chunk_docs - rows, batch.num_rows - at)
                if take:
                    held.append(batch.slice(at, take))
                    rows, postings, at = rows + take, postings + int(counts[at:at + take].sum()), at + take
                if at < batch.num_rows:
                    flush()
                    rows = postings = 0
        if held:
            flush()
        sizes = [len(i) for i, _ in best.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(list(best), np.int64), sizes)),
             pa.array(np.concatenate([i for i, _ in best.values()])),
             pa.array(np.concatenate([s for _, s in best.values()]))], ["item", "doc_id", "score"])
    return run


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int | None, Counter]]]:
    """Items with their terms, in blocks of bounded size, one at a time on the driver."""
    block, size = [], 0
    for row in items.toLocalIterator():
        text = bytes(row[1] or b"")
        terms = Counter()
        for words in term_slices(text):
            terms.update(words)
        if terms:
            block.append((row[0], terms))
            size += len(text)
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id",
                  item_id: str = "item_id", text: str = "text", block_bytes: int = 4 << 20,
                  chunk_docs: int = 8192, chunk_postings: int = 1 << 20) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item."""
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    out = None
    for block in _blocks(items.select(F.col(item_id).cast("long"), F.col(text).cast("binary")), block_bytes):
        words = sorted({w for _, terms in block for w in terms})
        known = {w: i for i, w in enumerate(words)}
        vocabulary = spark.sparkContext.broadcast(known)
        counted = store(texts.mapInArrow(
            _count(vocabulary), "doc_id long, n long, terms array<int>, tf array<long>"), "op11-counted")
        vocabulary.unpersist()
        total = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
        weights = np.array([weight(total[0], df[i]) if i in df else 0 for i in range(len(words))], np.int64)
        # a term without weight adds nothing
        queries = {q: {known[w]: times for w, times in terms.items() if weights[known[w]] > 0}
                   for q, (_, terms) in enumerate(block)}
        shared = spark.sparkContext.broadcast((total[0], total[1], weights, queries))
        found = store(counted.mapInArrow(_search(shared, k, chunk_docs, chunk_postings),
                                         "item long, doc_id long, score long"), "op11-found")
        shared.unpersist()
        # at most k rows per task and item
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], "item long, item_id long")
        part = found.withColumn("rank", place).where(F.col("rank") <= k).join(names, "item").select(
            "item_id", "rank", F.when(F.col("doc_id") != _LAST, F.col("doc_id")).alias("doc_id"), "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    ready(spark)
    return ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM lengths),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, total GROUP BY term),
impacts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // len))) AS impact
  FROM tfs JOIN lengths USING (doc_id) JOIN weights USING (term), total),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scored AS (
  SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score
  FROM asked JOIN impacts USING (term) GROUP BY item_id, doc_id HAVING sum(impact) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank,
       doc_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""
