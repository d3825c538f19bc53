"""Operator 12, phrase collocation mining: SON partitioning.

Texts are split into pieces and words as the contract says; all counts are per
language.  Three passes read the whole texts:

1. the corpus is dealt into ``shards`` shards, and each is mined completely
   for words and pairs: those that reach the support divided by the number of
   shards are locally frequent.  A phrase that reaches the support in all must
   do so in at least one shard, however the rows are dealt;
2. the same for phrases of three to five words, of which only those can be
   frequent whose words and pairs are locally frequent somewhere;
3. what is locally frequent anywhere is counted globally, as strings, and is
   kept if it reaches the support: these counts are exact.

The first two passes count 64-bit fingerprints.
What passes 2 and 3 look for reaches the tasks as a Bloom filter of a fixed
size (``filter_bits``), whatever the corpus holds.  A filter only ever lets
too much through (so does a clash of fingerprints): what it wrongly lets
through is counted like all else, in pass 3 by its string, and falls short of
the support.  Tasks add up their own counts before the shuffle.

Cuts, subsumption and ranks are joins on the frequent phrases alone.  The
products of a score are decimals of 38 digits, which hold 1000 * a * n for
counts below 10 ** 16.  The best of a language are found in
two steps (per salt, then per language), so no language meets in one task.

Defined cases: null and empty texts have no words; a null language is ``und``.
Rows are documents of their own, also if repeated.  A very long text is read in slices.
A word may hold any characters but spaces, tabs and the separators.
Empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnlake.llm.common import read_table, ready, store

SUPPORT = 100
LONGEST = 5
BEST = 2000
#: A-Z in lower case, separators of pieces as line feeds, tabs as spaces.
_CHARS = bytes(c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c
               for c in range(256))
SLICE = 1 << 20
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_PROBES = 2


def word_slices(text: bytes, size: int = SLICE) -> Iterator[list[bytes]]:
    """Words of a text, with b"\\n" where a piece ends and b"" between spaces, a slice at a time.

    No word is cut.
    """
    start = 0
    while start < len(text):
        stop = start + size
        part = text[start:stop].translate(_CHARS)
        if stop < len(text):
            cut = max(part.rfind(b" "), part.rfind(b"\n"))
            while cut < 0 and start + len(part) < len(text):
                more = text[start + len(part):start + len(part) + size].translate(_CHARS)
                ends = [x for x in (more.find(b" "), more.find(b"\n")) if x >= 0]
                part += more[:min(ends) + 1] if ends else more
                cut = len(part) - 1 if ends else -1
            part = part if cut < 0 else part[:cut + 1]
        start += len(part)
        yield part.replace(b"\n", b" \n ").split(b" ")


class _Ids(dict):
    """Words of one language -> local ids, given out as words come."""

    def __init__(self, lang: str, names: list[tuple[str, bytes]]):
        super().__init__({b"\n": 0, b"": -1})
        self.lang, self.names = lang, names

    def __missing__(self, word: bytes) -> int:
        self.names.append((self.lang, word))
        self[word] = len(self.names)
        return len(self.names)


class Stream:
    """Words of several documents as local ids; 0 ends a piece.  Id i is the (lang, word) ``names[i - 1]``."""

    def __init__(self):
        self.names: list[tuple[str, bytes]] = []
        self.langs: dict[str, _Ids] = {}
        self.parts: list[np.ndarray] = []
        self.tokens = 0
        #: tokens at the front that an earlier stream has counted
        self.old = 0

    def add(self, lang: str, words: list[bytes]) -> None:
        if lang not in self.langs:
            self.langs[lang] = _Ids(lang, self.names)
        part = np.fromiter(map(self.langs[lang].__getitem__, words), np.int64, len(words))
        part = part[part >= 0]
        self.parts.append(part)
        self.tokens += len(part)

    def end(self) -> None:
        self.parts.append(np.zeros(1, np.int64))
        self.tokens += 1

    def tail(self) -> "Stream":
        """A stream that begins with the words a later phrase can still begin with."""
        last = np.concatenate(self.parts)[-(LONGEST - 1):]
        new = Stream()
        for x in last:
            if x:
                lang, word = self.names[x - 1]
                new.add(lang, [word])
            else:
                new.end()
        new.old = new.tokens
        return new

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per local id (0 for the end of a piece)."""
        seeds: dict[str, int] = {}
        out = np.zeros(len(self.names) + 1, _U)
        for i, (lang, word) in enumerate(self.names, 1):
            if lang not in seeds:
                seeds[lang] = xxhash.xxh64_intdigest(lang.encode())
            out[i] = xxhash.xxh64_intdigest(word, seeds[lang])
        return out


def streams(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Stream]:
    """(lang, text) rows as streams of about ``most`` tokens."""
    stream = Stream()
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for words in word_slices(text.as_py() or b""):
                if stream.tokens - stream.old >= most:
                    yield stream
                    stream = stream.tail()
                stream.add(lang, words)
            stream.end()
    if stream.tokens > stream.old:
        yield stream


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    return x ^ (x >> _U(29))


def phrases(stream: Stream, hashes: np.ndarray, known: "Bloom | None" = None):
    """(size, ids, places, fingerprints) of the phrases in a stream, by falling pruning.

    Without ``known`` all words and pairs; with it phrases of up to five words
    whose words and pairs it holds.  A phrase belongs to the stream that holds
    its last word as a new one.
    """
    ids = np.concatenate(stream.parts)
    h = hashes[ids]
    fit = ids > 0
    if known:
        fit &= known.holds(hashes)[ids]
    at = np.flatnonzero(fit)
    yield 1, ids, at[at >= stream.old], h[at[at >= stream.old]]
    at = np.flatnonzero(fit[:-1] & fit[1:])
    prints = mix(h[at] * _STEP + h[at + 1])
    if known:
        held = known.holds(prints)
        at, prints = at[held], prints[held]
    pair = np.zeros(len(ids), bool)
    pair[at] = True
    for size in range(2, LONGEST + 1 if known else 3):
        if size > 2:
            going = at + size <= len(ids)
            at, prints = at[going], prints[going]
            going = pair[at + size - 2]
            at = at[going]
            prints = mix(prints[going] * _STEP + h[at + size - 1])
        new = at + size > stream.old
        yield size, ids, at[new], prints[new]


class Bloom:
    """A filter of ``bits`` bits (a power of two) over 64-bit fingerprints."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def holds(self, prints: np.ndarray) -> np.ndarray:
        out = np.ones(len(prints), bool)
        for probe in range(_PROBES):
            at = (prints >> _U(32 * probe)) & _U(self.bits - 1)
            out &= (self.words[at >> _U(6)] >> (at & _U(63))) & _U(1) == 1
        return out


def bloom(prints: DataFrame, bits: int) -> Bloom:
    """The filter of column ``h``, built by partial aggregates; at most bits / 64 rows come back."""
    spots = F.array(*[F.shiftrightunsigned("h", 32 * p).bitwiseAND(F.lit(bits - 1)) for p in range(_PROBES)])
    words = (prints.select(F.explode(spots).alias("at"))
             .groupBy(F.shiftrightunsigned("at", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("set")).toArrow())
    out = np.zeros(bits // 64, _U)
    out[words.column("word").to_numpy()] = words.column("set").to_numpy().view(_U)
    return Bloom(out, bits)


def _mine(known, shards: int, most: int):
    """(lang, text) -> (shard, h, n): words and pairs, or, if pairs are known, longer phrases."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = known and Bloom(*known.value)
        shard = TaskContext.get().partitionId() % shards
        for stream in streams(batches, most):
            for size, _, _, prints in phrases(stream, stream.hashes(), held):
                if held is None or size > 2:
                    x, n = np.unique(prints, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), shard, np.int32)), pa.array(x.view(np.int64)),
                         pa.array(n.astype(np.int64))], ["shard", "h", "n"])
    return run


def _count(pairs, longer, most: int):
    """(lang, text) -> (lang, phrase, size, n) of what the filters hold; size 0: all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, long = Bloom(*pairs.value), Bloom(*longer.value)
        for stream in streams(batches, most):
            langs = pa.array([g for g, _ in stream.names], pa.string())
            words = pa.array([w for _, w in stream.names], pa.string())
            ids = np.concatenate(stream.parts)[stream.old:]
            n = pa.table([langs, pa.array(np.bincount(ids, minlength=len(words) + 1)[1:])], ["lang", "n"])
            n = n.group_by("lang").aggregate([("n", "sum")]).combine_chunks()
            yield _rows(0, n.column("lang").combine_chunks(), pa.array([""] * len(n), pa.string()),
                        n.column("n_sum").to_numpy())
            for size, ids, places, prints in phrases(stream, stream.hashes(), short):
                if size > 2:
                    hit = long.holds(prints)
                    places, prints = places[hit], prints[hit]
                if size == 1:
                    first = ids[places]
                    n = np.bincount(first, minlength=1)
                    first = np.flatnonzero(n)
                    yield _rows(1, langs.take(pa.array(first - 1)), words.take(pa.array(first - 1)), n[first])
                    continue
                order = np.argsort(prints)
                places, prints = places[order], prints[order]
                new = prints[1:] != prints[:-1]
                # equal fingerprints of other words are phrases of their own
                for k in range(size):
                    new |= ids[places[1:] + k] != ids[places[:-1] + k]
                starts = np.flatnonzero(np.concatenate([[True], new])) if len(places) else np.zeros(0, int)
                at = places[starts]
                text = pa.compute.binary_join_element_wise(
                    *[words.take(pa.array(ids[at + k] - 1)) for k in range(size)], " ")
                yield _rows(size, langs.take(pa.array(ids[at] - 1)), text,
                            np.diff(np.append(starts, len(places))))
    return run


def _rows(size: int, langs: pa.Array, texts: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [langs, texts, pa.array(np.full(len(langs), size, np.int32)), pa.array(n, pa.int64())],
        ["lang", "phrase", "size", "n"])


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT,
                     shards: int = 16, filter_bits: int = 1 << 27, tokens: int = 1 << 20):
    """((lang, phrase, size, a) with a >= support, sizes 1 to 5; (lang, n): all word occurrences)."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"),
                        F.col(text).cast("binary").alias("text"))

    def locally_frequent(known=None):
        mined = texts.mapInArrow(_mine(known, shards, tokens), "shard int, h long, n long")
        found = mined.groupBy("shard", "h").agg(F.sum("n").alias("n")).where(
            F.col("n") >= -(-support // shards))
        held = bloom(found.select("h"), filter_bits)
        return spark.sparkContext.broadcast((held.words, held.bits))

    pairs = locally_frequent()
    longer = locally_frequent(pairs)
    counted = store(texts.mapInArrow(_count(pairs, longer, tokens),
                                     "lang string, phrase string, size int, n long")
                    .groupBy("lang", "phrase", "size").agg(F.sum("n").alias("a"))
                    .where((F.col("a") >= support) | (F.col("size") == 0)), "op12-frequent")
    for used in (pairs, longer):
        used.unpersist()
    # a file of its own: its size, one row per language, decides how it is joined
    totals = store(counted.where("size = 0").select("lang", F.col("a").alias("n")), "op12-totals")
    return counted.where("size > 0"), totals


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT,
                 best: int = BEST, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of every language."""
    frequent, totals = frequent_phrases(docs, text, lang, support, **options)
    longer = frequent.where("size > 1").withColumn("words", F.split("phrase", " "))
    part = lambda at, size: F.array_join(F.slice("words", at, size), " ")
    cuts = longer.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"),
        part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    left = frequent.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    wide = lambda c: F.col(c).cast("decimal(16,0)")
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang").select(
        "lang", "phrase", "a", "k", "l", "r", "n",
        (F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("n")).alias("over"),
        (wide("l") * wide("r")).alias("under")).withColumn("score", F.expr("over div under"))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r")
    inner = longer.where("size > 2").select("lang", "a", "words", "size", F.explode(F.expr(
        "sequence(2, size - 1)")).alias("m")).select(
        "lang", "a", "words", "m", F.explode(F.expr("sequence(1, size - m + 1)")).alias("at")).select(
        "lang", part(F.col("at"), F.col("m")).alias("phrase"), "a").groupBy("lang", "phrase").agg(
        F.max("a").alias("whole"))
    left_over = store(lowest.join(inner, ["lang", "phrase"], "left").where(
        F.col("whole").isNull() | (F.col("whole") < F.col("a"))).drop("whole"), "op12-scored")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salt = left_over.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    few = salt.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    few = few.where(F.col("place") <= best)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return few.withColumn("rank", place).where(F.col("rank") <= best).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of every language in ``documents``."""
    ready(spark)
    return collocations(read_table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
listed AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, s AS size, unnest([array_to_string(w[i:i + s - 1], ' ') for i in range(1, len(w) - s + 2)]) AS phrase
  FROM listed, (VALUES (1), (2), (3), (4), (5)) sizes(s)
  WHERE len(w) >= s),
counts AS (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang),
frequent AS (SELECT * FROM counts WHERE a >= 100),
longer AS (SELECT *, string_split(phrase, ' ') AS w FROM frequent WHERE size > 1),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM longer),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r, t.n,
         CAST((1000::HUGEINT * c.a * t.n) // (l.a::HUGEINT * r.a) AS BIGINT) AS score
  FROM cuts c
  JOIN frequent l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN frequent r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')
  JOIN totals t ON t.lang = c.lang),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
spans AS (SELECT lang, a, w, size, unnest(range(2, size)) AS m FROM longer WHERE size > 2),
starts AS (SELECT *, unnest(range(1, size - m + 2)) AS b FROM spans),
inner_max AS (
  SELECT lang, array_to_string(w[b:b + m - 1], ' ') AS phrase, max(a) AS whole FROM starts GROUP BY ALL),
left_over AS (
  SELECT s.* FROM lowest s LEFT JOIN inner_max i USING (lang, phrase)
  WHERE i.whole IS NULL OR i.whole < s.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a, l, r, n, score
FROM left_over
QUALIFY rank <= 2000
"""
