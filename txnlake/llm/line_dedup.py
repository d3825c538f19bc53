"""Operator 4, line dedup: repeated line runs from a distributed suffix array.

Every document is a sequence of line ids.  Suffixes are ordered by
distributed prefix doubling: the rank of a suffix at depth 2h is the place of
its (rank at i, rank at i + h) pair in a range-partitioned sort of the
distinct pairs.  A suffix whose prefix of the reached depth occurs once is
discarded: it shares no longer prefix with any other, and neither does a
suffix that would need it for its next pair.  So the table shrinks from depth
to depth.

A run of lines matters from ``min_bytes`` bytes on (newlines included).  The
default of 20 takes every repeated line of 19 bytes or more; blank and very
short lines go only within a longer run.  What goes, for every suffix, is the
longest prefix that also starts earlier, if it has that size.

For a suffix, ``need`` is the least number of lines that reaches the size, and
``most`` the greatest at which the lines after its first stay below it.  The
suffixes that agree on n lines are a longest-common-prefix interval of the
array: they are found at depth 2**k <= n by two overlapping ranks, at i and at
i + n - 2**k.  All but the first of an interval, in the order (doc_id, text
hash, line), are later copies.  Intervals are taken at every n from ``need``
to ``most``: a still longer prefix leaves a prefix of full size to the next
line's suffix, so together the intervals cover exactly the longest prefixes,
their short last lines too.  Overlapping intervals join up to maximal repeated
runs.  Doubling goes on until no length is left; a newline counts as a byte,
so that is at most log2(min_bytes) rounds.

Only DataFrame functions are used.  Classes are counted with partial
aggregation before any shuffle, and joins back to a class are equi-joins on a
unique key, which skew-join splitting can divide.

Defined cases: a null text stays null; an empty text is one empty line.  Rows
equal in doc_id and text are one document and get the same result.  Null
doc_ids come first.  A document whose lines all go keeps an empty text (the
pipeline stage drops it).  Empty tables stay empty.  Other columns pass
through, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnlake.llm.common import read_table, ready, store
from txnlake.llm.sharding import ranked, with_border

_DOC = ["doc", "th"]
_NO_ID = -(1 << 63)  # stands for a null doc_id; its text hash is another one


def _unit() -> tuple:
    """Non-null key of a (doc_id, text) pair."""
    return (F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc"),
            F.xxhash64("text", F.col("doc_id").isNull()).alias("th"))


def _suffixes(docs: DataFrame, min_bytes: int) -> DataFrame:
    """doc, th, pos, line id (a, b), need, most: a row per line."""
    lines = docs.where(F.col("text").isNotNull()).select(
        *_unit(), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    rows = lines.select("doc", "th", "pos", F.xxhash64("line").alias("a"),
                        F.xxhash64(F.lit(4), "line").alias("b"),
                        (F.octet_length("line") + 1).cast("long").alias("size"))
    rows = rows.repartition(*_DOC).dropDuplicates([*_DOC, "pos"])
    doc = Window.partitionBy(*_DOC)
    stop = F.sum("size").over(doc.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("stop", stop).withColumn("start", F.col("stop") - F.col("size"))
    # lines that start within min_bytes of this one's start: one more than fit below that size
    need = F.count(F.lit(1)).over(doc.orderBy("start").rangeBetween(0, min_bytes - 1))
    whole = F.sum("size").over(doc)
    # this line, and the lines after it that stay below min_bytes together
    most = F.count(F.lit(1)).over(doc.orderBy("stop").rangeBetween(0, min_bytes - 1))
    rows = rows.select(*_DOC, "pos", "a", "b", most.cast("int").alias("most"), F.when(
        whole - F.col("start") >= min_bytes, need.cast("int")).alias("need"))
    return rows.withColumn("most", F.greatest("need", "most"))


def _ranks(pairs: DataFrame, name: str) -> DataFrame:
    """(a, b, rank) of the pairs that occur more than once, in the order (a, b)."""
    classes = (pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
               .select("a", "b", F.lit(1).alias("one")))
    order = ["a", "b"]
    return with_border(ranked(classes, order, name), order, "one").select(
        "a", "b", F.col("border").alias("rank"))


def _at(suffixes: DataFrame, shift) -> DataFrame:
    """Suffix ranks keyed by the position ``shift`` lines before."""
    return suffixes.select(*_DOC, (F.col("pos") - shift).alias("pos"), F.col("rank").alias("b"))


def later_copies(docs: DataFrame, min_bytes: int) -> DataFrame:
    """(doc, th, pos, n): the runs of n lines that occur earlier, from the LCP intervals."""
    rows = store(_suffixes(docs, min_bytes), "op4-lines")
    found, depth = [], 1
    pairs = rows
    while True:
        ranks = _ranks(pairs, f"op4-ranks-{depth}")
        suffixes = store(pairs.join(ranks, ["a", "b"]).select(*_DOC, "pos", "need", "most", "rank"),
                         f"op4-suffixes-{depth}")
        due = suffixes.where((F.col("most") >= depth) & (F.col("need") < 2 * depth)).withColumn("n", F.explode(
            F.sequence(F.greatest("need", F.lit(depth)), F.least("most", F.lit(2 * depth - 1)))))
        ends = suffixes.select(*_DOC, F.col("pos").alias("at"), F.col("rank").alias("tail"))
        due = due.withColumn("at", F.col("pos") + F.col("n") - depth).join(ends, [*_DOC, "at"])
        key = ["n", "rank", "tail"]
        place = F.struct(*_DOC, "pos")
        # stored, so that the join below has exchanges of its own, which skew-join splitting divides
        first = store(due.groupBy(*key).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies"))
                      .where("copies > 1").drop("copies"), f"op4-first-{depth}")
        found.append(due.join(first, key).where(place > F.col("first")).select(*_DOC, "pos", "n"))
        if suffixes.where(F.col("most") >= 2 * depth).isEmpty():
            break
        pairs = suffixes.withColumnRenamed("rank", "a").join(
            _at(suffixes, depth), [*_DOC, "pos"])
        depth *= 2
    return reduce(DataFrame.unionAll, found)


def repeated_runs(docs: DataFrame, min_bytes: int) -> DataFrame:
    """(doc, th, runs): the maximal runs of deleted lines, as sorted (from, to) pairs."""
    spans = later_copies(docs, min_bytes).withColumn("end", F.col("pos") + F.col("n"))
    doc = Window.partitionBy(*_DOC).orderBy("pos")
    reached = F.max("end").over(doc.rowsBetween(Window.unboundedPreceding, -1))
    islands = spans.withColumn("new", F.coalesce(F.col("pos") > reached, F.lit(True)).cast("int"))
    islands = islands.withColumn("island", F.sum("new").over(
        doc.rowsBetween(Window.unboundedPreceding, 0)))
    runs = islands.groupBy(*_DOC, "island").agg(F.min("pos").alias("from"), F.max("end").alias("to"))
    return runs.groupBy(*_DOC).agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("runs"))


def dedup_lines(docs: DataFrame, min_bytes: int = 20) -> DataFrame:
    """``row`` (all input columns), n_lines, runs (null: none), kept (the text that is left)."""
    found = repeated_runs(docs.select("doc_id", "text"), min_bytes)
    rows = docs.select(F.struct(*docs.columns).alias("row"), *_unit())
    joined = rows.join(found, _DOC, "left").withColumn("lines", F.split(F.col("row.text"), "\n"))
    # what is kept lies between the ends of the runs
    kept = F.expr("""array_join(flatten(zip_with(
        concat(array(0), transform(runs, r -> r.to)),
        concat(transform(runs, r -> r.from), array(size(lines))),
        (s, e) -> slice(lines, s + 1, e - s))), '\n')""")
    return joined.select("row", F.when(F.col("lines").isNotNull(), F.size("lines")).alias("n_lines"),
                         "runs", F.when(F.col("runs").isNull(), F.col("row.text"))
                         .otherwise(kept).alias("kept"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, deleted lines and runs, bytes and digest of what is kept."""
    ready(spark)
    out = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.coalesce(F.expr("aggregate(runs, 0, (n, r) -> n + r.to - r.from)"), F.lit(0))
    return out.select(
        F.col("row.doc_id").alias("doc_id"), F.col("n_lines").cast("long").alias("n_lines"),
        removed.cast("long").alias("n_removed"),
        F.coalesce(F.size("runs"), F.lit(0)).cast("long").alias("n_runs"),
        F.octet_length("kept").cast("long").alias("kept_bytes"), F.md5(F.col("kept")).alias("kept_md5"))


OP4_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS pos
  FROM documents),
sized AS (
  SELECT *, strlen(line) + 1 AS size,
         sum(strlen(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos) AS stop,
         sum(strlen(line) + 1) OVER (PARTITION BY doc_id) AS whole
  FROM lines),
-- runs of 20 bytes or more, as short as can be or with less than 20 after their first line
spans AS (
  SELECT a.doc_id, a.pos, e.pos - a.pos + 1 AS n
  FROM sized a JOIN sized e ON e.doc_id = a.doc_id AND e.pos >= a.pos AND e.pos < a.pos + 20
  WHERE e.stop - (a.stop - a.size) >= 20
    AND (e.stop - e.size - (a.stop - a.size) < 20 OR e.stop - a.stop < 20)),
windows AS (
  SELECT s.doc_id, s.pos, s.n, string_agg(l.line, chr(10) ORDER BY l.pos) AS run
  FROM spans s JOIN lines l ON l.doc_id = s.doc_id AND l.pos >= s.pos AND l.pos < s.pos + s.n
  GROUP BY s.doc_id, s.pos, s.n),
copies AS (
  SELECT doc_id, pos, n FROM windows
  QUALIFY row_number() OVER (PARTITION BY run, n ORDER BY doc_id, pos) > 1),
marked AS (
  SELECT l.doc_id, l.pos, l.line,
         EXISTS (SELECT 1 FROM copies c WHERE c.doc_id = l.doc_id
                 AND l.pos >= c.pos AND l.pos < c.pos + c.n) AS gone
  FROM lines l),
edges AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), FALSE) AS opens
  FROM marked)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       count(*) FILTER (opens) AS n_runs,
       strlen(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_bytes,
       md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_md5
FROM edges GROUP BY doc_id
"""


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: later copies of line runs are deleted; documents left empty by that go."""
    ready(spark)
    out = dedup_lines(docs).where(F.col("runs").isNull() | (F.trim("kept") != ""))
    text = F.col("kept")
    return out.select(*[
        text.alias("text") if c == "text"
        else F.when(F.col("runs").isNull(), F.col("row.n_chars"))
        .otherwise(F.length(text)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col("row")[c].alias(c) for c in docs.columns])
