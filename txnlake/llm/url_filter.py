"""Operator 10, URL filters: rules first, then logistic regression.

Host and path are cut out of the url with built-in functions and the rule
table (a parameter, a handful of rows) becomes one CASE expression, longest
rule first.  What no rule decides goes to a logistic regression on hashed
character n-grams of host and path.  It is trained on the driver from a small
labelled url table (a parameter, at most ``train_rows`` rows; by default one
spelled from two hand-labelled word lists over the same url shapes, so that
only the words tell the classes apart); scoring is one Arrow pass
over the undecided urls with the weight vector (2**bits floats) shipped with
the task.

Defined cases: a null url, or one without ``://``, has empty host and path
and is judged by the model's bias; no labelled rows, or rows of one class
only, give that class's verdict (``allow`` without any).  Repeated rows are
judged one by one.  Extra columns pass through untouched unless they carry
an output name, which is then replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from txnlake.llm.common import read_table, ready

#: (rule, verdict); a rule is "host/path-prefix".
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
         ("org/fr/", "allow"))
#: Hand-labelled words of the default url table: 1 = unwanted, 0 = wanted.
UNWANTED = ("casino", "poker", "slots", "jackpot", "roulette", "bets", "betting", "gamble", "win-big",
            "pills", "cheap", "cheap-meds", "viagra", "pharma-deal", "adult", "adult-cam", "porn", "xxx",
            "x-rated", "sex", "escort", "dating-hot", "spam", "spam-link", "link-farm", "farm-links",
            "ads", "ads-server", "adserver", "track", "tracker", "clicktrack", "popup-ads", "free-money",
            "free-coins", "free-gift", "prize-win", "payday-loan", "fast-loan", "crypto-double", "warez",
            "cracks", "torrent", "keygen", "malware", "phish", "replica-watch", "lottery")
WANTED = ("news", "library", "museum", "school", "garden", "recipes", "weather", "science", "history",
          "music", "travel", "health", "sports", "city", "council", "books", "reader", "journal", "letters",
          "university", "research", "nature", "river", "mountain", "kitchen", "theatre", "cinema", "radio",
          "bread", "market", "forum", "wiki", "docs", "support", "archive", "photo", "painting", "language",
          "grammar", "mathematics", "physics", "chemistry", "biology", "geography", "astronomy", "poetry",
          "nation", "other")
_SHAPES = ("{}.example.com/en/{}", "www.{}.example.org/de/{}.html", "m.{}.example.net/fr/{}/",
           "blog.{}.example.com/es/{}")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules) -> Column:
    """The longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at, rest = rule.split("/", 1)
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(f"/{rest}")
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def rule_verdict(rule: Column, rules) -> Column:
    out = F.lit(None).cast("string")
    for name, verdict in rules:
        out = F.when(rule == name, F.lit(verdict)).otherwise(out)
    return out


@dataclass(frozen=True)
class NgramModel:
    """Logistic regression over hashed character n-grams."""

    bits: int
    sizes: tuple[int, ...]
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        rows, feats, value = ngram_features(texts, self.bits, self.sizes)
        z = self.bias + np.bincount(rows, self.weights[feats] * value, minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def ngram_features(texts: list[str], bits: int, sizes) -> tuple[np.ndarray, ...]:
    """(row, feature, value) triples; a row's values have unit length."""
    raw = [t.encode() for t in texts]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64) + np.uint64(1)
    owner = np.repeat(np.arange(len(raw)), lengths)
    rows, feats = [], []
    for n in sizes:
        if len(data) < n:
            continue
        h = np.full(len(data) - n + 1, n, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x100000001B3) + data[j:len(data) - n + 1 + j]
        h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
        inside = owner[:len(h)] == owner[n - 1:]
        rows.append(owner[:len(h)][inside])
        feats.append(h[inside].astype(np.int64))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    row, feat = np.concatenate(rows), np.concatenate(feats)
    count = np.bincount(row, minlength=len(raw))
    return row, feat, 1 / np.sqrt(count[row])


def fit(texts: list[str], labels: list[int], bits: int, sizes, steps: int,
        rate: float, l2: float) -> NgramModel:
    """Full-batch AdaGrad on the log loss."""
    y = np.array(labels, float)
    w, b = np.zeros(1 << bits), 0.0
    if not len(y) or y.min() == y.max():
        return NgramModel(bits, tuple(sizes), w, 0.0 if not len(y) else (40.0 if y[0] else -40.0))
    row, feat, value = ngram_features(texts, bits, sizes)
    gw, gb = np.full(len(w), 1e-8), 1e-8
    for _ in range(steps):
        z = b + np.bincount(row, w[feat] * value, minlength=len(y))
        e = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(y)
        g = np.bincount(feat, e[row] * value, minlength=len(w)) + l2 * w
        gw += g * g
        gb += e.sum() ** 2
        w -= rate * g / np.sqrt(gw)
        b -= rate * e.sum() / np.sqrt(gb)
    return NgramModel(bits, tuple(sizes), w, float(b))


def small_url_table(spark: SparkSession) -> DataFrame:
    """The default labelled table: every hand-labelled word in every shape."""
    rows = [(shape.format(word, 100 * k + 7), label)
            for label, words in ((1, UNWANTED), (0, WANTED))
            for k, word in enumerate(words) for shape in _SHAPES]
    url = F.concat(F.lit("https://"), F.col("tail"))
    return spark.createDataFrame(rows, "tail string, label int").select(
        host_of(url).alias("host"), path_of(url).alias("path"), "label")


def train(labelled: DataFrame, train_rows: int = 4000, bits: int = 16, sizes=(3, 4, 5),
          steps: int = 150, rate: float = 0.5, l2: float = 1e-5) -> NgramModel:
    """Fit on ``labelled(host, path, label)``: at most ``train_rows`` rows, by hash order."""
    few = (labelled.select("host", "path", "label").where("label is not null")
           .orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(train_rows).collect())
    return fit([r.host + r.path for r in few], [int(r.label) for r in few],
               bits, sizes, steps, rate, l2)


def url_filter(pages: DataFrame, model: NgramModel, rules=RULES, url: str = "url",
               threshold: float = 0.9) -> DataFrame:
    """``pages`` + host, path, rule, score (null where a rule decides), verdict.

    ``threshold`` is high: an unknown host is allowed, only a sure score blocks.
    """
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "score", "verdict")]
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast(model)  # 2**bits floats

    @F.pandas_udf(DoubleType())
    def block_score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            out = pd.Series(np.nan, index=s.index)
            some = s.notna()
            if some.any():
                out[some] = shared.value.score(s[some].tolist())
            yield out

    cut = (pages.select(*keep, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
           .withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)))
    judged = cut.withColumn("score", block_score(
        F.when(F.col("rule").isNull(), F.concat("host", "path"))))
    judged = judged.withColumn("score", F.when(F.col("rule").isNull(), F.col("score")))
    return judged.withColumn("verdict", F.coalesce(
        rule_verdict(F.col("rule"), rules),
        F.when(F.col("score") > threshold, "block").otherwise("allow")))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules, else by the model of the small url table."""
    ready(spark)
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages, train(small_url_table(spark))).select(
        "page_id", "host", "path", "rule", "verdict", "score")
