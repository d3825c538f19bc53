"""The corpus pipeline and the registered queries on the smallest tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from tests.llm.test_minhash import brute as near_brute
from tests.llm.test_line_dedup import brute as line_brute
from txnlake.llm import queries
from txnlake.llm.common import store


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(llm_spark, sf_small, key):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = E.queries()[key](llm_spark, sf_small)
    cur = con.execute(queries.ORACLE_SQL[key])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert Counter(map(tuple, df.select(names).collect())) == Counter(cur.fetchall())


def test_stages(llm_spark, sf_small):
    """Line and near dedup and the bins against a plain version; the other stages drop few documents, change none."""
    docs = llm_spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = store(stage(llm_spark, docs, sf_small), f"test-{name}")
        seen[name] = (before, docs.collect())
        if name != "packing":
            assert docs.columns == columns
    before, after = seen["line_dedup"]
    want = line_brute([(r.doc_id, r.text) for r in before], 20)
    assert {r.doc_id: r.text for r in after} == {d: t for d, t in want.items() if t.strip()}
    before, after = seen["near_dedup"]
    classes = near_brute([(r.doc_id, r.text) for r in before])
    assert {r.doc_id for r in after} == set(classes.values())
    for name in ("toxicity", "decontamination"):
        before, after = seen[name]
        assert Counter(after) - Counter(before) == Counter() and len(after) > .7 * len(before)
    before, after = seen["packing"]
    size = Counter()
    for r in after:
        size[r.doc_id] += r.size
    assert size == {r.doc_id: len(r.text.split()) + 1 for r in before}
