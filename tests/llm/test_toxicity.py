"""Operator 3: multiple-instance toxicity."""

import random

from tests.llm.conftest import documents
from txnlake.llm import toxicity


def _text(rnd, bad):
    out = []
    for s in range(rnd.randint(2, 12)):
        w = [rnd.choice(["stone", "river", "cloud", "green", "tree", "walk", "bread"]) for _ in range(8)]
        if bad and (s == 0 or rnd.random() < .2):
            w[3] = rnd.choice(["vileword", "nastyword"])
        out.append(" ".join(w) + ".")
    return " ".join(out)


def _corpus(n, seed):
    rnd = random.Random(seed)
    return [(k, _text(rnd, k % 6 == 0), int(k % 6 == 0)) for k in range(n)]


def test_held_out_accuracy_and_offending_sentences(llm_spark):
    rows = _corpus(900, 1)
    model = toxicity.fit([t for _, t, _ in rows[:600]], [y for *_, y in rows[:600]])
    df = documents(llm_spark, [(d, t) for d, t, _ in rows[600:]]).drop("score")
    got = {r.doc_id: r for r in toxicity.score_toxicity(df, model, spans=True).collect()}
    for d, t, y in rows[600:]:
        assert 0 <= got[d].score <= 1 and got[d].predicted == y
        bad = [s for s in toxicity.sentences(t) if "vileword" in s or "nastyword" in s]
        assert got[d].offending == bad


def test_noisy_or():
    m = toxicity.BagModel({"bad": 3.0}, -2.0, 0.25)
    one = 1 / (1 + 2.718281828 ** -1)
    none = 1 / (1 + 2.718281828 ** 2)
    assert abs(m.score("bad day. fine day.")[0] - (1 - (1 - one) * (1 - none))) < 1e-6
    assert m.score("fine day. bad day.")[1] == 1 and m.score(" \n") == (0.25, -1)


def test_labels_of_one_class_or_none():
    assert toxicity.fit([], []).score("any words")[0] < 1e-6
    assert toxicity.fit(["a b", "c"], [1, 1]).score("any words")[0] > .99
    assert toxicity.fit(["", "x y"], [1, 0]).score("")[0] == 1.0


def test_edges(llm_spark, edges, nothing):
    model = toxicity.fit([t for _, t, _ in _corpus(200, 2)], [y for *_, y in _corpus(200, 2)])
    out = toxicity.score_toxicity(edges, model)
    assert set(edges.columns) | {"predicted"} == set(out.columns) and out.count() == edges.count()
    assert all(0 <= r.score <= 1 for r in out.collect())
    assert toxicity.score_toxicity(nothing, model).count() == 0
    labels = llm_spark.createDataFrame([(5, 1), (6, 0), (1, None), (9, 1)], "doc_id long, toxic int")
    assert toxicity.train(edges, labels) is not None and toxicity.train(nothing, labels).weights == {}


def test_long_clean_texts_stay_clean():
    rows = _corpus(900, 3)
    model = toxicity.fit([t for _, t, _ in rows[:600]], [y for *_, y in rows[:600]])
    clean = " ".join(t for _, t, y in rows[600:] if not y)
    for size in (100_000, 300_000, 1_000_000):
        text = (clean * (size // len(clean) + 1))[:size]
        assert model.score(text)[0] < .1
        assert model.score(f"{text} stone river vileword cloud green.")[0] > .9


def test_fit_reads_whole_texts(llm_spark):
    """Texts over 20,000 characters teach too; the bound is a total, whatever the order of lengths."""
    rows = [(d, f"{t} " + "stone river cloud. " * 1200, y) for d, t, y in _corpus(60, 4)]
    assert min(len(t) for _, t, _ in rows) > 20_000
    docs = documents(llm_spark, [(d, t) for d, t, _ in rows])
    labels = llm_spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert model.word("vileword") > 0 or model.word("nastyword") > 0
    assert [model.score(t)[0] >= .3 for _, t, _ in rows] == [y == 1 for *_, y in rows]
    assert toxicity.train(docs, labels, train_chars=1).weights == {}
