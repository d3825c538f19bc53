"""Operator 4: repeated line runs."""

import random

from tests.llm.conftest import EDGES, documents
from txnlake.llm.line_dedup import dedup_lines, line_dedup_stage


def brute(docs, least):
    """From each line on, the longest run that starts earlier, too; it goes if it has ``least`` bytes."""
    earlier, gone = {}, {}  # a tree of all suffixes so far
    for d, t in sorted(docs):
        lines = t.split("\n")
        gone.setdefault(d, set())
        for i in range(len(lines)):
            node, known, size, j = earlier, True, 0, i
            for k in range(i, len(lines)):
                known = known and lines[k] in node
                if known:
                    size, j = size + len(lines[k].encode()) + 1, k + 1
                node = node.setdefault(lines[k], {})
            if size >= least:
                gone[d].update(range(i, j))
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in docs}


def test_equals_brute_force(llm_spark):
    rnd = random.Random(4)
    pool = [rnd.choice(["", "a", "bb", "line", "x" * 9, "longer line here"]) + str(rnd.randint(0, 3))
            for _ in range(12)] + [""]
    for least in (1, 12, 40):
        docs, made = [], []
        for d in range(60):
            lines = [rnd.choice(pool) if rnd.random() < .6 else f"own {d} {k}"
                     for k in range(rnd.randint(1, 25))]
            if made and rnd.random() < .5:
                other = rnd.choice(made)
                k = rnd.randint(0, len(other))
                lines[rnd.randint(0, len(lines)):0] = other[k:k + rnd.randint(1, 12)]
            made.append(lines)
            docs.append((d, "\n".join(lines)))
        out = dedup_lines(documents(llm_spark, docs), least).collect()
        assert {r.row.doc_id: r.kept for r in out} == brute(docs, least)


def test_edges(llm_spark, edges, nothing):
    out = dedup_lines(edges, 20).collect()
    kept = {}
    for r in out:
        kept.setdefault(r.row.doc_id, []).append(r.kept)
    assert len(out) == len(EDGES)
    assert kept[1] == [None] and kept[2] == [""] and kept[6] == [""]
    assert kept[5] == ["same words in two rows of it"] * 2 and kept[None] == ["no id at all here"]
    stage = line_dedup_stage(llm_spark, edges, "")
    assert stage.columns == edges.columns and stage.schema == edges.schema
    # of equal texts the later one goes; the two rows equal in id as well are one document
    assert sorted(r.doc_id or 0 for r in stage.collect()) == [0, 1, 2, 3, 4, 5, 5, 7, 8]
    assert dedup_lines(nothing).count() == 0


def test_stage_drops_emptied_documents(llm_spark):
    line = "a line of some length that is repeated in another document of this very small corpus, twice"
    docs = documents(llm_spark, [(1, f"{line}\n{line} more"), (2, f"{line}\n{line} more"),
                                 (3, f"new\n{line}\n{line} more\nend")])
    out = {r.doc_id: (r.text, r.n_chars) for r in line_dedup_stage(llm_spark, docs, "").collect()}
    assert out == {1: (f"{line}\n{line} more", 2 * len(line) + 6), 3: ("new\nend", 7)}


def test_single_boilerplate_lines_go(llm_spark):
    line = "one short line of boilerplate"
    docs = documents(llm_spark, [(k, f"own words of document {k}\n{line}\n\nUn.\nmore of {k} here, too") for k in range(40)])
    out = {r.doc_id: r.text for r in line_dedup_stage(llm_spark, docs, "").collect()}
    assert len(out) == 40 and line in out[0]
    # blank and short lines go with the run that they end
    assert all(out[k] == f"own words of document {k}\nmore of {k} here, too" for k in range(1, 40))
