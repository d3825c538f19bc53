"""Operator 8: token ids in shard files."""

import random
import struct
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import EDGES, documents
from txnlake.llm import token_store
from txnlake.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_equal_the_library(library):
    rnd = random.Random(11)
    letters = "ab' 's\n\t\x1c\x85\xa0 é漢字1²Ⅷ!?.,'ll've<|endoftext|>\u200b\u0300😀"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 12))) for _ in range(1500)]
    texts += ["plain words, in\nlines.\nAnd more", "two  spaces", " lead", "trail ", "a\n\nb", ""]
    got = token_store.Encoder(PATH).encode(texts, 0)
    for t, raw in zip(texts, got):
        ids = library(t)
        assert raw == struct.pack(f"<{len(ids)}I", *ids), repr(t)


def test_special_strings_are_what_the_library_makes_of_them(library):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\ny z", "a <|endoftext> b"]
    assert library(texts[0]) == [64, 220, 50256, 275, 0]
    got = token_store.Encoder(PATH).encode(texts, 0)
    assert got == [struct.pack(f"<{len(library(t))}I", *library(t)) for t in texts]


def test_odd_white_space_is_noticed_again(library):
    """A chunk with a tab is known from an even text and comes up in an uneven one."""
    e = token_store.Encoder(PATH)
    for text in ("a\tb c", "a\tb \tc d", "a\tb\t\n c", "a\u00a0 \u00a0b a\tb", "\ta\tb"):
        for _ in range(2):
            assert e.encode([text, "plain"], 0)[0] == struct.pack(f"<{len(library(text))}I", *library(text))


def test_texts_of_any_length_train_the_dictionary(llm_spark):
    rows = [(k, " ".join(f"word{k * j % 97}" for j in range(9000))) for k in range(40)]
    long = token_store.train_dictionary(documents(llm_spark, rows), PATH, 0, 30, 2000, 4096)
    assert len(long) > 1000


def test_a_full_table_still_gives_ids(library, monkeypatch):
    monkeypatch.setattr(token_store, "CACHE_ENTRIES", 5)
    e = token_store.Encoder(PATH)
    for k in range(30):
        text = f"word{k} again{k % 3} the same"
        assert e.encode([text], 0)[0] == struct.pack(f"<{len(library(text))}I", *library(text))


def test_round_trip_and_random_access(llm_spark, library):
    rnd = random.Random(12)
    docs = [(k * 7, " ".join(rnd.choice(["some", "words", "of", "text,", "more"]) + str(rnd.randint(0, 99))
                             for _ in range(rnd.randint(0, 200)))) for k in range(300)]
    rnd.shuffle(docs)
    folder = scratch_path(llm_spark, "test-shards")
    manifest = token_store.token_store(documents(llm_spark, docs), PATH, folder, shard_bytes=4000,
                                       dict_bytes=4096).collect()
    assert len(manifest) > 3
    place, start = 0, 0
    ordered = sorted(docs)
    for m in sorted(manifest, key=lambda m: m.shard):
        shard = token_store.Shard(folder, m.path)
        for k in reversed(range(len(shard))):  # by seek, in any order
            assert shard.ids(k).tolist() == library(ordered[place + k][1])
        assert shard.doc_ids == [d for d, _ in ordered[place:place + len(shard)]]
        place += len(shard)
    got = sorted(token_store.read_shards(llm_spark.createDataFrame(manifest), folder).collect())
    for (d, t), r in zip(ordered, got, strict=True):
        ids = library(t)
        assert (r.doc_id, r.start, r.n_tokens) == (d, start, len(ids))
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        start += len(ids)


def test_edges(llm_spark, edges, nothing, library):
    folder = scratch_path(llm_spark, "test-shards")
    out = token_store.read_shards(token_store.token_store(edges, PATH, folder), folder).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in out) == sorted(
        (str(d), len(library(t))) for d, t in EDGES)
    folder = scratch_path(llm_spark, "test-shards")
    manifest = token_store.token_store(nothing, PATH, folder)
    assert manifest.count() == 0 and token_store.read_shards(manifest, folder).count() == 0
