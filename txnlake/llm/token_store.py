"""Operator 8, token ids in binary shard files.

Every text is encoded with a byte-level BPE of the ``tokenizers`` library.
Its ids (little-endian unsigned 32-bit, end id included) form one zstandard
frame, compressed with a dictionary that all shards share and that is trained
on the id arrays of a bounded sample.  A shard file is

    magic "TXIDS001" | sha256 of the dictionary (32 bytes) | frames ...
    | index: per document <doc_id i64, has doc_id u32, n_ids u32, frame bytes u64>
    | doc count u64 | ids u64 | index offset u64

and ``dictionary`` lies beside the shards.  One document is read by a seek:
its index entry gives frame offset and length.  Files are written in
ascending doc_id order: encoded rows are stored once, range-partitioned by
doc_id, and each range becomes one file; a manifest row per file carries its
path and totals.  A task writes to a name of its own attempt and renames it
at the end, so a retried task replaces the file by an equal one.

The library's work is done once per distinct chunk (about a word): its ids
are kept in a bounded table in the worker process.

Defined cases: null text is an empty text (only the end id); rows with a null
doc_id come first; equal doc_ids are kept as rows, ordered by size and a hash of the frame;
an empty table gives no shard.  Extra columns are ignored.  A special string
inside a text is one id, as the library has it; such texts are encoded whole.
"""

from __future__ import annotations

import functools
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnlake.llm.common import one_thread, read_table, ready, store
from txnlake.session import scratch_path

MAGIC = b"TXIDS001"
INDEX = np.dtype([("doc_id", "<i8"), ("known", "<u4"), ("n_ids", "<u4"), ("bytes", "<u8")])
#: Distinct chunks whose ids a worker keeps, in each of two generations.
CACHE_ENTRIES = 500_000
#: White space next to white space or at an end: such texts are cut with care.
_UNEVEN = re.compile(r"\s\s|\A\s|\s\Z").search
_SAFE_CUT = re.compile(r"(?= \S)").split
_WORD = re.compile(r" ?\S+").fullmatch


class Encoder:
    """Texts to id bytes, with the ids of known chunks remembered.

    A byte-level BPE never merges across its pre-tokens, and a pre-token
    starts at every blank before a visible character; a newline between two
    visible characters is a pre-token of its own.  So the ids of a text are
    those of its chunks in a row.
    """

    def __init__(self, path: str):
        one_thread()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: strings that the library takes as one id wherever they stand
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: ids by chunk, in two generations: a full table becomes the old one
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        (self.newline,) = self._ids("\n")

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def chunks(self, text: str) -> list[str]:
        """Words with the blank before them, and newlines; or the whole text if it can't be cut."""
        if any(special in text for special in self.specials):
            return [text]
        if "\0" not in text:
            out = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
            # an empty chunk or a lone blank: white space next to white space or at an end
            if "" not in out and " " not in out:
                return out
        return [c for c in _SAFE_CUT(text) if c]

    def learn(self, chunks: list[str]) -> list[str]:
        """Encode new chunks, words many at a time with newlines between them; those with other white space."""
        known, plain, whole = self.known, [], []
        for c in chunks:
            (plain if _WORD(c) else whole).append(c)
        for chunk, e in zip(whole, self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)):
            known[chunk] = np.array(e.ids, "<u4").tobytes()
        parts = [plain[at:at + 256] for at in range(0, len(plain), 256)]
        joined = self.tokenizer.encode_batch_fast(["\n".join(p) for p in parts],
                                                  add_special_tokens=False)
        for part, e in zip(parts, joined):
            ids = np.array(e.ids, "<u4")
            raw, cut = ids.tobytes(), (4 * np.flatnonzero(ids == self.newline)).tolist()
            for chunk, start, stop in zip(part, [-4, *cut], [*cut, len(raw)], strict=True):
                known[chunk] = raw[start + 4:stop]
        return [c for c in whole if c != "\n"]

    def _look_up(self, chunks: set[str]) -> tuple[dict[str, bytes], list[str]]:
        """(ids of all these chunks, those with white space inside): a small table for a few texts."""
        if len(self.known) > CACHE_ENTRIES:
            self.known, self.old = {}, self.known
        ids = {c: v for c, v in zip(chunks, map(self.known.get, chunks))}
        lacking = [c for c, v in ids.items() if v is None]
        back = {c: self.old[c] for c in lacking if c in self.old}
        self.known.update(back)
        odd = self.learn([c for c in lacking if c not in back])
        for c in lacking:
            ids[c] = self.known[c]
        # forgotten, so that they are noticed whenever they come
        for c in odd:
            del self.known[c]
        return ids, odd

    def encode(self, texts: list[str], end_id: int) -> list[bytes]:
        pieces = [self.chunks(t) for t in texts]
        ids, odd = self._look_up(set().union(*pieces))
        if odd:
            # white space next to white space, perhaps: cut only between a blank and a word
            for at, text in enumerate(texts):
                if len(pieces[at]) > 1 and not set(odd).isdisjoint(pieces[at]) and _UNEVEN(text):
                    pieces[at] = [c for c in _SAFE_CUT(text) if c]
            ids |= self._look_up(set().union(*pieces).difference(ids))[0]
        get, end = ids.__getitem__, struct.pack("<I", end_id)
        return [b"".join(map(get, p)) + end for p in pieces]


@functools.cache
def encoder(path: str) -> Encoder:
    """One per worker process, whose table lives on from task to task."""
    return Encoder(path)


def train_dictionary(docs: DataFrame, encoder_path: str, end_id: int, sample_docs: int,
                     sample_chars: int, dict_bytes: int) -> bytes:
    """Dictionary from about ``sample_docs`` texts, drawn with equal chance from all rows.

    Of a text longer than ``sample_chars`` a stretch of that length takes part,
    at a place that its hash tells: texts of any length train, and what the
    driver sees is bounded.  Too little material gives an empty dictionary
    (plain frames).
    """
    import zstandard

    share = min(1.0, sample_docs / max(1, docs.count()))
    place = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - sample_chars, F.lit(0)) + 1)
    few = docs.sample(share, seed=8).where(F.col("text").isNotNull()).select(
        F.substring("text", place.cast("int") + 1, F.lit(sample_chars)).alias("text")).collect()
    samples = encoder(encoder_path).encode([r.text for r in few], end_id)
    try:
        return zstandard.train_dictionary(dict_bytes, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _slices(frame: pd.DataFrame, chars: int) -> Iterator[pd.DataFrame]:
    """Parts of a batch with at most ``chars`` characters, one row at least."""
    total = frame["text"].str.len().cumsum().to_numpy()
    start = 0
    while start < len(frame):
        stop = max(start + 1, int(np.searchsorted(
            total, (total[start - 1] if start else 0) + chars, "right")))
        yield frame.iloc[start:stop]
        start = stop


def encode_documents(docs: DataFrame, encoder_path: str, dictionary: bytes, end_id: int,
                     level: int = 1) -> DataFrame:
    """doc_id, n_tokens, frame: one compressed id array per document."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)  # bounded by dict_bytes

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        known = encoder(encoder_path)
        extra = {"dict_data": zstandard.ZstdCompressionDict(shared.value)} if shared.value else {}
        press = zstandard.ZstdCompressor(level=level, write_content_size=True, **extra)
        for batch in batches:
            for part in _slices(batch, 1 << 21):
                ids = known.encode(part["text"].tolist(), end_id)
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(),
                                    "n_tokens": [len(x) // 4 for x in ids],
                                    "frame": [press.compress(x) for x in ids]})

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInPandas(run, "doc_id long, n_tokens long, frame binary")


def filesystem(uri: str):
    """(file system, path) of a shared folder or file named by a uri or a plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (
        fs.LocalFileSystem(), uri)


def write_shards(encoded: DataFrame, folder: str, dictionary: bytes, shards: int) -> DataFrame:
    """Write one file per doc_id range; a manifest row (shard, path, n_docs, n_ids) per file."""
    digest = hashlib.sha256(dictionary).digest()
    system, base = filesystem(folder)
    system.create_dir(base, recursive=True)
    with system.open_output_stream(f"{base}/dictionary") as out:
        out.write(dictionary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        batches = (b for b in batches if len(b))
        first = next(batches, None)
        if first is None:
            return
        shard = TaskContext.get().partitionId()
        system, base = filesystem(folder)
        final, own = f"{base}/shard-{shard:06d}", f"{base}/.{shard:06d}-{uuid.uuid4().hex}"
        sizes, n_ids, at = [], 0, len(MAGIC) + len(digest)
        with system.open_output_stream(own) as out:
            out.write(MAGIC + digest)
            batch = first
            while batch is not None:
                part = np.zeros(len(batch), INDEX)
                part["known"] = batch["doc_id"].notna()
                part["doc_id"] = batch["doc_id"].fillna(0)
                part["n_ids"] = batch["n_tokens"]
                part["bytes"] = batch["frame"].str.len()
                out.write(b"".join(batch["frame"]))
                sizes.append(part)
                n_ids += int(part["n_ids"].sum(dtype=np.int64))
                at += int(part["bytes"].sum())
                batch = next(batches, None)
            index = np.concatenate(sizes)
            out.write(index.tobytes() + struct.pack("<QQQ", len(index), n_ids, at))
        system.move(own, final)
        yield pd.DataFrame({"shard": [shard], "path": [f"{folder}/shard-{shard:06d}"],
                            "n_docs": [len(index)], "n_ids": [n_ids]})

    order = ["doc_id", "n_tokens", "tie"]  # no frame goes into the range sample
    ranged = (encoded.withColumn("tie", F.xxhash64("frame")).repartitionByRange(shards, *order)
              .sortWithinPartitions(*order).drop("tie"))
    files = store(ranged.mapInPandas(
        run, "shard long, path string, n_docs long, n_ids long"), "op8-manifest")
    # one row per file: a window over them is small by construction
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("*", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))


class Shard:
    """Random access to one shard file."""

    def __init__(self, folder: str, path: str):
        import zstandard

        system, name = filesystem(path)
        system_d, base = filesystem(folder)
        with system_d.open_input_stream(f"{base}/dictionary") as f:
            dictionary = f.read()
        self.file = system.open_input_file(name)
        size = self.file.size()
        n, self.n_ids, at = struct.unpack("<QQQ", self.file.read_at(24, size - 24))
        head = self.file.read_at(40, 0)
        if head[:8] != MAGIC or head[8:] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path}: not a shard of this dictionary")
        index = np.frombuffer(self.file.read_at(INDEX.itemsize * n, at), INDEX)
        self.doc_ids = [int(d) if known else None for d, known in zip(index["doc_id"], index["known"])]
        self.counts, self.lengths = index["n_ids"].astype(np.int64), index["bytes"].astype(np.int64)
        self.offsets = 40 + np.cumsum(self.lengths) - self.lengths
        extra = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        self.press = zstandard.ZstdDecompressor(**extra)

    def __len__(self) -> int:
        return len(self.counts)

    def id_bytes(self, k: int) -> bytes:
        """The ids of the k-th document, as little-endian 32-bit integers."""
        return self.press.decompress(self.file.read_at(int(self.lengths[k]), int(self.offsets[k])))

    def ids(self, k: int) -> np.ndarray:
        return np.frombuffer(self.id_bytes(k), "<u4")


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                shard = Shard(folder, row.path)
                start = row.start + np.cumsum(shard.counts) - shard.counts
                for at in range(0, len(shard), 5000):
                    some = range(at, min(at + 5000, len(shard)))
                    raw = [shard.id_bytes(k) for k in some]
                    yield pd.DataFrame({"doc_id": pd.array(shard.doc_ids[at:at + len(raw)], "Int64"),
                                        "start": start[at:at + len(raw)],
                                        "n_tokens": [len(x) // 4 for x in raw],
                                        "ids_crc32": [zlib.crc32(x) for x in raw]})

    spread = manifest.select("path", "start").repartition(
        int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")
    return spread.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_store(docs: DataFrame, encoder_path: str, folder: str, end_id: int = 0,
                shard_bytes: int = 64 << 20, sample_docs: int = 2000, sample_chars: int = 20_000,
                dict_bytes: int = 64 << 10) -> DataFrame:
    """Encode ``docs(doc_id, text)`` into shard files below ``folder``; the manifest.

    ``shard_bytes`` of compressed ids make one file.
    """
    ready(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    dictionary = train_dictionary(docs, encoder_path, end_id, sample_docs, sample_chars, dict_bytes)
    encoded = store(encode_documents(docs, encoder_path, dictionary, end_id), "op8-encoded")
    total = encoded.agg(F.sum(F.length("frame"))).first()[0] or 0
    floor = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return write_shards(encoded, folder, dictionary, max(floor, -(-total // shard_bytes)))


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through the shard files and back."""
    import public_tokenizers

    ready(spark)
    folder = scratch_path(spark, "op8-shards")
    manifest = token_store(read_table(spark, sf_dir, "documents"),
                           public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read_shards(manifest, folder)
