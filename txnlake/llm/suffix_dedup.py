"""Operator 9, suffix-array dedup: repeated byte strings across documents.

Every byte covered by a ``length``-byte string that also starts in a document
with a smaller doc_id goes.  The strings are found by suffix sorting, after a
filter that spares the sort all suffixes that can't repeat:

1. Texts are packed into batches of about half a megabyte and stored.  In every
   window of ``length`` bytes the 16-byte gram with the least hash is its
   anchor; equal windows have equal anchors.
2. Anchor hashes, once per batch, are dealt out by hash; those in several
   batches, or in several documents of one, may belong to repeated windows.
3. Each batch cuts out the fragments around such anchors (the windows whose
   anchor it is, 50 to 84 bytes), merges equal ones and deals them out by
   anchor hash.  A task merges equal fragments again, and orders the suffixes
   of the rest up to ``length`` bytes: multikey quicksort up to a shallow
   depth, blind tries for the groups that are still tied.  Classes of equal
   windows get the least doc_id that holds them.
4. A bit per window (is there a smaller doc_id?) goes back to the batch, which
   marks the covered bytes.

Equal fragments are merged per batch before each shuffle, so the copies of a
text or passage cost one entry per batch.  Batches and dealt-out parts are
bounded by their number growing with the input.

Defined cases: a null text has no bytes; texts shorter than ``length`` lose
nothing; a null doc_id is smaller than all others; rows with equal doc_ids
take nothing from each other.  Empty tables give no rows.  Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm.common import read_table, ready, store
from txnlake.llm.suffix_sort import deep_shallow

GRAM = 16
SHALLOW = 32
_U = np.uint64
_NO_ID = -(1 << 63)
_HASH_BYTES = 6


def _words(data: np.ndarray, n: int) -> np.ndarray:
    """The 8 bytes from each of the first n places, as numbers."""
    return np.lib.stride_tricks.as_strided(data, (n, 8), (1, 1)).copy().view("<u8").ravel()


def _gram_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a * _U(0x9E3779B97F4A7C15)) ^ (b * _U(0xC2B2AE3D27D4EB4F))
    h ^= h >> _U(29)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(32)
    return h | _U(1)


def _slide(h: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over every run of ``width`` places."""
    k = 1
    m = h
    while 2 * k <= width:
        m = pick(m[:-k], m[k:])
        k *= 2
    rest = width - k
    return pick(m[:len(m) - rest], m[rest:]) if rest else m


def anchors(data: np.ndarray, lengths: np.ndarray, length: int) -> np.ndarray:
    """Places of the anchors of all windows; ``data`` are the texts in a row."""
    width = length - GRAM + 1
    n = len(data) - GRAM + 1
    if len(data) < length:
        return np.zeros(0, np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    h = _gram_hash(_words(padded, n), _words(padded[8:], n))
    least = _slide(h, width, np.minimum)               # by window start
    ends = np.cumsum(lengths)
    for e in ends[:-1].tolist():                       # windows that cross a border
        least[max(0, e - length + 1):e] = 0
    around = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    return np.flatnonzero(_slide(around, width, np.maximum)[:n] == h)


def pack(length: int, batch_bytes: int):
    """doc_id, text -> batches: key, doc_ids, lengths, text (zstd), anchors (zstd of the places)."""
    def one(ids: list, texts: list) -> pa.RecordBatch:
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        lengths = np.array([len(t) for t in texts], np.int64)
        places, start, k = [], 0, 0
        while k < len(texts):                          # pieces that fit a core's cache
            stop = k + 1
            while stop < len(texts) and lengths[k:stop + 1].sum() < (1 << 17):
                stop += 1
            piece = np.frombuffer(b"".join(texts[k:stop]), np.uint8)
            places.append(start + anchors(piece, lengths[k:stop], length))
            start, k = start + len(piece), stop
        at = np.concatenate(places) if places else np.zeros(0, np.int64)
        gaps = np.diff(at, prepend=0).astype(np.uint32)
        return pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in (
                (uuid.uuid4().bytes, pa.binary()),
                (np.array(ids, np.int64).tobytes(), pa.binary()), (lengths.tobytes(), pa.binary()),
                (press.compress(b"".join(texts)), pa.binary()),
                (press.compress(gaps.tobytes()), pa.binary()))],
            names=["batch", "ids", "lengths", "text", "gaps"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                t = t.as_buffer().to_pybytes() if t.is_valid else b""
                ids.append(_NO_ID if d is None else d)
                texts.append(t)
                size += len(t) + 16
                if size >= batch_bytes:
                    yield one(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield one(ids, texts)
    return run


class Batch:
    """One stored batch, unpacked."""

    def __init__(self, ids: bytes, lengths: bytes, text: bytes, gaps: bytes):
        import zstandard

        self.ids = np.frombuffer(ids, np.int64)
        self.lengths = np.frombuffer(lengths, np.int64)
        self.ends = np.cumsum(self.lengths)
        self.data = np.frombuffer(zstandard.decompress(text), np.uint8) if self.ends[-1] else \
            np.zeros(0, np.uint8)
        self.at = np.cumsum(np.frombuffer(zstandard.decompress(gaps), np.uint32), dtype=np.int64)
        self.doc = np.searchsorted(self.ends, self.at, "right")
        self.hash = self.hashes(self.at)

    def hashes(self, at: np.ndarray) -> np.ndarray:
        word = np.zeros((2, len(at)), np.uint64)
        for j in range(GRAM):
            word[j // 8] |= self.data[at + j].astype(np.uint64) << _U(8 * (j % 8))
        return _gram_hash(word[0], word[1])

    def fragments(self, repeated: np.ndarray, length: int) -> "Fragments":
        return Fragments(self, repeated, length)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> _U(40)) * _U(buckets) >> _U(24)).astype(np.int64)


def _short(hashes: np.ndarray) -> bytes:
    """The low 6 bytes of every hash."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_HASH_BYTES].tobytes()


def _long(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // _HASH_BYTES, 8), np.uint8)
    out[:, :_HASH_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, _HASH_BYTES)
    return out.view("<u8").ravel()


_LOW = _U((1 << (8 * _HASH_BYTES)) - 1)


class Fragments:
    """The windows of the repeated anchors of a batch, equal fragments merged.

    ``first``/``count``: first window start and number of windows of each
    occurrence; ``of``: its fragment; per fragment ``rows`` (bytes, padded),
    ``windows``, ``least`` (least doc_id) and ``bucket_key`` (anchor hash).
    """

    def __init__(self, batch: Batch, repeated: np.ndarray, length: int):
        width = length - GRAM + 1
        at, h, doc = batch.at, batch.hash, batch.doc
        start = batch.ends[doc] - batch.lengths[doc]
        low = np.maximum(at - width + 1, start)
        high = np.minimum(at, batch.ends[doc] - length)
        n = len(at)
        for d in range(1, width):                      # other anchors of the same windows
            near = np.flatnonzero(at[d:] - at[:-d] < width)
            if not len(near):
                break
            left, right = near, near + d
            same = doc[left] == doc[right]
            left, right = left[same], right[same]
            wins = h[left] <= h[right]                 # the leftmost of equal ones
            np.maximum.at(low, right[wins], at[left[wins]] + 1)
            np.minimum.at(high, left[~wins], at[right[~wins]] - width)
        pick = np.flatnonzero((low <= high) & np.isin(h & _LOW, repeated)) if n else np.zeros(0, int)
        self.first, self.count = low[pick], high[pick] - low[pick] + 1
        self.doc = doc[pick]
        place_in = at[pick] - self.first               # of the anchor
        span = self.count + length - 1
        full = length + width - 1                      # the longest fragment
        raw = np.zeros((len(pick), full), np.uint8)
        for a in range(0, len(pick), 2048):            # in slices, to keep the index small
            part = slice(a, a + 2048)
            place = self.first[part, None] + np.arange(full)[None, :]
            raw[part] = batch.data[np.minimum(place, len(batch.data) - 1)]
            raw[part][np.arange(full)[None, :] >= span[part, None]] = 0
        tagged = np.concatenate([self.count[:, None].astype(np.uint8), raw], 1)
        _, one, self.of = np.unique(tagged.view(f"V{full + 1}").ravel(),
                                    return_index=True, return_inverse=True)
        del tagged
        order = np.lexsort((one, h[pick][one]))        # by anchor hash: buckets are ranges
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.of = back[self.of] if len(order) else self.of.astype(np.int64)
        one = one[order]
        self.rows, self.windows, self.key = raw[one], self.count[one], h[pick][one]
        self.anchor = place_in[one]
        self.least = np.full(len(one), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.of, batch.ids[self.doc])


def _by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) over sorted keys."""
    b = _bucket(keys, buckets)
    head = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])) if len(b) else []
    for k, start in enumerate(head):
        yield int(b[start]), int(start), int(head[k + 1]) if k + 1 < len(head) else len(b)


def _freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass batches on, giving unused Arrow memory back after each."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def _table(names: list[str], columns: list, types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def deal_hashes(buckets: int):
    """batch -> bucket, batch, hashes (once each), several (in more than one document)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for key, *parts in zip(*(c.to_pylist() for c in rows.columns)):
                b = Batch(*parts)
                order = np.lexsort((b.ids[b.doc], b.hash))
                h, d = b.hash[order], b.ids[b.doc][order]
                head = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else \
                    np.zeros(0, np.int64)
                several = np.zeros(len(head), bool)
                if len(head):
                    tail = np.append(head[1:], len(h)) - 1
                    several = d[head] != d[tail]
                once = h[head]
                out = list(_by_bucket(once, buckets))
                yield _table(["bucket", "batch", "hashes", "several"], [
                    [o[0] for o in out], [key] * len(out), [_short(once[a:z]) for _, a, z in out],
                    [np.packbits(several[a:z]).tobytes() for _, a, z in out]],
                    [pa.int64(), pa.binary(), pa.binary(), pa.binary()])
    return run


def _partition(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of a partition by bucket (rows are sorted by it)."""
    held, rows = None, []
    for part in _freed(batches):
        for row in zip(*(c.to_pylist() for c in part.columns)):
            if row[0] != held and rows:
                yield held, rows
                rows = []
            held = row[0]
            rows.append(row[1:])
    if rows:
        yield held, rows


def find_repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """bucket, batch, hashes, several -> batch, hashes that other documents have, too."""
    for _, rows in _partition(batches):
        hashes = [_long(r[1]) for r in rows]
        sizes = np.array([len(h) for h in hashes])
        h = np.concatenate(hashes)
        several = np.concatenate([np.unpackbits(np.frombuffer(r[2], np.uint8), count=n).astype(bool)
                                  for r, n in zip(rows, sizes)])
        order = np.argsort(h, kind="stable")
        sorted_ = h[order]
        head = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
        size = np.diff(np.append(head, len(h)))
        hit = (size > 1) | np.logical_or.reduceat(several[order], head)
        keep = np.zeros(len(h), bool)
        keep[order] = np.repeat(hit, size)
        cut = np.cumsum(sizes) - sizes
        found = [(r[0], h[c:c + n][keep[c:c + n]]) for r, c, n in zip(rows, cut, sizes)]
        found = [(k, x) for k, x in found if len(x)]
        yield _table(["batch", "hashes"], [[k for k, _ in found], [_short(x) for _, x in found]],
                     [pa.binary(), pa.binary()])


def _repeated(parts: list[bytes] | None) -> np.ndarray:
    return _long(b"".join(parts)) if parts else np.zeros(0, np.uint64)


def deal_fragments(length: int, buckets: int):
    """batch, its repeated hashes -> bucket, batch, fragments (zstd)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        for rows in _freed(batches):
            for key, ids, lengths, text, gaps, hashes in zip(*(c.to_pylist() for c in rows.columns)):
                f = Batch(ids, lengths, text, gaps).fragments(_repeated(hashes), length)
                out = list(_by_bucket(f.key, buckets))
                yield _table(["bucket", "batch", "windows", "anchors", "least", "rows"], [
                    [o[0] for o in out], [key] * len(out),
                    [f.windows[a:z].astype(np.uint8).tobytes() for _, a, z in out],
                    [f.anchor[a:z].astype(np.uint8).tobytes() for _, a, z in out],
                    [f.least[a:z].tobytes() for _, a, z in out],
                    [press.compress(f.rows[a:z].tobytes()) for _, a, z in out]],
                    [pa.int64(), *[pa.binary()] * 5])
    return run


def order_windows(length: int):
    """Fragments of a bucket -> bucket, batch, a bit mask per fragment (bit i: window i repeats)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        full = 2 * length - GRAM
        for bucket, rows in _partition(batches):
            windows = np.concatenate([np.frombuffer(r[1], np.uint8) for r in rows]).astype(np.int64)
            anchor = np.concatenate([np.frombuffer(r[2], np.uint8) for r in rows]).astype(np.int64)
            least = np.concatenate([np.frombuffer(r[3], np.int64) for r in rows])
            raw = np.frombuffer(b"".join(zstandard.decompress(r[4]) for r in rows),
                                np.uint8).reshape(-1, full)
            tagged = np.concatenate([windows[:, None].astype(np.uint8), raw], 1)
            _, one, of = np.unique(tagged.view(f"V{full + 1}").ravel(),
                                   return_index=True, return_inverse=True)
            del tagged
            first = np.full(len(one), np.iinfo(np.int64).max)
            np.minimum.at(first, of, least)
            data, count, anchor = raw[one].ravel(), windows[one], anchor[one]
            del raw
            masks = np.zeros(len(windows), np.uint64)
            # equal windows have their anchor at the same place: one order per place
            for place in range(length - GRAM + 1):
                start = anchor - place                 # of the window in its fragment
                own = np.flatnonzero((start >= 0) & (start < count))
                if not len(own):
                    continue
                order, group = deep_shallow(data, own * full + start[own], length, SHALLOW)
                head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
                lowest = np.minimum.reduceat(first[own[order]], head)
                doc = np.full(len(one), np.iinfo(np.int64).max)  # least doc_id of the window
                doc[own[order]] = np.repeat(lowest, np.diff(np.append(head, len(group))))
                # bits by occurrence: a smaller doc_id holds the window
                gone = np.flatnonzero(doc[of] < least)
                masks[gone] |= _U(1) << start[of[gone]].astype(np.uint64)
            cut = np.cumsum([len(r[1]) for r in rows])
            yield _table(["bucket", "batch", "masks"], [
                [bucket] * len(rows), [r[0] for r in rows],
                [masks[c - len(r[1]):c].tobytes() for r, c in zip(rows, cut)]],
                [pa.int64(), pa.binary(), pa.binary()])
    return run


def mark(length: int):
    """batch, repeated hashes, masks -> doc_id, n_bytes, n_removed, spans, kept_sha256."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for _, ids, lengths, text, gaps, hashes, masks in zip(
                    *(c.to_pylist() for c in rows.columns)):
                b = Batch(ids, lengths, text, gaps)
                f = b.fragments(_repeated(hashes), length)
                mask = np.frombuffer(b"".join(m["masks"] for m in sorted(
                    masks or [], key=lambda m: m["bucket"])), np.uint64)
                delta = np.zeros(len(b.data) + 1, np.int32)
                # an equal fragment of a smaller doc_id in this batch repeats every window
                whole = b.ids[f.doc] > f.least[f.of] if len(f.of) else np.zeros(0, bool)
                np.add.at(delta, f.first[whole], 1)
                np.add.at(delta, f.first[whole] + f.count[whole] + length - 1, -1)
                part = np.flatnonzero(~whole)
                bits = mask[f.of[part]] if len(part) else np.zeros(0, np.uint64)
                for i in range(length - GRAM + 1):
                    hit = part[(bits >> _U(i)) & _U(1) == 1]
                    np.add.at(delta, f.first[hit] + i, 1)
                    np.add.at(delta, f.first[hit] + i + length, -1)
                gone = np.cumsum(delta[:-1]) > 0
                yield _results(b, gone)
    return run


def _results(b: Batch, gone: np.ndarray) -> pa.RecordBatch:
    starts = b.ends - b.lengths
    removed, spans, digests = [], [], []
    total = np.concatenate([[0], np.cumsum(gone)])
    raw = b.data.tobytes()
    for s, e in zip(starts.tolist(), b.ends.tolist()):
        n = int(total[e] - total[s])
        removed.append(n)
        if not n:
            spans.append([])
            digests.append(hashlib.sha256(raw[s:e]).hexdigest())
            continue
        edge = np.flatnonzero(np.diff(gone[s:e].astype(np.int8), prepend=0, append=0))
        spans.append([{"from": a, "to": z} for a, z in edge.reshape(-1, 2).tolist()])
        digests.append(hashlib.sha256(b.data[s:e][~gone[s:e]].tobytes()).hexdigest())
    span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
    return _table(["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256"], [
        [None if d == _NO_ID else d for d in b.ids.tolist()], b.lengths.tolist(), removed, spans,
        digests], [pa.int64(), pa.int64(), pa.int64(), span, pa.string()])


def suffix_dedup(docs: DataFrame, length: int = 50, batch_bytes: int = 1 << 19) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_bytes, n_removed, spans, kept_sha256.

    ``length`` may be 24 to 79 bytes (a fragment's windows fit a 64-bit mask).
    """
    if not 24 <= length <= 79:
        raise ValueError("length must be 24 to 79")
    spark = docs.sparkSession
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blob = "ids binary, lengths binary, text binary, gaps binary"
    batches = store(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                F.col("text").cast("binary").alias("text"))
                    .mapInArrow(pack(length, batch_bytes), f"batch binary, {blob}"), "op9-batches")
    n = batches.count()
    parts = max(spread, n // 64)  # a part gets the anchors of about 64 batches
    buckets = 8 * parts  # a task holds one bucket at a time
    dealt = batches.mapInArrow(deal_hashes(buckets),
                               "bucket long, batch binary, hashes binary, several binary")
    repeated = store(dealt.repartition(parts, "bucket").sortWithinPartitions("bucket")
                     .mapInArrow(find_repeated, "batch binary, hashes binary")
                     .groupBy("batch").agg(F.collect_list("hashes").alias("hashes")), "op9-repeated")
    cut = batches.join(repeated, "batch").mapInArrow(
        deal_fragments(length, buckets),
        "bucket long, batch binary, windows binary, anchors binary, least binary, rows binary")
    masks = store(cut.repartition(parts, "bucket").sortWithinPartitions("bucket", "batch")
                  .mapInArrow(order_windows(length), "bucket long, batch binary, masks binary")
                  .groupBy("batch").agg(F.collect_list(F.struct("bucket", "masks")).alias("masks")),
                  "op9-masks")
    return (batches.join(repeated, "batch", "left").join(masks, "batch", "left")
            .mapInArrow(mark(length), "doc_id long, n_bytes long, n_removed long, "
                        "spans array<struct<from: long, to: long>>, kept_sha256 string"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 50-byte strings of documents with smaller ids."""
    ready(spark)
    return suffix_dedup(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256")
