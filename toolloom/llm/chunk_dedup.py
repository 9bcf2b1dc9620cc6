"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes: shifted by one bit and the byte's number added, in 16 bits, so it depends on the last 16 bytes
only. A cut stands where it is low, one byte in CUT on average, never inside a character. From every cut on runs a
chunk, to the first cut at least LEAST_BYTES further on. Where chunks begin and end depends on the text around them only, so an
insertion shifts them but doesn't change those behind it.

Chunks are compared by digest over all documents. Chunks that several documents have are joined to spans where they overlap or
touch; spans of at least least_words words count as repeated. Of each chunk one document stays the owner: that of the
lowest part, and in it the lowest id. Spans of owned chunks stay, other spans are cut out of the text.

Documents are dealt over parts by hash. A part sends the digest of each of its chunks once, however many of its documents have it,
and gets one byte back for each: so a passage that a third of all documents share costs as much as any other.

Null and empty texts have no chunks. Texts are taken whole. Rows with equal id and text are one document; null ids are allowed, and rows with
a null id and equal text are one document too. A chunk that only one document has, even twice, is not repeated. An empty table gives an empty
result. Columns other than the named ones are not looked at. Digests are told apart by 48 bits besides their bucket.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolloom.llm.common import shuffle_partitions, stored
from toolloom.llm.exchange import dealt, narrow, split_keys, unpacked, wide
from toolloom.llm.words import Words, chunks, mix, span_hashes

CUT = 16
LEAST_BYTES = 96
LEAST_WORDS = 25
PART_CHARS = 6_000_000
PIECE_BYTES = 500_000  # of a part's texts at once: hashing them takes some 50 bytes a byte
GEAR = 16
_GEAR = (mix(np.arange(501, 501 + 256, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin: at the begin of each text and behind each byte where the gear hash is low."""
    n = len(data)
    h = _GEAR[data]
    reach = 1
    while reach < GEAR:  # sums over 1, 2, 4 .. bytes
        older = np.zeros(n, np.uint16)
        older[reach:] = h[: n - reach] << np.uint16(reach)
        h = h + older
        reach *= 2
    low = h < (1 << 16) // CUT
    place = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))
    low &= place >= GEAR - 1
    at = np.flatnonzero(low) + 1
    at = at[at < n]
    at = at[(data[at] & 0xC0) != 0x80]
    begins = offsets[:-1][np.diff(offsets) > 0]
    return np.union1d(at, begins)


class Chunks:
    """start, end (bytes), doc and digest of the chunks of some texts."""

    def __init__(self, texts: pa.Array):
        self.words = words = Words(texts)
        data, offsets = words.data, words.offsets
        at = cuts(data, offsets)
        doc = np.searchsorted(offsets, at, "right") - 1
        ends = np.append(at, len(data))  # the first cut or text end that is far enough
        end = ends[np.minimum(np.searchsorted(ends, at + LEAST_BYTES), len(ends) - 1)]
        end = np.minimum(end, offsets[doc + 1])
        whole = end - at >= LEAST_BYTES
        self.start, self.end, self.doc = at[whole], end[whole], doc[whole]
        self.digest = span_hashes(data, self.start, self.end)


_SENT = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("several", pa.binary())])
_CODES = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("codes", pa.binary())])
_SPANS = "doc_id long, text string, kept_text string, spans array<struct<start: long, end: long, n_words: long, stays: boolean>>"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("n_words", pa.int64()), ("stays", pa.bool_())]))
_FOUND = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("kept_text", pa.string()), ("spans", _SPAN)])


def _unique(table: pa.Table) -> pa.RecordBatch:
    """Of one part: each document once, by id (null first) and text hash."""
    ids = np.array([(-(1 << 63) if x is None else x) for x in table.column("doc_id").to_pylist()], np.int64)
    order = np.lexsort((table.column("text_hash").to_numpy(), ids))
    i, h = ids[order], table.column("text_hash").to_numpy()[order]
    first = np.ones(len(order), bool)
    first[1:] = (i[1:] != i[:-1]) | (h[1:] != h[:-1])
    chosen = table.select(["doc_id", "text"]).take(pa.array(order[first])).combine_chunks()
    return pa.RecordBatch.from_arrays([chosen.column("doc_id").chunk(0), unpacked(chosen.column("text"))], ["doc_id", "text"])


def _pieces(batch: pa.RecordBatch):
    """(first document of the piece, texts, chunks) of the part's texts, a piece at a time."""
    at = 0
    for piece in chunks(iter([batch]), PIECE_BYTES):
        yield at, piece, Chunks(piece.column("text"))
        at += piece.num_rows


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct digests of the part, the first document that has each, and whether several have it."""
    found = [(c.digest, c.doc + at) for at, _, c in _pieces(batch)]
    digest, doc = (np.concatenate(x) for x in zip(*found))
    keys, which = np.unique(digest, return_inverse=True)
    low, high = np.full(len(keys), np.iinfo(np.int64).max), np.full(len(keys), -1)
    np.minimum.at(low, which, doc)
    np.maximum.at(high, which, doc)
    return keys, low, high > low


def _send(buckets: int):
    def send(table: pa.Table) -> pa.Table:
        keys, _, several = _keys(_unique(table))
        part = table.column("part")[0].as_py()
        rows = [(part, b, narrow(keys[m]), several[m].astype("u1").tobytes()) for b, (m,) in split_keys([keys], buckets)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 4, _SENT)], schema=_SENT)

    return send


def _judge(table: pa.Table) -> pa.Table:
    """Of one bucket: for each part and digest 0 (no other document has it), 1 (the part owns it) or 2 (another part does)."""
    parts = table.column("part").to_numpy()
    order = np.argsort(parts, kind="stable")
    keys = [wide(table.column("keys")[int(i)].as_py()) for i in order]
    several = np.concatenate([np.frombuffer(table.column("several")[int(i)].as_py(), "u1") for i in order])
    sizes = [len(k) for k in keys]
    names, first, which, count = np.unique(np.concatenate(keys), return_index=True, return_inverse=True, return_counts=True)
    repeated = (count > 1) | (np.bincount(which, weights=several) > 0)
    owner = np.zeros(len(which), bool)
    owner[first] = True  # the lowest part comes first
    codes = np.where(repeated[which], np.where(owner, 1, 2), 0).astype("u1")
    packed = [x.tobytes() for x in np.split(codes, np.cumsum(sizes)[:-1])]
    return pa.Table.from_arrays([pa.array(parts[order], pa.int32()), table.column("bucket").combine_chunks(), pa.array(packed, pa.binary())], schema=_CODES)


def _joined(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Spans of sorted intervals that overlap or touch."""
    if not len(start):
        return []
    top = np.maximum.accumulate(end)
    new = np.concatenate(([True], start[1:] > top[:-1]))
    begins = np.flatnonzero(new)
    return list(zip(start[begins].tolist(), top[np.append(begins[1:] - 1, len(end) - 1)].tolist()))


def _cut(buckets: int, least_words: int):
    def cut(docs: pa.Table, codes: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _FOUND.empty_table()
        batch = _unique(docs)
        keys, owner, _ = _keys(batch)
        code = np.zeros(len(keys), np.uint8)
        sent = dict(zip(codes.column("bucket").to_pylist(), codes.column("codes").to_pylist()))
        for b, (m,) in split_keys([keys], buckets):
            code[m] = np.frombuffer(sent[b], "u1")
        out = []
        for at, piece, c in _pieces(batch):
            which = np.searchsorted(keys, c.digest)
            of = code[which]
            stays = (of == 1) & (owner[which] == c.doc + at)
            bounds = np.searchsorted(c.doc, np.arange(piece.num_rows + 1))
            for i, (doc_id, text) in enumerate(zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist())):
                a, b, spans, rest = bounds[i], bounds[i + 1], [], text
                if of[a:b].any():
                    begin = int(c.words.offsets[i])
                    for keep in (True, False):
                        mine = np.flatnonzero((of[a:b] > 0) & (stays[a:b] == keep)) + a
                        for x, y in _joined(c.start[mine], c.end[mine]):
                            n = int(np.searchsorted(c.words.end, y, "right") - np.searchsorted(c.words.start, x))
                            if n >= least_words:
                                spans.append((x - begin, y - begin, n, keep))
                    if spans:
                        raw = text.encode()
                        char = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
                        char = np.concatenate(([0], char))
                        left, pieces = 0, []
                        for x, y, _, keep in sorted(spans):
                            if not keep:
                                pieces.append(raw[left:x])
                                left = max(left, y)
                        rest = b"".join([*pieces, raw[left:]]).decode()
                        spans = [{"start": int(char[x]), "end": int(char[y]), "n_words": n, "stays": k} for x, y, n, k in sorted(spans)]
                out.append((doc_id, text, rest, spans))
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _FOUND)], schema=_FOUND)

    return cut


def dedup(docs: DataFrame, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, kept_text and spans (start, end in code points, n_words, stays) of every document."""
    spark = docs.sparkSession
    named = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    chars = named.agg(F.coalesce(F.sum(F.length("text") + 1), F.lit(0)).alias("n")).first().n
    parts = max(shuffle_partitions(spark), math.ceil(chars / PART_CHARS))
    texts = dealt(named.withColumn("text_hash", F.xxhash64("text")), parts)
    sent = texts.groupBy("part").applyInArrow(_send(parts), "part int, bucket int, keys binary, several binary")
    codes = stored(sent.groupBy("bucket").applyInArrow(_judge, "part int, bucket int, codes binary"))
    return texts.groupBy("part").cogroup(codes.groupBy("part")).applyInArrow(_cut(parts, least_words), _SPANS)
