"""Texts dealt over parts, and sorted 64-bit keys over buckets and back: a part gets answers in the order in which it asked."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dealt(docs: DataFrame, parts: int) -> DataFrame:
    """docs (doc_id, text and others) with part, by id and text, and the text packed, as two shuffles carry it."""
    named = docs.withColumn("part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int"))
    fields = [T.StructField("text", T.BinaryType()) if f.name == "text" else f for f in named.schema]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [None if x is None else packer.compress(x) for x in batch.column("text").cast(pa.binary()).to_pylist()]
            columns = [pa.array(texts, pa.binary()) if n == "text" else c for n, c in zip(batch.schema.names, batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return named.mapInArrow(pack, T.StructType(fields))


def unpacked(texts: pa.ChunkedArray) -> pa.Array:
    opener = zstandard.ZstdDecompressor()
    return pa.array([None if x is None else opener.decompress(x).decode() for x in texts.to_pylist()], pa.string())


def narrow(keys: np.ndarray, size: int = 6) -> bytes:
    """The upper 8 * size bits of each key; with the bucket, which depends on all bits, they tell keys apart."""
    raw = keys.astype(">u8").view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(raw[:, :size].T).tobytes()  # byte by byte: the first ones of sorted keys repeat


def wide(raw: bytes, size: int = 6) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(size, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, 8 - size :] = planes.T
    return out.reshape(-1).view(">u8").astype(np.uint64)


def short(counts: np.ndarray) -> bytes:
    """Numbers, of which most are below 255, as bytes; the others follow."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return small.tobytes() + counts[counts >= 255].astype("<i8").tobytes()


def long(raw: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(raw, "<i8", offset=n)
    return out


def split_keys(keys: Sequence[np.ndarray], buckets: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For each bucket that is used: which of the sorted keys of each array belong to it, in order.

    Steps, messages and memory grow with the keys alone, however many buckets there are.
    """
    homes = [(k % np.uint64(buckets)).astype(np.int64) for k in keys]
    orders = [np.argsort(h, kind="stable") for h in homes]
    homes = [h[o] for h, o in zip(homes, orders)]
    used = np.unique(np.concatenate([h[:1] for h in homes] + [h[1:][h[1:] != h[:-1]] for h in homes]))
    bounds = [(np.searchsorted(h, used, "left").tolist(), np.searchsorted(h, used, "right").tolist()) for h in homes]
    for i, b in enumerate(used.tolist()):
        yield b, [o[left[i] : right[i]] for o, (left, right) in zip(orders, bounds)]
