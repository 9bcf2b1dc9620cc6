"""Token ids in seekable binary files.

One file holds the documents of one range of ids, in ascending order. It ends at FILE_IDS token ids or FILE_DOCS documents, and the
next one begins, so that files, their indexes and the readers' tasks keep their size whatever the table's. A file holds:

    data frames     independent zstandard frames of whole documents, ids as little-endian unsigned 32-bit integers
    index           skippable frame 0x184D2A50: number of documents, their ids, null marks, numbers of token ids
    seek table      skippable frame 0x184D2A5E of the seekable format: for each frame compressed size, plain size
                    and CRC-32 of the plain bytes; then number of frames, a descriptor byte, 0x8F92EAB1

A reader takes the tail, then decompresses only the frames that hold the documents it wants, and checks each.

Null and empty texts give the end id alone. Documents with a null id come first and keep it; repeated ids stay
next to each other, in the order of a hash of their texts. An empty table gives no documents. Other columns are not looked at. A document
is never divided between frames, so memory grows with the longest document only.
"""

from __future__ import annotations

import json
import os
import string
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from toolloom.llm.common import renamed, scratch_dir, shuffle_partitions, stored
from toolloom.llm.words import chunks

FRAME_IDS = 1 << 16
FILE_IDS = 1 << 27
FILE_DOCS = 1 << 20
WORDS_KEPT = 200_000
_PUNCTUATION = string.punctuation.encode()
_INDEX, _SEEK, _SEEK_END = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_MANIFEST = "shard int, piece int, file string, n_docs long, n_ids long"
_FILE = pa.schema([("shard", pa.int32()), ("piece", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else one from U+0100 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in prints)
    spare = {b: chr(0x100 + i) for i, b in enumerate(others)}
    return [spare.get(b, chr(b)) for b in range(256)]


class WordEncoder:
    """Ids of a text as the ids of its words in a row; words are remembered, in two generations of at most keep words.

    Right for tokenizers that never join across white space, such as those that drop it. For lower-casing byte-level
    vocabularies that split at the bounds of letter runs, words of Latin letters go to the model at once, and the
    punctuation behind them on its own.
    """

    def __init__(self, tokenizer: str, keep: int = WORDS_KEPT):
        self.tokenizer, self.keep = Tokenizer.from_str(tokenizer), keep
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        parts = json.loads(tokenizer)
        steps = lambda x: [y["type"] for y in (x or {}).get("normalizers", (x or {}).get("pretokenizers", []))]
        self.plain = steps(parts["normalizer"]) == ["NFC", "Replace", "Lowercase"] and steps(parts["pre_tokenizer"]) == ["Split", "ByteLevel"]
        self.letters = _byte_letters()

    def _word(self, word: bytes) -> bytes | None:
        """The ids of a word of Latin letters and punctuation behind it; None for any other."""
        base = word.rstrip(_PUNCTUATION)
        if base.isalpha():
            text = base.decode().lower()
        else:
            text = base.decode()
            if not text.isalpha() or max(text) > "\u024f" or "\u0130" in text:
                return None
            text = "".join([self.letters[b] for b in text.lower().encode()])
        ids = array("I", [t.id for t in self.tokenizer.model.tokenize(text)]).tobytes()
        if len(base) < len(word):
            end = word[len(base) :]
            ids += self.known.get(end) or self._learn([end])[end]
        return ids

    def _learn(self, new: list[bytes]) -> dict[bytes, bytes]:
        found = {}
        if self.plain:
            found = {w: ids for w in new if (ids := self._word(w)) is not None}
            new = [w for w in new if w not in found]
        for a in range(0, len(new), 1000):
            part = new[a : a + 1000]
            encoded = self.tokenizer.encode_batch([w.decode() for w in part], add_special_tokens=False)
            found.update((w, np.array(e.ids, np.uint32).tobytes()) for w, e in zip(part, encoded))
        self.known.update(found)
        return found

    def __call__(self, text: bytes) -> np.ndarray:
        words = (text if b"<|" in text else text.lower() if self.plain else text).split()  # at the six ASCII characters
        known = self.known
        found = list(map(known.get, words))
        try:
            return np.frombuffer(b"".join(found), np.uint32)
        except TypeError:  # None: words that are new
            unknown = {w for w, ids in zip(words, found) if ids is None}
        if len(known) + 2 * len(unknown) > self.keep:
            self.older, self.known = known, (known := {})
            unknown = set(words)
        older, new = self.older, []
        for w in unknown:
            if (ids := older.get(w)) is None:
                new.append(w)
            else:
                known[w] = ids
        self._learn(new)
        return np.frombuffer(b"".join([known[w] if ids is None else ids for w, ids in zip(words, found)]), np.uint32)


_encoders: dict[int, WordEncoder] = {}


def _encoder(tokenizer: str) -> WordEncoder:
    """The encoder of this Python worker, kept from task to task."""
    key = zlib.crc32(tokenizer.encode())
    if key not in _encoders:
        _encoders.clear()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        _encoders[key] = WordEncoder(tokenizer)
    return _encoders[key]


class ShardWriter:
    def __init__(self, out):
        self.out, self.waiting, self.n_waiting, self.n_ids = out, [], 0, 0
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.counts: list[int] = []
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.n_waiting and self.n_waiting + len(ids) > FRAME_IDS:
            self._frame()
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        self.ids.append(doc_id)
        self.counts.append(len(ids))

    def _frame(self) -> None:
        plain = np.concatenate(self.waiting).astype("<u4").tobytes()
        packed = self.compressor.compress(plain)
        self.out.write(packed)
        self.frames.append((len(packed), len(plain), zlib.crc32(plain)))
        self.waiting, self.n_waiting = [], 0

    def close(self) -> None:
        if self.n_waiting:
            self._frame()
        n = len(self.ids)
        index = struct.pack("<Q", n) + np.array([0 if x is None else x for x in self.ids], "<i8").tobytes()
        index += np.array([x is None for x in self.ids], "u1").tobytes() + np.array(self.counts, "<i8").tobytes()
        self.out.write(struct.pack("<II", _INDEX, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0x80, _SEEK_END)
        self.out.write(struct.pack("<II", _SEEK, len(table)) + table)


def read_shard(source, wanted: set[int] | None = None) -> Iterator[tuple[int | None, np.ndarray, int]]:
    """(doc id, token ids, ids of the file before it) in file order; of the wanted ids only, if given."""
    size = source.size()
    source.seek(size - 9)
    n_frames, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != _SEEK_END:
        raise ValueError("no seek table at the end of the file")
    begin = size - 9 - 12 * n_frames
    source.seek(begin)
    frames = [struct.unpack("<III", source.read(12)) for _ in range(n_frames)]
    at = sum(f[0] for f in frames)
    source.seek(at)
    magic, length = struct.unpack("<II", source.read(8))
    if magic != _INDEX:
        raise ValueError("no document index behind the frames")
    index = source.read(length)
    (n,) = struct.unpack_from("<Q", index)
    ids = np.frombuffer(index, "<i8", n, 8)
    null = np.frombuffer(index, "u1", n, 8 + 8 * n)
    counts = np.frombuffer(index, "<i8", n, 8 + 9 * n)
    begins = np.concatenate(([0], np.cumsum(counts)))
    frame_at = np.concatenate(([0], np.cumsum([f[0] for f in frames], dtype=np.int64)))
    frame_ids = np.concatenate(([0], np.cumsum([f[1] // 4 for f in frames], dtype=np.int64)))
    opened, plain = -1, np.zeros(0, "<u4")
    for i in range(n):
        doc = None if null[i] else int(ids[i])
        if wanted is not None and doc not in wanted:
            continue
        k = int(np.searchsorted(frame_ids, begins[i], "right")) - 1
        if k != opened:
            source.seek(int(frame_at[k]))
            raw = zstandard.ZstdDecompressor().decompress(source.read(frames[k][0]))
            if len(raw) != frames[k][1] or zlib.crc32(raw) != frames[k][2]:
                raise ValueError(f"frame {k} doesn't match its checksum")
            opened, plain = k, np.frombuffer(raw, "<u4")
        a = int(begins[i] - frame_ids[k])
        yield doc, plain[a : a + int(counts[i])], int(begins[i])


def write_tokens(docs: DataFrame, tokenizer_file: str, end_id: int = 1, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS, file_docs: int = FILE_DOCS) -> DataFrame:
    """Encodes the texts, ends each with end_id and writes them; returns shard, piece, file, n_docs, n_ids of each file.

    The documents are ranged by id over spark.sql.shuffle.partitions tasks, each of which writes files of at most file_docs
    documents and file_ids token ids (a longer document has a file of its own). A file is written under a name of its own
    and then moved into place, so a task that runs again replaces it by the same content.
    """
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark)
    tokenizer = spark.sparkContext.broadcast(Path(tokenizer_file).read_text())  # the vocabulary: of fixed size

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, piece, encode, writer = TaskContext.get().partitionId(), 0, None, None
        files, root = pafs.FileSystem.from_uri(folder)

        def finished() -> pa.RecordBatch:
            writer.close()
            out.close()
            name = f"shard-{shard:06d}-{piece:06d}.bin"
            files.move(own, f"{root}/{name}")
            row = {"shard": [shard], "piece": [piece], "file": [f"{folder}/{name}"], "n_docs": [len(writer.ids)], "n_ids": [writer.n_ids]}
            return pa.RecordBatch.from_pydict(row, schema=_FILE)

        for batch in chunks(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                encode = encode or _encoder(tokenizer.value)
                ids = np.append(encode(text.as_py() or b""), np.uint32(end_id))
                if writer is not None and (writer.n_ids + len(ids) > file_ids or len(writer.ids) >= file_docs):
                    yield finished()
                    writer, piece = None, piece + 1
                if writer is None:
                    files.create_dir(root, recursive=True)
                    own = f"{root}/{uuid.uuid4().hex}.part"
                    out = files.open_output_stream(own)
                    writer = ShardWriter(out)
                writer.add(doc_id, ids)
        if writer is not None:
            yield finished()

    ranged = renamed(docs, doc_id=id_col, text=text_col).repartitionByRange(shuffle_partitions(spark), "doc_id", F.xxhash64("text"))
    ordered = ranged.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return stored(ordered.mapInArrow(write, _MANIFEST))


def read_tokens(manifest: DataFrame, wanted: list[int] | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids, from the files.

    wanted is a list of document ids that the caller states; frames without any of them stay packed.
    """
    spark = manifest.sparkSession
    shards = manifest.select("file", "n_ids").orderBy("shard", "piece").collect()  # one row for each file
    before, rows = 0, []
    for r in shards:
        rows.append((r.file, before))
        before += r.n_ids
    chosen = set(wanted) if wanted is not None else None
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    schema = pa.schema([(n, pa.int64()) for n in names] + [("ids", pa.list_(pa.int64()))] * with_ids)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, path = pafs.FileSystem.from_uri(row["file"])
                with files.open_input_file(path) as source:
                    found: list[tuple] = []
                    size = 0
                    for doc, ids, at in read_shard(source, chosen):
                        found.append((doc, row["before"] + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), ids))
                        size += len(ids)
                        if size > 4 * FRAME_IDS:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*found), schema)], schema=schema)
                            found, size = [], 0
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*found), schema)], schema=schema)

    listed = spark.createDataFrame(rows, "file string, before long").repartition(max(1, len(rows)))
    return listed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)
