"""Two tokenizers' tokens of the same texts, aligned by interval coalescing, with corpus-wide counts of the linked ids.

Both tokenizers cut the bytes of " " + text. Per block of texts all tokens of A and B are lexsorted by start; the running
maximum of their ends tells where a group ends: where the next start reaches it. Inside the groups the overlapping pairs
are expanded, each at the byte where the later of its two tokens starts; pairs whose tokens also end together are links.

A byte-level BPE whose merges are numbered in order is run by its ranks (same ids, a quarter of the time), any other by the
tokenizers library. Texts are handled in parts of PART_BYTES; a part names each of its linked id pairs once, with its
count, whatever its documents repeat, so the counts' join carries a frequent pair once a part and not once a text.

Null and empty texts, and texts whose tokens of A or B joined are not " " + text (B writes U+2581 as a space; special
tokens' strings are plain text) have no tokens: zeros, and an empty digest. A text is never cut: a part of one very long
text is as large as that text. Ties in an id's highest count are all best. Null and repeated ids are rows like any other,
equal rows give equal results, an empty table gives an empty one. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from toolloom.llm.common import renamed, stored
from toolloom.llm.exchange import long, short
from toolloom.llm.token_files import _byte_letters
from toolloom.llm.words import chunks

PART_BYTES = 8_000_000
BLOCK_BYTES = 1_000_000
# How byte-level BPE cuts a text into words, as published with the first such vocabulary.
_WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NUMBERS = "n_a long, n_b long, n_groups long, n_links long"


class ByteSide:
    """Ids of " " + text in a byte-level BPE of the tokenizers library, and the bytes of each id."""

    def __init__(self, file: str):
        parts = json.loads(file)
        model, before = parts["model"], parts["pre_tokenizer"] or {}
        letters = {c: b for b, c in enumerate(_byte_letters())}
        self.bytes = [b""] * (1 + max(model["vocab"].values()))
        for token, i in model["vocab"].items():
            self.bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        ranked = all(model["vocab"].get(m) == 256 + i for i, m in enumerate(merges)) and all(len(x) == 1 for x in self.bytes[:256])
        plain = parts["normalizer"] is None and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if ranked and plain and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space"):
            ranks = {x: i for i, x in enumerate(self.bytes[: 256 + len(merges)])}
            known = tiktoken.Encoding("ranks", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda texts: [known.encode_ordinary(" " + t) for t in texts]
        else:
            library = Tokenizer.from_str(file)
            library.encode_special_tokens = True
            self.encode = lambda texts: [e.ids for e in library.encode_batch([" " + t for t in texts], add_special_tokens=False)]


class PieceSide:
    """Ids of a text in a sentencepiece model, which adds the space itself, and the bytes of each id."""

    def __init__(self, model: bytes):
        pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        name = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(name)]
        self.encode = lambda texts: pieces.encode(texts, num_threads=1)


def coalesce(starts: tuple[np.ndarray, np.ndarray], ends: tuple[np.ndarray, np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(groups of A's and of B's tokens, A's token and B's token of every overlapping pair).

    Tokens of one side ascend and don't overlap each other; none is empty.
    """
    n = [len(x) for x in starts]
    start, end = np.concatenate(starts), np.concatenate(ends)
    side = np.repeat(np.array([0, 1], np.int8), n)
    order = np.lexsort((side, start))
    sorted_start = start[order]
    reach = np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = sorted_start[1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    # At each start the overlapping pair is the latest token of either side, if both still last.
    is_a = order < n[0]
    latest_a = np.maximum.accumulate(np.where(is_a, order, -1))
    latest_b = np.maximum.accumulate(np.where(is_a, -1, order - n[0]))
    closing = np.ones(len(order), bool)
    closing[:-1] = sorted_start[1:] != sorted_start[:-1]
    at = np.flatnonzero(closing & (latest_a >= 0) & (latest_b >= 0))
    a, b = latest_a[at], latest_b[at]
    both = (ends[0][a] > sorted_start[at]) & (ends[1][b] > sorted_start[at])
    return [group[: n[0]], group[n[0] :]], a[both], b[both]


class Aligner:
    def __init__(self, a_file: str, b_model: bytes):
        self.a, self.b = ByteSide(a_file), PieceSide(b_model)
        self.sizes = [np.array([len(x) for x in side.bytes], np.int64) for side in (self.a, self.b)]
        n = [len(side.bytes) for side in (self.a, self.b)]
        self.shift = 2 * n[0]
        # what is written for a token: its id and the sign behind it, which differs for the last of its side in a group
        self.written = [b"%d%s" % (i, sign) for k, last in ((n[0], b"|"), (n[1], b";")) for sign in (b",", last) for i in range(k)]

    def _ids(self, texts: list[str]) -> list[list[list[int]]]:
        """Both sides' ids of each text; none on either side where they don't give back the text."""
        found = [side.encode(texts) for side in (self.a, self.b)]
        for i, t in enumerate(texts):
            line = b" " + t.encode()
            if not t or any(b"".join(map(side.bytes.__getitem__, ids[i])) != line for side, ids in zip((self.a, self.b), found)):
                found[0][i], found[1][i] = [], []
        return found

    def __call__(self, texts: list[str]) -> tuple[list[np.ndarray], list[bytes], np.ndarray, np.ndarray]:
        """(n_a, n_b, n_groups, n_links of each text; its groups written out; text and id pair of every link)."""
        ids = self._ids(texts)
        counts = [np.array([len(x) for x in side], np.int64) for side in ids]
        flat = [np.fromiter((i for x in side for i in x), np.int64, int(c.sum())) for side, c in zip(ids, counts)]
        # both sides cover the same bytes of the same texts, so one line of bytes serves for all
        ends = [np.cumsum(size[x]) for size, x in zip(self.sizes, flat)]
        starts = [e - size[x] for size, x, e in zip(self.sizes, flat, ends)]
        group, a, b = coalesce(tuple(starts), tuple(ends))
        docs = [np.repeat(np.arange(len(texts)), c) for c in counts]
        together = ends[0][a] == ends[1][b]
        a, b = a[together], b[together]
        link_doc, pair = docs[0][a], flat[0][a] << 32 | flat[1][b]
        n_in = [np.bincount(g, minlength=1 + max((int(x[-1]) for x in group if len(x)), default=-1)) for g in group]
        first_doc = docs[0][np.cumsum(n_in[0]) - 1] if len(docs[0]) else np.zeros(0, np.int64)
        numbers = [*counts, np.bincount(first_doc, minlength=len(texts)), np.bincount(link_doc, minlength=len(texts))]
        return numbers, self._written(flat, group, n_in, counts), link_doc, pair

    def _written(self, flat: list[np.ndarray], group: list[np.ndarray], n_in: list[np.ndarray], counts: list[np.ndarray]) -> list[bytes]:
        """Each text's groups as a1,a2|b1;a3|b2."""
        upto = [np.cumsum(n) for n in n_in]
        codes = np.empty(len(flat[0]) + len(flat[1]), np.int64)
        for k, base in ((0, 0), (1, self.shift)):
            at = np.arange(len(flat[k]))
            others = (upto[1] - n_in[1])[group[0]] if k == 0 else upto[0][group[1]]  # of the other side before it
            last = at == upto[k][group[k]] - 1
            codes[at + others] = base + flat[k] + len(self.sizes[k]) * last
        listed, bounds = codes.tolist(), np.cumsum([0, *(counts[0] + counts[1])]).tolist()
        return [b"".join([self.written[c] for c in listed[i:j]])[:-1] for i, j in zip(bounds, bounds[1:])]


_aligners: dict[int, Aligner] = {}


def _aligner(a_file: str, b_model: bytes) -> Aligner:
    """The aligner of this Python worker, kept from task to task."""
    key = zlib.crc32(b_model, zlib.crc32(a_file.encode()))
    if key not in _aligners:
        _aligners.clear()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        _aligners[key] = Aligner(a_file, b_model)
    return _aligners[key]


class _Part:
    """Documents until they are as many bytes as a part has, then their rows and the part's linked id pairs."""

    def __init__(self, number: int, with_groups: bool):
        self.number, self.with_groups, self.size, self.n = number, with_groups, 0, 0
        self.ids, self.numbers, self.digests, self.groups, self.docs, self.pairs = [], [], [], [], [], []

    def add(self, ids: list, texts: list[str], aligner: Aligner) -> None:
        numbers, written, doc, pair = aligner(texts)
        self.size += sum(map(len, texts))
        self.ids += ids
        self.numbers.append(np.stack(numbers))
        self.digests += [hashlib.sha256(w).hexdigest() if w else "" for w in written]
        self.groups += [w.decode() for w in written] if self.with_groups else []
        # equal links of a text count once from here on
        order = np.lexsort((pair, doc))
        doc, pair = doc[order], pair[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])
        at = np.flatnonzero(new)
        self.docs.append(np.stack([doc[at] + self.n, np.diff(np.append(at, len(doc)))]))
        self.pairs.append(pair[at])
        self.n += len(ids)

    def rows(self, schema: pa.Schema) -> pa.RecordBatch:
        (doc, times), pair = np.concatenate(self.docs, axis=1), np.concatenate(self.pairs)
        known, code = np.unique(pair, return_inverse=True)
        total = np.bincount(code, weights=times, minlength=len(known)).astype(np.int64)
        bounds = np.searchsorted(doc, np.arange(self.n + 1))
        packer = zstandard.ZstdCompressor(level=1)
        packed = [packer.compress(np.diff(code[i:j], prepend=0).astype("<u4").tobytes() + short(times[i:j])) for i, j in zip(bounds, bounds[1:])]
        numbers = np.concatenate(self.numbers, axis=1)
        columns = {
            "doc_id": self.ids, **dict(zip(("n_a", "n_b", "n_groups", "n_links"), numbers)), "groups_sha256": self.digests,
            "groups": self.groups or [None] * self.n, "n_pairs": np.diff(bounds), "packed": packed,
        }
        pairs = {"a": known >> 32, "b": known & 0xFFFFFFFF, "n": total}
        n, m = self.n, len(known)
        arrays = [pa.array(np.full(n + m, self.number), pa.int64())]
        for field in list(schema)[1:]:
            of_docs = pa.array(columns[field.name], field.type) if field.name in columns else pa.nulls(n, field.type)
            of_pairs = pa.array(pairs[field.name], field.type) if field.name in pairs else pa.nulls(m, field.type)
            arrays.append(pa.concat_arrays([of_docs, of_pairs]))
        return pa.RecordBatch.from_arrays(arrays, schema=schema)


def aligned_parts(docs: DataFrame, a_file: str, b_file: str, with_groups: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of documents and rows of linked id pairs (a, b, n), both with the part they belong to; written once."""
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast((Path(a_file).read_text(), Path(b_file).read_bytes()))  # vocabularies: of fixed size
    named = renamed(docs, doc_id=id_col, text=text_col)
    key = named.schema["doc_id"].dataType.simpleString()
    kinds = f"part long, doc_id {key}, {_NUMBERS}, groups_sha256 string, groups string, n_pairs long, packed binary, a long, b long, n long"
    ints = [pa.field(x, pa.int64()) for x in ("n_a", "n_b", "n_groups", "n_links")]
    rest = [("groups_sha256", pa.string()), ("groups", pa.string()), ("n_pairs", pa.int64()), ("packed", pa.binary()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, part, schema = TaskContext.get().partitionId() << 32, None, None
        for block in chunks(batches, BLOCK_BYTES):
            schema = schema or pa.schema([("part", pa.int64()), block.schema.field("doc_id"), *ints, *rest])
            part = part or _Part(number, with_groups)
            part.add(block.column("doc_id").to_pylist(), block.column("text").fill_null("").to_pylist(), _aligner(*files.value))
            if part.size >= PART_BYTES:
                yield part.rows(schema)
                number, part = number + 1, None
        if part is not None:
            yield part.rows(schema)

    return stored(named.mapInArrow(align, kinds))


def pair_counts(parts: DataFrame) -> DataFrame:
    """a, b, count, best: how often the ids are linked over all documents, and whether no other id is linked to b more often.

    A window holds one row for each id of A at most.
    """
    counts = parts.where("a is not null").groupBy("a", "b").agg(F.sum("n").alias("count"))
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def align(parts: DataFrame, counts: DataFrame) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups of each document.

    n_best: links whose id pair is best; count_sum: the counts of its links added up.
    """
    wanted = parts.where("a is not null").select(F.col("part").alias("to"), "a", "b").join(counts, ["a", "b"])
    documents = parts.where("a is null").drop("a", "b", "n")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in documents.schema if f.name not in ("part", "n_pairs", "packed"))

    def answer(documents: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.lexsort([answers.column(c).to_numpy() for c in ("b", "a")])
        count = answers.column("count").to_numpy()[order]
        best = answers.column("best").to_numpy(zero_copy_only=False)[order]
        opener, found = zstandard.ZstdDecompressor(), []
        for packed, n in zip(documents.column("packed").to_pylist(), documents.column("n_pairs").to_pylist()):
            raw = opener.decompress(packed)
            code, times = np.cumsum(np.frombuffer(raw, "<u4", n), dtype=np.int64), long(raw[4 * n :], n)
            found.append((int(times[best[code]].sum()), int((times * count[code]).sum())))
        columns = [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)]
        kept = documents.drop_columns(["part", "n_pairs", "packed"])
        return kept.append_column("n_best", columns[0]).append_column("count_sum", columns[1])

    grouped = documents.groupBy("part").cogroup(wanted.groupBy("to"))
    return grouped.applyInArrow(answer, f"{kinds}, n_best long, count_sum long")
