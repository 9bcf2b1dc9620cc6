import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from toolloom.llm import alignment
from toolloom.llm.token_files import _byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    byte_bpe = Tokenizer.from_file(A)
    byte_bpe.encode_special_tokens = True
    return byte_bpe, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(text, libraries):
    """(id, begin, end) of each token of both sides, byte by byte."""
    byte_bpe, pieces = libraries
    letters = {c: bytes([b]) for b, c in enumerate(_byte_letters())}
    line = (" " + (text or "")).encode()
    sides = []
    if not text:
        return [], []
    for ids, spelled in (
        (byte_bpe.encode(" " + text, add_special_tokens=False).ids, lambda i: b"".join(letters[c] for c in byte_bpe.id_to_token(i))),
        (pieces.encode(text), lambda i: bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()),
    ):
        at, found, joined = 0, [], b""
        for i in ids:
            found.append((i, at, at + len(spelled(i))))
            at += len(spelled(i))
            joined += spelled(i)
        if joined != line:
            return [], []
        sides.append(found)
    return sides


def brute(rows, libraries):
    """doc_id -> the contract's numbers, from pairs of tokens one by one."""
    counts, per = Counter(), {}
    for k, (_, text) in enumerate(rows):
        a, b = tokens(text, libraries)
        cuts = sorted({t[2] for t in a} & {t[2] for t in b})
        groups, last = [], 0
        for cut in cuts:
            inside = [",".join(str(i) for i, x, y in side if last <= x and y <= cut) for side in (a, b)]
            groups.append("|".join(inside))
            last = cut
        ends = defaultdict(list)
        for i, _, y in b:
            ends[y].append(i)
        links = [(i, j) for i, _, y in a for j in ends[y]]
        counts.update(links)
        per[k] = (len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
    top = {j: max(n for (_, y), n in counts.items() if y == j) for _, j in counts}
    found = []
    for k, (doc, _) in enumerate(rows):
        n_a, n_b, n_groups, links, digest = per[k]
        found.append((doc, n_a, n_b, n_groups, len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return sorted(found, key=str)


def texts():
    rng = random.Random(5)
    parts = ["the", " cat", "  ", "\n\n", "naïve", "日本語", "🙂", "<|endoftext|>", "<s>", "1234567", "don't", "\t", "Ä", "...", "antidisestablishment", " ", "é", "x" * 40]
    made = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(1, 30))) for _ in range(60)]
    plain = "The quick brown fox jumps over the lazy dog; it isn't very tokenizable, unfortunately. "
    return [None, "", " ", "a", "▁", "a▁b", "\x00", plain, plain, plain * 300, *made]


def test_equals_brute_force_in_parts_of_any_size(spark, libraries, monkeypatch):
    rows = list(enumerate(texts())) + [(3, "a"), (None, "null id"), (None, "null id")]
    want = brute(rows, libraries)
    frame = spark.createDataFrame([(i, t, -1, "a", 0) for i, t in rows], "doc_id long, text string, part int, a string, n int")
    for size, files in ((8_000_000, 1), (300, 3)):
        monkeypatch.setattr(alignment, "PART_BYTES", size)
        monkeypatch.setattr(alignment, "BLOCK_BYTES", 100)
        made = alignment.aligned_parts(frame.repartition(files), A, B)
        found = alignment.align(made, alignment.pair_counts(made)).drop("groups").collect()
        columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
        assert sorted([tuple(r[c] for c in columns) for r in found], key=str) == want


def test_groups_are_written_out_and_empty_tables_stay_empty(spark):
    frame = spark.createDataFrame([("k1", "unbelievable 日"), ("k2", None)], "doc_id string, text string")
    made = alignment.aligned_parts(frame, A, B, with_groups=True)
    found = {r.doc_id: r for r in alignment.align(made, alignment.pair_counts(made)).collect()}
    assert found["k2"].groups == found["k2"].groups_sha256 == ""
    groups = [g.split("|") for g in found["k1"].groups.split(";")]
    assert len(groups) == found["k1"].n_groups and sum(len(a.split(",")) for a, _ in groups) == found["k1"].n_a
    assert hashlib.sha256(found["k1"].groups.encode()).hexdigest() == found["k1"].groups_sha256
    empty = alignment.aligned_parts(frame.where("false"), A, B)
    assert alignment.align(empty, alignment.pair_counts(empty)).count() == 0


def test_overlaps_expand_inside_groups():
    """A: [0,4) [4,6) [6,9); B: [0,2) [2,5) [5,6) [6,9): two groups, and every overlapping pair once."""
    starts, ends = (np.array([0, 4, 6]), np.array([0, 2, 5, 6])), (np.array([4, 6, 9]), np.array([2, 5, 6, 9]))
    group, a, b = alignment.coalesce(starts, ends)
    assert [g.tolist() for g in group] == [[0, 0, 1], [0, 0, 0, 1]]
    naive = {(i, j) for i in range(3) for j in range(4) if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]}
    assert sorted(zip(a.tolist(), b.tolist())) == sorted(naive)


def test_other_vocabularies_run_by_the_library():
    """A vocabulary whose merges aren't numbered in order gives the library's ids."""
    import json

    parts = json.loads(open(A).read())
    swap = {"Ġthe": parts["model"]["vocab"]["Ġof"], "Ġof": parts["model"]["vocab"]["Ġthe"]}
    parts["model"]["vocab"].update(swap)
    side = alignment.ByteSide(json.dumps(parts))
    library = Tokenizer.from_str(json.dumps(parts))
    assert side.encode(["the end of it"])[0] == library.encode(" the end of it").ids
    assert b"".join(side.bytes[i] for i in side.encode(["the end of it"])[0]) == b" the end of it"
