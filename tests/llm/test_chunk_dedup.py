import random

import pyarrow as pa

from toolloom.llm import chunk_dedup as cd


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzéü") for _ in range(rng.randint(2, 9))) for _ in range(n))


def run(spark, rows):
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, part int")
    return {r.doc_id: r for r in cd.dedup(frame).collect()}


def test_shared_passages_are_found_wherever_they_stand(spark):
    rng = random.Random(2)
    passage, line = words(rng, 70), words(rng, 12)
    rows = [(i, f"{words(rng, rng.randint(0, 90))} {line}\n{passage} {words(rng, rng.randint(1, 90))}") for i in range(12)]
    rows += [(50 + i, f"{words(rng, 60)} {line} {words(rng, 60)}") for i in range(12)] + [(90, None), (91, ""), (92, passage * 2), (93, words(rng, 3000))]
    found = run(spark, rows)
    texts = dict(rows)
    assert len(found) == len(rows)
    for i in [*range(12), 92]:
        assert found[i].spans
        for s in found[i].spans:
            assert texts[i][s.start : s.end] in f"{line}\n{passage} {passage * 2}" or texts[i][s.start : s.end] in passage * 2
    assert all(not found[i].spans and found[i].kept_text == texts[i] for i in texts if i >= 50 and i != 92)
    keepers = [i for i in [*range(12), 92] if any(s.stays for s in found[i].spans)]
    assert len(keepers) == 1
    for i in range(12):
        if i not in keepers:
            assert len(found[i].kept_text) < len(texts[i]) - 200


def test_insertions_move_chunks_but_keep_them():
    import pyarrow as pa

    rng = random.Random(5)
    text = words(rng, 400)
    a, b = cd.Chunks(pa.array([text])), cd.Chunks(pa.array(["new words " + text[:700] + " inserted " + text[700:]]))
    assert len(set(a.digest.tolist()) - set(b.digest.tolist())) < 0.1 * len(a.digest)


def test_copies_keep_one_and_repeated_rows_are_one(spark):
    text = words(random.Random(9), 120)
    found = run(spark, [(1, text), (2, text), (2, text), (3, "x" * 50_000)])
    assert sorted(found) == [1, 2, 3] and not found[3].spans
    assert sorted(s.stays for i in (1, 2) for s in found[i].spans) == [False, True]
    assert run(spark, []) == {}


def test_a_part_is_hashed_in_small_pieces_with_the_same_result(monkeypatch):
    texts = [None, "", "long " * 30_000, *[f"text {i} of many, " * 200 for i in range(1000)]]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    sizes = [sum(len(t or "") for t in piece.column("text").to_pylist()) for _, piece, _ in cd._pieces(batch)]
    assert sum(sizes) == sum(len(t or "") for t in texts) and max(sizes) < 1_000_000
    small = cd._keys(batch)
    monkeypatch.setattr(cd, "PIECE_BYTES", 1 << 40)
    assert all((a == b).all() for a, b in zip(small, cd._keys(batch)))
