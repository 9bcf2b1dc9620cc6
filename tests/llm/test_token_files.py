import io
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from toolloom.llm import token_files as tf

FILE = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Hello, WORLD!? it's l'été d'ÉTÉ. Straße 12345 3.14 x_y-z 日本語 テキスト",
    "don't <|endoftext|> <|ENDOFTEXT|> Ünïcödé... İstanbul ΣΑΣ ﬁne ét a b   c",
    "",
    "a.b.c ... ,,, word.' (word). 'sword' we'll!! \x0b tab\tnew\nline\x0cff \x1cfs \x85nel",
    "ab́c ́ x́ ñandú ǅ ª º ʰ",
]


def test_words_give_the_same_ids_as_the_text():
    encode = tf.WordEncoder(open(FILE).read())
    whole = Tokenizer.from_file(FILE)
    for text in [*TEXTS, " ".join(TEXTS * 3)]:
        assert encode(text.encode()).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_generations_of_words_change_nothing():
    small, whole = tf.WordEncoder(open(FILE).read(), keep=4), Tokenizer.from_file(FILE)
    for text in TEXTS * 2:
        assert small(text.encode()).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_a_word_with_any_punctuation_behind_it_goes_to_the_model_at_once():
    encode, whole = tf.WordEncoder(open(FILE).read()), Tokenizer.from_file(FILE)
    tails = ["***", "$$$", ".&&&", "'", "'!", "<|", "|>", "_", "-", "\\", '"', "])}", "~`^@#%+=/"]
    words = [w + t for w in ("Word", "l'été", "é", "don't", "a1", "") for t in tails]
    for text in [*words, " ".join(words)]:
        assert encode(text.encode()).tolist() == whole.encode(text, add_special_tokens=False).ids
    for t in tails:
        assert encode._word(b"word" + t.encode()) is not None and encode._word("été".encode() + t.encode()) is not None


def rows(spark, data):
    return spark.createDataFrame(data, "doc_id long, text string, start int, ids string")


DATA = [(5, "hello there", 1, "x"), (1, None, None, None), (3, "", 2, "y"), (None, "no id", 0, ""), (2, "word " * 5000, 0, ""), (5, "hello again", 1, "x"), (9, "Zebra", 1, "")]


@pytest.fixture(scope="module")
def manifest(spark):
    return tf.write_tokens(rows(spark, DATA), FILE)


def test_round_trip(spark, manifest):
    whole = Tokenizer.from_file(FILE)
    found = tf.read_tokens(manifest).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, 1, 2, 3, 5, 5, 9]
    at = 0
    texts = {(i, tuple(whole.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in DATA}
    for r in found:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids[-1] == 1
        assert (r.doc_id, tuple(r.ids[:-1])) in texts
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens


def test_files_end_at_their_size(spark, manifest):
    """More files, of bounded size, with the same documents in the same places."""
    once = sorted(map(str, tf.read_tokens(manifest).collect()))
    for limits, most in (({"file_docs": 1}, 1), ({"file_docs": 2}, 2), ({"file_ids": 4}, 4)):
        files = tf.write_tokens(rows(spark, DATA).repartition(3), FILE, **limits)
        assert sorted(map(str, tf.read_tokens(files).collect())) == once
        assert [r.doc_id for r in tf.read_tokens(files, wanted=[9]).collect()] == [9]
        for r in files.collect():
            assert r.n_docs <= most if "file_docs" in limits else r.n_ids <= most or r.n_docs == 1
        assert files.agg({"n_docs": "sum"}).first()[0] == len(DATA)


def test_only_wanted_documents(spark, manifest):
    assert sorted(r.doc_id for r in tf.read_tokens(manifest, wanted=[5, 9]).collect()) == [5, 5, 9]


def test_reader_opens_only_the_frames_it_needs_and_checks_them():
    out = io.BytesIO()
    writer = tf.ShardWriter(out)
    for i in range(4):
        writer.add(i, np.arange(60_000, dtype=np.uint32) + i)
    writer.close()
    raw = bytearray(out.getvalue())
    raw[100] ^= 1  # in the first frame
    source = pa.PythonFile(io.BytesIO(bytes(raw)), "r")
    assert [d for d, _, _ in tf.read_shard(source, {2, 3})] == [2, 3]
    with pytest.raises(Exception):
        list(tf.read_shard(pa.PythonFile(io.BytesIO(bytes(raw)), "r"), {0}))


def test_empty_table(spark):
    assert tf.read_tokens(tf.write_tokens(rows(spark, []), FILE)).count() == 0
