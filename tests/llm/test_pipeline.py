import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline

from . import brute
from .test_decontaminate import case, near_windows
from .test_toxicity import corpus


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Texts of the toxicity fixture and of the leak fixture, some of them copied, with labels and benchmark."""
    folder = str(tmp_path_factory.mktemp("tables"))
    prose = corpus(5, 250)
    leaks, items = case(4)
    rows = [(i, t) for i, t, _ in prose] + [(1000 + i, t) for i, t in leaks]
    rows += [(2000 + i, t) for i, t, _ in prose[:40]] + [(3000 + i, t + " one more") for i, t, _ in prose[10:30]]
    docs = spark.createDataFrame([(i, t, "l", f"s{i % 3}" if i % 10 else None, len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, _, y in prose], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, items, {i: y for i, _, y in prose}


def test_every_stage_on_its_own_input(spark, tables):
    folder, items, toxic = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_files"]
    read = lambda frame: [(r.doc_id, r.text) for r in frame.collect()]

    kept = pipeline.stored(stages["toxicity"](spark, docs, folder))
    assert kept.columns == docs.columns
    ids = {i for i, _ in read(kept)}
    missed = [i for i, y in toxic.items() if y == (i in ids)]
    assert len(missed) <= 0.03 * len(toxic) and {i for i, _ in read(docs)} - ids <= {*toxic, *(i + 2000 for i in toxic), *(i + 3000 for i in toxic)}

    single = pipeline.stored(stages["near_duplicates"](spark, kept, folder))
    groups = brute.groups(read(kept))
    assert sorted(i for i, _ in read(single)) == sorted(i for i, (_, least) in groups.items() if i == least)
    assert single.columns == docs.columns and single.count() < kept.count()

    clean = pipeline.stored(stages["decontamination"](spark, single, folder))
    hit = {i for i, _ in near_windows(read(single), items)}
    assert hit and sorted(i for i, _ in read(clean)) == sorted(i for i, _ in read(single) if i not in hit)
    assert clean.columns == docs.columns

    mixed = pipeline.stored(stages["mixing"](spark, clean, folder))
    texts, copies = dict(read(clean)), Counter(read(mixed))
    assert mixed.columns == docs.columns and all(texts[i] == t and n <= 2 for (i, t), n in copies.items())
    words = lambda t: len(brute.WORD.findall(t or ""))
    total = sum(map(words, texts.values()))
    assert abs(sum(n * words(t) for (_, t), n in copies.items()) - 1.5 * total) < 0.05 * total

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = stages["token_files"](spark, mixed, folder).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted(i for i, _ in read(mixed))
    at = 0
    for r in found:
        ids = [*whole.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_run_is_the_stages_in_a_row(spark, tables):
    folder, _, _ = tables
    rows = pipeline.run(spark, folder)
    assert rows.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and rows.count() > 100
    assert rows.agg(F.sum("n_tokens")).first()[0] == rows.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0]
