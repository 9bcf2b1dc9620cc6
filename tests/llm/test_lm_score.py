import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from toolloom.llm import lm_score

from . import brute

ROWS = [(1, "The cat sat on the mat"), (2, "the cat sat"), (3, None), (4, ""), (5, "THE dog \x0b sat\n\ton the cat"), (6, "zebra the cat sat on"), (7, "the cat sat"), (None, "cat cat cat"), (8, "é É é")]
TRAIN = {1, 2, 3, 4, 5, 8}


def tokens(text):
    return [*brute.WORD.findall(brute.lower(text)), "</s>"]


def expected(order):
    texts = [tokens(t) for i, t in ROWS if i in TRAIN]
    counts = Counter(w for t in texts for w in t)
    n, v = sum(counts.values()), len(counts)
    grams = [Counter() for _ in range(order)]
    for t in texts:
        line = ["<s>", *t]
        for k in range(1, order):
            grams[k].update(tuple(line[i - k : i + 1]) for i in range(k, len(line)))

    def history(h):
        if len(h) == 1:
            return len(texts) if h[0] == "<s>" else counts[h[0]]
        return grams[len(h) - 1][tuple(h)]

    out = {}
    for i, text in ROWS:
        t = tokens(text)
        sums = []
        for m in lm_score.STRENGTHS:
            total = 0.0
            for at, w in enumerate(t):
                p = (counts[w] + 1) / (n + v + 1)
                line = ["<s>", *t[:at]]
                for k in range(1, order):
                    h = line[-k:] if len(line) >= k else None
                    if h and m < math.inf and history(h) > 0:
                        p = (grams[k][(*h, w)] + m * p) / (history(h) + m)
                total += math.log10(p)
            sums.append(total)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)
        out[i] = (len(t), sum(counts[w] > 0 for w in t), n, base, math.log10(sum(10**s for s in sums) / len(sums)))
    return out


def test_equals_a_plain_automaton(spark):
    frame = spark.createDataFrame([(i, t, "x") for i, t in ROWS], "doc_id long, text string, train string")
    for order in (1, 2, 3, 4):
        rows = lm_score.score_texts(frame, F.col("doc_id").isin(*TRAIN), order=order).collect()
        want = expected(order)
        assert len(rows) == len(ROWS)
        for r in rows:
            n_tokens, n_known, n, base, score = want[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (n_tokens, n_known, n)
            assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9)


def test_no_rows_and_nothing_to_train_on(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert lm_score.score_texts(frame, F.lit(True)).count() == 0
    frame = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    (row,) = lm_score.score_texts(frame, F.lit(False)).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.score) == (3, 0, 0, 0.0)


def test_states_and_failures():
    """After a c the longest state is (a c); d is reached from it over (c), b only over the empty state."""
    texts = pa.array(["a c d", "a c d", "b c d", "a c b"])
    grams = lm_score.Grams(texts, 3)
    counts = [c.astype(float) for c in grams.counted(np.array([False, False, True, False]))]
    counts = [c + x for c, x in zip(counts, grams.counted(np.array([True, False, False, False])))]
    machine = lm_score.Automaton(grams, counts)
    met, took = machine.walk()
    assert machine.size[met].tolist() == [1, 2, 2, 2] * 3 + [1, 2, 2, 1]
    assert (machine.size[took] - 1).tolist() == [1, 2, 2, 2] * 3 + [1, 2, 0, 0]
    assert machine.size[machine.fail[met]].tolist() == [0, 1, 1, 1] * 3 + [0, 1, 1, 0]


def test_a_text_seen_twice_scores_above_one_seen_once(spark):
    words = [f"w{i % 97}" for i in range(400)]
    rng = random.Random(5)
    texts = [" ".join(rng.sample(words, 60)) for _ in range(40)]
    frame = spark.createDataFrame(list(enumerate(texts + texts[:10])), "doc_id long, text string")
    scores = {r.doc_id: r.score / r.n_tokens for r in lm_score.score_texts(frame, F.lit(True)).collect()}
    assert min(scores[i] for i in range(10)) > max(scores[i] for i in range(10, 40))
    assert all(math.isclose(scores[i], scores[40 + i]) for i in range(10))
