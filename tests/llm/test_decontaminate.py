import math
import random
from collections import Counter

from toolloom.llm import decontaminate as dc

from . import brute


def near_windows(docs, items, limit=0.8):
    """{(doc_id, item_id): best similarity} over the windows of item length that start where a shared shingle says."""
    sets = {k: brute.shingles(t) for k, t in items}
    df = Counter(s for k in sets for s in sets[k])
    n = sum(bool(s) for s in sets.values())
    weight = lambda s: 1 + math.log(n) - (math.log(df[s]) if s in df else 0)
    out = {}
    for i, text in docs:
        words = brute.WORD.findall(brute.lower(text))
        for k, item in items:
            w = brute.WORD.findall(brute.lower(item))
            size = min(5, len(w))
            for a in range(len(words) - size + 1 if size else 0):
                for o in range(len(w) - size + 1):
                    if words[a : a + size] == w[o : o + size]:
                        start = max(0, a - o)
                        part = words[start : start + len(w)]
                        own = {tuple(part[j : j + size]) for j in range(len(part) - size + 1)}
                        both = sum(map(weight, own & sets[k]))
                        similarity = both / (sum(map(weight, own | sets[k])))
                        if similarity >= limit - 1e-9:
                            out[i, k] = max(similarity, out.get((i, k), 0))
    return out


def case(seed):
    rng = random.Random(seed)
    vocab = [f"W{i}" for i in range(150)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(k, text(n)) for k, n in enumerate([14, 20, 33, 60, 5, 3, 59, 20])]
    items.append((20, items[3][1][:40] + text(20)))
    docs = []
    for i in range(60):
        words = text(rng.randint(0, 120))
        for _ in range(rng.randint(0, 2)):
            leak = list(rng.choice(items)[1])
            for _ in range(rng.choice([0, 0, 1, 2])):
                leak[rng.randrange(len(leak))] = rng.choice(vocab)
            at = rng.choice([0, len(words), rng.randint(0, len(words))])
            words[at:at] = leak
        docs.append((i, "\n ".join(words).lower() if i % 2 else " ".join(words)))
    docs += [(70, None), (71, ""), (72, " ".join(items[0][1][:10]))]
    return docs, [(k, " ".join(w)) for k, w in items] + [(21, None), (22, " ")]


def test_equals_brute_force(spark):
    for seed in (1, 2):
        docs, items = case(seed)
        frame = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, item_id int")
        bench = spark.createDataFrame([(k, t, 0) for k, t in items], "item_id long, text string, doc_id int")
        found = {(r.doc_id, r.item_id): r.similarity for r in dc.find(frame, bench).collect()}
        want = near_windows(docs, items)
        assert found.keys() == want.keys() and len(want) > 30
        assert all(math.isclose(found[k], want[k], rel_tol=1e-9) for k in want)
        clean = {r.doc_id for r in dc.without(frame, dc.find(frame, bench)).collect()}
        assert clean == {i for i, _ in docs} - {i for i, _ in want}


def test_without_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(dc, "MOST_BROADCAST", 0)
    docs, items = case(3)
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in dc.find(frame, bench).collect()} == near_windows(docs, items).keys()


def test_empty_tables_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e f g"), (None, "a b c d e f g"), (1, "x")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "A B C D E F")], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.start_word) for r in dc.find(docs, items).collect()] == [(None, None, 0)]
    assert [r.doc_id for r in dc.without(docs, dc.find(docs, items)).collect()] == [1]
    assert dc.find(docs.where("false"), items).count() == 0 and dc.find(docs, items.where("false")).count() == 0


def test_blocks_meet_within_the_radius(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), dc.RADIUS):
            b ^= 1 << bit
        rows.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    frame = spark.createDataFrame(rows, "a long, b long")
    from pyspark.sql import functions as F

    prints = frame.select("a", F.col("b").alias("print"))
    for n in (4, 5):
        near = dc.probes(prints, n=n)
        met = near.where(F.array_contains(dc.blocks(F.col("a"), n), F.struct("block", "value")))
        assert met.select("a").distinct().count() == len(rows)
        assert near.distinct().count() == near.count()


def test_recall_against_all_windows(spark):
    """Items that share much of their text, so that weights differ, and windows at every start, not only aligned ones."""
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(4000)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    common = [text(25) for _ in range(3)]
    items = [(k, text(rng.randint(8, 30)) + rng.choice(common)[: rng.randint(5, 25)] + text(rng.randint(0, 8))) for k in range(60)]
    docs = []
    for i in range(480):
        leak = list(items[i % 60][1])
        for _ in range(rng.choice([0, 1, 1, 2])):
            at, what = rng.randrange(len(leak)), rng.randrange(3)
            leak[at : at + (what != 1)] = [rng.choice(vocab)] * (what != 2)
        docs.append((i, " ".join(text(rng.randint(0, 40)) + leak + text(rng.randint(0, 40)))))
    items = [(k, " ".join(w)) for k, w in items]
    sets = {k: brute.shingles(t) for k, t in items}
    df = Counter(s for k in sets for s in sets[k])
    weight = lambda s: 1 + math.log(60) - (math.log(df[s]) if s in df else 0)
    want = set()
    for i, t in docs:
        words = t.split()
        for k, item in items:
            n = len(item.split())
            for start in range(max(1, len(words) - n + 1)):
                own = {tuple(words[j : j + 5]) for j in range(start, min(start + n, len(words)) - 4)}
                if own & sets[k] and sum(map(weight, own & sets[k])) / sum(map(weight, own | sets[k])) >= 0.8:
                    want.add((i, k))
                    break
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in dc.find(frame, bench).collect()}
    assert len(want) > 150 and found <= want and len(found & want) >= 0.99 * len(want)
