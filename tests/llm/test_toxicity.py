import random
import zlib
from types import SimpleNamespace

from pyspark.sql import functions as F

from toolloom.llm import toxicity as tx
from toolloom.llm.common import crc_remainder


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
    return out


def test_automaton_is_edit_distance():
    rng = random.Random(7)
    terms = [("stupid", False, 1.0), ("moron", False, 1.0), ("bad", False, 1.0), ("grumbl", True, 1.0), ("vequ", True, 1.0)]
    lexicon = tx.Lexicon(terms)
    for _ in range(4000):
        word = list(rng.choice([t for t, _, _ in terms]) + rng.choice(["", "", "er", "s"]))
        for _ in range(rng.randint(0, 2)):
            at, kind = rng.randrange(len(word) + 1), rng.random()
            if kind < 0.4:
                word.insert(at, rng.choice("abdimnoprstuv"))
            elif word and kind < 0.7:
                del word[min(at, len(word) - 1)]
            elif word:
                word[min(at, len(word) - 1)] = rng.choice("abdimnoprstuv")
        word = "".join(word)
        best = None
        for text, stem, _ in terms:
            allowed = tx.Lexicon.allowed(text, stem)
            d = min(distance(word[:n], text) for n in range(len(word) + 1)) if stem else distance(word, text)
            if d <= allowed:
                best = d if best is None else min(best, d)
        found = lexicon.match(word)
        assert (found[0] if found else None) == best, word


def test_terms_are_left_out_only_where_a_beginning_finds_them():
    row = lambda term, stem, toxic: SimpleNamespace(term=term, stem=stem, toxic=toxic, other=0)
    found = [row("pig", False, 40), row("pigface", False, 10), row("pigh", True, 9), row("assh", True, 30), row("ass", False, 8), row("asshat", False, 7), row("asshol", True, 6)]
    terms = tx._choose_terms(found, 100, 100)
    assert [t[:2] for t in terms] == [("pig", False), ("assh", True), ("pigface", False), ("pigh", True), ("ass", False)]
    scanner = tx.Scanner(terms)
    clean = scanner.features("some day")
    assert all(scanner.features(f"some {w} day") != clean for w in ("pig", "pigface", "pighead", "ass", "asshat", "asshole"))
    heavier = tx.Lexicon([("ass", True, 1.0), ("assh", True, 3.0)])
    assert heavier.match("asshat") == (0, 1) and heavier.match("asset") == (0, 0)


def test_beginnings_stand_by_words_that_no_term_before_finds(spark):
    texts = [("a kretinoid here", 1)] * 30 + [(f"some kretal{x} there", 1) for x in "abcd"] * 5 + [("a fine day", 0)] * 60
    sample = spark.createDataFrame(texts, "text string, toxic int")
    terms = [("kretinoid", False, 9.0), ("kretinoi", True, 9.0), ("kret", True, 9.0), ("kretal", True, 9.0)]
    assert [t[:2] for t in tx._own_evidence(sample, terms, 2, 50, 60)] == [("kretinoid", False), ("kret", True)]


def test_context_tells_quotation():
    words = lambda t: t.lower().split()
    assert tx.quotation(words('he said "you moron" to me'), 3) >= 1
    assert tx.quotation(words("you are a moron and"), 3) == 0
    assert tx.quotation(words("the word moron means"), 2) == 0.5


def corpus(seed, n=600):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(300)]
    rows = []
    for i in range(n):
        toxic = i % 7 == 0
        words = [rng.choice(vocab) for _ in range(rng.randint(20, 120))]
        for _ in range(rng.randint(2, 4) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["Kretinoid!", "kretinoid", "zzugg" + rng.choice("aeiou"), "Schmuckel,"]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_accuracy_and_misspellings(spark):
    rows = corpus(1)
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in rows] + [(9000, None, "s"), (9001, "", "s"), (9002, "some kretin0id here and a Schmukel too, kretinoid", "s"), (9003, "w " * 30000, "s")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows] + [(1, None, 1), (77777, 1, 1), (None, 1, 1)], "doc_id long, toxic int, quality int")
    model = tx.learn(docs, labels, usable=crc_remainder(F.col("doc_id"), 5) != 0)
    scored = {r.kept_doc_id: r.score for r in tx.score(docs, model, keep=["doc_id", "score"]).collect()}
    assert len(scored) == len(rows) + 4 and all(0 <= s <= 1 for s in scored.values())
    held = [(y, scored[i]) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((s >= 0.5) == bool(y) for y, s in held) >= 0.97 * len(held)
    assert scored[9002] > 0.5 and max(scored[9000], scored[9001], scored[9003]) < 0.2
    assert scored[9000] == scored[9001]
    again = tx.learn(docs.repartition(7), labels, usable=crc_remainder(F.col("doc_id"), 5) != 0)
    assert again.terms == model.terms


def test_without_labels_of_both_classes(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert tx.score(docs, tx.learn(docs, none)).first().score == 0.0
    assert tx.score(docs, tx.learn(docs, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"))).first().score == 1.0
    assert tx.score(docs.where("false"), tx.learn(docs, none)).count() == 0
