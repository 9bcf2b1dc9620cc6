import math
import random

from pyspark.sql import functions as F

from toolloom.llm import quality

from . import brute

TEXTS = [
    None, "", "one", "a b c d e f g h i j", "x y z " * 30, "#tag *bold* $1 % & | <a>\n#tag *bold* $1 % & | <a>\n\n\n \nend",
    "the cat sat on the mat and the cat sat on the mat again", "line\nline\nline \nother", "\x0b\x0cword\x1cword x　y \r\n b",
    "é ü \U0001f600 ß", "w " * 3000, " ".join(f"u{i}" for i in range(5000)),
]


def plain(text):
    text = text or ""
    words = brute.WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = {w for w in windows if windows.count(w) > 1} if len(set(windows)) < len(windows) else set()
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(5)}
    lines = [x for x in text.split("\n") if brute.WORD.search(x)]
    n_repeat = len(covered)
    failed = len(words) < 10 or 100 * n_repeat > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), n_repeat, failed)


def test_base_counts(spark):
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choice("abcd") for _ in range(rng.randint(5, 60))) + rng.choice(["", "\n"]) for _ in range(60)]
    frame = spark.createDataFrame([(i, t, "l", None, 5) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_words int")
    rows = quality.apply_rules(frame).collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows}
    assert got == {i: plain(t) for i, t in enumerate(texts)}
    assert not any(r.kept and r.base_failed for r in rows)


def test_fences_follow_the_group(spark):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    short = lambda: " ".join(word(rng.randint(2, 6)) for _ in range(80))
    long = lambda: " ".join(word(rng.randint(22, 26)) for _ in range(80))
    rows = [(i, short(), "a", "s") for i in range(100)] + [(200 + i, long(), "b", None) for i in range(100)] + [(300, long(), "a", "s"), (301, short(), "b", None), (302, short(), None, "new"), (303, long(), "a", "small")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality.apply_rules(frame).where("kept").collect()}
    assert {*range(100), *range(200, 300)} <= kept and not kept & {300, 301, 303}


def test_sketches_merge(spark):
    rows = spark.range(1000).select(F.lit("l").alias("lang"), F.concat(F.lit("s"), F.col("id") % 7).alias("source"), F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: F.sha2((F.col("id") * 31 + i).cast("string"), 256))).alias("text"))
    measured = quality.measures(rows.repartition(5))
    fences = quality.fences(measured).collect()
    assert len(fences) == 7 and all(f.word_length_q1 == f.word_length_q3 == 64.0 for f in fences)


def test_empty_table(spark):
    assert quality.apply_rules(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).count() == 0


def test_each_measure_rejects_an_outlier_that_the_base_rules_pass(spark):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    text = lambda w: "\n".join(" ".join(w[i : i + 12]) for i in range(0, len(w), 12))
    rows = [(i, text(words(rng.randint(150, 900))), "l", f"s{i % 3}") for i in range(150)]
    passage = words(60)
    doubled = [x for _ in range(45) for x in ("ab cd", " ".join(words(12)))]
    planted = {
        "word_length": text([w * 4 for w in words(400)]),
        "symbol_share": text([w + "#" * (i % 3 == 0) for i, w in enumerate(words(400))]),
        "dup_line_share": "\n".join(doubled),
        "repeat_share": text(words(401) + passage + words(402) + passage),
        "distinct_share": text([rng.choice(vocabulary[:30]) for _ in range(500)]),
        "upper_share": text([w.upper() if i % 3 == 0 else w for i, w in enumerate(words(400))]),
    }
    rows += [(1000 + i, t, "l", "s0") for i, t in enumerate(planted.values())]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in quality.apply_rules(frame).collect()}
    for i, measure in enumerate(planted):
        assert not found[1000 + i].base_failed and measure in found[1000 + i].outside, measure
    assert all(found[i].kept for i in range(150))


def test_fences_equal_brute_force(spark):
    rng = random.Random(8)
    groups = [("a", "s")] * 60 + [("a", "t")] * 9 + [("a", None)] + [("b", "s")] * 25 + [(None, "s")] * 2
    texts = [" ".join("".join(rng.choice("aBc#") for _ in range(rng.randint(1, 4 + 6 * (lang == "b")))) for _ in range(rng.randint(10, 90))) for lang, _ in groups]
    frame = spark.createDataFrame([(i, t, *g) for i, (t, g) in enumerate(zip(texts, groups))], "doc_id long, text string, lang string, source string")
    rows = quality.apply_rules(frame).collect()
    good = [r for r in rows if not r.base_failed]

    def quartile(m, q, r):
        blend = None
        for level in (good, [x for x in good if x.lang == r.lang], [x for x in good if (x.lang, x.source) == (r.lang, r.source)]):
            values = sorted(x[m] for x in level)
            if values:
                own = values[max(0, math.ceil(q * len(values)) - 1)]
                blend = own if blend is None else (len(values) * own + quality.PRIOR * blend) / (len(values) + quality.PRIOR)
        return blend

    def error(m, usual, r):
        if m == "word_length":
            return usual / math.sqrt(r.n_words)
        if m == "distinct_share":
            return 1 / (math.sqrt(r.n_words) * math.log(r.n_words))
        units = max({"dup_line_share": r.n_lines, "repeat_share": r.n_words / quality.PASSAGE}.get(m, r.n_words), 1)
        p = (usual * units + 1) / (units + 2)
        return math.sqrt(p * (1 - p) / units)

    for r in rows:
        want = []
        for m, (below, above) in quality.MEASURES.items():
            q1, q3 = quartile(m, 0.25, r), quartile(m, 0.75, r)
            if (below and r[m] < q1 - quality.FENCE * (q3 - q1 + error(m, q1, r))) or (above and r[m] > q3 + quality.FENCE * (q3 - q1 + error(m, q3, r))):
                want.append(m)
        assert r.outside == want
    assert len(good) > 60


def test_one_document_more_moves_no_fence_far(spark):
    """A group does not change its fences at once when it reaches some size."""
    of = lambda n, at: [(at + i, " ".join(["abcdefgh"] * 3 + [f"u{j}" for j in range(40)]), "l", f"n{n}") for i in range(n)]
    rows = [(i, " ".join(f"word{j * i}" for j in range(1, 60)), "l", "big") for i in range(100)] + of(48, 1000) + of(49, 2000) + of(50, 3000) + of(51, 4000)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    upper = {r.g_source: r.word_length_q3 for r in quality.fences(quality.measures(frame)).collect()}
    line = [upper[f"n{n}"] for n in (48, 49, 50, 51)]
    assert max(line) - min(line) < 0.1 and abs(upper["big"] - line[0]) > 1
