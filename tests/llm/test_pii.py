import random
import re

from pyspark.sql import functions as F

from toolloom.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """The patterns as they are written, one after the other."""
    spans = [("email", *m.span()) for m in EMAIL.finditer(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0:
            spans.append(("card", *m.span()))
    spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return spans


def test_base_spans_are_what_the_patterns_find():
    rng = random.Random(4)
    pieces = ["a@b.c", "x.y+z@mail.example.com", "@", "a@b", "a@b@c.d", ".", "-", " ", "é", "1.2.3.4", "999.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (626) 555-5759", "+", "12", "0", "+49", "(", ")", "word", "00000000000000", "192.168.0.0255"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))
        assert pii.base_spans(text) == plain(text), text


def test_very_long_runs_take_linear_time():
    for text in ("1" * 200_000, "1." * 100_000, "+1" + " " * 200_000, "a" * 200_000 + "@", "a@" * 100_000, "1 " * 100_000):
        pii.base_spans(text)


def test_context_discovers_unseen_forms(spark):
    rng = random.Random(1)
    rows = []
    for i in range(40):
        rows.append((i, f"please mail: user{i}@host{i}.org today, number {rng.randint(100, 999)} of the list"))
    rows += [(100, "please mail: bob[at]site77.123 today"), (101, "the number 12345 of mail"), (102, None), (103, ""), (102, "ip 10.0.0.1"), (None, "see +1 (626) 555-5759 now")]
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, spans string")
    found = pii.find(frame).select("doc_id", pii.listed(F.col("base")).alias("base"), pii.listed(pii.merged(F.col("base"), F.col("found"))).alias("spans")).collect()
    got = {r.doc_id: r for r in found if r.doc_id not in (102, None)}
    assert got[100].base == "" and got[100].spans == "email:13:30" and got[101].spans == got[103].spans == ""
    assert all(r.spans == r.base for i, r in got.items() if i != 100) and got[3].base == "email:13:28"
    assert sorted(r.spans for r in found if r.doc_id == 102) == ["", "ip:3:11"] and [r.spans for r in found if r.doc_id is None] == ["phone:4:21"]
    assert pii.masked(rows[100 - 60][1], [{"kind": "email", "start": 13, "end": 30}]) == "please mail: <email> today"


def test_contexts_far_from_the_seeds(spark):
    """Seeds at the first word only; from word to word the kind goes on by values that stand at both."""
    texts = [f"mail: user{i}@host{i}.org" for i in range(300)]
    texts += [f"{w} first{i}[at]site.777" for i in range(50) for w in ("mail:", "writes")]
    texts += [f"{w} second{i}[at]site.777" for i in range(6) for w in ("writes", "contact")]
    texts += ["contact last[at]site.777", "lonely other[at]site.777"]
    found = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    values = {(r.value, r.kind) for r in found.select(F.explode("found").alias("s")).select("s.*").collect()}
    assert values == {(f"{v}[at]site.777", "email") for v in [f"first{i}" for i in range(50)] + [f"second{i}" for i in range(6)] + ["last"]}


def test_neighbours_at_any_distance_and_of_any_length(spark):
    """120 spaces between the word and its value; no-break spaces belong to words; words of 300 characters."""
    long_word = "Wort" * 75
    texts = [f"mail:{' ' * (1 + i % 2 * 119)}user{i}@host{i}.org" for i in range(60)] + [f"mail:{' ' * 120}bob[at]site77.123"]
    texts += [f"{long_word} +1 626 555 57{i}" for i in range(10, 40)] + [f"{long_word.lower()}\n\n00-62-65-55"]
    texts += [f"no\u00a0break 10.0.0.{i}" for i in range(30)] + ["no\u00a0break addr-1234", "break addr-9999"]
    found = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    values = {(r.value, r.kind) for r in found.select(F.explode("found").alias("s")).select("s.*").collect()}
    assert values == {("bob[at]site77.123", "email"), ("00-62-65-55", "phone"), ("addr-1234", "ip")}


def test_neighbours_of_many_spans_in_one_word_take_linear_time():
    text = "w " + "a@b.cd," * 30_000 + " " + "x" * 200_000
    near = pii._Neighbours(text)
    assert {near(a, b) for _, a, b in pii.base_spans(text)} == {("w", pii._named("x" * 200_000))}


def test_empty_table(spark):
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).count() == 0
