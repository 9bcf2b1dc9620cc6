import random
import re
from collections import Counter

from pyspark.sql import functions as F

from toolloom.llm import threads

A = "Where is the report?\nI need it today."
ROWS = [
    (1, 0, "user", A, 9),
    (1, 1, "assistant", "> Where is the report?\n> I need it today.\nIt is in the folder.", 9),
    (1, 2, "user", ">> Where is the report?\n>> I need it today.\n> It is in  the FOLDER.\nWhich folder?", 9),
    (1, 3, "user", "> I need it today.\nSo do I.", 9),
    (1, 4, "assistant", "no quotes here", 9),
    (2, 0, "user", " > > which folder?\nSame question.", 9),
    (2, 1, "user", "> nobody ever said this\nHm.", 9),
    (2, 2, "user", "> Hm.\n>Same question.\n\nok", 9),
    (3, 0, "user", None, 9),
    (3, 1, "user", "> " + "long " * 20000 + "\nshort", 9),
    (None, None, "user", "long " * 20000, 9),
    (3, 1, "user", "> " + "long " * 20000 + "\nshort", 9),
]


def run(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, row int")
    return threads.threads(frame).select("*", F.size("path").alias("n")).collect()


def test_links_depths_and_texts(spark):
    found = {(r.conv, r.turn): r for r in run(spark, ROWS)}
    parents = {k: (r.parent_conv, r.parent_turn) for k, r in found.items() if r.depth}
    assert parents == {(1, 1): (1, 0), (1, 2): (1, 1), (1, 3): (1, 0), (2, 0): (1, 2), (2, 2): (2, 0), (3, 1): (None, None)}
    assert {k: r.depth for k, r in found.items()} == {(1, 0): 0, (1, 1): 1, (1, 2): 2, (1, 3): 1, (1, 4): 0, (2, 0): 3, (2, 1): 0, (2, 2): 4, (3, 0): 0, (3, 1): 1, (None, None): 0}
    assert found[(2, 2)].thread == 1 and [(p.conv, p.turn) for p in found[(2, 2)].path] == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 2)]
    assert found[(1, 2)].text == "Which folder?" and found[(2, 2)].text == "ok" and found[(3, 0)].text == ""
    assert found[(1, 0)].text == A and not found[(1, 0)].has_quotes and found[(2, 1)].has_quotes


def test_reply_order(spark):
    rows = [r for r in run(spark, ROWS) if r.thread == 1]
    rows.sort(key=lambda r: [(p.conv, p.turn) for p in r.path])
    assert [(r.conv, r.turn) for r in rows] == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 2), (1, 3), (1, 4)]


def test_every_row_comes_back(spark):
    assert len(run(spark, ROWS)) == len(ROWS) and run(spark, []) == []


def test_long_chain(spark):
    rows = [(7, 0, "user", "message number 0", 0)] + [(7, i, "user", f"> message number {i - 1}\nmessage number {i}", 0) for i in range(1, 20)]
    found = {r.turn: r.depth for r in run(spark, rows)}
    assert found == {i: i for i in range(20)}


def test_an_edited_outer_quote_falls_back_on_the_inner_one(spark):
    rows = [
        (1, 0, "user", "the first question of all", 0),
        (1, 1, "user", "> the first question of all\na long and winding answer", 0),
        (1, 2, "user", "> [cut] an answer\n>> the first question of all\nthanks", 0),
        (1, 3, "user", "> [cut]\n>> [cut as well]\nwhat?", 0),
    ]
    found = {r.turn: (r.parent_turn, r.depth) for r in run(spark, rows)}
    assert found == {0: (None, 0), 1: (0, 1), 2: (0, 1), 3: (None, 0)}


def test_the_context_decides_who_is_meant(spark):
    ok = "yes, that is fine"
    rows = [
        (1, 0, "user", "shall we meet on Monday", 0),
        (1, 1, "user", "shall we bring the papers", 0),
        (1, 2, "user", f"> shall we meet on Monday\n{ok}", 0),
        (1, 3, "user", f"> shall we bring the papers\n{ok}", 0),
        (1, 4, "user", f"> {ok}\n>> shall we bring the papers\nso I do", 0),
        (1, 5, "user", f"> {ok}\nwhich of them?", 0),
        (2, 0, "user", f"> {ok}\n>> shall we bring the papers\nme too", 0),
        (2, 1, "user", ok, 0),
        (2, 2, "user", f"> {ok}\n>> shall we bring the papers\nown conversation first", 0),
    ]
    found = {(r.conv, r.turn): (r.parent_conv, r.parent_turn) for r in run(spark, rows)}
    assert found[1, 4] == (1, 3) and found[1, 5] == (1, 2) and found[2, 0] == (1, 3) and found[2, 2] == (2, 1)


def norm(text):
    return " ".join(text.lower().split())


def plain(rows):
    """{(conv, turn): parent} by comparing every message with every other one before it; conversations and turns are unique numbers."""
    cut = {}
    for conv, turn, _, text, _ in rows:
        passages = []
        for line in (text or "").split("\n"):
            marks = re.match(r"(?:[ \t]*>)+", line)
            depth = marks.group().count(">") if marks else 0
            line = re.sub(r"^(?:[ \t]*>)+[ \t]?", "", line)
            if not passages or passages[-1][0] != depth:
                passages.append((depth, []))
            passages[-1][1].append(line)
        first, pieces = {}, set()
        for depth, lines in passages:
            if norm(" ".join(lines)):
                first.setdefault(depth, norm(" ".join(lines)))
                pieces.add((depth, norm(" ".join(lines))))
            pieces |= {(depth, norm(x)) for x in lines if len(norm(x)) >= threads.LEAST_CHARS}
        cut[conv, turn] = (pieces, lambda d, first=first: first.get(min((x for x in first if x > d), default=None)))
    found = {}
    for at, (pieces, context) in cut.items():
        votes = {}
        for depth, piece in pieces:
            by = sorted(p for p, (said, _) in cut.items() if depth and p < at and (0, piece) in said)
            alike = {p for p in by if context(depth) is not None and cut[p][1](0) == context(depth)}
            order = sorted(by, key=lambda p: (p[0] != at[0], p not in alike, p))
            if order:
                votes.setdefault(depth, Counter())[order[0]] += len(piece)
        if votes:
            least = votes[min(votes)]
            found[at] = min(least, key=lambda p: (-least[p], p))
    return found


def test_equals_brute_force(spark):
    rng = random.Random(11)
    phrases = ["yes", "I agree with that", "no, not at all", "where is the report", "it is in the folder", "see the second page", "thank you"]
    rows = []
    for conv in range(12):
        for turn in range(9):
            lines = [rng.choice(phrases) for _ in range(rng.randint(1, 3))]
            if rows and rng.random() < 0.8:
                near = [r for r in rows if r[0] == conv] or rows
                quoted = ["> " + x for x in rng.choice(near if rng.random() < 0.8 else rows)[3].split("\n")]
                if rng.random() < 0.4:
                    quoted[rng.randrange(len(quoted))] += " edited"
                lines = quoted + lines
            rows.append((conv, turn, "user", "\n".join(lines), 0))
    want = plain(rows)
    got = {(r.conv, r.turn): (r.parent_conv, r.parent_turn) for r in run(spark, rows) if r.parent_turn is not None}
    assert got == want and len(want) > 50
