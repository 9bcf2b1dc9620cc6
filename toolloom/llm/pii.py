"""Personal data: fixed forms, and by bootstrapping what stands where they stand.

Base: e-mail addresses, IP addresses, card and phone numbers by their form. They are the seeds of a graph: its instances
are the seeds and all other tokens that look like identifiers (three digits or more, or an @), its patterns the word before and
the word after an instance. In turns, a pattern's score for a kind is the mean score of what it stands next to, over all its occurrences
in the corpus, whatever follows; an identifier's score is that of 1 - (1 - s) .. (1 - s) over its patterns that have at least LEAST_SEEDS different
instances of the kind and a score of at least SURE. Identifiers at or above ACCEPT join the kind: in the next
turn they are instances of all their patterns, of those without any seed too. Support only grows, so the turns end: when no identifier is new
and no score rises by more than SETTLED. Words that stand next to identifiers by chance occur too often elsewhere to score.

Null and empty texts have no spans. Whole texts are searched, in time that grows with their length; the word next to an instance counts
whatever its distance and length. Overlapping spans of different kinds are all kept; a found span never
overlaps a base span. Copies of a text are one witness: instances are told apart by their characters. Rows with null or repeated
ids are searched like any other; of equal scores all count. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toolloom.llm.common import renamed, stored
from toolloom.llm.words import Words, chunks

KINDS = ("email", "ip", "card", "phone")
LEAST_SEEDS = 5
SURE = 0.5
ACCEPT = 0.8
SETTLED = 1e-6
LONG_WORD = 100

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # from the first digit on: later ones fail alike
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = ".,;:!?\"'()[]{}<>"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each address has one @ behind its local part: look at those, each once."""
    floor, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > floor and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            yield begin, found.end()
            floor = found.end()
        else:
            floor = at + 1
        at = text.find("@", floor)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in the order of KINDS, then start; code points, end exclusive."""
    spans = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 13 <= len(d) <= 19 and _luhn(d):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                spans.append(("phone", *m.span()))
    return spans


def identifiers(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Tokens with an @ or at least three digits that no span overlaps."""
    taken = sorted((a, b) for _, a, b in spans)
    i = 0
    for m in _TOKEN.finditer(text):
        token = m.group()
        if "@" not in token and sum("0" <= c <= "9" for c in token) < 3:
            continue
        begin = m.start() + len(token) - len(token.lstrip(_EDGE))
        end = m.start() + len(token.rstrip(_EDGE))
        while i < len(taken) and taken[i][1] <= m.start():
            i += 1
        if end - begin >= 4 and not any(a < end and b > begin for a, b in taken[i : i + 8]):
            yield begin, end


def _lowered(text: str) -> str:
    return text.encode().lower().decode()  # A-Z only


def _named(word: str) -> str:
    """A word lower-cased A-Z; a very long one by its hash behind a space, which no word has."""
    if len(word) <= LONG_WORD:
        return _lowered(word)
    return f" {Words(pa.array([word])).hash.view(np.int64)[0]}"


class _Neighbours:
    """The words before and after spans of a text, whatever is between; empty at the text's bounds."""

    def __init__(self, text: str):
        self.words = [m.span() for m in _TOKEN.finditer(text)]
        self.begins = [a for a, _ in self.words]
        self.text, self.known = text, {}

    def _word(self, i: int) -> str:
        if not 0 <= i < len(self.words):
            return ""
        if i not in self.known:
            self.known[i] = _named(self.text[slice(*self.words[i])])
        return self.known[i]

    def __call__(self, begin: int, end: int) -> tuple[str, str]:
        return self._word(bisect_right(self.begins, begin) - 2), self._word(bisect_left(self.begins, end))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("before", pa.string()), ("after", pa.string())])
_FOUND = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(_SPAN)), ("others", pa.list_(_SPAN))])
_SPAN_SQL = "array<struct<kind: string, start: long, end: long, value: string, before: string, after: string>>"


def _scan(docs: DataFrame) -> DataFrame:
    """doc_id, spans (of the base kinds) and others (identifiers without a kind), with their neighbours."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            rows = []
            for text in part.column("text").to_pylist():
                text = text or ""
                if "@" not in text and not _HAS_DIGIT(text):
                    rows.append(([], []))
                    continue
                spans, near = base_spans(text), _Neighbours(text)
                describe = lambda kind, a, b: (kind, a, b, text[a:b], *near(a, b))
                rows.append(([describe(*s) for s in spans], [describe(None, *s) for s in identifiers(text, spans)]))
            names = [f.name for f in _SPAN]
            column = lambda i: pa.array([[dict(zip(names, s)) for s in r[i]] for r in rows], pa.list_(_SPAN))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), column(0), column(1)], schema=_FOUND)

    return docs.mapInArrow(scan, f"doc_id long, spans {_SPAN_SQL}, others {_SPAN_SQL}")


_HAS_DIGIT = re.compile("[0-9]").search


def _word_counts(docs: DataFrame) -> DataFrame:
    """word (hash), n: how often each word occurs; added up inside each task before anything is sent."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, sums = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        send = lambda: pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(sums)], ["word", "n"])
        for part in chunks(batches):
            names, which = np.unique(np.concatenate([names, Words(part.column("text")).hash]), return_inverse=True)
            weights = np.concatenate([sums, np.ones(len(which) - len(sums), np.int64)])
            sums = np.bincount(which, weights=weights, minlength=len(names)).astype(np.int64)
            if len(names) > 1_000_000:
                yield send()
                names, sums = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        yield send()

    return docs.select("text").mapInArrow(count, "word long, n long")


def _hashed(frame: DataFrame, column: str) -> DataFrame:
    """With word, the hash of a column that holds one word."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(column)
            hashes = Words(words).hash.view(np.int64).copy()
            for i, word in enumerate(words.to_pylist()):
                if word[0] == " ":  # a very long word is its hash
                    hashes[i] = int(word)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes)], [*batch.schema.names, "word"])

    return frame.mapInArrow(add, T.StructType([*frame.schema, T.StructField("word", T.LongType())]))


def patterns_and_instances(scanned: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(side, word, kind, score) of the sure patterns and (value, kind, score) of the accepted identifiers."""
    seen = scanned.select(F.explode(F.concat("spans", "others")).alias("s")).select("s.*")
    both = F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("text")) for s in ("before", "after")])
    sides = seen.select("kind", "value", F.explode(both).alias("p"))
    edges = stored(sides.where("p.text <> ''").groupBy("p.side", "p.text", "value", "kind").agg(F.count(F.lit(1)).alias("times")))
    # a pattern never counts that would have too few instances or too low a score if all it stands next to were accepted
    most = edges.groupBy("side", "text").agg(F.count_distinct("value").alias("values"), F.sum("times").alias("most")).where(F.col("values") >= LEAST_SEEDS)
    counted = _hashed(most.select("side", "text", "most"), "text").join(_word_counts(docs), "word").groupBy("side", "text").agg(F.max("most").alias("most"), F.sum("n").alias("total"))
    totals = stored(counted.where(F.col("most") >= SURE * F.col("total")).select("side", "text", "total"))
    edges = stored(edges.join(totals, ["side", "text"]).drop("total"))
    seeds = edges.where("kind is not null").select("side", "text", "kind", "value", F.col("times").cast("double").alias("mass"))
    open_ = edges.where("kind is null").drop("kind")
    accepted = None
    while True:
        # the value of an edge with a kind counts for that kind, that of one without for every kind that it was accepted for
        mass = seeds
        if accepted is not None:
            mass = seeds.unionByName(open_.join(accepted, "value").select("side", "text", "kind", "value", (F.col("times") * F.col("score")).alias("mass")))
        held = mass.groupBy("side", "text", "kind").agg(F.sum("mass").alias("mass"), F.count_distinct("value").alias("values")).where(F.col("values") >= LEAST_SEEDS)
        scored = held.join(totals, ["side", "text"]).withColumn("score", F.least(F.col("mass") / F.col("total"), F.lit(1.0)))
        patterns = stored(scored.where(F.col("score") >= SURE).select("side", "text", "kind", "score"))
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))
        before = accepted
        accepted = stored(open_.join(patterns, ["side", "text"]).groupBy("value", "kind").agg((1 - doubt).alias("score")).where(F.col("score") >= ACCEPT))
        rise = accepted
        if before is not None:
            rise = accepted.join(before.withColumnRenamed("score", "was"), ["value", "kind"], "left").where(F.col("was").isNull() | (F.col("score") - F.col("was") > SETTLED))
        if rise.isEmpty():
            break
    return patterns, accepted


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and found: arrays of (kind, start, end, value); the order is that of KINDS, then start."""
    docs = renamed(docs, doc_id=id_col, text=text_col)
    scanned = stored(_scan(docs).withColumn("row", F.monotonically_increasing_id()))
    _, accepted = patterns_and_instances(scanned, docs)
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    hits = scanned.select("row", F.explode("others").alias("s")).select("row", "s.value", "s.start", "s.end").join(accepted.select("value", "kind"), "value")
    per_row = hits.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(place.alias("place"), "start", "end", "kind", "value"))).alias("hits"))
    joined = scanned.join(per_row, "row", "left")
    found = F.transform(F.coalesce("hits", F.array()), lambda h: F.struct(h["kind"].alias("kind"), h["start"].alias("start"), h["end"].alias("end"), h["value"].alias("value")))
    base = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    return joined.select("doc_id", base.alias("base"), F.when(F.col("hits").isNull(), F.slice(base, 1, 0)).otherwise(found).alias("found"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def merged(base: Column, found: Column) -> Column:
    """All spans in the order of KINDS, then start."""
    keyed = F.transform(F.concat(base, found), lambda s: F.struct(F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"]).alias("place"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.sort_array(keyed)


def masked(text: str | None, spans: list) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            out += [(text or "")[at : s["start"]], f"<{s['kind']}>"]
            at = s["end"]
    return "".join([*out, (text or "")[at:]])
