"""Language-model scores: log10 probability of each whole text under n-grams counted on all training texts.

The model is a weighted automaton. Its states are the word sequences (up to order - 1 words) that training texts hold,
its arcs their continuations. With c the counts, h a state and h' the state one word shorter,

    P(w | h) = (c(h w) + m * P(w | h')) / (c(h) + m),        P(w) = (c(w) + 1) / (N + V + 1)

so an arc weighs log10 P(w | h), and where h has no arc for w the failure arc to h' weighs log10(m / (c(h) + m)). An arc leads to the longest
state that ends in its word. One pass from left to right carries the state through each text and notes the arcs; their weights and those of
the failures on the way are then summed. The strength m that suits a text depends on whether the corpus
holds its like, so the text's probability is the mean of those under each of STRENGTHS; the last is infinite, the
unigrams alone. All strengths share the states, so one pass serves them.

No task holds the whole automaton. Documents are dealt over parts; each part sends its own n-grams, counted, to where all parts'
counts of an n-gram are added, and gets the totals back: the piece of the automaton that its texts can visit.

Null and empty texts have the end as their only token. A-Z count as a-z; words are runs of bytes other than space and
\\x09-\\x0D. Rows with a null id are scored like others and train if the given condition says so. Repeated rows count as often as they
occur, and equal texts get equal scores. A very long text is one walk like any other; its part is held in one task. Without training texts all known counts are 0. An empty table gives an empty result. Only the named columns are looked at.

Words are told apart by 48 bits of their hash, longer n-grams by 40, besides their bucket.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolloom.llm.common import shuffle_partitions, stored
from toolloom.llm.exchange import dealt, long, narrow, short, split_keys, unpacked, wide
from toolloom.llm.words import Words, chunks, mix

ORDER = 3
PART_CHARS = 6_000_000
KEY_BYTES = (6, 5)
STRENGTHS = (4.0, 64.0, 1024.0, 16384.0, math.inf)
START, END = np.uint64(0x51A7), np.uint64(0xE4D)
_FACTOR = mix(np.arange(71, 71 + 16, dtype=np.uint64)) | np.uint64(1)


class Grams:
    """The tokens of some texts in a row and, for each order, the sorted distinct n-grams and which one ends at each token.

    bound: first token of each text, and the end. at[k]: number of the (k + 1)-gram at each token, -1 where the text
    has no such many tokens yet; the start of a text counts as one token, but only as history.
    """

    def __init__(self, texts: pa.Array, order: int):
        hashes, counts = [], []
        for part in chunks(iter([pa.record_batch([texts], ["text"])])):
            words = Words(part.column("text"))
            hashes.append(words.hash), counts.append(words.count)
        count = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.bound = np.concatenate(([0], np.cumsum(count + 1)))
        tokens = np.full(self.bound[-1], END)
        inside = np.ones(len(tokens), bool)
        inside[self.bound[1:] - 1] = False
        tokens[inside] = flat
        place = np.arange(len(tokens)) - np.repeat(self.bound[:-1], count + 1)
        self.keys: list[np.ndarray] = []
        self.at: list[np.ndarray] = []
        for k in range(order):
            grams = tokens * _FACTOR[0]
            for j in range(1, k + 1):
                before = np.full(len(tokens), START)
                before[j:] = tokens[: len(tokens) - j]
                before[place < j] = START
                grams = grams + before * _FACTOR[j]
            grams = mix(grams + np.uint64(k))
            exists = place + 1 >= k
            if k == 1:  # the start as a state of its own, known by how many texts there are
                keys, at = np.unique(np.append(grams, [START]), return_inverse=True)
                self.start, at = int(at[-1]), at[:-1]
            else:
                keys, at = np.unique(grams, return_inverse=True)
            self.keys.append(keys)
            self.at.append(np.where(exists, at, -1))

    def counted(self, train: np.ndarray) -> list[np.ndarray]:
        """How often each n-gram occurs in the texts to train on."""
        used = np.repeat(train, np.diff(self.bound))
        found = []
        for k, (keys, at) in enumerate(zip(self.keys, self.at)):
            c = np.bincount(at[used & (at >= 0)], minlength=len(keys))
            if k == 1:
                c[self.start] = int(train.sum())
            found.append(c.astype(np.uint32))
        return found


_SENT = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("sizes", pa.list_(pa.int64())), ("keys", pa.list_(pa.binary())), ("counts", pa.binary())])
_TOTALS = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("totals", pa.binary()), ("tokens", pa.int64()), ("kinds", pa.int64())])


def _send(order: int, buckets: int):
    def send(table: pa.Table) -> pa.Table:
        grams = Grams(unpacked(table.column("text")), order)
        counts = grams.counted(table.column("train").to_numpy(zero_copy_only=False).astype(bool))
        rows = []
        for b, mine in split_keys(grams.keys, buckets):
            keys = [narrow(k[m], KEY_BYTES[i > 0]) for i, (k, m) in enumerate(zip(grams.keys, mine))]
            rows.append((b, [len(m) for m in mine], keys, short(np.concatenate([c[m] for c, m in zip(counts, mine)]))))
        part = table.column("part")[0].as_py()
        columns = list(zip(*rows)) if rows else [[]] * 4
        return pa.Table.from_arrays([pa.array([part] * len(rows), pa.int32()), *[pa.array(c, f.type) for c, f in zip(columns, list(_SENT)[1:])]], schema=_SENT)

    return send


def _add(table: pa.Table) -> pa.Table:
    """Of one bucket: for each part the totals of its n-grams, in its order. Part -1 says how many training tokens and kinds there are."""
    bucket = table.column("bucket")[0].as_py()
    sizes = table.column("sizes").to_pylist()
    counts = [long(x.as_py(), sum(s)) for x, s in zip(table.column("counts"), sizes)]
    keys = table.column("keys").to_pylist()
    out = [[] for _ in sizes]
    tokens = kinds = 0
    for k in range(len(sizes[0])):
        own = [c[sum(s[:k]) : sum(s[: k + 1])] for c, s in zip(counts, sizes)]
        names, which = np.unique(np.concatenate([wide(x[k], KEY_BYTES[k > 0]) for x in keys]), return_inverse=True)
        totals = np.bincount(which, weights=np.concatenate(own), minlength=len(names)).astype(np.int64)
        if k == 0:
            tokens, kinds = int(totals.sum()), int((totals > 0).sum())
        at = 0
        for i, s in enumerate(sizes):
            out[i].append(totals[which[at : at + s[k]]])
            at += s[k]
    packed = [short(np.concatenate(x)) for x in out]
    n = len(packed)
    columns = ([*table.column("part").to_pylist(), -1], [bucket] * (n + 1), [*packed, None], [None] * n + [tokens], [None] * n + [kinds])
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TOTALS)], schema=_TOTALS)


class Automaton:
    """The states that the texts of a part can visit, with their arcs and failure arcs.

    Number 0 is the empty state; every n-gram has a number above, as the arc of its last word from the state of the words before it (source)
    and, if it is shorter than order, as the state of its words. fail: the n-gram without its first word. target: the state an arc leads
    to. arcs[k]: for each token of the texts the arc from a state of k words, -1 where training texts have none. Words alone always have one.
    """

    def __init__(self, grams: Grams, counts: list[np.ndarray]):
        order, n = len(grams.keys), len(grams.at[0])
        first = np.cumsum([1, *map(len, grams.keys)])
        number = [np.where(at >= 0, at + f, 0) for at, f in zip(grams.at, first)]
        self.count = np.concatenate(([0], *counts))
        self.size = np.zeros(first[-1], np.int64)
        self.fail, self.source = np.zeros_like(self.size), np.zeros_like(self.size)
        self.levels = [slice(a, b) for a, b in zip(first, first[1:])]
        for k, level in enumerate(self.levels):
            self.size[level] = k + 1
            if k:
                self.fail[number[k]] = number[k - 1]
                self.source[number[k][1:]] = number[k - 1][:-1]
        self.start = 0
        if order > 1:
            begin = first[1] + grams.start
            self.size[begin] = 1
            self.source[number[1][grams.bound[:-1]]] = begin
            self.start = int(begin) if self.count[begin] > 0 else 0
        self.fail[0] = self.source[0] = 0
        has_state = (self.size < order) & (self.count > 0)
        self.target = np.where(has_state, np.arange(len(self.size)), self.fail)
        self.arcs = [number[0], *[np.where(self.count[x] > 0, x, -1) for x in number[1:]]]
        self.bound, self.tokens = grams.bound, n

    def walk(self) -> tuple[np.ndarray, np.ndarray]:
        """One pass over the texts, from left to right: the state in which each token was met, and the arc it took from there or after failures."""
        met, took = array("q"), array("q")
        size, fail, target = map(memoryview, (self.size, self.fail, self.target))
        arcs = [memoryview(x) for x in self.arcs]
        for begin, end in pairwise(self.bound.tolist()):
            state = self.start
            for i in range(begin, end):
                met.append(state)
                arc = arcs[size[state]][i]
                while arc < 0:
                    state = fail[state]
                    arc = arcs[size[state]][i]
                took.append(arc)
                state = target[arc]
        return np.frombuffer(met, np.int64), np.frombuffer(took, np.int64)

    def weights(self, strength: float, n: int, v: int) -> tuple[np.ndarray, np.ndarray]:
        """log10 of each arc's probability, and of each state's failures down to the empty state."""
        p, down = np.ones(len(self.size)), np.zeros(len(self.size))
        for k, level in enumerate(self.levels):
            shorter = self.fail[level]
            if k == 0:
                p[level] = (self.count[level] + 1) / (n + v + 1.0)
            elif strength == math.inf:
                p[level] = p[shorter]
            else:
                p[level] = (self.count[level] + strength * p[shorter]) / (self.count[self.source[level]] + strength)
            if strength < math.inf:
                down[level] = down[shorter] - np.log10(1 + self.count[level] / strength)
        return np.log10(p), down


def traverse(grams: Grams, counts: list[np.ndarray], n: int, v: int) -> Iterator[np.ndarray]:
    """log10 P of each token, for each of the strengths: the failures on its way and its arc."""
    automaton = Automaton(grams, counts)
    met, took = automaton.walk()
    left = automaton.source[took]
    for strength in STRENGTHS:
        arc, down = automaton.weights(strength, n, v)
        yield down[met] - down[left] + arc[took]


def _score(order: int, buckets: int, n: int, v: int):
    def score(docs: pa.Table, totals: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), ("train", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        if not docs.num_rows:
            return schema.empty_table()
        grams = Grams(unpacked(docs.column("text")), order)
        counts = [np.zeros(len(k), np.float64) for k in grams.keys]
        sent = {b: t for b, t in zip(totals.column("bucket").to_pylist(), totals.column("totals").to_pylist())}
        for b, mine in split_keys(grams.keys, buckets):
            found = long(sent[b], sum(map(len, mine)))
            for c, m, x in zip(counts, mine, np.split(found, np.cumsum([len(m) for m in mine])[:-1])):
                c[m] = x
        begins = grams.bound[:-1]
        own = counts[0][grams.at[0]]
        known = np.add.reduceat((own > 0).astype(np.int64), begins)
        each = np.stack([np.add.reduceat(x, begins) for x in traverse(grams, counts, n, v)])
        top = each.max(axis=0)
        mean = top + np.log10(np.power(10.0, each - top).mean(axis=0))
        given = [docs.column(c).combine_chunks() for c in ("doc_id", "train")]
        return pa.Table.from_arrays([*given, *map(pa.array, (np.diff(grams.bound), known, each[-1], mean))], schema=schema)

    return score


def score_texts(docs: DataFrame, train: Column, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, kinds, base_score, score of each row.

    train is a condition on the columns of docs; null counts as false. To the driver come sums only.
    """
    spark = docs.sparkSession
    named = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    chars = named.agg(F.coalesce(F.sum(F.length("text") + 1), F.lit(0)).alias("n")).first().n
    parts = max(shuffle_partitions(spark), math.ceil(chars / PART_CHARS))
    texts = dealt(named, parts)
    sent = texts.groupBy("part").applyInArrow(_send(order, parts), "part int, bucket int, sizes array<long>, keys array<binary>, counts binary")
    totals = stored(sent.groupBy("bucket").applyInArrow(_add, "part int, bucket int, totals binary, tokens long, kinds long"))
    sums = totals.where("part = -1").agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"), F.coalesce(F.sum("kinds"), F.lit(0)).alias("v")).first()
    pieces = totals.where("part >= 0").select("part", "bucket", "totals")
    both = texts.groupBy("part").cogroup(pieces.groupBy("part"))
    scored = both.applyInArrow(_score(order, parts, sums.n, sums.v), "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "train", "n_tokens", "n_known", F.lit(sums.n).cast("long").alias("train_tokens"), F.lit(sums.v).cast("long").alias("kinds"), "base_score", "score")
