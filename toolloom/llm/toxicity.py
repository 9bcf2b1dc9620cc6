"""Toxicity of texts: a learned lexicon, found with misspellings, weighed by what stands around it.

The lexicon holds words and word beginnings that toxic training texts have far more often than others. It is a trie; the
Levenshtein automaton of MOST_EDITS runs over it together with the word, so one pass over a word's letters finds every
term within that distance. The product of both is made deterministic state by state as words need it. Each hit gets a
context score from the words around it: quotation marks that enclose it and words of reporting make it a quotation.
Plain, misspelled and quoted hits are features of their own, and a logistic regression weighs them.

Learning uses at most most_rows labelled texts of each class, those whose ids have the lowest hashes; every text is
scored, whole. Labels, language, source and id are not inputs of a score.

Null and empty texts get the score of a text without hits. Texts of any length are scored in one pass. Labels
that are null, or for unknown documents, are left out; where a document has several, the highest holds. Without labels
of both classes every score is the share of toxic labels (0 without any). Repeated rows are scored alike. Other columns don't matter; those to keep come
back unchanged.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolloom.llm.words import chunks

MOST_EDITS = 1
FUZZY_LETTERS = 5
PREFIXES = (3, 4, 5, 6, 7, 8)
MOST_TERMS = 2000
MOST_ROWS = 3000
WINDOW = 6
WORDS_KEPT = 300_000
EDGE = ".,;:!?\"'()[]{}<>«»“”„‘’…-–—*_~/\\|"
QUOTES = "\"«»“”„‟"
REPORTING = {
    *("say", "says", "said", "saying", "write", "writes", "wrote", "written", "call", "calls", "called", "word", "words", "term"),
    *("quote", "quoted", "quotes", "quoting", "cited", "alleged", "comment", "commented", "reported", "insult", "insulted", "slur"),
    *("sagt", "sagte", "schrieb", "nannte", "wort", "zitat", "dit", "disait", "appelle", "mot", "citation"),
    *("dijo", "dice", "llamó", "palabra", "cita", "escribió"),
}
FEATURES = 7


class Lexicon:
    """terms: (text, whether any word that begins so counts, weight)."""

    def __init__(self, terms: Sequence[tuple[str, bool, float]]):
        self.terms = list(terms)
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.reach = [0]  # the most edits that any term below allows
        for number, (text, stem, _) in enumerate(self.terms):
            allowed = self.allowed(text, stem)
            node = 0
            self.reach[0] = max(self.reach[0], allowed)
            for letter in text:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({}), self.ends.append([]), self.reach.append(0)
                node = self.children[node][letter]
                self.reach[node] = max(self.reach[node], allowed)
            self.ends[node].append(number)
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.whole: list[tuple[int, int] | None] = []
        self.begun: list[tuple[int, int] | None] = []
        self.start = self._state({(0, 0)})

    @staticmethod
    def allowed(text: str, stem: bool) -> int:
        return MOST_EDITS if len(text) >= FUZZY_LETTERS + stem else 0

    def _state(self, places: set[tuple[int, int]]) -> int:
        todo = list(places)
        while todo:  # a letter of the term is missing in the word
            node, edits = todo.pop()
            for child in self.children[node].values():
                if edits < self.reach[child] and (child, edits + 1) not in places:
                    places.add((child, edits + 1)), todo.append((child, edits + 1))
        least: dict[int, int] = {}
        for node, edits in places:
            least[node] = min(edits, least.get(node, edits))
        key = frozenset(least.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key), self.steps.append({})
            found = [(edits, number) for node, edits in key for number in self.ends[node] if edits <= self.allowed(*self.terms[number][:2])]
            self.whole.append(self._nearer(*found)), self.begun.append(self._nearer(*[x for x in found if self.terms[x[1]][1]]))
        return self.states[key]

    def _step(self, state: int, letter: str) -> int:
        after = set()
        for node, edits in self.sets[state]:
            if edits < self.reach[node]:
                after.add((node, edits + 1))
            for other, child in self.children[node].items():
                if other == letter:
                    after.add((child, edits))
                elif edits < self.reach[child]:
                    after.add((child, edits + 1))
        self.steps[state][letter] = found = self._state(after) if after else -1
        return found

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, number) of the nearest term, if any; of equally near ones the heaviest."""
        if len(self.sets) > 200_000:
            self.__init__(self.terms)
        state, best = self.start, None
        for letter in word:
            following = self.steps[state].get(letter)
            state = self._step(state, letter) if following is None else following
            if state < 0:
                return best
            if begun := self.begun[state]:
                best = self._nearer(best, begun)
        return self._nearer(best, self.whole[state])

    def _nearer(self, *found: tuple[int, int] | None) -> tuple[int, int] | None:
        return min((x for x in found if x), key=lambda x: (x[0], -self.terms[x[1]][2], x[1]), default=None)


class Scanner:
    """Features of texts; the words that were looked up are remembered, up to a fixed number."""

    def __init__(self, terms: Sequence[tuple[str, bool, float]]):
        self.lexicon = Lexicon(terms)
        self.clean: set[str] = set()
        self.hits: dict[str, tuple[int, float]] = {}

    def features(self, text: str | None) -> list[float]:
        words = (text or "").lower().split()
        for w in set(words).difference(self.clean):
            if w not in self.hits:
                found = self.lexicon.match(bare) if len(bare := w.strip(EDGE)) > 2 else None
                if found:
                    self.hits[w] = (found[0], self.lexicon.terms[found[1]][2])
                else:
                    self.clean.add(w)
        out = [0.0] * FEATURES
        if self.hits:
            hits = self.hits
            for i, w in enumerate(words):
                if w in hits:
                    edits, weight = hits[w]
                    kind = 4 if quotation(words, i) >= 1 else 2 if edits else 0
                    out[kind] += 1
                    out[kind + 1] += weight
            out[6] = (out[0] + out[2]) / max(1, len(words)) * 100
        if len(self.clean) > WORDS_KEPT:
            self.clean.clear()
        if len(self.hits) > WORDS_KEPT:
            self.hits.clear()
        return [math.log1p(x) for x in out]


def quotation(words: Sequence[str], i: int) -> float:
    """How much the words around word i say that it is quoted: 1 if marks enclose it, half for a word of reporting."""
    before, after = words[max(0, i - WINDOW) : i], words[i + 1 : i + 1 + WINDOW]
    own = words[i]
    opened = own[0] in QUOTES or any(w[0] in QUOTES and w[-1] not in QUOTES for w in before)
    closed = own.rstrip(".,;:!?")[-1:] in QUOTES if own.rstrip(".,;:!?") else False
    closed = closed or any(w.rstrip(".,;:!?")[-1:] in QUOTES and w[0] not in QUOTES for w in after if w.rstrip(".,;:!?"))
    said = any(w.strip(EDGE) in REPORTING for w in (*before, *after))
    return (1.0 if opened and closed else 0.0) + (0.5 if said else 0.0)


@dataclass
class Model:
    terms: list[tuple[str, bool, float]]
    weights: np.ndarray  # the last one is the constant
    fallback: float | None = None

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.fallback is not None:
            return np.full(len(features), self.fallback)
        x = np.column_stack([features, np.ones(len(features))])
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -35, 35)))


def _term_counts(labelled: DataFrame) -> DataFrame:
    """term, stem, toxic, other: in how many texts of each class a word or word beginning occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {0: Counter(), 1: Counter()}
        for part in chunks(batches):
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                words = {w.strip(EDGE) for w in (text or "").lower().split()}
                words = {w for w in words if 2 < len(w) <= 40}
                counts[toxic].update({(w, False) for w in words} | {(w[:n], True) for w in words for n in PREFIXES if len(w) > n})
            if len(counts[0]) + len(counts[1]) > WORDS_KEPT:
                yield flush(counts)
        yield flush(counts)

    def flush(counts) -> pa.RecordBatch:
        keys = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_())]
        columns += [pa.array([counts[y][k] for k in keys], pa.int64()) for y in (1, 0)]
        out = pa.RecordBatch.from_arrays(columns, ["term", "stem", "toxic", "other"])
        counts[0].clear(), counts[1].clear()
        return out

    return labelled.mapInArrow(count, "term string, stem boolean, toxic long, other long").groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _choose_terms(found: list, n_toxic: int, n_other: int) -> list[tuple[str, bool, float]]:
    """The terms in the order of texts times weight, without those that continue a beginning taken before, which finds all their words."""
    scored = []
    for r in found:
        odds = math.log((r.toxic + 0.5) / (n_toxic + 1)) - math.log((r.other + 0.5) / (n_other + 1))
        scored.append((-round(r.toxic * odds, 6), -len(r.term) - (not r.stem), r.term, r.stem, odds))
    beginnings: set[str] = set()
    terms = []
    for _, _, term, stem, odds in sorted(scored):
        if any(term[:n] in beginnings for n in range(1, len(term) + 1)):
            continue
        if stem:
            beginnings.add(term)
        terms.append((term, stem, odds))
    return terms


def _own_evidence(sample: DataFrame, terms: list[tuple[str, bool, float]], least: int, n_toxic: int, n_other: int) -> list[tuple[str, bool, float]]:
    """The terms that pass by the words that no term before finds; their weights are those of these words.

    To the driver comes, for each text, by which terms its words are found, each combination once.
    """
    number = {(text, stem): i for i, (text, stem, _) in enumerate(terms)}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            rows = []
            for text in part.column("text").to_pylist():
                found = set()
                for w in {w.strip(EDGE) for w in (text or "").lower().split()}:
                    by = [number[k] for k in [(w, False), *((w[:n], True) for n in PREFIXES if n <= len(w))] if k in number]
                    if by:
                        found.add(tuple(by))
                rows.append([list(x) for x in found])
            yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(rows, pa.list_(pa.list_(pa.int32())))], ["toxic", "found"])

    texts: dict[tuple[int, ...], tuple[set[int], set[int]]] = {}
    for i, r in enumerate(sample.mapInArrow(find, "toxic int, found array<array<int>>").collect()):
        for by in r.found:
            texts.setdefault(tuple(by), (set(), set()))[r.toxic].add(i)
    finds: dict[int, list[tuple[int, ...]]] = {}
    for by in texts:
        for i in by:
            finds.setdefault(i, []).append(by)
    kept: set[int] = set()
    out = []
    for i, (text, stem, _) in enumerate(terms):
        left = [texts[by] for by in finds.get(i, []) if kept.isdisjoint(by)]
        other, toxic = (len(set().union(*(x[y] for x in left))) for y in (0, 1))
        odds = math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((other + 0.5) / (n_other + 1))
        if toxic >= least and odds - 1.5 * math.sqrt(1 / (toxic + 0.5) + 1 / (other + 0.5)) > math.log(4):
            kept.add(i)
            out.append((text, stem, odds))
    return out


def _regression(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Logistic regression by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    b = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -35, 35)))
        gradient = x.T @ (weight * (y - p)) - penalty * b
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty), gradient)
        step *= min(1.0, 4 / max(1e-12, np.abs(step).max()))
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def learn(docs: DataFrame, labels: DataFrame, usable: Column | None = None, most_rows: int = MOST_ROWS) -> Model:
    """docs: doc_id, text; labels: doc_id, toxic. usable: a condition on the labels' doc_id, of those to learn from.

    To the driver come the chosen rows' features and the terms that pass, at most 2 * most_rows and MOST_TERMS.
    """
    given = labels.where("toxic in (0, 1) and doc_id is not null")
    given = (given if usable is None else given.where(usable)).groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = [given.where(F.col("toxic") == y).orderBy(F.xxhash64("id"), "id").limit(most_rows) for y in (0, 1)]
    sample = docs.select("doc_id", "text").join(chosen[0].unionByName(chosen[1]), F.col("doc_id") == F.col("id")).select("text", "toxic")
    sample = sample.repartition(max(8, int(docs.sparkSession.sparkContext.defaultParallelism)))
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    totals = {r.toxic: r.n for r in given.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = [sizes.get(0, 0), sizes.get(1, 0)]
    if not all(n):
        return Model([], np.zeros(FEATURES + 1), float(bool(n[1])))
    least = max(2, math.ceil(0.004 * n[1]))
    # far more often in toxic texts, by half as many smoothed odds again as chance would give
    odds = F.log((F.col("toxic") + 0.5) / (n[1] + 1.0)) - F.log((F.col("other") + 0.5) / (n[0] + 1.0))
    sure = odds - 1.5 * F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("other") + 0.5))
    found = _term_counts(sample).where((F.col("toxic") >= least) & (sure > math.log(4))).orderBy(F.desc(F.col("toxic") * odds), "term", "stem").limit(MOST_TERMS).collect()
    terms = _own_evidence(sample, _choose_terms(found, n[1], n[0]), least, n[1], n[0])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(terms)
        for part in chunks(batches):
            rows = [scanner.features(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "features"])

    rows = sample.mapInArrow(features, "toxic int, features array<double>").collect()
    rows.sort(key=lambda r: (r.toxic, r.features))
    y = np.array([r.toxic for r in rows], float)
    weight = np.where(y == 1, totals[1] / n[1], totals[0] / n[0])
    return Model(terms, _regression(np.array([r.features for r in rows]), y, weight / weight.mean()))


def score(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns to keep, under the names kept_*, and score. One pass, no shuffle; the model is of bounded size."""
    kept = docs.select(docs[text_col].alias("text"), *[docs[c].alias(f"kept_{c}") for c in keep])
    schema = kept.schema[1:].add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(model.terms)
        for part in chunks(batches):
            found = model.score(np.array([scanner.features(t) for t in part.column("text").to_pylist()]).reshape(-1, FEATURES))
            yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(found, pa.float64())], [*part.schema.names[1:], "score"])

    return kept.mapInArrow(run, schema)
