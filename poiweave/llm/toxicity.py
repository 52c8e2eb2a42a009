"""Toxicity: Levenshtein automata over a lexicon trie, with context windows around each hit.

The lexicon is learned from labelled rows: whole words and word beginnings that occur in toxic documents far more
often than in others. Its entries stand in a trie; the product of the trie with the Levenshtein
automaton of each entry is made deterministic as it is used, so a word is read once, whatever the number of
entries. Entries of five letters and more match within one edit, of nine and more within two, unless the word found is an ordinary
word of the labelled documents.

The window around each hit tells abuse from quotation: a hit between quotation marks, or next to a reporting
word, counts as quoted. A logistic model over the document's hits gives the score.

Fitting uses at most ``SAMPLE`` labelled rows and ``LEXICON`` entries; scoring is one pass without a shuffle.

Defined cases: a null or empty text has no hit and gets the score of a document without hits; a row is scored by its text
alone; without labels of both kinds, or without any entry, the score is the share of label 1 (0 if unknown); other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poiweave.llm import arrays as ar
from poiweave.llm.sample import base_rate, held_out, labelled_sample

SAMPLE = 12000
THRESHOLD = 0.3
LEAST_DOCS = 4
# Weights before any data: a word one or two edits away says less than the term itself.
PRIOR = (0.0, 0.0, 3.0, 5.0, 0.0, 0.0)
LEAST_G = 25.0
LEAST_RATIO = 10.0
BEGINNINGS = (4, 5, 6)
WINDOW = 5
CACHE = 200_000
_MORE = "\x01"  # marks a word beginning
_WORD = re.compile(r"\w+(?:[@$*!|]\w+)*")
_OPEN, _CLOSE = "\"“„«‘", "\"”“»’"
_REPORTING = frozenset("said says wrote writes called quote quoted quoting word term phrase slur dit écrit citation mot sagte schrieb zitat wort dijo escribió cita palabra".split())


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def allowed_edits(entry: str) -> int:
    n = len(entry)
    if entry.endswith(_MORE):
        return 1 if n > 6 else 0  # a short beginning matches exactly
    return 2 if n >= 9 else 1 if n >= 5 else 0


class Automaton:
    """Product of the lexicon trie and the Levenshtein automata, made deterministic on demand."""

    def __init__(self, entries: list[str]):
        # Words hang from node 0 and beginnings from node 1, as what follows a beginning is free and what follows a word is not.
        self.children: list[dict[str, int]] = [{}, {}]
        self.ends: list[tuple[int, bool, int] | None] = [None, None]
        self.most = [0, 0]
        for number, entry in enumerate(entries):
            edits, begins = allowed_edits(entry), entry.endswith(_MORE)
            node = int(begins)
            self.most[node] = max(self.most[node], edits)
            for c in entry.rstrip(_MORE):
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], edits)
            self.ends[node] = (number, begins, edits)
        self._reset()

    def _reset(self) -> None:
        self.numbers: dict[frozenset, int] = {frozenset(): 0}
        self.sets: list[frozenset] = [frozenset()]
        self.steps: dict[tuple[int, str], int] = {}
        self.final: dict[int, tuple[int, int] | None] = {}
        self.start = self._number(self._closed({0: 0, 1: 0}))

    def _closed(self, least: dict[int, int]) -> frozenset:
        """With the states reached by leaving out letters of an entry."""
        todo = list(least.items())
        while todo:
            node, edits = todo.pop()
            for child in self.children[node].values():
                if edits + 1 <= self.most[child] and least.get(child, 9) > edits + 1:
                    least[child] = edits + 1
                    todo.append((child, edits + 1))
        return frozenset(least.items())

    def _number(self, states: frozenset) -> int:
        if states not in self.numbers:
            self.numbers[states] = len(self.sets)
            self.sets.append(states)
        return self.numbers[states]

    def _step(self, state: int, c: str) -> int:
        least: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.most[node] and least.get(node, 9) > edits:
                least[node] = edits

        for node, edits in self.sets[state]:
            end = self.ends[node]
            if end and end[1] and edits <= end[2]:
                reach(node, edits)  # the beginning has matched; what follows is free
            reach(node, edits + 1)
            for letter, child in self.children[node].items():
                reach(child, edits if letter == c else edits + 1)
        return self._number(self._closed(least))

    def match(self, word: str) -> tuple[int, int] | None:
        """The closest entry and its number of edits, if any is near enough."""
        if len(self.sets) > 50_000:
            self._reset()
        state = self.start
        for c in word:
            following = self.steps.get((state, c))
            if following is None:
                following = self.steps[state, c] = self._step(state, c)
            state = following
            if not state:
                return None
        if state not in self.final:
            found = [(e, self.ends[n][0]) for n, e in self.sets[state] if self.ends[n] and e <= self.ends[n][2]]
            self.final[state] = min(found)[::-1] if found else None
        return self.final[state]


def in_quotes(text: str, start: int, end: int) -> bool:
    """Whether quotation marks open before and close after the span, within its line."""
    lo, hi = text.rfind("\n", 0, start) + 1, text.find("\n", end)
    before, after = text[max(lo, start - 200) : start], text[end : hi if 0 <= hi < end + 200 else end + 200]
    straight = before.count('"') % 2 == 1 and '"' in after
    curly = max(before.rfind(c) for c in _OPEN[1:]) > max(before.rfind(c) for c in _CLOSE[1:] if c not in _OPEN) and any(c in after for c in _CLOSE[1:])
    return straight or curly


FEATURES = 6


class Reader:
    """Measures of a document's hits; keeps a bounded memory of words already read."""

    def __init__(self, entries: list[str], innocent: frozenset[str] = frozenset()):
        self.automaton, self.innocent, self.known = Automaton(entries), innocent, {}

    def closest(self, word: str) -> tuple[int, int] | None:
        return None if word in self.innocent else self.automaton.match(word)

    def hits(self, text: str) -> list[tuple[str, int, int, int, int]]:
        """Word, start, end, entry and edits of each hit."""
        low = text.lower()
        found = set()
        for word in set(_WORD.findall(low)):
            if word not in self.known:
                if len(self.known) >= CACHE:
                    self.known.clear()
                self.known[word] = self.closest(word)
            if self.known[word] is not None:
                found.add(word)
        if not found:
            return []
        return [(m[0], m.start(), m.end(), *self.closest(m[0])) for m in _WORD.finditer(low) if m[0] in found]

    def measures(self, text: str) -> list[float]:
        hits = self.hits(text)
        if not hits:
            return [0.0] * FEATURES
        low = text.lower()
        exact = near = quoted = 0
        for _, start, end, _, edits in hits:
            window = low[max(0, start - 12 * WINDOW) : end + 12 * WINDOW]
            around = _WORD.findall(window)
            if in_quotes(low, start, end) or not _REPORTING.isdisjoint(around):
                quoted += 1
            elif edits:
                near += 1
            else:
                exact += 1
        rate = 100 * exact / (1 + text.count(" "))
        return [float(exact > 0), np.log1p(exact), float(near > 0), np.log1p(near), np.log1p(quoted), np.log1p(rate)]


@dataclass
class Model:
    entries: list[str]
    weights: np.ndarray
    bias: float
    innocent: frozenset[str] = frozenset()


def _terms(word: str) -> list[str]:
    return [word, *(word[:k] + _MORE for k in BEGINNINGS if len(word) > k)] if len(word) >= 3 else []


def _toxic_terms(batches):
    """Each term of a toxic document with the word before its first place: copies of a document add no new pair."""
    for batch in batches:
        found = set()
        for text in ar.column(batch, "text").to_pylist():
            own = words_of(text or "")
            found |= {t: before for before, w in reversed([*zip(["", *own], own)]) for t in _terms(w)}.items()
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], pa.string()), pa.array([b for _, b in found], pa.string())], ["term", "before"])


def _clean_terms(batches):
    for batch in batches:
        count = Counter()
        for text in ar.column(batch, "text").to_pylist():
            count.update({t for w in set(words_of(text or "")) for t in _terms(w)})
        yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], ["term", "clean"])


def pick_entries(terms: list[tuple[str, int, int]]) -> list[str]:
    """Entries from ``(term, toxic, clean)``: all words, each with its own edits, and beginnings that cover
    clearly more documents than each of their words, the longest such beginning."""
    by = {t: n for t, n, _ in terms}
    begins = sorted((t for t in by if t.endswith(_MORE)), key=len)
    # By the letters they begin with: documents of the most frequent word, and of the most frequent longer beginning.
    word, longer = Counter(), Counter()
    for t, n in by.items():
        stem = t.removesuffix(_MORE)
        for k in BEGINNINGS:
            if t == stem and len(stem) >= k:
                word[stem[:k]] = max(word[stem[:k]], n)
            elif t != stem and len(stem) > k:
                longer[stem[:k]] = max(longer[stem[:k]], n)
    kept: set[str] = set()
    for b in begins:
        stem = b[:-1]
        if word[stem] < 0.8 * by[b] and longer[stem] < 0.95 * by[b] and not any(stem[:k] in kept for k in range(1, len(stem) + 1)):
            kept.add(stem)
    return sorted([stem + _MORE for stem in kept] + [t for t in by if not t.endswith(_MORE)])


def learn_entries(sample: DataFrame, toxic: int, clean: int) -> list[str]:
    """The terms whose share among toxic documents is far above that among others (G test).

    A term counts once in a document, and once for each word before it, so that copies of a document do not make
    terms of its words. All significant terms are taken; their number is bounded by the labelled sample alone.
    """
    seen = sample.filter("label = 1").select("text").mapInArrow(_toxic_terms, "term string, before string").distinct().groupBy("term").agg(F.least(F.count("*"), F.lit(toxic)).alias("toxic"))
    seen = seen.filter(F.col("toxic") >= LEAST_DOCS)
    others = sample.filter("label = 0").select("text").mapInArrow(_clean_terms, "term string, clean long").groupBy("term").agg(F.sum("clean").alias("clean"))
    counts = seen.join(others, "term", "left").withColumn("clean", F.coalesce("clean", F.lit(0)))
    t, c, n = F.col("toxic"), F.col("clean"), toxic + clean
    et, ec = (t + c) * (toxic / n), (t + c) * (clean / n)
    g = 2 * (t * F.log(t / et) + F.when(c > 0, c * F.log(c / ec)).otherwise(0.0))
    ratio = ((t + 0.5) / (toxic + 1)) / ((c + 0.5) / (clean + 1))
    rows = counts.withColumn("g", g).filter((F.col("g") >= LEAST_G) & (ratio >= LEAST_RATIO)).orderBy("term").collect()
    return pick_entries([(r.term, r.toxic, r.clean) for r in rows])


def _near_words(entries: list[str]):
    def run(batches):
        reader = Reader(entries)
        for batch in batches:
            count = Counter()
            for text, label in zip(ar.column(batch, "text").to_pylist(), ar.column(batch, "label").to_pylist()):
                count.update((h[0], label) for h in {h[0]: h for h in reader.hits(text or "") if h[4]}.values())
            names = sorted({w for w, _ in count})
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([count[w, v] for w in names], pa.int64()) for v in (1, 0))], ["word", "toxic", "clean"])

    return run


def learn_innocent(sample: DataFrame, entries: list[str], toxic: int, clean: int) -> frozenset[str]:
    """Words near an entry that are ordinary words: no more frequent in toxic documents than in others."""
    counts = sample.mapInArrow(_near_words(entries), "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    found = counts.filter(F.col("toxic") * clean <= 3 * F.col("clean") * toxic)
    return frozenset(r.word for r in found.collect())


def _measured(entries: list[str], innocent: frozenset[str]):
    def run(batches):
        reader = Reader(entries, innocent)
        for batch in batches:
            rows = [reader.measures(x or "") for x in ar.column(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([ar.column(batch, "label"), pa.array(rows, pa.list_(pa.float64()))], ["label", "x"])

    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Lexicon and logistic weights from a bounded sample of labelled rows outside the held-out part."""
    rate = base_rate(labels, "toxic")
    rows = labelled_sample(docs, labels, "toxic", sample).select("text", "label")
    by = dict(rows.groupBy("label").count().collect())
    toxic, clean = by.get(1, 0), by.get(0, 0)
    entries = learn_entries(rows, toxic, clean) if toxic and clean else []
    if not entries:
        return Model([], np.zeros(FEATURES), float(np.log(max(rate, 1e-6) / max(1 - rate, 1e-6))) if toxic + clean else -50.0)
    innocent = learn_innocent(rows, entries, toxic, clean)
    got = rows.mapInArrow(_measured(entries, innocent), "label int, x array<double>").collect()
    x, y = np.array([r.x for r in got]), np.array([r.label for r in got], np.float64)
    w = np.where(y == 1, rate / toxic, (1 - rate) / clean) * len(y)
    x1, theta = np.c_[x, np.ones(len(x))], np.zeros(FEATURES + 1)
    keep, prior = 0.05 * np.r_[np.ones(FEATURES), 1e-3], np.r_[PRIOR, 0.0]
    for _ in range(30):
        p = 1 / (1 + np.exp(-x1 @ theta))
        h = (x1 * (w * p * (1 - p))[:, None]).T @ x1 + np.diag(keep)
        theta = theta + np.clip(np.linalg.solve(h, x1.T @ (w * (y - p)) - keep * (theta - prior)), -2, 2)
    return Model(entries, theta[:-1], float(theta[-1]), innocent)


def _scores(model: Model):
    def run(batches):
        reader = Reader(model.entries, model.innocent)
        for batch in batches:
            x = np.array([reader.measures(t or "") for t in ar.column(batch, "text").to_pylist()]).reshape(-1, FEATURES)
            score = 1 / (1 + np.exp(-np.clip(x @ model.weights + model.bias, -50, 50)))
            yield pa.RecordBatch.from_arrays([ar.column(batch, "doc_id"), ar.column(batch, "held_out"), pa.array(score), pa.array(np.expm1(x[:, 1] + 0).round().astype(np.int64))], ["doc_id", "held_out", "score", "n_terms"])

    return run


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, n_terms (hits that count as abuse without an edit) and predicted for every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(_scores(model), "doc_id long, held_out boolean, score double, n_terms long")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
