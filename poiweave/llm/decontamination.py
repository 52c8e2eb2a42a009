"""Benchmark decontamination: BM25 over an inverted index of test items, searched with block-max WAND.

Every passage of every document (``PASSAGE`` words, each starting half a passage after the last) is a
query. An item is retrieved when the passage reaches a set share of the item's own score, so all posting weights are divided
by that bar and one threshold of 1 holds for every item; nothing is cut to a top k.

Postings lie in blocks of ``BLOCK`` items with the greatest weight of each term. The search goes over all passages of a slice at
once: for each passage and block it sums the block maxima of the passage's terms, and only blocks whose sum can reach the
threshold are opened and scored item by item. The most frequent terms are not looked up for this: together they can add at most
``COMMON`` to an item of a block, and that most is added to the block's sum, as in WAND's lists before the pivot.

Retrieved items are verified on the words around the passage: the share of the question's distinct five-word shingles found there, and
the share of the answer's. An item's answer is its last sentence.

The index is sent to every task. Items are split into shards of at most ``SHARD_BYTES`` of text, each with an
index of its own and one pass over the documents; a benchmark below that is one pass without a shuffle. Document frequencies, the number of items and
their mean length are those of the whole benchmark, counted by Spark, so scores and bars do not depend on the shards. The driver holds one shard at a time: its pass is
written to the shared folder before the next is built.

Defined cases: null or empty texts have no passage, null or empty items are never found; a question or answer of fewer than five words is one
shingle; repeated items are found each; repeated rows are each judged; empty tables leave all documents; other columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poiweave.llm import arrays as ar
from poiweave.llm.shared import discard, stored

PASSAGE = 128
SHARE = 0.5
COMMON = 0.5
SHINGLE = 5
OVERLAP = 0.8
SHARD_BYTES = 8 << 20
BLOCK = 4
K1, B = 1.2, 0.75
SCHEMA = "item_id long, score double, question_overlap double, answer_overlap double"

_GAPS = np.ones(256, bool)
_GAPS[48:58] = _GAPS[65:91] = _GAPS[97:123] = False
_GAPS[128:] = False
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of letters and digits, case of A-Z aside, and the first word of each row (and the end)."""
    data = ar.lowered(data)
    start, end, row = ar.words(data, at, _GAPS)
    return ar.span_hash(ar.prefix_hash(data), start, end), np.searchsorted(row, np.arange(len(at)))


def _of_text(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return word_hashes(raw, np.array([0, len(raw)]))[0]


def question_and_answer(text: str) -> tuple[str, str]:
    """All but the last sentence, and the last; an item of one sentence is both."""
    parts = [p for p in _SENTENCE.split(text.strip()) if p.strip()]
    if len(parts) < 2:
        return text, text
    return " ".join(parts[:-1]), parts[-1]


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of so many words in a row."""
    value = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        value = value * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - size + 1 + k]
    return np.unique(ar.mix(value))


@dataclass
class Index:
    """Postings by term in blocks of ``BLOCK`` items; weights are shares of an item's bar."""

    terms: np.ndarray  # sorted hashes
    first: np.ndarray  # blocks of a term: first[t] .. first[t + 1]
    blocks: np.ndarray
    highest: np.ndarray  # greatest weight of the term in the block
    common: np.ndarray  # terms left out of the search
    slack: np.ndarray  # by block: the most that common terms can add
    weights: list[dict[int, float]]  # by item: its terms and their weights
    item_ids: list[int | None]
    length: np.ndarray
    parts: list[tuple[np.ndarray, np.ndarray]]  # words of question and answer


@dataclass
class Statistics:
    """Of the whole benchmark: items with words, their mean length in words, and the document frequency of a shard's terms."""

    items: int
    mean_length: float
    terms: np.ndarray  # sorted hashes
    frequency: np.ndarray


def build_index(rows: list[tuple[int | None, str]], whole: Statistics | None = None) -> Index | None:
    """The index of a shard's items; None if no item has a word. Without ``whole`` the items are the whole benchmark."""
    rows = [(i, t, _of_text(t)) for i, t in rows]
    rows = [r for r in rows if len(r[2])]
    if not rows:
        return None
    length = np.array([len(w) for _, _, w in rows])
    found = [np.unique(w, return_counts=True) for _, _, w in rows]
    owner = np.repeat(np.arange(len(rows)), [len(t) for t, _ in found])
    term, tf = np.concatenate([t for t, _ in found]), np.concatenate([n for _, n in found])
    terms, number, df = np.unique(term, return_inverse=True, return_counts=True)
    whole = whole or Statistics(len(rows), float(length.mean()), terms, df)
    of_all = whole.frequency[np.searchsorted(whole.terms, terms)]
    idf = np.log(1 + (whole.items - of_all + 0.5) / (of_all + 0.5))
    weight = idf[number] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[owner] / whole.mean_length))
    # Half a passage of a longer item is all that one passage is sure to hold.
    bar = SHARE * np.minimum(1, PASSAGE / 2 / length) * np.bincount(owner, weight)
    weight = weight / bar[owner]
    weights: list[dict[int, float]] = [{} for _ in rows]
    for i, t, w in zip(owner.tolist(), number.tolist(), weight.tolist()):
        weights[i][t] = w

    block = owner // BLOCK
    order = np.lexsort((block, number))
    runs = ar.runs(number[order] * (int(block.max()) + 1) + block[order])
    highest, of_term, blocks = np.maximum.reduceat(weight[order], runs), number[order][runs], block[order][runs]
    first = np.searchsorted(of_term, np.arange(len(terms) + 1))
    # The most frequent terms, as many as can never lift an item of any block by more than COMMON.
    common, slack = np.zeros(len(terms), bool), np.zeros(int(block.max()) + 1)
    for t in np.argsort(-df, kind="stable"):
        own = slice(first[t], first[t + 1])
        if (slack[blocks[own]] + highest[own]).max() <= COMMON:
            common[t] = True
            slack[blocks[own]] += highest[own]
    parts = [tuple(_of_text(p) for p in question_and_answer(t)) for _, t, _ in rows]
    return Index(terms, first, blocks, highest, common, slack, weights, [r[0] for r in rows], length, parts)


def live_blocks(index: Index, term: np.ndarray, passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of passage and block whose block maxima can reach the bar.

    ``term`` is the term of each word (or -1), ``passages`` the one or two passages that each word is in (or -1).
    """
    hit = np.flatnonzero(term >= 0)
    hit = hit[~index.common[term[hit]]]
    keys = np.concatenate([p[hit] * len(index.terms) + term[hit] for p in passages])
    keys = np.unique(keys[np.concatenate([p[hit] >= 0 for p in passages])])
    passage, t = keys // len(index.terms), keys % len(index.terms)
    n = index.first[t + 1] - index.first[t]
    at = np.repeat(index.first[t] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    pairs, place = np.unique(np.repeat(passage, n) * len(index.slack) + index.blocks[at], return_inverse=True)
    bound = np.bincount(place, index.highest[at], len(pairs))
    block = pairs % len(index.slack)
    live = bound + index.slack[block] >= 1 - 1e-9
    return pairs[live] // len(index.slack), block[live]


def overlap(part: np.ndarray, near: np.ndarray) -> float:
    """Share of the distinct shingles of ``part`` that occur in ``near``."""
    size = min(SHINGLE, len(part))
    return float(np.isin(shingles(part, size), shingles(near, size)).mean()) if size and len(near) >= size else 0.0


def leaks_of_slice(index: Index, data: np.ndarray, at: np.ndarray) -> list[list[tuple[int, float, float, float]]]:
    """Verified items of each row: number, score, and the overlaps of question and answer."""
    words, first = word_hashes(data, at)
    out: list[list] = [[] for _ in range(len(at) - 1)]
    if not len(words):
        return out
    place = np.minimum(np.searchsorted(index.terms, words), len(index.terms) - 1)
    term = np.where(index.terms[place] == words, place, -1)
    half = PASSAGE // 2
    count = np.diff(first)
    passages = np.where(count > 0, np.maximum(1, -(-(count - half) // half)), 0)
    begin = np.cumsum(passages) - passages
    row = np.repeat(np.arange(len(count)), passages)
    start = first[row] + half * (np.arange(passages.sum()) - begin[row])
    stop = np.minimum(start + PASSAGE, first[row + 1])
    row_of = np.repeat(np.arange(len(count)), count)
    turn = (np.arange(len(words)) - first[row_of]) // half
    own = np.where(turn < passages[row_of], begin[row_of] + turn, -1)
    before = np.where(turn > 0, begin[row_of] + turn - 1, -1)
    for p, block in zip(*(x.tolist() for x in live_blocks(index, term, [own, before]))):
        here = set(term[start[p] : stop[p]].tolist())
        for item in range(block * BLOCK, min((block + 1) * BLOCK, len(index.weights))):
            score = sum(w for t, w in index.weights[item].items() if t in here)
            if score < 1:
                continue
            r, reach = row[p], int(index.length[item])
            near = words[max(first[r], start[p] - reach) : min(first[r + 1], stop[p] + reach)]
            question, answer = (overlap(x, near) for x in index.parts[item])
            if question >= OVERLAP and answer >= OVERLAP:
                out[r].append((item, score, question, answer))
    return [_best(found) for found in out]


def _best(found: list[tuple]) -> list[tuple]:
    """The passage of the highest score for each item."""
    best: dict[int, tuple] = {}
    for x in found:
        if x[0] not in best or x[1] > best[x[0]][1]:
            best[x[0]] = x
    return [best[k] for k in sorted(best)]


def _item_words(batches):
    """The distinct words of each item with its length, one row a word; and one without a word, for the length alone."""
    for rows, data, at in ar.slices(batches):
        words, first = word_hashes(data, at)
        for k in range(len(at) - 1):
            own = words[first[k] : first[k + 1]]
            if len(own):
                terms = np.unique(own).view(np.int64).tolist()
                yield pa.RecordBatch.from_arrays([ar.column(rows, "shard").take(pa.array([k] * (1 + len(terms)))), pa.array([None, *terms], pa.int64()), pa.array([len(own)] + [None] * len(terms), pa.int64())], ["shard", "term", "length"])


def shards(benchmark: DataFrame, most: int = SHARD_BYTES) -> Iterator[tuple[Index, bool]]:
    """One index for each shard of items, one at a time, and whether it is the only one."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size <= most:
        index = build_index([(r.item_id, r.text) for r in items.collect()])
        if index is not None:
            yield index, True
        return
    n = int(-(-size * 3 // (2 * most)))
    items = stored(items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("int")), "items")
    words = stored(items.mapInArrow(_item_words, "shard int, term long, length long"), "words")
    total = words.agg(F.count("length").alias("items"), F.avg("length").alias("mean")).first()
    frequency = stored(words.filter("term is not null").groupBy("term").agg(F.count("*").alias("n")), "frequency")
    for k in range(n):
        rows = items.filter(F.col("shard") == k).collect()
        own = frequency.join(words.filter((F.col("shard") == k) & F.col("term").isNotNull()).select("term").distinct(), "term").collect()
        terms = np.array([r.term for r in own], np.int64).view(np.uint64)
        order = np.argsort(terms)
        whole = Statistics(total.items, total["mean"] or 1.0, terms[order], np.array([r.n for r in own], np.int64)[order])
        index = build_index([(r.item_id, r.text) for r in rows], whole)
        if index is not None:
            yield index, False
    discard(items, words, frequency)


def _rows_of(index: Index, batches):
    for rows, data, at in ar.slices(batches):
        yield rows, leaks_of_slice(index, data, at)


def _find(index: Index):
    def run(batches):
        for rows, found in _rows_of(index, batches):
            ids = ar.column(rows, "doc_id").to_pylist()
            flat = [(i, index.item_ids[x[0]], *x[1:]) for i, own in zip(ids, found) for x in own]
            if flat:
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*flat), kinds)], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, most: int = SHARD_BYTES) -> DataFrame:
    """One row per document and item that it holds: doc_id, item_id, score (1 is the bar), question_overlap, answer_overlap."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, " + SCHEMA
    out = docs.sparkSession.createDataFrame([], schema)
    for index, only in shards(benchmark, most):
        found = rows.mapInArrow(_find(index), schema)
        out = out.unionByName(found if only else stored(found, "found"))
    return out


def _clean(index: Index):
    def run(batches):
        for rows, found in _rows_of(index, batches):
            yield rows.filter(pa.array([not x for x in found], pa.bool_())).select(["_row"])

    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame, most: int = SHARD_BYTES) -> DataFrame:
    """The rows of ``docs``, with their columns, that hold no benchmark item. No shuffle."""
    for index, only in shards(benchmark, most):
        packed = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text").cast("string").alias("text"))
        before, docs = docs, packed.mapInArrow(_clean(index), packed.drop("text").schema).select("_row.*")
        if not only:
            docs = stored(docs, "clean")
            discard(before)
    return docs
