"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Each line is described by binned measures of its own bytes and of the lines before and after it. The
field gives every line a good or bad label with marginals by forward-backward; the document's quality is
their mean weighted by line length, mapped to a probability on the fitting sample.

The model is fitted on at most ``SAMPLE`` labelled documents (never a held-out one) from their line
measures alone; scoring is one pass over the documents with a model of a few kilobytes and no shuffle.

Defined cases: a null or empty text is one empty line; a row is scored by its text alone, so repeated rows score
alike; without labels every score is 0.5; other columns pass or are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poiweave.llm import arrays as ar
from poiweave.llm.sample import base_rate, held_out, labelled_sample

SAMPLE = 4000
THRESHOLD = 0.7
BINS = 8
STEPS = 150
L2 = 1e-3

_UPPER, _LETTER, _DIGIT, _MARK, _BLANK, _BAR, _STOP = (np.zeros(256, np.uint8) for _ in range(7))
_UPPER[65:91] = 1
_LETTER[65:91] = _LETTER[97:123] = 1
_LETTER[128:] = 1
_DIGIT[48:58] = 1
_BLANK[[32, 9, 11, 12, 13]] = 1
_MARK[33:127] = 1 - _LETTER[33:127] - _DIGIT[33:127]
_BAR[[ord(c) for c in "|#$%&*<>{}[]=~^_\\@+"]] = 1
_STOP[[ord(c) for c in ".,;:!?"]] = 1
MEASURES = 9


def line_bins(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Binned measures of each line, its length, and the number of lines of each row."""
    n_rows = len(at) - 1
    # One line break is put behind every row, so each has a last line, if empty.
    ends_at = at[1:] + np.arange(n_rows)
    flat = np.empty(len(data) + n_rows, np.uint8)
    keep = np.ones(len(flat), bool)
    keep[ends_at] = False
    flat[keep], flat[ends_at] = data, 10
    breaks = np.flatnonzero(flat == 10)
    starts = np.r_[0, breaks[:-1] + 1]
    length = breaks - starts
    per_row = np.diff(np.searchsorted(breaks, np.r_[-1, ends_at], "right"))

    def count(table: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flat) + 1, np.int32)
        np.cumsum(table[flat], out=total[1:], dtype=np.int32)
        return (total[breaks] - total[starts]).astype(np.float64)

    upper, letters, digits, marks, blanks, bars, stops = (count(t) for t in (_UPPER, _LETTER, _DIGIT, _MARK, _BLANK, _BAR, _STOP))
    words = blanks + 1
    prefix = ar.prefix_hash(flat)
    # Words that only repeat the word before them.
    word_start, word_end, word_line = ar.words(flat, np.r_[starts, len(flat)])
    word = ar.span_hash(prefix, word_start, word_end)
    echo = np.flatnonzero((word[1:] == word[:-1]) & (word_line[1:] == word_line[:-1])) + 1
    echoes = np.bincount(word_line[echo], minlength=len(starts))
    line_hash = ar.mix(ar.span_hash(prefix, starts, breaks) + np.repeat(np.arange(n_rows), per_row).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(line_hash, kind="stable")
    seen = np.zeros(len(starts), bool)
    seen[order[1:]] = line_hash[order[1:]] == line_hash[order[:-1]]

    def level(share: np.ndarray, edges: list[float]) -> np.ndarray:
        return np.searchsorted(edges, share, "right")

    size = np.maximum(length, 1)
    out = np.stack(
        [
            np.minimum(np.log2(length + 1) / 1.6, BINS - 1).astype(np.int64),
            level(upper / np.maximum(letters, 1), [0.02, 0.06, 0.12, 0.25, 0.5, 0.8]),
            level(digits / size, [0.005, 0.02, 0.05, 0.1, 0.2, 0.4]),
            level(bars / words, [0.01, 0.05, 0.15, 0.4, 0.8, 1.6]),
            level((marks - stops - bars) / words, [0.01, 0.03, 0.08, 0.2, 0.5, 1.0]),
            level(stops / words, [0.02, 0.08, 0.15, 0.3, 0.7, 1.4]),
            level(letters / words, [1.5, 3.0, 4.5, 6.0, 8.0, 12.0]),
            seen.astype(np.int64) + 2 * (length == 0),
            level(echoes / words, [0.01, 0.05, 0.1, 0.2, 0.4, 0.7]),
        ],
        axis=1,
    )
    return out.astype(np.uint8), length, per_row


def with_neighbours(bins: np.ndarray, per_row: np.ndarray) -> np.ndarray:
    """Feature numbers of each line: its own bins and those of the lines around it (the last bin outside)."""
    ends = np.cumsum(per_row)
    before, after = np.full_like(bins, BINS), np.full_like(bins, BINS)
    before[1:], after[:-1] = bins[:-1], bins[1:]
    before[ends - per_row], after[ends - 1] = BINS, BINS
    every = np.concatenate([bins, before, after], axis=1).astype(np.int64)
    return every + np.arange(every.shape[1]) * (BINS + 1)


FEATURES = 3 * MEASURES * (BINS + 1)


@dataclass
class Field:
    """Emission weights of the good state, transition scores, and the map from quality to probability."""

    weights: np.ndarray
    transitions: np.ndarray
    slope: float
    shift: float


def _layout(per_row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows by falling number of lines, the start of each row's lines, and how many rows have a line k."""
    order = np.argsort(-per_row, kind="stable")
    first = (np.cumsum(per_row) - per_row)[order]
    return order, first, np.searchsorted(-per_row[order], -np.arange(1, per_row.max() + 1), "right")


def marginals(score: np.ndarray, per_row: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all rows at once: P(good) by line, expected transitions, and log Z by row.

    ``score`` is the log score of good against bad for each line.
    """
    _, first, alive = _layout(per_row)
    steps = len(alive)
    fwd, bwd = np.zeros((len(score), 2)), np.zeros((len(score), 2))
    node = np.stack([np.zeros_like(score), score], axis=1)

    def join(x: np.ndarray, t: np.ndarray) -> np.ndarray:
        return np.logaddexp(x[:, :1] + t[0], x[:, 1:] + t[1])

    fwd[first] = node[first]
    for k in range(1, steps):
        here = first[: alive[k]] + k
        fwd[here] = join(fwd[here - 1], trans) + node[here]
    for k in range(steps - 1, 0, -1):
        here = first[: alive[k]] + k
        bwd[here - 1] = join(bwd[here] + node[here], trans.T)
    total = np.logaddexp(fwd[:, 0] + bwd[:, 0], fwd[:, 1] + bwd[:, 1])
    good = np.exp(np.clip(fwd[:, 1] + bwd[:, 1] - total, -700, 0))
    later = np.ones(len(score), bool)
    later[first] = False
    here = np.flatnonzero(later)
    pair = fwd[here - 1][:, :, None] + trans + (node[here] + bwd[here])[:, None, :] - total[here][:, None, None]
    return good, np.exp(np.clip(pair, -700, 0)).sum(axis=0), total[np.cumsum(per_row) - per_row]


def fit_field(bins: np.ndarray, length: np.ndarray, per_row: np.ndarray, label: np.ndarray, rate: float) -> Field:
    """Maximum conditional likelihood by gradient steps (Adam); every line carries its document's label."""
    feats, y = with_neighbours(bins, per_row), np.repeat(label, per_row).astype(np.float64)
    inside = np.ones(len(y), bool)
    inside[np.cumsum(per_row) - per_row] = False
    same = y[np.flatnonzero(inside)].astype(np.int64)
    seen = np.zeros((2, 2))
    np.add.at(seen, (same, same), 1)
    # Long documents do not outweigh short ones.
    weight = np.repeat(1 / per_row, per_row)
    theta = np.zeros(FEATURES + 1)
    trans = np.zeros((2, 2))
    moment, spread = np.zeros(FEATURES + 5), np.zeros(FEATURES + 5)
    for step in range(1, STEPS + 1):
        good, expected, _ = marginals(theta[feats].sum(axis=1) + theta[-1], per_row, trans)
        miss = (y - good) * weight
        slope = np.bincount(feats.ravel(), np.repeat(miss, feats.shape[1]), FEATURES + 1)
        slope[-1] = miss.sum()
        grad = np.r_[slope / len(per_row) - L2 * theta, ((seen - expected) / len(y)).ravel() - L2 * trans.ravel()]
        moment = 0.9 * moment + 0.1 * grad
        spread = 0.99 * spread + 0.01 * grad**2
        move = 0.1 * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
        theta, trans = theta + move[:-4], trans + move[-4:].reshape(2, 2)
    field = Field(theta, trans, 1.0, 0.0)
    # Logistic map of the quality's log odds, with classes weighted as among all labels.
    x = _log_odds(qualities(field, bins, length, per_row))
    share = max(label.mean(), 1e-9), max(1 - label.mean(), 1e-9)
    w = np.where(label == 1, max(rate, 1e-3) / share[0], max(1 - rate, 1e-3) / share[1])
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * x + b)))
        h = w * p * (1 - p)
        g = np.array([(w * (label - p) * x).sum() - 0.1 * (a - 1), (w * (label - p)).sum() - 0.1 * b])
        m = np.array([[(h * x * x).sum() + 0.1, (h * x).sum()], [(h * x).sum(), h.sum() + 0.1]])
        d = np.linalg.solve(m, g)
        a, b = a + float(np.clip(d[0], -1, 1)), b + float(np.clip(d[1], -1, 1))
    field.slope, field.shift = max(a, 0.05), b
    return field


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def qualities(field: Field, bins: np.ndarray, length: np.ndarray, per_row: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the lines' marginals, by row."""
    good, _, _ = marginals(field.weights[with_neighbours(bins, per_row)].sum(axis=1) + field.weights[-1], per_row, field.transitions)
    first = np.cumsum(per_row) - per_row
    return np.add.reduceat(good * (length + 1), first) / np.add.reduceat(length + 1.0, first)


def _measured(batches):
    for rows, data, at in ar.slices(batches):
        bins, length, per_row = line_bins(data, at)
        ends = np.cumsum(per_row)
        yield pa.RecordBatch.from_arrays(
            [
                ar.column(rows, "label"),
                pa.array([bins[e - n : e].tobytes() for e, n in zip(ends, per_row)], pa.binary()),
                pa.array([length[e - n : e].astype("<i4").tobytes() for e, n in zip(ends, per_row)], pa.binary()),
            ],
            ["label", "bins", "length"],
        )


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field | None:
    """The field fitted on a bounded sample; None where there are no labels of both kinds."""
    rows = labelled_sample(docs, labels, "quality", sample).select("text", "label").mapInArrow(_measured, "label int, bins binary, length binary").collect()
    label = np.array([r.label for r in rows], np.float64)
    if len(set(label)) < 2:
        return None
    bins = [np.frombuffer(r.bins, np.uint8).reshape(-1, MEASURES) for r in rows]
    length = np.concatenate([np.frombuffer(r.length, "<i4") for r in rows]).astype(np.float64)
    return fit_field(np.concatenate(bins), length, np.array([len(b) for b in bins]), label, base_rate(labels, "quality"))


def _scores(field: Field | None):
    def run(batches):
        for rows, data, at in ar.slices(batches):
            if field is None:
                score = np.full(len(at) - 1, 0.5)
            else:
                x = _log_odds(qualities(field, *line_bins(data, at)))
                score = 1 / (1 + np.exp(-(field.slope * x + field.shift)))
            kept = [c for i, c in enumerate(rows.columns) if rows.schema.names[i] != "text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(score)], [*(n for n in rows.schema.names if n != "text"), "score"])

    return run


def score_documents(docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id, held_out, score and predicted for every row, from its text alone."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(_scores(field), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, field: Field | None) -> DataFrame:
    """The rows of ``docs``, with their columns, whose score reaches the threshold; all of them without a model."""
    if field is None:
        return docs
    packed = docs.withColumn("_row", F.struct(*docs.columns)).select("_row", F.col("text").cast("string").alias("text"))
    schema = packed.drop("text").schema.add("score", "double")
    return packed.mapInArrow(_scores(field), schema).filter(F.col("score") >= THRESHOLD).select("_row.*")
