"""Vectors as short codes: a codebook for each part of the vector, fitted by rounds of nearest entries, in integers.

Components become ``floor(1024 x)``; a vector is cut into ``parts`` equal parts. Each part's codebook starts as that part of the
``entries`` first vectors (by id). A round gives every part its nearest entry (squared distance, ties to the lower index) and replaces
each entry by the floor of its parts' mean; unused entries stay. After the last round parts are assigned again.

**Which entries are compared.** For each part of a vector and each run of ``GROUP`` entries a lower bound is kept of the distance
to the run's entries (other than the assigned one), with a stamp: the round of the codebook it was measured with. All codebooks so far are kept. In a
later round an entry stands where all its moves together have brought it, so the bound falls by the net displacement between
the stamped and the present codebook (the norm of the sum of the moves, never more than the sum of their norms, and zero for an entry that
came back). A run whose bound, less the largest net displacement in it, is still above the distance to the assigned entry holds no
nearer entry and is passed over; any other run is measured exactly and stamped anew. Bounds are floats, rounded so that they
only ever cause a needless scan; assignments are decided by exact integers.

How it is dealt: each round writes the vectors with their assignment and bounds to the shared folder and starts from the round
before; counts and sums of entries are added up in tasks, then by entry. The driver holds the codebooks of all rounds
(``rounds + 1`` times ``entries`` times the vector's length) and nothing that grows with the table.

Defined cases: a vector that is null, or holds a null, a non-finite component or one of 2^16 or more (its square would leave
64 bits), has no code and no row; nor has a vector whose length is not that of most others (the longer of equally frequent
lengths, of those that can be cut into equal parts); fewer vectors than entries make a smaller codebook; among rows of one id
the lesser vector comes first; a null id comes after all others; a null label is a label of its own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiweave.llm import arrays as ar
from poiweave.llm.shared import discard, stored

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
GROUP = 16
MOST = 1 << 26  # of a scaled component
EXACT = 1 << 52  # what a double holds exactly
SLACK = 1e-5
STATE = "vec_id long, label long, x array<long>, entry binary, bound binary, stamp binary, error long"


def _whole(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, x`` of the vectors that can be coded."""
    scaled = F.transform(F.col("embedding"), lambda v: v.cast("double") * SCALE)
    sound = F.forall(scaled, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float(MOST)))
    return vectors.filter(F.col("embedding").isNotNull()).filter(sound).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.transform(scaled, lambda v: F.floor(v)).alias("x"))


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all entries."""
    top = int(max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))) + 1
    kind = np.float64 if 4 * top * top * x.shape[1] < EXACT else np.int64
    x, entries = x.astype(kind), entries.astype(kind)
    return ((x * x).sum(axis=1)[:, None] + (entries * entries).sum(axis=1)[None, :] - 2 * (x @ entries.T)).astype(np.int64)


def net_moves(history: list[np.ndarray]) -> np.ndarray:
    """By stamp, part and run of entries: the largest net displacement from the stamped codebook to the present one."""
    now = history[-1].astype(np.float64)
    moved = np.array([np.sqrt(((now - old) ** 2).sum(axis=2)) for old in history])
    return np.maximum.reduceat(moved, np.arange(0, moved.shape[2], GROUP), axis=2)


def assign(x: np.ndarray, entry: np.ndarray, bound: np.ndarray, stamp: np.ndarray, codebook: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, int]:
    """One part of some vectors: their entries, bounds and stamps are brought up to the present codebook, in place.

    The run of the assigned entry is always measured. Returns the squared distances to the entries found, and how many
    distances were measured.
    """
    apart = ((x - codebook[entry]) ** 2).sum(axis=1)
    reach = np.sqrt(apart.astype(np.float64))[:, None]
    least = bound - moves[stamp, np.arange(bound.shape[1])[None, :]]
    scan = least - SLACK * (1 + np.abs(least) + bound + reach) <= reach
    measured = 0
    for run in range(bound.shape[1]):
        at = np.flatnonzero(scan[:, run])
        if not len(at):
            continue
        first = run * GROUP
        d = _distances(x[at], codebook[first : first + GROUP])
        measured += d.size
        best = d.argmin(axis=1)
        nearest = d[np.arange(len(at)), best]
        better = (nearest < apart[at]) | ((nearest == apart[at]) & (first + best < entry[at]))
        apart[at[better]], entry[at[better]] = nearest[better], first + best[better]
        bound[at, run], stamp[at, run] = np.sqrt(nearest.astype(np.float64)), len(moves) - 1
    return apart, measured


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    x = ar.column(batch, "x")
    return np.asarray(x.flatten()).reshape(batch.num_rows, -1)


def _matrix(batch: pa.RecordBatch, name: str, kind: str, *shape: int) -> np.ndarray:
    data, _ = ar.text_bytes(ar.column(batch, name))
    return np.frombuffer(data.tobytes(), kind).reshape(batch.num_rows, *shape)


def _blobs(values: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(values).reshape(len(values), -1).view(np.uint8)
    return ar.blobs(data.ravel(), np.arange(len(values) + 1) * data.shape[1])


def _assigned(history: list[np.ndarray]):
    """Rows with their state as of the last codebook of ``history`` (by part, entry and component)."""
    parts, entries = history[0].shape[:2]
    runs = -(-entries // GROUP)
    moves = net_moves(history)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _vectors(batch)
            if len(history) == 1:
                entry = np.zeros((len(x), parts), np.int64)
                bound, stamp = np.zeros((len(x), parts, runs)), np.zeros((len(x), parts, runs), np.int64)
            else:
                entry = _matrix(batch, "entry", "<u2", parts).astype(np.int64)
                bound = _matrix(batch, "bound", "<f4", parts, runs).astype(np.float64)
                stamp = _matrix(batch, "stamp", "u1", parts, runs).astype(np.int64)
            error = np.zeros(len(x), np.int64)
            for k, piece in enumerate(np.split(x, parts, axis=1)):
                error += assign(piece, entry[:, k], bound[:, k], stamp[:, k], history[-1][k], moves[:, k])[0]
            state = [_blobs(entry.astype("<u2")), _blobs(bound.astype("<f4")), _blobs(stamp.astype("u1")), pa.array(error)]
            yield pa.RecordBatch.from_arrays([*(ar.column(batch, c) for c in ("vec_id", "label", "x")), *state], ["vec_id", "label", "x", "entry", "bound", "stamp", "error"])

    return run


def _sums(parts: int):
    """For each part and entry that a task's rows use: number of rows and sums of components."""

    def run(batches):
        total: dict[tuple[int, int], list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, entry = _vectors(batch), _matrix(batch, "entry", "<u2", parts)
            for k, piece in enumerate(np.split(x, parts, axis=1)):
                order = np.argsort(entry[:, k], kind="stable")
                first = ar.runs(entry[order, k])
                for e, n, s in zip(entry[order[first], k].tolist(), np.diff(np.r_[first, len(order)]).tolist(), np.add.reduceat(piece[order], first, axis=0)):
                    known = total.setdefault((k, e), [0, 0])
                    known[0], known[1] = known[0] + n, known[1] + s
        if total:
            columns = [pa.array([k for k, _ in total], pa.int32()), pa.array([e for _, e in total], pa.int32()), pa.array([n for n, _ in total.values()], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([s.tolist() for _, s in total.values()], pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    return run


def _next(state: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Each entry replaced by the floor of the mean of its parts."""
    parts, _, width = codebooks.shape
    summed = state.select("x", "entry").mapInArrow(_sums(parts), "part int, entry int, n long, sums array<long>").groupBy("part", "entry")
    out = codebooks.copy()
    for row in summed.agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums")).collect():
        out[row.part, row.entry] = [s // row.n for s in row.sums]
    return out


def digest(codebooks: np.ndarray | None) -> str:
    """SHA-256 of all components as decimal integers, joined by commas."""
    return hashlib.sha256(",".join(map(str, [] if codebooks is None else codebooks.ravel().tolist())).encode()).hexdigest()


def fit_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray | None]:
    """``vec_id, label, x, entry, bound, stamp, error`` of each vector, and the codebooks by part, entry and component (None without vectors)."""
    if entries > 1 << 16 or rounds > 255:
        raise ValueError("at most 65536 entries and 255 rounds")
    state = _whole(vectors)
    lengths = state.groupBy(F.size("x").alias("n")).agg(F.count("*").alias("rows")).filter(f"n > 0 and n % {int(parts)} = 0")
    usual = lengths.orderBy(F.desc("rows"), F.desc("n")).first()
    if usual is None:
        return vectors.sparkSession.createDataFrame([], STATE), None
    state = state.filter(F.size("x") == usual.n)
    first = state.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    start = np.array([r.x for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    history = [np.ascontiguousarray(start)]
    for _ in range(rounds):
        before, state = state, stored(state.mapInArrow(_assigned(list(history)), STATE), "codes")
        discard(before)
        history.append(_next(state, history[-1]))
    done = stored(state.mapInArrow(_assigned(list(history)), STATE), "codes")
    discard(state)
    return done, history[-1]


def code_of(entry: str = "entry", entries: int = ENTRIES, parts: int = PARTS) -> Column:
    """The indexes of the parts in order: two hexadecimal digits each, four beyond 256 entries."""
    low = lambda k: F.substring(entry, 2 * k + 1, 1)
    high = lambda k: F.substring(entry, 2 * k + 2, 1)
    wide = [c for k in range(parts) for c in ([high(k), low(k)] if entries > 256 else [low(k)])]
    return F.lower(F.concat(*[F.hex(c) for c in wide]))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row for each vector that can be coded: vec_id, label, code, error, label_error, codebooks_sha256."""
    state, codebooks = fit_codes(vectors, parts, entries, rounds)
    of_label = state.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    found = state.join(of_label, F.col("label").eqNullSafe(F.col("_label")))
    return found.select("vec_id", "label", code_of("entry", entries, parts).alias("code"), "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))
