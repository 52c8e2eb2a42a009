"""Line deduplication by content-defined chunks of lines.

Each line is hashed, and a rolling hash over the last ``SPAN`` line hashes says whether a line is an edge: at a divisor d, one in
d is. So a passage has the same edges wherever it stands. A chunk begins behind an edge (or with the text) and ends with the next edge
that is at least ``LEAST`` lines on (or with the text). Chunks are taken at several divisors, coarse to fine: coarse ones
are whole passages, and at divisor 1 each line is an edge, so that chunks of two lines begin at every line and no short passage is
missed for what stands around it.

Of the chunks that occur more than once, whatever their divisor, the first stays where it occurs first (smallest id, then place): its lines are cut by no
other chunk. The lines of all others are removed, after their bytes were compared with the first one's. So whatever is
removed still stands whole in the document that has it first. Where the first copies of passages overlap, more than one copy of a line stays.

A chunk that a third of the documents share costs each task one row: chunks are counted by two 64-bit hashes and their length before
the shuffle. A bitmap of bounded size then lets through the chunks that may occur twice, and only their bytes are shuffled.

Defined cases: a null or empty text is one empty line and keeps it; chunks of one line, and of blank lines alone, stay; a null id
comes after all others; rows of one id are told apart by a digest of their text, by which they are ordered; of repeated rows (one id, one text) each chunk stays in all of them; a
chunk that overlaps its own first place loses only the lines outside it; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poiweave.llm import arrays as ar
from poiweave.llm.shared import discard, stored
from poiweave.operators.prefilter import may_match

SPAN = 2
DIVISORS = (8, 1)
LEAST = 2
BITS = 1 << 27  # 16 MiB
_SECOND = np.random.default_rng(20250301).permutation(256).astype(np.uint8)
_STEP = np.uint64(0x9E3779B97F4A7C15)
KEY = ["h1", "h2", "n_bytes"]
CHUNKS = "doc_id long, tag binary, first_byte long, n_bytes long, n_lines int, h1 long, h2 long, body binary"


def line_ends(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end (with its line break) of each line, and its row; a row's last line may be empty only if the row is."""
    breaks = np.flatnonzero(data == 10) + 1
    ends = np.unique(np.r_[breaks, at[1:]])
    ends = ends[ends > 0]
    starts = np.r_[0, ends[:-1]] if len(ends) else ends
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def rolled(hashes: np.ndarray, row: np.ndarray, span: int = SPAN) -> np.ndarray:
    """At each line: a hash of the last ``span`` line hashes of its text."""
    out = hashes.copy()
    for back in range(1, span):
        same = row[back:] == row[:-back]
        out[back:] = np.where(same, out[back:] + hashes[:-back] * _STEP ** np.uint64(back), out[back:])
    return ar.mix(out)


def chunks_of(edges: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First line and end of the chunks between edges; ``edges`` says of each line whether it is one."""
    last = np.r_[row[1:] != row[:-1], True] if len(row) else np.zeros(0, bool)
    begins = np.flatnonzero(np.r_[True, (edges | last)[:-1]]) if len(row) else np.zeros(0, np.int64)
    ends = np.flatnonzero(edges | last) + 1
    texts = np.flatnonzero(last) + 1
    begins = begins[begins + LEAST <= texts[np.searchsorted(texts, begins, "right")]] if len(begins) else begins
    return begins, ends[np.searchsorted(ends, begins + LEAST)] if len(begins) else begins


def _chunk_rows(divisors: tuple[int, ...], bodies: bool):
    def run(batches):
        for rows, data, at in ar.slices(batches):
            starts, ends, row = line_ends(data, at)
            one = ar.prefix_hash(data)
            two = ar.prefix_hash(_SECOND[data])
            ink = np.r_[0, np.cumsum(~ar.SPACE[data])]
            at_edge = rolled(ar.span_hash(one, starts, ends), row)
            spans = [chunks_of((at_edge >> np.uint64(40)) % np.uint64(d) == 0, row) for d in divisors]
            # A chunk of several divisors is one.
            both = np.unique(np.concatenate([first * (len(row) + 1) + end for first, end in spans]))
            if not len(both):
                continue
            first, end = both // (len(row) + 1), both % (len(row) + 1)
            a, b = starts[first], ends[end - 1]
            full = ink[b] > ink[a]
            first, end, a, b = first[full], end[full], a[full], b[full]
            of, raw = row[first], data.tobytes() if bodies else b""
            take = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [
                    ar.column(rows, "doc_id").take(take),
                    ar.column(rows, "tag").take(take),
                    pa.array(a - at[of]),
                    pa.array(b - a),
                    pa.array((end - first).astype(np.int32)),
                    pa.array(ar.span_hash(one, a, b).view(np.int64)),
                    pa.array(ar.span_hash(two, a, b).view(np.int64)),
                    pa.array([raw[x:y] for x, y in zip(a.tolist(), b.tolist())], pa.binary()) if bodies else pa.nulls(len(a), pa.binary()),
                ],
                [x.split()[0] for x in CHUNKS.split(", ")],
            )

    return run


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("tag"))


def repeated_chunks(docs: DataFrame, divisors: tuple[int, ...] = DIVISORS) -> DataFrame:
    """Chunks that occur more than once: doc_id, tag (of the text), first_byte, n_bytes, n_lines, the document that has them first, and
    whether this is that place (``kept``). One after another, and equal in all bytes."""
    texts = _texts(docs)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag", "first_byte")
    counted = texts.mapInArrow(_chunk_rows(divisors, False), CHUNKS).groupBy(*KEY).agg(F.min(order).alias("head"), F.count("*").alias("n")).filter("n > 1")
    heads = stored(counted.select(*KEY, "head"), "heads")
    likely = may_match(texts.mapInArrow(_chunk_rows(divisors, True), CHUNKS), heads, KEY, BITS)
    several = stored(likely.join(heads, KEY), "chunks")
    discard(heads)
    kept = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("tag") == F.col("head.tag")) & (F.col("first_byte") == F.col("head.first_byte"))
    marked = several.withColumn("kept", kept)
    first = marked.filter("kept").groupBy(*KEY).agg(F.min("body").alias("first_body"))
    same = marked.join(first, KEY).filter(F.col("body") == F.col("first_body"))
    return same.select("doc_id", "tag", "first_byte", "n_bytes", "n_lines", F.col("head.doc_id").alias("first_doc"), "kept")


def _cut(batches):
    for batch in batches:
        out = []
        for doc, text, spans in zip(*(ar.column(batch, n).to_pylist() for n in ("doc_id", "text", "spans"))):
            raw = (text or "").encode()
            starts, ends, _ = line_ends(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
            gone = np.zeros(max(1, len(starts)), bool)
            for kept in (False, True):  # the lines of first places stay, whatever else holds them
                for s in spans or []:
                    if s["kept"] == kept:
                        gone[np.searchsorted(starts, s["first_byte"]) : np.searchsorted(starts, s["first_byte"] + s["n_bytes"])] = not kept
            left = b"".join(raw[a:b] for a, b, cut in zip(starts.tolist(), ends.tolist(), gone.tolist()) if not cut)
            out.append((doc, len(gone), int(gone.sum()), len(raw) - len(left), left.decode()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int64()] * 4 + [pa.string()])], ["doc_id", "n_lines", "n_removed_lines", "n_removed_bytes", "text"])


def drop_repeated_chunks(docs: DataFrame, divisors: tuple[int, ...] = DIVISORS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed_lines, n_removed_bytes, and the text that is left."""
    found = repeated_chunks(docs, divisors)
    spans = found.groupBy(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag")).agg(F.collect_set(F.struct("first_byte", "n_bytes", "kept")).alias("spans"))
    texts = _texts(docs)
    return texts.join(spans, (texts.tag == spans["_tag"]) & texts.doc_id.eqNullSafe(spans["_id"]), "left").select("doc_id", "text", "spans").mapInArrow(
        _cut, "doc_id long, n_lines long, n_removed_lines long, n_removed_bytes long, text string"
    )
