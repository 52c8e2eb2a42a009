"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

The lattice of a text has a node at each character border and an edge for each piece of the
vocabulary that stands between two of them; a character without a piece of its own has one edge that
stands for its byte pieces. Forward filtering sums the weights of all paths to each node; backward sampling then walks
from the end to the start, drawing each incoming edge by its share. The draws are a hash of the row's key, the
place in the row and the step, so a row always gets the same segmentation, on any executor.

Where two neighbouring bytes stand together in no piece, no edge crosses; the lattice falls into
independent parts there. Equal parts of a slice share one lattice and are sampled together, as arrays. A
space is a space throughout (the vocabulary's own mark for it is translated), text is not normalised, and a mark
that stands in a text is written in byte pieces; so decoding gives back every byte.

Scores of a merge-order vocabulary are ranks; they become log probabilities -log(rank + 10). ``alpha`` sharpens
or flattens the distribution.

Defined cases: a null or empty text has no pieces and decodes to nothing; a null key is a key of its own; repeated rows
get the same pieces; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poiweave.llm import arrays as ar

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 1.0
SLICE_BYTES = 2 << 20
FALLBACK = -12.0  # log weight of a byte piece
_SPACE_MARK = "▁"
SCHEMA = "doc_id long, n_pieces long, ids array<int>, decoded_sha256 string, lossless boolean"


@dataclass
class Vocabulary:
    """Trie of the pieces by row displacement, and what each piece stands for."""

    shift: np.ndarray  # of a node's children in the slots
    owner: np.ndarray  # node that a slot belongs to
    child: np.ndarray
    piece: np.ndarray  # id of the piece that ends at a node, or -1
    weight: np.ndarray  # log weight by id
    byte_ids: np.ndarray
    joined: np.ndarray  # pairs of bytes that stand side by side in some piece
    piece_data: np.ndarray
    piece_at: np.ndarray


def build_vocabulary(pieces: list[tuple[bytes, float]], byte_ids: list[int], skip: set[int], alpha: float = ALPHA) -> Vocabulary:
    """A vocabulary of ``(bytes, log probability)`` by id; ids in ``skip`` are never edges."""
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    joined = np.zeros((256, 256), bool)
    for number, (body, _) in enumerate(pieces):
        if number in skip or not body:
            continue
        node = 0
        for b in body:
            if b not in children[node]:
                children[node][b] = len(children)
                children.append({})
                ends.append(-1)
            node = children[node][b]
        if ends[node] < 0:
            ends[node] = number
        raw = np.frombuffer(body, np.uint8)
        joined[raw[:-1], raw[1:]] = True
    size = 1 << max(10, int(np.ceil(np.log2(4 * len(children)))))
    owner = np.full(size + 256, -1, np.int32)
    child = np.zeros(size + 256, np.int32)
    shift = np.zeros(len(children), np.int32)
    place = 0
    for node in sorted(range(len(children)), key=lambda n: -len(children[n])):
        own = children[node]
        if not own:
            break
        while any(owner[place + b] >= 0 for b in own):
            place = (place * 5 + 12345) % size if len(own) < 8 else (place + 1) % size
        shift[node] = place
        for b, target in own.items():
            owner[place + b], child[place + b] = node, target
        place = (place + 7) % size
    weight = np.array([w for _, w in pieces]) * alpha
    data = [bytes([byte_ids.index(k)]) if k in byte_set else body for byte_set in [set(byte_ids)] for k, (body, _) in enumerate(pieces)]
    at = np.r_[0, np.cumsum([len(x) for x in data])].astype(np.int64)
    return Vocabulary(shift, owner, child, np.array(ends, np.int32), weight, np.array(byte_ids, np.int32), joined, np.frombuffer(b"".join(data), np.uint8), at)


def load_vocabulary(path: str = MODEL, alpha: float = ALPHA) -> Vocabulary:
    """The vocabulary of a model file, read on the driver; a few megabytes, whatever the corpus."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    scores = np.array([model.get_score(i) for i in range(n)])
    special = {i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
    own_bytes = {model.id_to_piece(i): i for i in range(n) if model.is_byte(i)}
    byte_ids = [own_bytes[f"<0x{b:02X}>"] for b in range(256)]
    if scores.min() < -1000:  # merge order, not log probabilities
        scores = -np.log(10 - np.minimum(scores, 0))
    pieces = [(b"" if i in special else model.id_to_piece(i).replace(_SPACE_MARK, " ").encode(), float(scores[i])) for i in range(n)]
    return build_vocabulary(pieces, byte_ids, special | set(byte_ids), alpha)


def _edges(voc: Vocabulary, data: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and piece of every edge; ``stop`` is the end of the part each byte is in. Piece -1: byte pieces."""
    borders = (data & 0xC0) != 0x80
    begins = np.r_[True, stop[1:] != stop[:-1]]
    start = np.flatnonzero(borders | begins)
    after = np.minimum(np.r_[start[1:], len(data)], stop[start])  # end of the character
    single = np.zeros(len(start), bool)
    found = []
    at, node, which = start.copy(), np.zeros(len(start), np.int32), np.arange(len(start))
    while len(at):
        slot = voc.shift[node] + data[at]
        ok = voc.owner[slot] == node
        at, which, node = at[ok] + 1, which[ok], voc.child[slot[ok]]
        hit = voc.piece[node] >= 0
        h = which[hit]
        found.append((start[h], at[hit], voc.piece[node[hit]]))
        single[h[at[hit] == after[h]]] = True
        more = at < stop[start[which]]
        at, which, node = at[more], which[more], node[more]
    rest = ~single
    found.append((start[rest], after[rest], np.full(int(rest.sum()), -1, np.int32)))
    return tuple(np.concatenate(x) for x in zip(*found))


def _by(keys: np.ndarray) -> np.ndarray:
    """A stable order of small non-negative integers, by 16 bits at a time."""
    order = np.argsort((keys & 0xFFFF).astype(np.uint16), kind="stable")
    high = keys >> 16
    if len(keys) and int(high.max()):
        order = order[_by(high[order])]
    return order


def filtered(voc: Vocabulary, data: np.ndarray, stop: np.ndarray, first: np.ndarray):
    """Edges by end node, with the cumulative share of each among those of its node, and each node's first edge."""
    start, end, piece = _edges(voc, data, stop)
    weight = np.where(piece >= 0, voc.weight[piece], FALLBACK * (end - start))
    order = _by(end)
    start, end, piece, weight = start[order], end[order], piece[order], weight[order]
    node_first = ar.runs(end)
    node_end, count = end[node_first], np.diff(np.r_[node_first, len(end)])
    depth = node_end - first[node_end - 1]  # bytes from the start of the part
    total = np.zeros(len(data) + 1)  # of a node, by the byte before it; a part's start has none
    origin = np.zeros(len(data) + 1, bool)
    origin[first] = True
    share = np.empty(len(end))
    turn = _by(depth)
    cuts = np.r_[ar.runs(depth[turn]), len(turn)]
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        nodes = turn[lo:hi]
        n = count[nodes]
        begin = np.cumsum(n) - n
        edge = np.repeat(node_first[nodes] - begin, n) + np.arange(n.sum())
        s = start[edge]
        value = weight[edge] + np.where(origin[s], 0.0, total[s - 1])
        high = np.maximum.reduceat(value, begin)
        part = np.exp(value - np.repeat(high, n))
        whole = np.add.reduceat(part, begin)
        total[node_end[nodes] - 1] = high + np.log(whole)
        share[edge] = part / np.repeat(whole, n)
    running = np.cumsum(share)
    before = running[node_first] - share[node_first]
    cumulative = running - np.repeat(before, count)
    cumulative[np.r_[node_first[1:], len(end)] - 1] = 2.0  # the last edge takes what rounding leaves
    edge_of = np.zeros(len(data) + 1, np.int64)
    edge_of[node_end] = node_first
    return start, end, piece, cumulative, edge_of


def encode_slice(voc: Vocabulary, data: np.ndarray, at: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all rows in a row, and their number by row."""
    n_rows, n = len(at) - 1, len(data)
    if not n:
        return np.zeros(0, np.int32), np.zeros(n_rows, np.int64)
    cut = np.ones(n, bool)
    cut[1:] = ~voc.joined[data[:-1], data[1:]] & ((data[1:] & 0xC0) != 0x80)
    cut[at[:-1][at[:-1] < n]] = True
    begin = np.flatnonzero(cut)
    finish = np.r_[begin[1:], n]
    _, sample, kind = np.unique(ar.span_hash(ar.prefix_hash(data), begin, finish), return_index=True, return_inverse=True)
    parts = np.searchsorted(begin, at)
    row = np.repeat(np.arange(n_rows), np.diff(parts))
    place = np.arange(len(begin)) - parts[row]

    length = finish[sample] - begin[sample]
    part_end = np.cumsum(length)
    part_start = part_end - length
    flat = data[np.repeat(begin[sample] - part_start, length) + np.arange(part_end[-1])]
    start, end, piece, cumulative, edge_of = filtered(voc, flat, np.repeat(part_end, length), np.repeat(part_start, length))

    # All parts walk back together, one edge a step, until each has reached its start.
    where, goal = part_end[kind].copy(), part_start[kind]
    seed = ar.mix(seeds[row] + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    active, steps, taken = np.arange(len(begin)), [], np.zeros(len(begin), np.int64)
    while len(active):
        u = (ar.mix(seed[active] + np.uint64(len(steps) + 1)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        edge = edge_of[where[active]]
        later = np.flatnonzero(cumulative[edge] <= u)
        while len(later):
            edge[later] += 1
            later = later[cumulative[edge[later]] <= u[later]]
        size = np.where(piece[edge] >= 0, 1, end[edge] - start[edge])
        steps.append((active, edge, size))
        taken[active] += size
        where[active] = start[edge]
        active = active[where[active] > goal[active]]
    tail = np.cumsum(taken)
    ids = np.empty(int(tail[-1]), np.int32)
    per_row = np.bincount(row, taken, n_rows).astype(np.int64)
    for active, edge, size in steps:
        tail[active] -= size
        whole = piece[edge] >= 0
        ids[tail[active[whole]]] = piece[edge[whole]]
        for k in range(4):
            deep = ~whole & (size > k)
            ids[tail[active[deep]] + k] = voc.byte_ids[flat[start[edge[deep]] + k]]
    return ids, per_row


def decode_slice(voc: Vocabulary, ids: np.ndarray, per_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows in a row, and the offset of each row."""
    length = voc.piece_at[ids + 1] - voc.piece_at[ids]
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    data = voc.piece_data[np.repeat(voc.piece_at[ids] - (ends - length), length) + np.arange(total)]
    return data, np.r_[0, ends][np.r_[0, np.cumsum(per_row)]] if len(ends) else np.zeros(len(per_row) + 1, np.int64)


def row_seeds(keys: pa.Array) -> np.ndarray:
    known = keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    none = keys.is_null().to_numpy(zero_copy_only=False)
    return ar.mix(np.where(none, np.uint64(0x5EED), known * np.uint64(2) + np.uint64(1)) + np.uint64(0xA5A5A5A5))


def _encode(voc: Vocabulary):
    def run(batches):
        for rows, data, at in ar.slices(batches, most=SLICE_BYTES):
            keys = ar.column(rows, "doc_id")
            ids, per_row = encode_slice(voc, data, at, row_seeds(keys))
            back, edges = decode_slice(voc, ids, per_row)
            raw, given = back.tobytes(), data.tobytes()
            pieces = [raw[a:b] for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    pa.array(per_row, pa.int64()),
                    ar.lists(ids, per_row, pa.int32()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in pieces]),
                    pa.array([x == given[a:b] for x, a, b in zip(pieces, at[:-1], at[1:])]),
                ],
                ["doc_id", "n_pieces", "ids", "decoded_sha256", "lossless"],
            )

    return run


def encode_documents(docs: DataFrame, path: str = MODEL, alpha: float = ALPHA) -> DataFrame:
    """One row per row of ``docs``: its sampled piece ids, and the digest of what they decode to. No shuffle."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_encode(load_vocabulary(path, alpha)), SCHEMA)


def _decode(voc: Vocabulary):
    def run(batches):
        for batch in batches:
            ids = ar.column(batch, "ids")
            per_row = np.array([len(x) if x is not None else 0 for x in ids.to_pylist()], np.int64)
            data, at = decode_slice(voc, ids.flatten().to_numpy().astype(np.int64), per_row)
            yield pa.RecordBatch.from_arrays([ar.column(batch, "doc_id"), ar.blobs(data, at)], ["doc_id", "text"])

    return run


def decode_documents(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """``(doc_id, text)`` of encoded rows."""
    rows = encoded.select("doc_id", "ids").mapInArrow(_decode(load_vocabulary(path)), "doc_id long, text binary")
    return rows.withColumn("text", F.col("text").cast("string"))
