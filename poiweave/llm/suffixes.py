"""Suffix-array deduplication: remove bytes in 50-byte strings that also start in a smaller document.

Sorting every suffix of a corpus by difference-cover sampling moves some ten times the corpus per level, so suffixes
that cannot repeat are set aside first, and the others are dealt so that all suffixes with a common
50-byte prefix meet:

1. Anchors. In each text the 20-byte strings whose hash is least within some 50-byte window are its anchors
   (one in 15 bytes); equal windows have the same anchor at the same place. Anchors are compared by hash
   over the whole corpus, and only those in two documents go on.
2. Contexts. An anchor's context is all windows that hold it, at most 80 bytes. Equal contexts are
   merged to the smallest document before and after the shuffle, so a passage that a third of all documents
   share is a single context in each task.
3. Suffix array. Each bucket of anchors sorts the suffixes of its distinct contexts with the difference-cover
   algorithm: sampled triples are sorted and named, the string of names is sorted by recursion, the remaining
   suffixes are sorted by their first byte and the rank behind it, and both are merged. Adjacent suffixes whose first 50 bytes agree
   form a class, whose smallest document decides. Equal windows have the same anchor, so a bucket is worked off in parts by the anchor's
   hash, about ``AT_ONCE`` contexts together: arrays, some hundred bytes for each byte of context, stay small. Windows whose hash occurs
   once in them are left out of the array.
4. Anchors that occur more than ``HOT`` times (a phrase in countless different sentences) would make one bucket large; their
   windows are dealt by their own bytes instead, merged by salt first.

Spark distributes steps 1, 2 and 4 and the dealing of step 3: every suffix that could share a 50-byte prefix with another meets it in one
part of a bucket of bounded size. Within a part the difference-cover algorithm (triples, names, recursion, merge) runs in the bucket's task.

Texts travel in groups of about ``GROUP_BYTES``, dealt once by a hash of the id; anchors, contexts and results are packed arrays.

Defined cases: a null or empty text has no bytes; a null id is larger than any other and null ids do not remove from one another; rows of one id
do not remove from one another, and each gets its row; matches never cross rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiweave.llm import arrays as ar

LENGTH = 50
ANCHOR = 20
REACH = LENGTH - ANCHOR
WIDE = LENGTH + REACH
GROUP_BYTES = 1 << 20
BUCKET_BYTES = 4 << 20
HOT = 5000
AT_ONCE = 1 << 12  # contexts sorted together; more where one of a bucket's 256 parts has more
SALTS = 16
LAST = (1 << 63) - 1  # stands for a null id

ANCHORS = "bucket int, g int, hashes binary, counts binary"
REPLIES = "g int, keys binary"
CONTEXTS = "bucket int, salt int, bytes binary, size binary, part binary, owner binary, tag binary, place binary"
SPANS = "g int, owner binary, tag binary, first binary, last binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


# --- suffix array by difference cover ------------------------------------------------------------


def _names(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Order of tuples, the rank of each (equal tuples share one), and the number of ranks."""
    if max(int(c.max(initial=0)) for c in columns) < 1 << 21:
        key = columns[0].astype(np.uint64)
        for c in columns[1:]:
            key = (key << np.uint64(21)) | c.astype(np.uint64)
        order = np.argsort(key, kind="stable")
        fresh = np.r_[True, key[order[1:]] != key[order[:-1]]] if len(key) else np.zeros(0, bool)
    else:
        order = np.lexsort(columns[::-1])
        fresh = np.r_[True, np.any([c[order[1:]] != c[order[:-1]] for c in columns], axis=0)]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(fresh)
    return order, rank, int(fresh.sum())


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by difference-cover sampling; ``text`` holds integers from 1 on."""
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    t = np.r_[text.astype(np.int64), 0, 0, 0]
    # Sampled triples: positions that leave 1 or 2 when divided by 3 (one more, so that the first part ends in a zero).
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.r_[one, two]
    order, rank, different = _names([t[sample], t[sample + 1], t[sample + 2]])
    if different < len(sample):
        order = suffix_array(rank)
        rank = np.empty(len(sample), np.int64)
        rank[order] = np.arange(1, len(sample) + 1)
    at = np.zeros(n + 3, np.int64)
    at[sample] = rank
    ordered = sample[order]
    ordered = ordered[ordered < n]
    # The remaining suffixes by first character and the rank behind it.
    rest = np.arange(0, n, 3)
    rest = rest[np.lexsort((at[rest + 1], t[rest]))]
    # Merge: with suffixes that leave 1 by (character, rank), with those that leave 2 by (two characters, rank).
    wide = len(sample) + 2
    ones, twos = ordered[ordered % 3 == 1], ordered[ordered % 3 == 2]

    def single(i: np.ndarray) -> np.ndarray:
        return t[i] * wide + at[i + 1]

    high = int(t.max()) + 1

    pairs = [t[i] * high + t[i + 1] for i in (twos, rest)]
    if high * high * wide >= 1 << 62:  # pairs by their rank, so that keys fit 64 bits
        dense = np.unique(np.concatenate(pairs), return_inverse=True)[1]
        pairs = [dense[: len(twos)], dense[len(twos) :]]
    doubles, wanted = (p * wide + at[i + 2] for p, i in zip(pairs, (twos, rest)))
    below = np.searchsorted(single(ones), single(rest)) + np.searchsorted(doubles, wanted)
    out = np.full(n, -1, np.int64)
    out[below + np.arange(len(rest))] = rest
    out[out < 0] = ordered
    return out


def window_classes(text: np.ndarray, valid: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Valid window starts in suffix order, and whether each begins a new class (adjacent prefixes differ)."""
    order = suffix_array(text.astype(np.int64) + 1)
    order = order[valid[order]]
    fresh = np.ones(len(order), bool)
    for lo in range(1, len(order), 1 << 15):
        hi = min(len(order), lo + (1 << 15))
        same = np.ones(hi - lo, bool)
        for k in range(length):
            same &= text[order[lo:hi] + k] == text[order[lo - 1 : hi - 1] + k]
        fresh[lo:hi] = ~same
    return order, fresh


# --- anchors --------------------------------------------------------------------------------------


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """Minimum or maximum of every ``width`` neighbours."""
    done = 1
    while done * 2 <= width:
        x = pick(x[:-done], x[done:])
        done *= 2
    return pick(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def anchors(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors and their 64-bit hashes; no anchor crosses a row's end."""
    n = len(data)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    prefix = ar.prefix_hash(data)
    raw = (prefix[ANCHOR:] - prefix[:-ANCHOR]) * ar.powers(n + 1)[1][: n - ANCHOR + 1]
    high = ((raw * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)
    for e in at[1:-1]:  # strings across the end of a row
        high[max(0, e - ANCHOR + 1) : e] = 0xFFFFFFFF
    least = _slide(high, REACH + 1, np.minimum)
    padded = np.r_[np.zeros(REACH, np.uint32), least, np.zeros(REACH, np.uint32)]
    chosen = (_slide(padded, REACH + 1, np.maximum) == high) & (high != 0xFFFFFFFF)
    place = np.flatnonzero(chosen)
    return place, ar.mix(raw[place])


def _tables(table: pa.Table):
    """A group's rows in slices: ids, bytes, offsets and a tag of each text."""
    for batch in table.to_batches():
        for rows, data, at in ar.slices([batch]):
            ids = ar.column(rows, "doc_id").to_numpy()
            raw = data.tobytes()
            yield rows, ids, data, at, np.array([zlib.crc32(raw[a:b]) for a, b in zip(at[:-1], at[1:])], np.uint32)


def _split(bucket: np.ndarray, part: np.ndarray | None = None) -> list[tuple[int, np.ndarray]]:
    """Each bucket with the indexes of its elements, in order of ``part`` if given."""
    order = np.argsort(bucket if part is None else bucket << 8 | part, kind="stable")
    first = ar.runs(bucket[order])
    return [(int(bucket[order[lo]]), order[lo:hi]) for lo, hi in zip(first, np.r_[first[1:], len(order)])]


def _parts(key: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of an anchor's hash, and the 32 bits that tell it apart within the bucket."""
    return ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _send_anchors(buckets: int):
    def run(key, table):
        found, owner = [], []
        for _, ids, data, at, _ in _tables(table):
            place, hashes = anchors(data, at)
            found.append(hashes)
            owner.append(ids[np.searchsorted(at, place, "right") - 1])
        hashes, owner = (np.concatenate(x) for x in (found, owner))
        order = np.argsort(hashes, kind="stable")
        hashes, owner = hashes[order], owner[order]
        first = ar.runs(hashes)
        several = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first) if len(first) else np.zeros(0, bool)
        count = np.minimum(np.diff(np.r_[first, len(hashes)]), 0x7FFF).astype(np.uint16) * np.uint16(2) + several.astype(np.uint16)
        bucket, low = _parts(hashes[first], buckets)
        rows = [(b, key[0].as_py(), low[i].tobytes(), count[i].tobytes()) for b, i in _split(bucket)]
        return _table(rows, ANCHORS)

    return run


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.table([pa.array(c, _KINDS[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _column(table: pa.Table, name: str, kind) -> np.ndarray:
    """All packed values of a column, one row after another."""
    return np.frombuffer(b"".join(x.as_py() for x in table.column(name)), kind)


def _sizes(table: pa.Table, name: str, width: int) -> np.ndarray:
    return np.array([len(x.as_py()) // width for x in table.column(name)], np.int64)


def _repeated_anchors(key, table):
    """To each group: its anchors that occur in two documents; those in many groups are marked."""
    low, counts = _column(table, "hashes", np.uint32), _column(table, "counts", np.uint16)
    group = np.repeat(table.column("g").to_numpy(), _sizes(table, "hashes", 4))
    _, place, in_groups = np.unique(low, return_inverse=True, return_counts=True)
    several = np.bincount(place, counts & 1) > 0
    again = ((in_groups > 1) | several)[place]
    hot = np.bincount(place, counts >> 1) > HOT
    packed = ((np.uint64(key[0].as_py()) << np.uint64(33)) | (hot[place].astype(np.uint64) << np.uint64(32)) | low)[again]
    return _table([(g, packed[i].tobytes()) for g, i in _split(group[again])], REPLIES)


# --- contexts -------------------------------------------------------------------------------------


def _merged(bytes_: np.ndarray, size: np.ndarray, owner: np.ndarray):
    """Number of each record's distinct context, the first record of each, and its smallest document."""
    packed = np.concatenate([bytes_, size.reshape(-1, 1)], axis=1)
    whole = np.ascontiguousarray(packed).view(np.dtype((np.void, packed.shape[1]))).ravel()
    _, first, number = np.unique(whole, return_index=True, return_inverse=True)
    least = np.full(len(first), LAST, np.int64)
    np.minimum.at(least, number, owner)
    return number, first, least


_SPAN_KINDS = (np.int64, np.uint32, np.int32, np.int32)


def _span_columns(table: pa.Table) -> list[np.ndarray]:
    return [_column(table, n, kind) for n, kind in zip(("owner", "tag", "first", "last"), _SPAN_KINDS)]


class _Spans:
    """Spans to remove, packed by group of documents."""

    def __init__(self, groups: int):
        self.groups, self.found = groups, []

    def add(self, owner, tag, first, last) -> None:
        if len(owner):
            self.found.append((owner, tag, first, last))

    def rows(self) -> list[tuple]:
        if not self.found:
            return []
        owner, tag, first, last = _joined(*(np.concatenate(x) for x in zip(*self.found)))
        g = group_of(owner, tag, self.groups)
        return [(k, *(x[i].astype(kind).tobytes() for x, kind in zip((owner, tag, first, last), _SPAN_KINDS))) for k, i in _split(g)]


# What goes between the context steps: records of a bucket, and decided spans of group g under bucket -1 - g.
OPEN = CONTEXTS + ", first binary, last binary"
_NAMES = [x.split()[0] for x in OPEN.split(", ")]


def _open_rows(records: list[tuple], spans: _Spans) -> pa.Table:
    done = [(-1 - g, -1, None, None, None, o, t, None, f, e) for g, o, t, f, e in spans.rows()]
    return _table([(*r, None, None) for r in records] + done, OPEN)


def _send_contexts(buckets: int, groups: int):
    def run(key, texts, replies):
        wanted = np.unique(_column(replies, "keys", np.uint64))
        spans, records = _Spans(groups), []
        if not len(wanted) or not texts.num_rows:
            return _open_rows([], spans)
        hot_bit = np.uint64(1 << 32)
        plain = wanted & ~hot_bit
        order = np.argsort(plain)
        plain, is_hot = plain[order], (wanted & hot_bit)[order] > 0
        cold, hot = [], []
        for _, ids, data, at, tags in _tables(texts):
            place, hashes = anchors(data, at)
            bucket, low = _parts(hashes, buckets)
            full = (bucket.astype(np.uint64) << np.uint64(33)) | low
            k = np.minimum(np.searchsorted(plain, full), len(plain) - 1)
            hit = plain[k] == full
            place, bucket, part, flag = place[hit], bucket[hit], low[hit] >> np.uint32(24), is_hot[k[hit]]
            row = np.searchsorted(at, place, "right") - 1
            start, end = np.maximum(place - REACH, at[row]), np.minimum(place + ANCHOR + REACH, at[row + 1])
            fits = end - start >= LENGTH
            padded = np.r_[data, np.zeros(WIDE, np.uint8)]
            for mask, into, width in ((fits & ~flag, cold, WIDE), (fits & flag, hot, LENGTH)):
                s, e, r, b, p = start[mask], end[mask], row[mask], bucket[mask], part[mask]
                if width == LENGTH:  # each window on its own
                    n = e - s - LENGTH + 1
                    s = np.repeat(s, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    s, r = np.unique(np.stack([s, np.repeat(r, n)]), axis=1) if len(s) else (s, np.repeat(r, n))
                    e, b = s + LENGTH, None
                body = np.lib.stride_tricks.sliding_window_view(padded, width)[s]
                body[np.arange(width) >= (e - s)[:, None]] = 0
                if b is None:
                    whole = ar.span_hash(ar.prefix_hash(data), s, e)
                    b, p = (whole % np.uint64(buckets)).astype(np.int64), whole >> np.uint64(56)
                into.append((b, body, (e - s).astype(np.uint8), p.astype(np.uint8), ids[r], tags[r], s - at[r]))
        salt = key[0].as_py() % SALTS
        for parts, number in ((cold, -1), (hot, salt)):
            b, body, size, part, owner, tag, place = (np.concatenate(x) for x in zip(*parts))
            if not len(b):
                continue
            records += _undecided(b, body, size, part, owner, tag, place, number, spans)
        return _open_rows(records, spans)

    return run


def _undecided(bucket, body, size, part, owner, tag, place, salt: int, spans: _Spans) -> list[tuple]:
    """Records that hold their context's smallest document here; the others are decided: all their bytes go."""
    number, _, least = _merged(body, size, owner)
    later = owner > least[number]
    spans.add(owner[later], tag[later], place[later], place[later] + size[later])
    keep = np.flatnonzero(~later)
    pack = zstandard.ZstdCompressor(level=3).compress
    return [
        (b, salt, pack(body[i].tobytes()), size[i].tobytes(), part[i].tobytes(), owner[i].astype(np.int64).tobytes(), tag[i].astype(np.uint32).tobytes(), place[i].astype(np.int32).tobytes())
        for b, i in ((b, keep[i]) for b, i in _split(bucket[keep], part[keep]))
    ]


def _unpacked(table: pa.Table):
    size = _column(table, "size", np.uint8)
    per = _sizes(table, "size", 1)
    body = np.zeros((len(size), WIDE), np.uint8)
    at, unpack = 0, zstandard.ZstdDecompressor().decompress
    for n, raw in zip(per, table.column("bytes")):
        if n:
            part = np.frombuffer(unpack(raw.as_py()), np.uint8).reshape(n, -1)
            body[at : at + n, : part.shape[1]] = part
            at += n
    kinds = {"part": np.uint8, "owner": np.int64, "tag": np.uint32, "place": np.int32}
    return body, size, *(_column(table, name, kind) for name, kind in kinds.items())


def _decided(table: pa.Table, groups: int) -> _Spans:
    """The spans to remove among the records of a bucket, found in whole parts, about ``AT_ONCE`` records together."""
    spans = _Spans(groups)
    body, size, part, owner, tag, place = _unpacked(table)
    order = np.argsort(part, kind="stable")
    edges = np.r_[ar.runs(part[order]), len(order)]
    lo = 0
    while lo < len(order):
        hi = max(edges[edges <= lo + AT_ONCE][-1], edges[edges > lo][0])
        i = order[lo:hi]
        _decide(body[i], size[i], owner[i], tag[i], place[i].astype(np.int64), spans)
        lo = hi
    return spans


def _decide(body, size, owner, tag, place, spans: _Spans) -> None:
    number, first, least = _merged(body, size, owner)
    later = owner > least[number]
    spans.add(owner[later], tag[later], place[later], place[later] + size[later])

    # Windows of distinct contexts; those whose hash occurs once here repeat nothing.
    length = size[first].astype(np.int64)
    ends = np.cumsum(length + 1)
    begins = ends - length - 1
    text = np.zeros(int(ends[-1]), np.uint8)
    at = np.repeat(begins - (np.cumsum(length) - length), length) + np.arange(length.sum())
    text[at] = body[first][np.arange(WIDE) < length[:, None]]
    windows = length - LENGTH + 1
    start = np.repeat(begins - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    context = np.repeat(np.arange(len(first)), windows)
    hashes = ar.span_hash(ar.prefix_hash(text), start, start + LENGTH)
    _, same, count = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = np.zeros(len(first), bool)
    shared[context[count[same] > 1]] = True
    if shared.any():
        keep = np.repeat(shared, length + 1)
        valid = np.zeros(len(text), bool)
        valid[start[count[same] > 1]] = True
        of = np.repeat(np.arange(len(first)), length + 1)[keep]
        offset = (np.arange(len(text)) - np.repeat(begins, length + 1))[keep]
        order, fresh = window_classes(text[keep], valid[keep])
        run_first = np.flatnonzero(fresh)
        smallest = np.minimum.reduceat(least[of[order]], run_first)[np.cumsum(fresh) - 1]
        gone = order[smallest < least[of[order]]]
        # Each window that goes, in every record of its context that is not decided yet.
        open_ = np.flatnonzero(~later)
        open_ = open_[np.argsort(number[open_], kind="stable")]
        lo = np.searchsorted(number[open_], of[gone])
        n = np.searchsorted(number[open_], of[gone], "right") - lo
        record = open_[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        begin = place[record] + np.repeat(offset[gone], n)
        spans.add(*_joined(owner[record], tag[record], begin, begin + LENGTH))


def _first_merge(groups: int):
    """Cold buckets are decided; hot windows of one salt are merged to one record each; spans pass."""

    def run(key, table):
        bucket, salt = key[0].as_py(), key[1].as_py()
        if bucket < 0:
            return table.select(_NAMES)
        if salt < 0:
            return _open_rows([], _decided(table, groups))
        spans = _Spans(groups)
        body, size, part, owner, tag, place = _unpacked(table)
        return _open_rows(_undecided(np.full(len(size), bucket), body, size, part, owner, tag, place, 0, spans), spans)

    return run


def _last_merge(groups: int):
    """Hot windows of all salts are decided; spans pass."""

    def run(key, table):
        bucket = key[0].as_py()
        if bucket < 0:
            spans = _Spans(groups)
            spans.add(*_span_columns(table))
            return _table(spans.rows(), SPANS)
        return _table(_decided(table, groups).rows(), SPANS)

    return run


def _joined(owner, tag, first, last):
    """Overlapping spans of one document as one."""
    order = np.lexsort((first, tag, owner))
    owner, tag, first, last = owner[order], tag[order], first[order], last[order]
    if not len(owner):
        return owner, tag, first, last
    # Ends rise with starts here: contexts and windows have one length, or were joined before, but for those cut at a text's end.
    fresh = np.r_[True, (owner[1:] != owner[:-1]) | (tag[1:] != tag[:-1]) | (first[1:] > last[:-1])]
    begin = np.flatnonzero(fresh)
    return owner[begin], tag[begin], first[begin], np.maximum.reduceat(last, begin)


def _apply(key, texts, spans):
    owner, tag, first, last = _span_columns(spans)
    order = np.lexsort((first, tag, owner))
    owner, tag, first, last = owner[order], tag[order], first[order], last[order]
    out = []
    for rows, ids, data, at, tags in _tables(texts):
        given = ar.column(rows, "doc_id").to_pylist()
        raw = data.tobytes()
        for r, doc in enumerate(ids):
            text = raw[at[r] : at[r + 1]]
            lo, hi = np.searchsorted(owner, doc), np.searchsorted(owner, doc, "right")
            lo, hi = lo + np.searchsorted(tag[lo:hi], tags[r]), lo + np.searchsorted(tag[lo:hi], tags[r], "right")
            kept, end, n_spans = [], 0, 0
            reach = np.maximum.accumulate(last[lo:hi]) if hi > lo else last[lo:hi]
            fresh = np.flatnonzero(np.r_[True, first[lo:hi][1:] > reach[:-1]]) if hi > lo else []
            for k, f in enumerate(fresh):
                kept.append(text[end : first[lo + f]])
                end = int(reach[(fresh[k + 1] if k + 1 < len(fresh) else hi - lo) - 1])
                n_spans += 1
            left = b"".join([*kept, text[end:]])
            out.append((given[r], len(text), len(text) - len(left), n_spans, left))
    return _table(out, RESULT)


def drop_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans and the bytes that are left."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups, buckets = max(1, -(-total // GROUP_BYTES)), max(1, -(-total // BUCKET_BYTES))
    # The texts are shuffled once; all three steps below read that shuffle.
    dealt = rows.withColumn("g", group_column(groups)).groupBy("g")
    sent = dealt.applyInArrow(_send_anchors(buckets), ANCHORS)
    replies = sent.groupBy("bucket").applyInArrow(_repeated_anchors, REPLIES)
    opened = dealt.cogroup(replies.groupBy("g")).applyInArrow(_send_contexts(buckets, groups), OPEN)
    merged = opened.groupBy("bucket", "salt").applyInArrow(_first_merge(groups), OPEN)
    spans = merged.groupBy("bucket").applyInArrow(_last_merge(groups), SPANS)
    done = dealt.cogroup(spans.groupBy("g")).applyInArrow(_apply, RESULT)
    return done.withColumn("doc_id", F.when(F.col("doc_id") != LAST, F.col("doc_id")))


def group_of(ids: np.ndarray, tags: np.ndarray, groups: int) -> np.ndarray:
    """Group of documents by id and text; as ``group_column``."""
    ids = ids.astype(np.int64)
    return ((ids ^ (ids.view(np.uint64) >> np.uint64(31)).view(np.int64) ^ tags.astype(np.int64)) % groups).astype(np.int64)


def group_column(groups: int) -> Column:
    x = F.col("doc_id").bitwiseXOR(F.shiftrightunsigned("doc_id", 31)).bitwiseXOR(F.crc32("text"))
    return F.pmod(x, F.lit(groups)).cast("int")
