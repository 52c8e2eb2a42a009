"""Each operator against a brute-force version on small inputs: nulls, empty and long texts, ties, repeated rows,
empty tables and extra columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from poiweave.llm import arrays as ar
from poiweave.llm import decontamination, exact, language, linechunks, minhash, pieces, quality, suffixes, toxicity, warc
from poiweave.llm.shared import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string"
_rng = random.Random(5)
_VOCABULARY = ["".join(_rng.choice("abcdeinorst") for _ in range(_rng.randint(2, 8))) for _ in range(400)]


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(_VOCABULARY) + ("." if rng.random() < 0.1 else "") for _ in range(n))


def frame(spark, rows):
    """Documents with columns whose names clash with those of results."""
    return spark.createDataFrame([(i, t, "en", "src", None, "x", "y") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, shared passages, nulls, blanks, a repeated row and a long text."""
    rows = [(i, prose(60 + 7 * (i % 9), i)) for i in range(40)]
    rows += [(100 + i, rows[3][1]) for i in range(7)]
    for k in range(12):
        words = rows[5][1].split()
        words[k * 3 % len(words)] = f"edit{k}"
        rows.append((200 + k, " ".join(words)))
    shared = prose(40, 999)
    rows += [(300 + k, prose(10, 300 + k) + " " + shared + " " + prose(12, 400 + k)) for k in range(15)]
    rows += [(400, None), (401, ""), (402, "   \n\t"), (403, "one two"), (404, "One TWO"), (405, "é" * 60), (406, "é" * 61)]
    rows += [(407, prose(6000, 7)), (408, rows[7][1]), (408, rows[7][1]), (None, rows[9][1]), (None, None), (500, "a" * 300), (501, "a" * 200)]
    return rows


# --- exact -----------------------------------------------------------------------------------------


def test_exact_groups_equal_brute_force(spark, corpus):
    got = sorted(map(tuple, exact.exact_groups(frame(spark, corpus), salts=3).collect()), key=repr)
    groups = {}
    for i, t in corpus:
        groups.setdefault(t or "", []).append(i)
    expected = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        seen = Counter()
        for i in ids:
            seen[i] += 1
            expected.append((i, keep, len(ids), i == keep and seen[i] == 1, hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(expected, key=repr)


def test_drop_copies_keeps_one_row_of_each_text(spark, corpus):
    docs = frame(spark, corpus)
    kept = exact.drop_copies(docs)
    assert kept.columns == docs.columns
    assert Counter(r.text or "" for r in kept.collect()) == Counter({t or "" for _, t in corpus})


# --- suffix array ----------------------------------------------------------------------------------


def test_suffix_array_equals_sorting():
    rng = np.random.default_rng(0)
    for n in [*range(12), 50, 300]:
        for letters in (1, 2, 6):
            text = rng.integers(1, letters + 1, n)
            assert suffixes.suffix_array(text).tolist() == sorted(range(n), key=lambda i: text[i:].tolist())


def brute_repeats(rows, length=50):
    order = lambda i: (i is None, i or 0)
    first = {}
    for i, t in sorted(rows, key=lambda r: order(r[0])):
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            first.setdefault(b[k : k + length], order(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < order(i):
                gone[k : k + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept))
    return sorted(out, key=repr)


def test_repeated_strings_equal_brute_force(spark, corpus, monkeypatch):
    monkeypatch.setattr(suffixes, "GROUP_BYTES", 5000)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 20000)
    got = [(r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffixes.drop_repeats(frame(spark, corpus)).collect()]
    assert sorted(got, key=repr) == brute_repeats(corpus)


def test_hot_windows_give_the_same_spans(corpus, monkeypatch):
    """The steps of the job by hand, with every anchor dealt by windows."""
    import pyarrow as pa

    rows = [(i if i is not None else suffixes.LAST, t or "") for i, t in corpus]
    expected = brute_repeats(rows)
    for hot in (10**9, 2):
        monkeypatch.setattr(suffixes, "HOT", hot)
        groups, buckets = 5, 3
        ids, tags = np.array([i for i, _ in rows]), np.array([zlib.crc32(t.encode()) for _, t in rows], np.uint32)
        of = suffixes.group_of(ids, tags, groups)
        texts = {g: pa.table({"doc_id": pa.array(ids[of == g]), "text": pa.array([t for (_, t), k in zip(rows, of) if k == g])}) for g in set(of.tolist())}

        def grouped(tables, *names):
            whole = pa.concat_tables([t for t in tables if t.num_rows] or tables[:1])
            keys = list(zip(*(whole.column(n).to_pylist() for n in names)))
            return {k: whole.filter(pa.array([x == k for x in keys])) for k in set(keys)}

        key = lambda k: tuple(pa.scalar(x) for x in k)
        sent = [suffixes._send_anchors(buckets)(key((g,)), t) for g, t in texts.items()]
        replies = grouped([suffixes._repeated_anchors(key(k), t) for k, t in grouped(sent, "bucket").items()], "g")
        opened = [suffixes._send_contexts(buckets, groups)(key((g,)), t, replies.get((g,), pa.table({"keys": pa.array([], pa.binary())}))) for g, t in texts.items()]
        merged = [suffixes._first_merge(groups)(key(k), t) for k, t in grouped(opened, "bucket", "salt").items()]
        spans = grouped([suffixes._last_merge(groups)(key(k), t) for k, t in grouped(merged, "bucket").items()], "g")
        none = pa.table({n: pa.array([], pa.binary()) for n in ("owner", "tag", "first", "last")})
        done = [suffixes._apply(key((g,)), t, spans.get((g,), none)) for g, t in texts.items()]
        got = [tuple(r.values()) for t in done for r in t.to_pylist()]
        assert sorted(got, key=repr) == expected


def test_a_bucket_is_worked_off_in_parts(monkeypatch):
    """A bucket of many contexts that all overlap others: arrays of bounded size, and the same spans however many go together."""
    import tracemalloc

    import pyarrow as pa

    key = lambda *k: tuple(pa.scalar(x) for x in k)
    passages = [prose(60, 5000 + k) for k in range(1500)]
    texts = [f"{prose(3, k)} {passages[k % 1500]} {prose(3, 9000 + k)}" for k in range(3000)]
    table = pa.table({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})
    replies = suffixes._repeated_anchors(key(0), suffixes._send_anchors(1)(key(0), table))
    opened = suffixes._send_contexts(1, 1)(key(0), table, replies)
    opened = opened.filter(pa.array([b == 0 for b in opened.column("bucket").to_pylist()]))
    peaks, spans = [], []
    for most in (1 << 30, suffixes.AT_ONCE):
        monkeypatch.setattr(suffixes, "AT_ONCE", most)
        tracemalloc.start()
        found = suffixes._decided(opened, 1)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        gone = [set() for _ in texts]
        for owner, _, first, last in found.found:
            for o, a, b in zip(owner.tolist(), first.tolist(), last.tolist()):
                gone[o].update(range(a, b))
        spans.append(gone)
    records = sum(len(x) for x in opened.column("size").to_pylist())
    assert records > 4 * suffixes.AT_ONCE and spans[0] == spans[1] and any(spans[0])
    assert peaks[1] < 50 << 20 and peaks[1] < peaks[0] / 2


# --- near-duplicates -------------------------------------------------------------------------------


def word_sets(rows, size=4):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    out = []
    for i, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(lower))
        out.append((i, {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()))
    return out


def brute_components(sets):
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = [(i, s) for i, s in sets if i is not None and s]
    for n, (i, a) in enumerate(known):
        for j, b in known[:n]:
            if 100 * len(a & b) >= 80 * len(a | b):
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    return {i: find(i) for i in parent}


def test_near_groups_equal_brute_force(spark, corpus):
    sets = word_sets(corpus)
    of = brute_components(sets)
    got = sorted(map(tuple, minhash.near_groups(frame(spark, corpus)).collect()), key=repr)
    expected = [(i, len(s), of.get(i), of.get(i) == i) for i, s in sets]
    assert got == sorted(expected, key=repr)


def test_dropping_near_copies_takes_shingles_of_five_words(spark):
    """Four edits in 165 words: similar by four-word shingles, not by five-word ones."""
    words = prose(165, 31).split()
    edited = [f"edit{k}" if k in (20, 60, 100, 140) else w for k, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join([*words[:-1], "end"]))]
    fours, fives = ([{tuple(t.split()[k : k + n]) for k in range(len(t.split()) - n + 1)} for _, t in rows[:2]] for n in (4, 5))
    assert len(fours[0] & fours[1]) >= 0.8 * len(fours[0] | fours[1]) and len(fives[0] & fives[1]) < 0.8 * len(fives[0] | fives[1])
    assert {r.doc_id for r in minhash.drop_near_copies(frame(spark, rows)).collect()} == {1, 2}
    assert {r.doc_id for r in minhash.near_groups(frame(spark, rows)).collect() if r.kept} == {1}


def test_blocks_find_what_hubs_leave(spark):
    """A chain of edits: only neighbours are similar, so hubs do not meet all links."""
    words = prose(100, 1).split()
    rows = []
    for k in range(14):
        words = list(words)
        words[k * 7] = f"edit{k}"
        rows.append((k, " ".join(words)))
    rows += [(50 + k, prose(80, 50 + k)) for k in range(5)]
    of = brute_components(word_sets(rows))
    got = {r.doc_id: r.component_id for r in minhash.near_groups(frame(spark, rows), block=3).collect()}
    assert got == of


@pytest.mark.parametrize("seed,block", [(1, 4), (2, 256)])
def test_links_around_the_threshold_equal_brute_force(spark, seed, block):
    """Many copies with few to many edits, of several lengths: some link to their hub, some to others only, some to none."""
    rng = random.Random(seed)
    rows = []
    for base in range(3):
        words = prose(60 + 90 * base, 700 + base).split()
        for k in range(60):
            edited = list(words)
            for at in rng.sample(range(len(words)), rng.randint(1, 1 + len(words) // 25)):
                edited[at] = f"edit{rng.randint(0, 3)}"
            rows.append((len(rows), " ".join(edited[rng.randint(0, 8) :])))
    of = brute_components(word_sets(rows))
    got = {r.doc_id: r.component_id for r in minhash.near_groups(frame(spark, rows), block=block).collect()}
    assert got == of and 10 < len(set(of.values())) < len(rows) - 60


def test_dropping_copies_keeps_rows_and_columns_as_they_are(spark):
    """Column names that the operators use themselves, repeated rows, rows without an id."""
    text = prose(80, 5)
    near = text + " end"
    rows = [(1, text), (1, text), (2, near), (3, text), (None, text), (None, None), (4, prose(50, 6))]
    names = ["_gone", "_id", "_sha", "_times", "row", "id", "component_id", "keep_id", "body"]
    docs = spark.createDataFrame([(i, t, *["x"] * len(names)) for i, t in rows], f"doc_id long, text string, {', '.join(f'{n} string' for n in names)}")
    left = minhash.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter([1, 1, None, None, 4])
    left = exact.drop_copies(docs)
    assert left.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter([(2, near), (3, text), (None, None), (4, rows[6][1])])


def test_rows_of_one_id_are_one_document(spark):
    """Its set is that of the row with the largest set key; the id meets other documents by that set alone."""
    rows = [(1, prose(60, 1)), (1, prose(60, 2)), (2, prose(60, 1)), (3, prose(60, 2))]
    got = {(r.doc_id, r.component_id) for r in minhash.near_groups(frame(spark, rows)).collect()}
    assert got in ({(1, 1), (2, 1), (3, 3)}, {(1, 1), (2, 2), (3, 1)})


def test_sequential_bounds_keep_similar_pairs():
    least = minhash.least_matches()
    assert least[0] == 0 and all(b >= a for a, b in zip(least, least[1:]))
    rng = np.random.default_rng(1)
    pairs = rng.random((20000, minhash.HASHES)) < 0.8
    assert (minhash.surviving(pairs.astype(int), np.ones_like(pairs, int)) >= 0).all()
    far = rng.random((2000, minhash.HASHES)) < 0.3
    assert (minhash.surviving(far.astype(int), np.ones_like(far, int)) < 0).mean() > 0.99


def test_components_follow_a_long_chain(spark):
    nodes = spark.range(60).select(F.col("id").alias("doc_id"), F.col("id").alias("component"))
    links = spark.createDataFrame([((k * 37) % 60, ((k + 1) * 37) % 60) for k in range(50)], "a long, b long")
    got = {r.doc_id: r.component for r in components(nodes, links).collect()}
    chain = [(k * 37) % 60 for k in range(51)]
    assert {got[x] for x in chain} == {min(chain)}
    assert all(got[x] == x for x in range(60) if x not in chain)


# --- lines -----------------------------------------------------------------------------------------


def split_lines(text):
    return re.findall(r"[^\n]*\n|[^\n]+", text or "")


def line_chunks(lines, divisor):
    """Chunks by plain loops: the rolled hash of the last two lines, in Python integers."""

    def line_hash(line):
        data = np.frombuffer(line.encode(), np.uint8)
        return int(ar.span_hash(ar.prefix_hash(data), np.array([0]), np.array([len(data)]))[0])

    def mixed(h):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = ((h ^ (h >> shift)) * factor) % 2**64
        return h ^ (h >> 31)

    hashes = [line_hash(x) for x in lines]
    rolled = [mixed((h + (hashes[k - 1] * 0x9E3779B97F4A7C15 if k else 0)) % 2**64) for k, h in enumerate(hashes)]
    ends = [k + 1 for k, h in enumerate(rolled) if (h >> 40) % divisor == 0 or k + 1 == len(lines)]
    begins = [0] + [e for e in ends if e < len(lines)]
    return [(b, next(e for e in ends if e >= b + 2)) for b in begins if b + 2 <= len(lines)]


def brute_lines(rows, divisors):
    """What is left of each row: lines of chunks that stand earlier go, lines of first places stay."""
    found, order = {}, lambda r: (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).digest())
    for i, t in sorted(set(rows), key=order):
        own = split_lines(t)
        for d in divisors:
            for b, e in line_chunks(own, d):
                if "".join(own[b:e]).strip():
                    found.setdefault("".join(own[b:e]), []).append(((i, t), b, e))
    gone, stays = {}, {}
    for places in found.values():
        if len({(r, b) for r, b, _ in places}) > 1 or rows.count(places[0][0]) > 1:
            head = min(places, key=lambda p: (order(p[0]), sum(len(x.encode()) for x in split_lines(p[0][1])[: p[1]])))
            for r, b, e in places:
                (stays if (r, b) == head[:2] else gone).setdefault(r, set()).update(range(b, e))
    return ["".join(x for k, x in enumerate(split_lines(t)) if k not in gone.get((i, t), set()) - stays.get((i, t), set())) for i, t in rows]


def line_rows():
    """Passages of two to twelve lines in several surroundings, cut short at times, and lines that repeat within a text."""
    rng, rows = random.Random(12), []
    passages = ["".join(prose(5, 900 + 20 * n + j) + "\n" for j in range(n)) for n in range(2, 13)]
    for k in range(90):
        parts = []
        for _ in range(rng.randint(1, 3)):
            lines = split_lines(rng.choice(passages))
            lines = lines[rng.randint(0, len(lines) // 3) :] if rng.random() < 0.3 else lines
            parts += ["".join(prose(5, 5000 + 10 * k + j) + "\n" for j in range(rng.randint(0, 4))), "".join(lines)]
        rows.append((k, "".join(parts) + (prose(4, k) if k % 2 else "")))
    rows += [(150, "a b\na b\na b\na b\n"), (151, "é\nü\nx\né\nü\n"), (152, None), (153, ""), (154, "\n\n\n"), (155, "\n\n\n")]
    return rows + [(156, "single"), (157, "single"), (158, rows[4][1]), (158, rows[4][1]), (None, rows[5][1]), (None, rows[6][1] + "\nw")]


@pytest.mark.parametrize("divisors", [(1,), (8,), (8, 1), (16, 4, 1)])
def test_line_chunks_equal_brute_force(spark, divisors):
    rows = line_rows()
    got = linechunks.drop_repeated_chunks(frame(spark, rows), divisors).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, t) for (i, _), t in zip(rows, brute_lines(rows, divisors)))
    assert sum(r.n_removed_lines for r in got) > 100
    texts = Counter((i, len((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, len(r.text.encode()) + r.n_removed_bytes) for r in got) == texts


def test_repeated_runs_of_lines_go_and_stay_once(spark):
    """Of the lines in runs of two or more that stand earlier, at least nine in ten go; every pair of neighbouring lines that
    repeats still stands somewhere."""
    rows = line_rows()[:90]
    got = {r.doc_id: r.text for r in linechunks.drop_repeated_chunks(frame(spark, rows)).collect()}
    earlier, repeated, removed = set(), 0, 0
    for i, t in rows:
        own, run = split_lines(t), set()
        pairs = list(zip(own, own[1:]))
        for k, pair in enumerate(pairs):
            if pair in earlier or pair in pairs[: max(0, k - 1)]:
                run |= {k, k + 1}
        earlier |= set(pairs)
        repeated += len(run)
        removed += len(own) - len(split_lines(got[i]))
        assert len(own) - len(split_lines(got[i])) <= len(run)
    assert repeated > 500 and removed >= 0.9 * repeated
    left = {p for t in got.values() for p in zip(split_lines(t), split_lines(t)[1:])}
    times = Counter(p for _, t in rows for p in zip(split_lines(t), split_lines(t)[1:]))
    assert {p for p, n in times.items() if n > 1} <= left


def test_the_first_copy_of_overlapping_runs_stays_whole(spark):
    rows = [(1, "X\nA\n"), (2, "X\nA\nB\n"), (3, "A\nB\n"), (4, "Y\nX\nA\nB\n")]
    got = {r.doc_id: r.text for r in linechunks.drop_repeated_chunks(frame(spark, rows)).collect()}
    assert got[1] == "X\nA\n" and got[3] == "" and got[4] == "Y\n" and "A\nB\n" in got[2]


def test_lines_of_rows_without_id_or_with_one_id(spark):
    run, other = "é é é\nü ü ü\nä ä ä\n", "öööö\nown line\n"
    rows = [(1, run), (2, "x\n" + run), (2, other + "yéyé\n" + run + other), (None, "z\n" + run), (None, "z\n" + run), (None, run + "w\n")]
    got = linechunks.drop_repeated_chunks(frame(spark, rows), (1,)).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, t) for (i, _), t in zip(rows, brute_lines(rows, (1,))))


def test_lines_of_a_long_text_and_of_no_rows(spark):
    long = "".join(f"line {k % 700} of {k}\n" for k in range(30_000))
    rows = [(1, long), (2, "x\n" + long + "y\n"), (3, long[: len(long) // 2])]
    got = {r.doc_id: r.text for r in linechunks.drop_repeated_chunks(frame(spark, rows)).collect()}
    assert got[1] == long and got[2] == "x\ny\n" and got[3] in ("", long[: len(long) // 2].rsplit("\n", 1)[1])
    assert linechunks.drop_repeated_chunks(frame(spark, [])).collect() == []


# --- archives --------------------------------------------------------------------------------------


def test_warc_round_trip(spark):
    long = "<p>" + "ü€x" * 9000 + "</p>"
    rows = [(1, "http://a/1", long), (2, "http://a/2", long), (3, None, None), (4, "u\r\nX: y", "x" * 99), (5, "u", "x" * 99), (6, "u", "WARC/1.1\r\n\r\n0\r\n\r\n" * 20), (7, "u", "y" * 100), (9, "u", "y" * 100), (9, "u", "y" * 100)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload string")
    got = warc.round_trip(spark, pages).select(
        warc.page_id_of(F.col("record_id")), "payload_bytes", "payload_digest", "type", warc.page_id_of(F.col("refers_to")), "error"
    ).collect()
    first, expected = {}, []
    for i, _, html in sorted(set(rows), key=repr):
        body = (html or "").encode()
        head = first.setdefault(body, i) if len(body) >= 100 else i
        expected.append((i, len(body), hashlib.sha256(body).hexdigest(), "response" if head == i else "revisit", None if head == i else head, None))
    assert sorted(map(tuple, got)) == sorted(expected)


def test_warc_gives_a_row_for_each_repeated_row(spark):
    long = "<p>" + "ü€x" * 9000 + "</p>"
    rows = [(1, "u", long), (1, "u", long), (1, "v", long), (2, "w", long), (2, "w", long), (3, "u", "x"), (3, "u", "x"), (4, "u", "y" * 200), (None, "u", long), (None, "u", long), (5, "a", None), (5, "a", ""), (5, None, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = warc.round_trip(spark, pages, every_row=True)
    got = whole.select(warc.page_id_of(F.col("record_id")), "target", "payload_bytes", "payload_digest", "type", warc.page_id_of(F.col("refers_to")), "error").collect()
    expected = []
    for i, url, html in rows:
        body = (html or "").encode()
        later = i == 2
        expected.append((i, url or "", len(body), hashlib.sha256(body).hexdigest(), "revisit" if later else "response", 1 if later else None, None))
    assert Counter(map(tuple, got)) == Counter(expected)
    assert whole.select("record_id").distinct().count() == len(rows)


def test_archives_hold_a_valid_record_in_each_gzip_member(spark, tmp_path):
    rows = [(1, "http://a/1\r\nX: y", "ü" * 9000), (2, "http://a/2", "ü" * 9000), (3, None, None), (None, "http://a/n", "x" * 5000)]
    planned = warc.plan_records(spark.createDataFrame(rows, "page_id long, url string, html string"))
    warc.write_archives(planned, str(tmp_path / "w"), date="2026-01-02T03:04:05Z")
    kinds, http = Counter(), "application/http; msgtype=response"
    for file in (tmp_path / "w").glob("part-*"):
        left = file.read_bytes()
        while left:
            reader = zlib.decompressobj(31)
            record, left = reader.decompress(left), reader.unused_data
            assert reader.eof and record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            head, _, rest = record.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head.decode().split("\r\n")[1:])
            assert int(fields["Content-Length"]) == len(rest) - 4
            assert fields["WARC-Date"] == "2026-01-02T03:04:05Z" and re.fullmatch("<urn:[^<>]+>", fields["WARC-Record-ID"]) and "WARC-Target-URI" in fields
            kind = fields["WARC-Type"]
            kinds[kind] += 1
            assert kind == "continuation" or fields["Content-Type"] == http
            assert (kind == "revisit") == ("WARC-Profile" in fields) == ("WARC-Refers-To" in fields)
            assert kind != "continuation" or {"WARC-Segment-Number", "WARC-Segment-Origin-ID"} <= set(fields)
    assert kinds == {"response": 3, "revisit": 1, "continuation": 4 + 1}
    large = b"z" * (1 << 24)
    assert warc.members(large)[-1:] == warc.members(b"x")[-1:] == b"\0" and zlib.decompressobj(31).decompress(warc.members(b"x")) == b"x"
    spark_rows = warc.round_trip(spark, spark.createDataFrame([], "page_id long, url string, html string"))
    assert spark_rows.count() == 0


def test_broken_archives_give_errors():
    records = [warc.records_of({"record_type": "response", "record_id": f"<urn:page:{k}:ab>", "url": "u", "payload_digest": "d", "payload": prose(900, k)}, 1 << 20, 300)[0] for k in range(40)]
    data = b"".join(map(warc.members, records))
    assert warc.unzipped(data) == (b"".join(records), True)
    for broken in (data[:-9], data[:-9] + b"garbage!!"):
        rows = list(warc.parse_archive(broken))
        assert [r[0] for r in rows[:39]] == [f"<urn:page:{k}:ab>" for k in range(39)] and rows[-1][-1] == "archive cut short"


def test_warc_segments_are_verified(spark):
    page = {"record_type": "response", "record_id": "<urn:page:1:ab>", "url": "u", "payload_digest": "d", "payload": "z" * 5000}
    parts = warc.records_of(page, 1000, 300)
    assert len(parts) > 3
    rows = lambda records: list(warc.parse_archive(b"".join(r + b"\r\n" for r in records)))
    for records, error in ((parts[::-1], None), (parts[:-1], "last segment missing"), (parts[:1] + parts[2:], "segment missing or repeated"), (parts[1:], "continuation without its first record")):
        (got,) = warc.reassemble(spark.createDataFrame(rows(records), warc.RECORDS)).collect()
        assert got.error == error and (error or bytes(got.payload) == b"z" * 5000)
    cut = list(warc.parse_archive(parts[0][:-20]))
    assert cut[0][-1] == "record cut short"


def test_chunked_framing():
    for body in (b"", b"a", b"\r\n" * 700, bytes(range(256)) * 9):
        assert warc.unchunked(warc.chunked(body, 7)) == body
    for broken in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n", b"-1\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(broken)


# --- benchmark -------------------------------------------------------------------------------------


def test_leaks(spark):
    items = [(k, prose(30, 5000 + k) + ". " + prose(8, 6000 + k) + ".") for k in range(30)] + [(90, None), (91, ""), (92, "?!"), (93, prose(150, 77))]
    clean = [(k, prose(200, 9000 + k)) for k in range(30)]
    leaky = [(100 + k, prose(90 + 11 * k, 9500 + k) + " " + items[k][1] + " " + prose(40, 9600 + k)) for k in range(30)]
    half = [(200 + k, prose(50, 9700 + k) + " " + " ".join(items[k][1].split()[:15])) for k in range(5)]
    rows = [*clean, *leaky, *half, (300, None), (301, ""), (None, items[0][1]), (302, items[-1][1])]
    benchmark = spark.createDataFrame([(*i, "clash") for i in items], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(frame(spark, rows), benchmark).collect()}
    assert got == {(100 + k, k) for k in range(30)} | {(None, 0), (302, 93)}
    docs = frame(spark, rows)
    left = decontamination.drop_leaks(docs, benchmark)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter([i for i, _ in [*clean, *half]] + [300, 301])
    assert decontamination.find_leaks(docs, benchmark.limit(0)).count() == 0
    assert decontamination.drop_leaks(docs, benchmark.limit(0)).count() == len(rows)


def test_scores_do_not_depend_on_shards(spark):
    items = [(k, prose(20 + k % 60, 5000 + k) + ". " + prose(8, 6000 + k) + ".") for k in range(60)] + [(90, None), (91, "?!")]
    rows = [(k, prose(60, 9500 + k) + " " + items[k][1] + " " + prose(40, 9600 + k) + " " + items[59 - k][1]) for k in range(60)]
    benchmark, docs = spark.createDataFrame(items, "item_id long, text string"), frame(spark, rows)
    one, many = ({(r.doc_id, r.item_id): r.score for r in decontamination.find_leaks(docs, benchmark, most).collect()} for most in (1 << 20, 3000))
    assert len(list(decontamination.shards(benchmark, 3000))) > 2
    assert one.keys() == many.keys() >= {(k, k) for k in range(60)} and all(abs(one[k] - many[k]) < 1e-9 for k in one)
    assert decontamination.drop_leaks(docs, benchmark, 3000).count() == 0


def test_leaks_in_a_long_text(spark):
    item = prose(30, 5000) + ". " + prose(8, 6000) + "."
    rows = [(1, prose(60_000, 1) + " " + item + " " + prose(20_000, 2)), (2, prose(80_000, 3))]
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontamination.find_leaks(frame(spark, rows), benchmark).collect()] == [(1, 7)]


def test_block_search_equals_scoring_every_item():
    items = [(k, prose(12 + k % 40, k)) for k in range(80)]
    index = decontamination.build_index(items)
    text = " ".join(prose(30, 800 + k) + " " + items[k][1] for k in range(0, 80, 9))
    words = decontamination._of_text(text)
    place = {h: k for k, h in enumerate(index.terms.tolist())}
    term = np.array([place.get(w, -1) for w in words.tolist()])
    for size in (40, 128):
        passage = np.arange(len(words)) // size
        p, b = decontamination.live_blocks(index, term, [passage, np.full(len(words), -1)])
        live = set(zip(p.tolist(), b.tolist()))
        for k in set(passage.tolist()):
            here = set(term[passage == k].tolist())
            for item, weights in enumerate(index.weights):
                if sum(w for t, w in weights.items() if t in here) >= 1:
                    assert (k, item // decontamination.BLOCK) in live


# --- pieces ----------------------------------------------------------------------------------------


def test_pieces_decode_to_every_byte(spark):
    texts = [None, "", " ", "a▁b  c\n\n\U0001f600 x", "▁▁", "\x00\x01\t", "naïve façade", prose(300, 4), "é" * 500, "x" * 3000, "日本語のテキスト", "hello world " * 50]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "no key"), (5, "same key")]
    got = pieces.encode_documents(frame(spark, rows))
    assert all(r.lossless and r.n_pieces == len(r.ids) for r in got.collect())
    assert Counter((r.doc_id, r.text) for r in pieces.decode_documents(got).collect()) == Counter((i, t or "") for i, t in rows)
    again = pieces.encode_documents(frame(spark, rows).repartition(5))
    assert {(r.doc_id, tuple(r.ids)) for r in got.collect()} == {(r.doc_id, tuple(r.ids)) for r in again.collect()}


def test_sampled_segmentations_follow_the_lattice():
    """Frequencies over many keys against the probabilities of all paths of a small lattice."""
    alphabet = [(bytes([c]), float(np.log(p))) for c, p in ((97, 0.2), (98, 0.3))] + [(b"ab", float(np.log(0.25))), (b"ba", float(np.log(0.15))), (b"aba", float(np.log(0.1)))]
    byte_pieces = [(b"", -12.0)] * 256
    voc = pieces.build_vocabulary(alphabet + byte_pieces, list(range(5, 261)), set(range(5, 261)))
    text = b"abab"

    def paths(rest: bytes):
        if not rest:
            yield (), 1.0
        for k, (body, score) in enumerate(alphabet):
            if rest.startswith(body):
                for tail, p in paths(rest[len(body) :]):
                    yield (k, *tail), float(np.exp(score)) * p

    known = dict(paths(text))
    n = 20000
    data, at = np.frombuffer(text * n, np.uint8), np.arange(n + 1) * len(text)
    ids, per_row = pieces.encode_slice(voc, data, at, ar.mix(np.arange(n, dtype=np.uint64)))
    ends = np.cumsum(per_row)
    seen = Counter(tuple(ids[e - c : e].tolist()) for e, c in zip(ends, per_row))
    total = sum(known.values())
    assert set(seen) <= set(known)
    for path, p in known.items():
        assert abs(seen[path] / n - p / total) < 0.02


# --- language --------------------------------------------------------------------------------------


def test_language_fuses_evidence(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.fit(docs)
    known = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = language.identify(language.document_evidence(docs), model).collect()
    assert len(got) == len(known)
    assert np.mean([known[r.doc_id] == r.lang for r in got]) > 0.95
    pages = spark.createDataFrame(
        [(1, None, None, 0), (2, "https://a.example.fr/x", "<html lang='fr'><body>1</body></html>", 0), (3, "http://h.de/de/", "", 0), (3, "http://h.de/de/", "", 0), (4, "no address", "<html lang=xx>", 0)],
        "page_id long, url string, html string, doc_id long",
    )
    got = language.identify(language.page_evidence(pages), model).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 5 and by[2].lang == "fr" and by[3].lang == "de" and by[2].declared == "fr"
    assert all(0 <= r.probability <= 1 + 1e-9 for r in got)
    assert language.identify(language.page_evidence(pages.limit(0)), model).count() == 0


def test_language_posterior_equals_one_by_hand(spark):
    """Text likelihoods, host and domain counts, and the three declared signals, multiplied in plain Python."""
    rows = [(k, prose(20, k) + (" der die das" if k % 3 == 0 else " the of and" if k % 3 == 1 else " og det er"), ("de", "en", "nor")[k % 3]) for k in range(90)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en", "nor"]
    pages = [(1, "http://a.x.de/de/1", "<html lang=de>der die"), (2, "http://a.x.de/nor/2", "<html lang=nor>og det"), (3, "http://b.x.de/", "the of and the"), (4, "http://y.uk/en", ""), (5, None, None), (6, "http://b.x.de/zz", "<html lang='xx'>das")]
    evidence = language.page_evidence(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    texts, hosts, domains, overall = {}, {}, {}, np.zeros(3)
    for r in evidence:
        data = np.frombuffer(r.text.encode(), np.uint8)
        bucket, _ = language.trigrams(data, np.array([0, len(data)]))
        logs = language.WEIGHT * model.table[bucket].astype(float).sum(axis=0)
        p = np.exp(logs - logs.max())
        texts[r.page_id] = p / p.sum()
        domain = ".".join(r.host.split(".")[-2:]) if "." in r.host else ""
        for table, key in ((hosts, (domain, r.host)), (domains, domain)):
            table[key] = table.get(key, 0) + texts[r.page_id]
        overall += texts[r.page_id]
    overall = (overall + 1) / (overall.sum() + 3)
    got = {r.page_id: r for r in language.identify(spark.createDataFrame(evidence, language.page_evidence(spark.createDataFrame(pages, "page_id long, url string, html string")).schema), model).collect()}
    for r in evidence:
        domain = ".".join(r.host.split(".")[-2:]) if "." in r.host else ""
        above = (domains[domain] + language.STRENGTH * overall) / (domains[domain].sum() + language.STRENGTH)
        prior = (hosts[domain, r.host] + language.STRENGTH * above) / (hosts[domain, r.host].sum() + language.STRENGTH)
        odds = np.maximum(texts[r.page_id], 1e-30) * (overall if r.host == "" else prior)
        for signal, trust in ((r.declared, language.DECLARED), (language.COUNTRIES.get(r.suffix, ""), language.SUFFIX), (r.path, language.PATH)):
            if signal in model.languages:
                odds = odds * [trust if x == signal else (1 - trust) / 2 for x in model.languages]
        odds = odds / odds.sum()
        assert got[r.page_id].lang == model.languages[int(odds.argmax())] and abs(got[r.page_id].probability - odds.max()) < 1e-5


def test_language_codes_are_taken_whole(spark):
    rows = [(k, prose(8, k), code) for k in range(40) for code in ("fi", "fil-PH", "pt_BR", "EN")] + [(900, "x", ""), (901, "x", None), (902, "x", "42")]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["en", "fi", "fil", "pt"]
    pages = spark.createDataFrame([(1, "http://a.zz/fil/x", "<html lang='fil-PH'>"), (2, "http://b.zz/fi/", "<html lang=fi>"), (3, "http://c.zz/file/", "<html lang=fili>")], "page_id long, url string, html string")
    got = {r.page_id: (r.declared, r.path) for r in language.page_evidence(pages).collect()}
    assert got == {1: ("fil", "fil"), 2: ("fi", "fi"), 3: ("", "")}


def test_every_language_is_a_class(spark):
    rows = [(k, prose(6, k), "en" if k % 2 else "de") for k in range(3000)] + [(9000, "kaksi kolme viisi kuusi", "fi"), (9001, "", "sv"), (None, "cinque sette otto nove", "it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, sample=40)
    assert model.languages == ["de", "en", "fi", "it", "sv"]
    odd = docs.filter("lang in ('fi', 'it')").withColumn("source", F.lit(None).cast("string"))
    assert {r.text_lang for r in language.identify(language.document_evidence(odd), model).collect()} == {"fi", "it"}
    assert language.fit(docs.limit(0)).languages == ["und"]


# --- classifiers -----------------------------------------------------------------------------------


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    per_row = np.array([1, 4, 3])
    score, trans = rng.normal(size=8), rng.normal(size=(2, 2))
    good, pairs, total = quality.marginals(score, per_row, trans)
    at = 0
    expected_pairs = np.zeros((2, 2))
    for r, n in enumerate(per_row):
        weights = np.zeros(2**n)
        for code in range(2**n):
            y = [(code >> k) & 1 for k in range(n)]
            weights[code] = np.exp(sum(score[at + k] * y[k] for k in range(n)) + sum(trans[y[k], y[k + 1]] for k in range(n - 1)))
        assert np.isclose(np.log(weights.sum()), total[r])
        p = weights / weights.sum()
        for k in range(n):
            assert np.isclose(good[at + k], sum(p[c] for c in range(2**n) if (c >> k) & 1))
        for c in range(2**n):
            for k in range(n - 1):
                expected_pairs[(c >> k) & 1, (c >> (k + 1)) & 1] += p[c]
        at += n
    assert np.allclose(pairs, expected_pairs)


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    field = quality.fit(docs, labels)
    rows = quality.score_documents(docs, field).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9
    odd = frame(spark, [(1, None), (2, ""), (3, "\n\n"), (3, "\n\n"), (None, "x" * 50000)])
    got = quality.score_documents(odd, field).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert quality.fit(docs, labels.limit(0)) is None
    assert {r.score for r in quality.score_documents(odd, None).collect()} == {0.5}
    assert quality.keep_good(odd, field).columns == odd.columns
    assert quality.keep_good(odd.limit(0), field).count() == 0


def test_empty_tables_give_no_rows(spark):
    none = frame(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert suffixes.drop_repeats(none).collect() == []
    assert toxicity.score_documents(none, toxicity.fit(none, labels)).collect() == []
    assert quality.score_documents(none, quality.fit(none, labels)).collect() == []
    assert language.identify(language.document_evidence(none), language.fit(none)).collect() == []
    assert minhash.near_groups(none).collect() == [] and exact.exact_groups(none).collect() == []


def test_no_significant_term_is_left_out(spark):
    rng = random.Random(4)
    terms = ["".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(7)) + f"{k:04d}" for k in range(2100)] + ["w" * 60]
    toxic = [[] for _ in range(700)]
    for t in terms:
        for k in rng.sample(range(700), 22):
            toxic[k].append(t)
    toxic = [" ".join(rng.sample(x, len(x))) for x in toxic]
    sample = spark.createDataFrame([(t, 1) for t in toxic] + [(prose(40, k), 0) for k in range(700)], "text string, label int")
    assert set(terms) <= set(toxicity.learn_entries(sample, 700, 700))


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = toxicity.score_documents(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), model).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.95
    odd = frame(spark, [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "x" * 50000)])
    got = toxicity.score_documents(odd, model).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    empty = toxicity.fit(docs, labels.limit(0))
    assert {r.score < 0.3 for r in toxicity.score_documents(odd, empty).collect()} == {True}


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(2)
    entries = ["idiot", "moron", "worthless", "scum", "low\x01", "pathetic", "foulmouth\x01"]
    automaton = toxicity.Automaton(entries)
    for _ in range(4000):
        base = list(rng.choice(entries).rstrip("\x01"))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(base) + 1)
            base[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "o", "zz"])
        word = "".join(base)
        near = []
        for n, e in enumerate(entries):
            if e.endswith("\x01"):
                d = min(edits(word[:k], e[:-1]) for k in range(len(word) + 1))
            else:
                d = edits(word, e)
            if d <= toxicity.allowed_edits(e):
                near.append((d, n))
        assert automaton.match(word) == (min(near)[::-1] if near else None), word


def test_inflected_terms_keep_their_edits():
    terms = [("idiot", 100, 0), ("idiots", 40, 0), ("idiotic", 20, 0), ("idio\x01", 160, 0), ("idiot\x01", 60, 0), ("worthless", 50, 0)]
    entries = toxicity.pick_entries(terms)
    reader = toxicity.Reader(entries)
    assert set(entries) >= {"idio\x01", "idiot", "idiots", "idiotic"}
    assert all(reader.closest(w) for w in ("1diot", "iddiot", "idiotically", "w0rthles"))
    assert reader.closest("idea") is None
    both = toxicity.Automaton(["scum", "scum\x01", "idiot"])
    assert both.match("scumbag") == (1, 0) and both.match("scum") == (0, 0) and both.match("idiotxy") is None


def test_rare_terms_are_learned(spark):
    """A term in 30 of 4,000 toxic documents (under 1 %) and in no other is significant."""
    rows = [(f"{prose(6, k)} {'zqxwv' if k < 30 else 'kjhgf'}", 1) for k in range(4000)] + [(prose(6, 9000 + k), 0) for k in range(4000)]
    sample = spark.createDataFrame(rows, "text string, label int")
    assert {"zqxwv", "kjhgf"} <= set(toxicity.learn_entries(sample, 4000, 4000))


def test_quotation_is_told_from_abuse():
    reader = toxicity.Reader(["moron"])
    abuse, quoted, reported = (reader.measures(t) for t in ("you absolute moron", 'they read "you moron" aloud', "the word moron is old"))
    assert abuse[0] == 1 and quoted[0] == 0 and reported[0] == 0 and quoted[4] > 0 and reported[4] > 0
    assert reader.measures("you absolute mor0n")[2] == 1
