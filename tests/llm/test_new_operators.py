"""Address rules, source divergence and vector codes against brute force: nulls, empty and long values, ties, repeated rows,
empty tables and extra columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from poiweave.llm import divergence, shared, urlrules, vectorcodes

# --- address rules ---------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, digest string, row string, host string"
RULES = "host string, path string, verdict string, note string"


def judged(url, rules, default):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (found[1], found[2]) if found else ("", "")
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if f".{host}".endswith(f".{h}") and path.startswith(p)]
    best = max(fits, key=lambda f: (f[:3], f[3] == "block"), default=(0, 0, None, default))
    return host, path, best[2], best[3]


@pytest.fixture(scope="module")
def urls():
    rng = random.Random(3)
    hosts = ["example.com", "WWW.Example.com", "a.b.www.example.com", "example.net", "notexample.com", "com", "net", "x.", ".com", "münchen.net", "a..net", "host:80", ""]
    paths = ["/", "/en/", "/en", "/en/x/y", "/EN/", "/es/1", "/fr/2?page=/en/", "/fr#x", "", "?q=1", "//en/", "/en/" + "z" * 3000]
    given = [f"{rng.choice(['http', 'https', ''])}://{h}{p}" for h in hosts for p in paths]
    return given + [None, "", "no scheme", "http:/one.com/en/", "a://b://c.com/en/", "://com/\n/en/", "x://" + "a." * 500 + "net/es/", "http://Ä.com/"]


def spark_rules(spark, rules):
    return spark.createDataFrame([(*r, "n") for r in rules], RULES)


@pytest.mark.parametrize("limit", [urlrules.BROADCAST_BYTES, 0])
def test_url_rules_equal_brute_force(spark, urls, limit):
    rules = [*urlrules.RULES, ("example.com", "", "block"), ("example.com", "/en", "allow"), ("b.www.example.com", "/e", "block"), ("net", "/es/", "allow"), ("", "", "block"), ("x.", "", "allow"), ("com", "/zz", "block")]
    rows = [(i, u, "<p>", "d", "r", "h") for i, u in enumerate(urls)] + [(7, urls[7], None, "d", "r", "h")] * 3 + [(None, urls[2], None, "d", "r", "h")]
    given = spark_rules(spark, rules).union(spark.createDataFrame([(None, "/", "block", "n"), ("com", None, "block", "n"), ("com", "/en/", None, "n")], RULES))
    got = urlrules.judge(spark.createDataFrame(rows, PAGES).repartition(5), given, broadcast_bytes=limit).collect()
    assert Counter(map(tuple, got)) == Counter((r[0], *judged(r[1], rules, "allow")) for r in rows)


def test_url_rules_of_one_host_with_a_third_of_all_rows(spark, urls):
    rows = [(i, "http://www.example.com/en/1" if i % 3 == 0 else f"http://h{i}.net/{'es' if i % 2 else 'de'}/", None, "d", "r", "h") for i in range(900)]
    got = urlrules.judge(spark.createDataFrame(rows, PAGES), spark_rules(spark, urlrules.RULES), broadcast_bytes=0)
    assert Counter(map(tuple, got.collect())) == Counter((r[0], *judged(r[1], urlrules.RULES, "allow")) for r in rows)


def test_url_rules_of_empty_tables(spark, urls):
    rows = spark.createDataFrame([(1, "http://a.com/", None, "d", "r", "h"), (2, None, None, "d", "r", "h")], PAGES)
    none = spark.createDataFrame([], RULES)
    assert sorted(map(tuple, urlrules.judge(rows, none, "block").collect())) == [(1, "a.com", "/", None, "block"), (2, "", "", None, "block")]
    assert urlrules.judge(rows.limit(0), spark_rules(spark, urlrules.RULES)).collect() == []


def test_url_rules_run_without_python(spark, urls):
    plan = urlrules.judge(spark.createDataFrame([(1, "http://a.com/", None, "d", "r", "h")], PAGES), spark_rules(spark, urlrules.RULES))
    assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().executedPlan().toString())


# --- source divergence -----------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, n_chars long, term string, part string, n string"


def audited(rows, least, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        own = {s: {t: counts[lang, s][t] for t in kept} for x, s in groups if x == lang}
        whole = {t: sum(c[t] for c in own.values()) for t in kept}

        def share(n):
            total = sum(n.values()) + len(kept)
            return {t: 1 + 1_000_000_000 * (c + 1) // total for t, c in n.items()}

        p, q = {s: share(c) for s, c in own.items()}, share(whole)
        for s in own:
            value = {o: sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept) for o in own if o != s}
            ranked = sorted(value, key=lambda o: (-value[o], o.encode()))
            out += [(lang, s, "pair", o, value[o], k) for k, o in enumerate(ranked, 1)]
            value = {t: (p[s][t] - q[t]) ** 2 // q[t] for t in kept if own[s][t] and p[s][t] > q[t]}
            ranked = sorted(value, key=lambda t: (-value[t], t.encode()))[:top]
            out += [(lang, s, "term", t, value[t], k) for k, t in enumerate(ranked, 1)]
    return out


@pytest.fixture(scope="module")
def sources():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 4))) for _ in range(250)] + ["Ｚ", "😀", "ÄÖ", "x\u00a0y"]
    rows = []
    for i in range(400):
        lang, source = rng.choice(["en", "en", "de", None, ""]), "hot" if i % 3 == 0 else rng.choice(["a", "b", "é", "Z", "", None])
        own = words[len(source or "") * 30 :][:120]
        rows.append((rng.choice([" ", "-", "9", "\n"]).join(rng.choice(own) for _ in range(rng.randint(0, 60))), lang, source))
    rows += [(None, "en", "empty"), ("", "en", "blank"), ("only once", "fr", "s1"), ("only twice", "fr", "s2"), (None, "xx", "alone"), ("AbC abc ABC", "en", "hot"), ("abc " * 30_000, "de", "long")]
    return rows + rows[:5]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, *r, None, "t", "p", "n") for i, r in enumerate(rows)], DOCS)


@pytest.mark.parametrize("top", [5, 200])
def test_divergence_equals_brute_force(spark, sources, monkeypatch, top):
    monkeypatch.setattr(divergence, "CELLS", 300)
    got = divergence.audit(docs_of(spark, sources).repartition(6), top=top).collect()
    assert sorted(map(tuple, got)) == sorted(audited(sources, 3, top))


def test_divergence_of_no_rows_and_of_no_kept_terms(spark):
    assert divergence.audit(docs_of(spark, [])).collect() == []
    rows = [("one", "en", "a"), ("two", "en", "b"), (None, None, None)]
    assert sorted(map(tuple, divergence.audit(docs_of(spark, rows)).collect())) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_skyband_keeps_what_fewer_than_k_dominate():
    rng = np.random.default_rng(2)
    n, in_lang = rng.integers(1, 12, 1500), rng.integers(1, 30, 1500)
    place = rng.permutation(1500)
    for k in (1, 4, 50):
        beaten = [((n >= n[i]) & (in_lang <= in_lang[i]) & (place < place[i])).sum() for i in range(1500)]
        assert sorted(divergence.skyband(n, in_lang, place, k)) == [i for i in range(1500) if beaten[i] < k]


def test_skybands_merge_in_any_order(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(4)
    size = 3000
    table = pa.table({"lang": ["en"] * size, "source": ["s"] * size, "term": [f"t{k:05d}" for k in rng.permutation(size)], "n": rng.integers(1, 40, size), "in_lang": rng.integers(1, 99, size), "part": pa.array([0] * size, pa.int32())})
    whole = set(divergence._band_of(table, 7).column("term").to_pylist())
    monkeypatch.setattr(divergence, "HELD", 100)  # a task passes on what it has several times
    first = [b for lo in range(0, size, 500) for b in divergence._skybands(7, False)(iter(table.slice(lo, 500).to_batches(max_chunksize=60)))]
    merged = divergence._band_of(pa.Table.from_batches(first), 7)
    assert set(merged.column("term").to_pylist()) == whole and merged.num_rows == len(whole) < size


def test_shares_are_exact_beyond_doubles():
    rng = random.Random(6)
    pairs = [(rng.randint(1, t), t) for t in [rng.randint(1, 9 * 10**15) for _ in range(500)]] + [(5, 5), (1, 9 * 10**15)]
    got = divergence.shares(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    assert got.tolist() == [1 + 10**9 * n // total for n, total in pairs]


# --- vector codes ----------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, x string, error string, _note string"


def coded(rows, parts, entries, rounds):
    """(vec_id, code, error) of each row and the codebooks, in Python integers."""
    usable = [(i, [math.floor(1024 * v) for v in e], y) for i, e, y in rows if e is not None and all(v is not None and math.isfinite(v) and abs(v) < 65536 for v in e)]
    usable.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(usable[0][1]) // parts
    cut = [[x[k * width : (k + 1) * width] for k in range(parts)] for _, x, _ in usable]
    books = [[c[k] for c in cut[:entries]] for k in range(parts)]

    def near(piece, book):
        return min((sum((a - b) ** 2 for a, b in zip(piece, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for k in range(parts):
            groups = defaultdict(list)
            for c in cut:
                groups[near(c[k], books[k])[1]].append(c[k])
            books[k] = [[sum(col) // len(groups[e]) for col in zip(*groups[e])] if e in groups else entry for e, entry in enumerate(books[k])]
    found = [[near(c[k], books[k]) for k in range(parts)] for c in cut]
    return [(i, y, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f)) for (i, _, y), f in zip(usable, found)], books


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(0, 0.05 + 0.3 * (i % 3 == 0), 12).round(2).tolist(), int(rng.integers(0, 4)) if i % 7 else None) for i in range(150)]
    rows += [(1000 + i, rows[40][1], 2) for i in range(80)]  # one vector with a third of all rows
    rows += [(500, None, 1), (501, [0.5] * 11 + [None], 1), (502, [0.5] * 11 + [float("nan")], 1), (503, [float("-inf")] + [0.5] * 11, 1), (504, [1e5] * 12, 1)]
    return rows + [(505, [60000.0] * 12, 1), (3, rows[3][1], 1), (3, rows[4][1], None), (None, rows[5][1], 0), (600, [0.0] * 12, None), (601, [-0.0] * 12, None)]


def vector_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "e", "n") for r in rows], VECTORS)


@pytest.mark.parametrize("entries,rounds", [(40, 4), (7, 3), (256, 2), (20, 0)])
def test_codes_equal_brute_force(spark, vectors, entries, rounds):
    got = vectorcodes.compress(vector_frame(spark, vectors).repartition(4), entries=entries, rounds=rounds).collect()
    expected, books = coded(vectors, 4, entries, rounds)
    assert Counter((r.vec_id, r.label, r.code, r.error) for r in got) == Counter(expected)
    of_label = Counter()
    for _, y, _, error in expected:
        of_label[y] += error
    assert all(r.label_error == of_label[r.label] for r in got)
    text = ",".join(str(v) for book in books for entry in book for v in entry)
    assert {r.codebooks_sha256 for r in got} == {hashlib.sha256(text.encode()).hexdigest()}


def test_net_displacement_passes_over_runs_and_never_changes_an_entry():
    """Runs are passed over by bounds, more of them with net displacements than with summed moves would be, and entries stay exact."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-400, 400, (64, 8))
    x = (centres[rng.integers(0, 64, 4000)] + rng.integers(-20, 20, (4000, 8))).astype(np.int64)
    book, history = x[:64].copy(), []
    entry, bound, stamp = np.zeros(4000, np.int64), np.zeros((4000, 4)), np.zeros((4000, 4), np.int64)
    measured = []
    for _ in range(6):
        history.append(book[None].copy())
        apart, n = vectorcodes.assign(x, entry, bound, stamp, book, vectorcodes.net_moves(history)[:, 0])
        measured.append(n)
        d = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
        assert (entry == d.argmin(axis=1)).all() and (apart == d.min(axis=1)).all()
        book = np.array([x[entry == e].sum(axis=0) // max(1, (entry == e).sum()) if (entry == e).any() else book[e] for e in range(64)])
    assert measured[0] == 4000 * 64 and measured[-1] < measured[0] / 2


def test_net_moves_see_entries_that_come_back():
    a, b = np.zeros((1, 16, 4), np.int64), np.full((1, 16, 4), 9, np.int64)
    moves = vectorcodes.net_moves([a, b, a])
    assert moves[0].max() == 0 and moves[1].min() == 18


def test_codes_of_odd_lengths_and_of_no_rows(spark):
    rows = [(i, [0.1 * i] * 8, 1) for i in range(5)] + [(7, [0.1] * 4, 1), (8, [0.1] * 7, 1), (9, [], 1)]
    got = vectorcodes.compress(vector_frame(spark, rows)).collect()
    assert sorted(r.vec_id for r in got) == list(range(5)) and all(r.error == 0 for r in got)
    for none in ([], [(1, None, 1), (2, [0.1] * 7, 1), (3, [], 1)]):
        assert vectorcodes.compress(vector_frame(spark, none)).collect() == []


def test_rounds_leave_no_files_but_the_last(spark, vectors):
    before = set(shared.listed(spark))
    vectorcodes.compress(vector_frame(spark, vectors), entries=9).collect()
    assert len(set(shared.listed(spark)) - before) == 1
