"""Near-duplicates: MinHash bands, sequential Bayesian pruning, exact verification.

A document's set holds its distinct shingles of ``words`` words: four in the query op3, whose contract says so, five
where near-copies are dropped from a corpus. Equal sets form a class, represented by
its smallest id. Signatures of the representatives are banded; documents that share a band are
candidates. A candidate pair is compared in batches of signature values: after each batch the
posterior of its similarity (uniform prior, binomial likelihood) says whether the pair can still reach the threshold,
and the pair is dropped when that probability falls below ``miss``. Survivors are verified on
their full sets, so every link is exact.

Groups of a band are never expanded into pairs. Each member is compared with the group's hub (the member that shares most bands
with others): with the highest of its hubs first, then with those that no link joins it to yet. What is left of groups,
members of different components, is compared in blocks of ``block`` members: each pair of blocks is a row that holds both blocks'
signatures and sets, is pruned and verified in its task, and gives only the links that join something. So no partner or candidate is capped.
Shingles are compared by 64-bit hashes of their words.

Defined cases: a null or blank text has an empty set and links with nothing; fewer words than a shingle has are
one shingle; repeated rows and ids each get a row, and rows of one id are one document, whose set is that of the row
with the largest set key; rows without an id have their own component null and are kept; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poiweave.llm import arrays as ar
from poiweave.llm.shared import components, discard, stored

WORDS = 4
CORPUS_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 6
HASHES = BANDS * ROWS
MISS = 1e-7
BATCH = 16
BLOCK = 256
LONG = 2000  # shingles of a member that fills its share of a block
COLUMNS = 16384

_SEEDS = np.random.default_rng(7).integers(1, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
_WORD_FACTORS = np.random.default_rng(11).integers(1, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)
SET_SCHEMA = "doc_id long, n_shingles long, set_key binary, bands array<long>, signature binary"


def shingle_hashes(data: np.ndarray, at: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, one row after another, and their number by row."""
    n_rows = len(at) - 1
    data = ar.lowered(data)
    start, end, row = ar.words(data, at)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(n_rows, np.int64)
    word = ar.span_hash(ar.prefix_hash(data), start, end)
    n_words = np.bincount(row, minlength=n_rows)
    m = len(word)
    last = np.minimum(np.arange(m) + size - 1, m - 1)
    whole = row[last] == row
    whole[max(0, m - size + 1) :] = False
    first_word = np.zeros(m, bool)
    first_word[np.cumsum(n_words)[n_words > 0] - n_words[n_words > 0]] = True
    take = np.flatnonzero(whole | (first_word & (n_words[row] < size)))
    length = np.minimum(n_words[row[take]], size)
    value = np.zeros(len(take), np.uint64)
    for k in range(size):
        at_k = np.minimum(take + k, m - 1)
        value = np.where(k < length, value * _WORD_FACTORS[0] + word[at_k] * _WORD_FACTORS[1 + k % 7], value)
    value = ar.mix(value + length.astype(np.uint64))
    owner = row[take]
    order = np.argsort(value)
    order = order[np.argsort(owner[order].astype(np.uint16) if n_rows < 65536 else owner[order], kind="stable")]
    value, owner = value[order], owner[order]
    fresh = np.r_[True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])]
    return value[fresh], np.bincount(owner[fresh], minlength=n_rows)


def signatures(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A MinHash signature for each row with a set: the least of each permuted hash."""
    edges = np.cumsum(counts) - counts
    out = np.empty((HASHES, len(counts)), np.uint64)
    scratch = np.empty(len(values), np.uint64)
    for k in range(HASHES):
        np.multiply(values, _SEEDS[k], out=scratch)
        out[k] = np.minimum.reduceat(scratch, edges)
    return ar.mix(out.T)


def _keys(values: np.ndarray, counts: np.ndarray) -> list[bytes | None]:
    """A digest of each row's sorted set; null for an empty one."""
    ends = np.cumsum(counts)
    return [hashlib.blake2b(values[e - c : e].tobytes(), digest_size=16).digest() if c else None for e, c in zip(ends, counts)]


def _set_rows(batches, words: int):
    for rows, data, at in ar.slices(batches):
        values, counts = shingle_hashes(data, at, words)
        full = counts > 0
        sig = np.zeros((len(counts), HASHES), np.uint64)
        if full.any():
            sig[full] = signatures(values, counts[full])
        band = ar.mix((sig.reshape(-1, BANDS, ROWS) * _WORD_FACTORS[:ROWS]).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
        small = np.ascontiguousarray((sig >> np.uint64(48)).astype("<u2"))
        yield pa.RecordBatch.from_arrays(
            [
                ar.column(rows, "doc_id").cast(pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array(_keys(values, counts), pa.binary()),
                ar.lists(band[full].view(np.int64).ravel(), np.where(full, BANDS, 0), pa.int64()),
                pa.array([s.tobytes() if f else None for s, f in zip(small, full)], pa.binary()),
            ],
            ["doc_id", "n_shingles", "set_key", "bands", "signature"],
        )


def _full_sets(words: int):
    def run(batches):
        for rows, data, at in ar.slices(batches):
            values, counts = shingle_hashes(data, at, words)
            mine = pa.array([k == w for k, w in zip(_keys(values, counts), ar.column(rows, "set_key").to_pylist())])
            ids, found = ar.column(rows, "doc_id").cast(pa.int64()), ar.lists(values.view(np.int64), counts, pa.int64())
            yield pa.RecordBatch.from_arrays([ids.filter(mine), found.filter(mine)], ["doc_id", "shingles"])

    return run


def least_matches(threshold: float = THRESHOLD, miss: float = MISS, hashes: int = HASHES) -> list[int]:
    """By number n of values compared: the fewest matches with P(similarity >= threshold) > miss.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), whose upper tail at t is the chance of at
    most m successes in n + 1 trials of chance t.
    """
    out = []
    for n in range(hashes + 1):
        tail, m = 0.0, -1
        while tail <= miss:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


_LEAST = least_matches()


def surviving(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of signatures survive all batches, and with how many matches (else -1)."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), np.int64)
    for k in range(0, HASHES, BATCH):
        matches[alive] += (left[alive, k : k + BATCH] == right[alive, k : k + BATCH]).sum(axis=1)
        keep = matches[alive] >= _LEAST[k + BATCH]
        matches[alive[~keep]] = -1
        alive = alive[keep]
    return matches


def _matrix(signature: pa.Array) -> np.ndarray:
    data, at = ar.text_bytes(signature)
    return data.view("<u2").reshape(-1, HASHES) if data.flags.c_contiguous and data.ctypes.data % 2 == 0 else np.frombuffer(data.tobytes(), "<u2").reshape(-1, HASHES)


def _pruned(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        found = surviving(_matrix(ar.column(batch, "sig_a")), _matrix(ar.column(batch, "sig_b")))
        keep = pa.array(found >= 0)
        yield pa.RecordBatch.from_arrays([ar.column(batch, "a").filter(keep), ar.column(batch, "b").filter(keep), pa.array(found[found >= 0], pa.int64())], ["a", "b", "matches"])


def _intersections(sets: list[list[np.ndarray]]) -> np.ndarray:
    """Sizes of the intersections of all sets on one side with all on the other, a range of columns at a time."""
    lengths = [[len(x) for x in side] for side in sets]
    flat = [np.concatenate(side) if side else np.zeros(0, np.int64) for side in sets]
    rows = [np.repeat(np.arange(len(n)), n) for n in lengths]
    common = np.intersect1d(*flat)
    out = np.zeros((len(sets[0]), len(sets[1])), np.float32)
    at = [np.searchsorted(common, f) for f in flat]
    known = [np.isin(f, common) for f in flat]
    for lo in range(0, len(common), COLUMNS):
        hi = min(lo + COLUMNS, len(common))
        sides = []
        for k in (0, 1):
            here = known[k] & (at[k] >= lo) & (at[k] < hi)
            dense = np.zeros((len(sets[k]), hi - lo), np.float32)
            dense[rows[k][here], at[k][here] - lo] = 1
            sides.append(dense)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _block_links(percent: int):
    """Verified links between members of two blocks in different components, no more than join what they join."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                sides = [ar.column(batch, n)[i].values for n in ("one", "two")]
                ids, comp = ([np.asarray(x.field(n)) for x in sides] for n in ("doc_id", "component"))
                sig = [_matrix(x.field("signature")) for x in sides]
                left, right = np.nonzero(comp[0][:, None] != comp[1][None, :])
                found = [surviving(sig[0][left[k : k + 8192]], sig[1][right[k : k + 8192]]) >= 0 for k in range(0, len(left), 8192)]
                alive = np.concatenate(found) if found else np.zeros(0, bool)
                left, right = left[alive], right[alive]
                if not len(left):
                    continue
                some = [np.unique(left), np.unique(right)]
                sets = [[np.asarray(x.field("shingles")[int(k)].values) for k in rows] for x, rows in zip(sides, some)]
                a, b = np.searchsorted(some[0], left), np.searchsorted(some[1], right)
                common = _intersections(sets)[a, b]
                size = [np.array([len(x) for x in side]) for side in sets]
                linked = 100 * common >= percent * (size[0][a] + size[1][b] - common)
                parent: dict[int, int] = {}

                def root(x: int) -> int:
                    while parent.get(x, x) != x:
                        x = parent[x]
                    return x

                pairs = []
                for x, y in zip(ids[0][left[linked]].tolist(), ids[1][right[linked]].tolist()):
                    rx, ry = root(x), root(y)
                    if rx != ry:
                        parent[rx] = ry
                        pairs.append((x, y))
                if pairs:
                    yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])

    return run


PAIRS = "a long, b long, matches long"


def _survivors(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    left = sigs.select(F.col("doc_id").alias("a"), F.col("signature").alias("sig_a"))
    right = sigs.select(F.col("doc_id").alias("b"), F.col("signature").alias("sig_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(_pruned, PAIRS)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
    joined = pairs.select("a", "b").join(left, "a")
    # Sets whose sizes alone rule the pair out are not compared.
    joined = joined.join(right, "b").filter(100 * F.least(F.size("set_a"), F.size("set_b")) >= percent * F.greatest(F.size("set_a"), F.size("set_b")))
    common = F.size(F.array_intersect("set_a", "set_b"))
    return joined.filter(100 * common >= percent * (F.size("set_a") + F.size("set_b") - common)).select("a", "b")


def _others(pairs: DataFrame, best: DataFrame, links: DataFrame) -> DataFrame:
    """Pairs besides the best ones whose ends are not joined through one hub."""
    star = links.select(F.col("a").alias("id"), F.col("b").alias("hub"))
    left, right = star.select(F.col("id").alias("a"), F.col("hub").alias("of_a")), star.select(F.col("id").alias("b"), F.col("hub").alias("of_b"))
    rest = pairs.select("a", "b").join(best, ["a", "b"], "left_anti").join(left, "a", "left").join(right, "b", "left")
    return rest.filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def near_groups(docs: DataFrame, percent: int = 80, block: int = BLOCK, words: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = stored(texts.mapInArrow(lambda batches: _set_rows(batches, words), SET_SCHEMA), "sets")
    one = sets.filter("doc_id is not null").groupBy("doc_id").agg(F.max("set_key").alias("set_key"))
    classes = one.filter("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    reps = sets.join(classes, (sets.doc_id == classes.rep) & (sets.set_key == classes.set_key), "left_semi").dropDuplicates(["doc_id"])
    banded = reps.select("doc_id", F.explode("bands").alias("band"))
    groups = banded.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    shared = stored(banded.join(groups, "band"), "members")
    score = shared.groupBy("doc_id").agg(F.sum("size").alias("score"))
    members = stored(shared.join(score, "doc_id"), "members")
    nodes = stored(reps.select("doc_id", "signature").join(score.select("doc_id"), "doc_id", "left_semi"), "nodes")
    full = stored(texts.join(reps.join(score.select("doc_id"), "doc_id", "left_semi").select("doc_id", "set_key"), "doc_id").mapInArrow(_full_sets(words), "doc_id long, shingles array<long>"), "full")
    discard(shared)

    highest = F.struct("score", -F.col("doc_id"))
    hubs = stored(members.groupBy("band").agg(F.max_by("doc_id", highest).alias("hub"), F.max("score").alias("hub_score")), "hubs")
    met = members.select("band", "doc_id").join(hubs, "band").filter("doc_id <> hub")
    pairs = stored(met.groupBy(F.col("doc_id").alias("a"), F.col("hub").alias("b")).agg(F.max("hub_score").alias("score")), "pairs")
    # A document meets its highest hub first. Copies of one text have the same one, so most need no other.
    best = pairs.groupBy("a").agg(F.max_by("b", F.struct("score", -F.col("b"))).alias("b"))
    first = stored(_verified(_survivors(best, nodes), full, percent), "links")
    more = _verified(_survivors(_others(pairs, best, first), nodes), full, percent)
    links = stored(first.union(more), "links")
    labels = stored(components(nodes.select("doc_id", F.col("doc_id").alias("component")), links), "labels")
    discard(pairs, first, links)

    # The hub has met everyone in its group; what is left of a group goes on where it lies in several components. Groups whose
    # hubs are in one component are taken together, so that a pair of documents is compared once, not once for each band.
    of_hub = hubs.join(labels.select(F.col("doc_id").alias("hub"), F.col("component").alias("together")), "hub").select("band", "hub", "together")
    rest = members.select("band", "doc_id").join(of_hub, "band").filter("doc_id <> hub").join(labels, "doc_id")
    several = rest.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("band")
    apart = stored(rest.join(several, "band").select("together", "doc_id", "component").distinct(), "open")
    found = stored(_apart(apart, nodes, full, percent, block), "links")
    discard(members, hubs, nodes, full, apart)
    if not found.isEmpty():
        labels = _merged(labels, found)

    by_class = classes.join(labels, classes.rep == labels.doc_id, "left").select("set_key", F.coalesce("component", "rep").alias("component"))
    of_rep = one.join(by_class, "set_key", "left").select(F.col("doc_id").alias("id"), "component")
    # A class is in the component of its representative, whose smallest id represents it.
    return sets.join(of_rep, sets.doc_id == of_rep.id, "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component", "doc_id")).alias("kept"),
    )


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after further links: only the components that these join are looked at."""
    a = labels.select(F.col("doc_id").alias("a"), F.col("component").alias("of_a"))
    b = labels.select(F.col("doc_id").alias("b"), F.col("component").alias("of_b"))
    joined = stored(links.join(a, "a").join(b, "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).filter("a <> b").distinct(), "links")
    ends = joined.select(F.col("a").alias("doc_id")).union(joined.select("b")).distinct()
    moved = components(ends.withColumn("component", F.col("doc_id")), joined).select(F.col("doc_id").alias("component"), F.col("component").alias("root"))
    return labels.join(moved, "component", "left").select("doc_id", F.coalesce("root", "component").alias("component"))


def _apart(members: DataFrame, nodes: DataFrame, full: DataFrame, percent: int, block: int) -> DataFrame:
    """Links between members of one ``together`` in different components.

    Blocks hold ``block`` members, fewer of long sets, all of them in the component of the hubs or none, and of sizes within
    one class: sets of sizes two classes apart cannot be similar. Blocks of the hubs' component are compared with the others only, so its
    size costs no more than its members times the blocks of those that are apart. Pairs of blocks are listed first, then each gets both blocks' signatures
    and sets, is pruned and verified in its task, and gives only links that join something.
    """
    size = F.floor(F.log(F.size("shingles")) / math.log(100 / percent)).cast("int") if percent < 100 else F.size("shingles")
    rows = members.join(nodes, "doc_id").join(full, "doc_id").withColumns({"other": F.col("component") != F.col("together"), "size": size})
    key = ["together", "other", "size"]
    amount = F.greatest(F.count("*") / block, F.sum(F.size("shingles")) / (block * LONG))
    dealt = rows.join(rows.groupBy(*key).agg(F.ceil(amount).cast("int").alias("blocks")), key)
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    packed = stored(dealt.groupBy(*key, "part").agg(F.collect_list(F.struct("doc_id", "component", "signature", "shingles")).alias("rows")), "blocks")

    def side(name: str) -> DataFrame:
        return packed.select("together", *[F.col(c).alias(f"{name}_{c}") for c in ("other", "size", "part")])

    once = ~F.col("p_other") | (F.struct("p_size", "p_part") <= F.struct("q_size", "q_part"))
    both = side("p").join(side("q").filter("q_other"), "together").filter((F.abs(F.col("p_size") - F.col("q_size")) <= 1) & once)
    for name, column in (("p", "one"), ("q", "two")):
        blocks = packed.select("together", *[F.col(c).alias(f"{name}_{c}") for c in ("other", "size", "part")], F.col("rows").alias(column))
        both = both.join(blocks, ["together", f"{name}_other", f"{name}_size", f"{name}_part"])
    return both.select("one", "two").mapInArrow(_block_links(percent), "a long, b long")


def drop_near_copies(docs: DataFrame, words: int = CORPUS_WORDS) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, all rows of that id; rows without an id stay."""
    rows = docs.select(F.struct("*").alias("row"))
    gone = near_groups(docs, words=words).filter("not kept and doc_id is not null").select(F.col("doc_id").alias("id")).distinct()
    return rows.join(gone, rows["row.doc_id"] == gone["id"], "left_anti").select("row.*")
