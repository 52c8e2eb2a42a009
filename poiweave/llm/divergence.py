"""How far the sources of a language are from each other and from the language, term by term.

Terms are runs of letters (ASCII, lowered, or any character beyond ASCII); a language keeps the terms of at least ``least`` of
its documents. A group (language and source) and a language give each kept term the share
``p = 1 + floor(10^9 (n + 1) / (N + V))`` with its n occurrences there, N those of all kept terms and V kept terms. The divergence
of p from q is ``floor((p - q)^2 / q)``. Part ``pair`` has, for each group, every other source of the language (its shares are
q) with the divergence summed over all kept terms; part ``term`` has the ``top`` terms of most divergence from the
language (its shares are q) among those that the group has and uses more.

How it is dealt:

* Texts are counted in tasks, by group and term within each slice of text, and summed by key.
* **Terms by a dominance skyband.** A term's rank within its group only improves with a higher count in the group, a lower
  count in the language and an earlier place in UTF-8 order. So a term that ``top`` others beat or equal in all three cannot be
  ranked, whatever the totals are: each partition retains the terms that fewer than ``top`` others dominate, partitions are
  merged sixteen at a time by the same rule, and only then shares are computed and terms ranked exactly.
* **Pairs by tables of counts.** The terms of a language are dealt to buckets of about ``CELLS`` counts. A bucket, met by the totals of
  the language's sources, gives each pair one partial sum. No row for a pair and a term is made.

All arithmetic is in integers: shares by long division in steps that fit 64 bits (N + V below 9 * 10^15), sums in two halves.

Defined cases: null text, language and source are ''; repeated rows each count as a document; a group without terms has a row for
each pair and none for terms; without kept terms (V = 0) pairs are 0; of equal values the item that is earlier in UTF-8 order comes first;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from poiweave.llm import arrays as ar
from poiweave.llm.shared import stored, text_or_empty

LEAST = 3
TOP = 200
SCALE = 1_000_000_000
CELLS = 200_000
FAN = 16
SLICE = 8 << 20  # bytes of text whose terms are counted together
HELD = 500_000  # terms that a task holds before it passes them on
BLOCK = 512
_GAPS = np.ones(256, bool)
_GAPS[np.r_[65:91, 97:123, 128:256]] = False
COUNTS = "lang string, source string, term string, n long, docs long"
BAND = "lang string, source string, term string, n long, in_lang long, part int"
SUMS = "lang string, source string, item string, high long, low long"


def term_counts(data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms of some texts; for each text and term of it: text, term and occurrences."""
    data = ar.lowered(data)
    start, end, row = ar.words(data, at, _GAPS)
    held = np.ascontiguousarray(data[~_GAPS[data]])
    found = ar.blobs(held, np.r_[0, np.cumsum(end - start)]).dictionary_encode()
    kinds = len(found.dictionary)
    if not kinds:
        return found.dictionary, *[np.zeros(0, np.int64)] * 3
    keys, n = np.unique(row * kinds + np.asarray(found.indices, np.int64), return_counts=True)
    return found.dictionary, keys // kinds, keys % kinds, n


def _count_rows(batches):
    for rows, data, at in ar.slices(batches, most=SLICE):
        terms, text, term, n = term_counts(data, at)
        lang, source = (ar.column(rows, c).dictionary_encode() for c in ("lang", "source"))
        group = np.asarray(lang.indices, np.int64) * len(source.dictionary) + np.asarray(source.indices, np.int64)
        keys, at_key = np.unique(group[text] * len(terms) + term, return_inverse=True)
        if not len(keys):
            continue
        of = keys // len(terms)
        yield pa.RecordBatch.from_arrays(
            [
                lang.dictionary.take(pa.array(of // len(source.dictionary))),
                source.dictionary.take(pa.array(of % len(source.dictionary))),
                terms.take(pa.array(keys % len(terms))).cast(pa.string()),
                pa.array(np.bincount(at_key, n).astype(np.int64)),
                pa.array(np.bincount(at_key).astype(np.int64)),
            ],
            ["lang", "source", "term", "n", "docs"],
        )


def skyband(n: np.ndarray, in_lang: np.ndarray, place: np.ndarray, top: int) -> np.ndarray:
    """Indexes of the terms that fewer than ``top`` others dominate: count as high, language's count as low, place earlier.

    Terms come in an order in which no term dominates an earlier one. It is enough to compare with those retained: a term
    dominated by ``top`` others is dominated by ``top`` retained ones, as domination passes on.
    """
    order = np.lexsort((place, in_lang, -n))
    kept = np.zeros(0, np.int64)
    for k in range(0, len(order), BLOCK):
        new = order[k : k + BLOCK]
        before = np.r_[kept, new]
        beats = (in_lang[before][None, :] <= in_lang[new][:, None]) & (place[before][None, :] < place[new][:, None])
        beats[:, len(kept) :] &= np.tri(len(new), k=-1, dtype=bool)
        kept = np.r_[kept, new[beats.sum(axis=1) < top]]
    return kept


def _band_of(table: pa.Table, top: int) -> pa.Table:
    """The skyband of each group of the table."""
    table = table.take(pc.sort_indices(table, [("lang", "ascending"), ("source", "ascending"), ("term", "ascending")]))
    if not table.num_rows:
        return table
    lang, source = (table.column(c).combine_chunks().dictionary_encode() for c in ("lang", "source"))
    group = np.asarray(lang.indices, np.int64) * len(source.dictionary) + np.asarray(source.indices, np.int64)
    n, in_lang = (np.asarray(table.column(c)) for c in ("n", "in_lang"))
    edges = np.r_[ar.runs(group), len(group)]
    kept = [lo + skyband(n[lo:hi], in_lang[lo:hi], np.arange(hi - lo), top) for lo, hi in zip(edges[:-1], edges[1:])]
    return table.take(pa.array(np.sort(np.concatenate(kept))))


def _skybands(top: int, label: bool):
    """Retain the skyband of each group among the rows of a task; a task that holds too much passes on what it has."""

    def run(batches):
        def passed(table: pa.Table):
            if label:
                part = pa.array(np.full(table.num_rows, TaskContext.get().partitionId(), np.int32))
                table = table.set_column(table.schema.get_field_index("part"), "part", part)
            return table.combine_chunks().to_batches()

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size > HELD:
                band = _band_of(pa.Table.from_batches(held), top)
                if band.num_rows > HELD // 2:
                    yield from passed(band)
                    band = band.slice(0, 0)
                held, size = band.to_batches(), band.num_rows
        if size:
            yield from passed(_band_of(pa.Table.from_batches(held), top))

    return run


def shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * n / total) for 0 < n <= total, three decimal digits at a time."""
    out, rest = np.zeros(np.broadcast(n, total).shape, np.int64), n
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digits
    return out + 1


def _share(n: Column, total: Column) -> Column:
    wide = F.lit(SCALE).cast("decimal(10,0)") * n.cast("decimal(19,0)")
    return F.call_function("div", wide, total.cast("decimal(19,0)")) + 1


def _pair_sums(key, counts: pa.Table, groups: pa.Table) -> pa.Table:
    """The divergence of each pair of a language's sources, summed over the terms of a bucket."""
    lang, bucket = key[0].as_py(), key[1].as_py()
    groups = groups.sort_by("source")
    names = groups.column("source").combine_chunks()
    total = np.asarray(groups.column("n")) + np.asarray(groups.column("terms"))
    size = len(names)
    term = counts.column("term").combine_chunks().dictionary_encode()
    at = np.asarray(pc.index_in(counts.column("source").combine_chunks(), names), np.int64)
    of, n = np.asarray(term.indices, np.int64), np.asarray(counts.column("n"))
    high, low = (np.zeros((size, size), np.int64) for _ in range(2))
    step = max(1, 4 * CELLS // max(1, size))
    order = np.argsort(of, kind="stable")
    at, of, n = at[order], of[order], n[order]
    for lo in range(0, len(term.dictionary), step):
        here = slice(*np.searchsorted(of, [lo, lo + step]))
        table = np.zeros((size, min(step, len(term.dictionary) - lo)), np.int64)
        table[at[here], of[here] - lo] = n[here]
        p = shares(table + 1, total[:, None])
        for k in range(size):
            apart = (p - p[k]) ** 2 // p[k]
            high[:, k] += (apart >> 32).sum(axis=1)
            low[:, k] += (apart & 0xFFFFFFFF).sum(axis=1)
    one, other = np.nonzero(~np.eye(size, dtype=bool) & ((high + low > 0) | (bucket == 0)))
    return pa.table(
        {
            "lang": pa.array([lang] * len(one), pa.string()),
            "source": names.take(pa.array(one)),
            "item": names.take(pa.array(other)),
            "high": pa.array(high[one, other]),
            "low": pa.array(low[one, other]),
        }
    )


def kept_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang, source, term, n, in_lang, first``: occurrences of kept terms by group and language; ``first`` marks one row of each
    language's term."""
    texts = docs.select(*[text_or_empty(c).alias(c) for c in ("lang", "source", "text")])
    counted = texts.mapInArrow(_count_rows, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    held = counted.select("lang", "source", "term", "n", F.sum("n").over(of_term).alias("in_lang"), F.sum("docs").over(of_term).alias("docs"), (F.min("source").over(of_term) == F.col("source")).alias("first"))
    return held.filter(F.col("docs") >= least).drop("docs")


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, n, lang_n, terms`` of every group that occurs: N of the group and of its language, and V."""
    groups = docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source")).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum(F.col("first").cast("long")).alias("terms"))
    of_lang = own.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.sum("terms").alias("terms"))
    zero = F.lit(0).cast("long")
    return (
        groups.join(own.drop("terms"), ["lang", "source"], "left")
        .join(of_lang, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("n", "lang_n", "terms")])
    )


def pair_part(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every pair of sources of a language."""
    buckets = max(1, -(-kept.count() // CELLS))
    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("bucket")
    counts = kept.select("lang", bucket, "source", "term", "n")
    # A language's totals go to the buckets that hold its terms, and to the first, where each pair gets a row.
    places = counts.select("lang", "bucket").union(groups.select("lang", F.lit(0).alias("bucket"))).distinct()
    totals = groups.select("lang", "source", "n", "terms").join(places, "lang").withColumnRenamed("bucket", "place")
    sums = counts.groupBy("lang", "bucket").cogroup(totals.groupBy("lang", "place")).applyInArrow(_pair_sums, SUMS)
    wide = F.sum(F.col("high").cast("decimal(38,0)")) * F.lit(1 << 32).cast("decimal(10,0)") + F.sum(F.col("low").cast("decimal(38,0)"))
    value = sums.groupBy("lang", "source", "item").agg(wide.cast("long").alias("value"))
    return _ranked(value.withColumn("part", F.lit("pair")))


def term_part(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank`` of the ``top`` terms of each group."""
    band = kept.select("lang", "source", "term", "n", "in_lang", F.lit(0).alias("part")).mapInArrow(_skybands(top, True), BAND)
    salt = F.floor(F.col("part") / FAN).cast("int")
    merged = band.withColumn("part", salt).repartition("lang", "source", "part").mapInArrow(_skybands(top, False), BAND)
    totals = groups.select("lang", "source", F.col("n").alias("of_group"), "lang_n", "terms")
    share = merged.join(totals, ["lang", "source"]).select(
        "lang",
        "source",
        F.col("term").alias("item"),
        _share(F.col("n") + 1, F.col("of_group") + F.col("terms")).alias("p"),
        _share(F.col("in_lang") + 1, F.col("lang_n") + F.col("terms")).alias("q"),
    )
    value = F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("q"))
    found = share.filter("p > q").select("lang", "source", F.lit("term").alias("part"), "item", value.alias("value"))
    return _ranked(found).filter(F.col("rank") <= top)


def _ranked(values: DataFrame) -> DataFrame:
    best = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    return values.select("lang", "source", "part", "item", "value", F.row_number().over(best).alias("rank"))


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """One row for each pair of sources of a language and for each ranked term: lang, source, part, item, value, rank."""
    kept = stored(kept_counts(docs, least), "counts")
    groups = stored(group_totals(docs, kept), "groups")
    return pair_part(kept, groups).unionByName(term_part(kept, groups, top))
