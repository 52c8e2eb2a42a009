"""Language identification by fusing evidence in Bayes' rule.

The log posterior of each language adds the text's likelihood (a character-trigram model), the declared
language of the markup, the address's country suffix and language path, and a prior of the host. Host priors
are smoothed in a hierarchy: all pages, then the registered domain, then the host, each level a Dirichlet prior of
``STRENGTH`` pages for the next; their counts are sums of the text's own posteriors, aggregated before the shuffle, so a host that holds a third
of all pages costs each task one row.

The trigram model has a class for every language given in the documents. It is fitted on ``SAMPLE`` documents dealt evenly over
the languages, but up to ``EACH`` of every language, however rare it is or many they are. Long texts do not overrule other
evidence at will: likelihoods count ``WEIGHT`` of their size, as neighbouring trigrams are not independent.

Defined cases: null or empty text, markup, address or host are no evidence; with no evidence at all the prior over all rows decides, ties go to
the first code in order; a null key is kept; repeated rows each get a row; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poiweave.llm import arrays as ar
from poiweave.llm.shared import stored

SAMPLE = 4000
EACH = 100
BUCKETS = 1 << 16
WEIGHT = 0.2
DECLARED = 0.9
SUFFIX = 0.8
PATH = 0.9
STRENGTH = 20.0

# Country suffixes and the language most used there.
COUNTRIES = {
    "de": "de", "at": "de", "ch": "de", "fr": "fr", "be": "fr", "es": "es", "mx": "es", "ar": "es", "co": "es", "cl": "es", "pe": "es",
    "uk": "en", "us": "en", "au": "en", "nz": "en", "ie": "en", "ca": "en", "it": "it", "pt": "pt", "br": "pt", "nl": "nl", "pl": "pl", "ru": "ru",
}


def trigrams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram at each byte (never across rows), and its row."""
    low = ar.lowered(data).astype(np.uint32)
    n = max(0, len(low) - 2)
    value = low[:n] | (low[1 : n + 1] << np.uint32(8)) | (low[2 : n + 2] << np.uint32(16))
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))[: len(low)]
    inside = row[:n] == row[2 : n + 2]
    return ((value[inside] * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64), row[:n][inside]


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # log likelihood by bucket and language


def _counted(batches):
    for rows, data, at in ar.slices(batches):
        bucket, row = trigrams(data, at)
        langs = ar.column(rows, "lang").to_pylist()
        for lang in sorted(set(langs)):
            mine = np.array([x == lang for x in langs])
            count = np.bincount(bucket[mine[row]], minlength=BUCKETS)
            found = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int32()), pa.array(count[found], pa.int64())], ["lang", "bucket", "n"])


def subtag(code: Column) -> Column:
    """The primary subtag of a language code, whole: ``fil`` of ``fil-PH``, ``pt`` of ``pt_BR``."""
    return F.lower(F.regexp_extract(code, "^([A-Za-z]+)(?:[-_]|$)", 1))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Trigram counts by language from a bounded sample of each language's documents, chosen by hash."""
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    key = F.coalesce(F.col("doc_id").cast("string"), text, F.lit(""))
    known = docs.select(subtag(F.col("lang").cast("string")).alias("lang"), key.alias("key"), text.alias("text"), F.xxhash64(key).alias("hash")).filter("lang <> ''")
    every = known.groupBy("lang").agg(F.count("*").alias("n"), F.min("hash").alias("low")).collect()
    languages = sorted(r.lang for r in every) or ["und"]
    each = max(EACH, sample // len(languages))
    # Twice as many as wanted lie below the bound, and the first one always does, so the ranking has few rows to sort.
    bounds = [(r.lang, max(r.low, min((1 << 63) - 1, -(1 << 63) + (2 * each << 64) // r.n))) for r in every]
    bound = F.broadcast(spark.createDataFrame(bounds, "lang string, bound long"))
    ranked = known.join(bound, "lang").filter("hash <= bound").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("hash", "key", "text")))
    counts = ranked.filter(F.col("rank") <= each).select("lang", "text").mapInArrow(_counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    table = np.full((BUCKETS, len(languages)), 0.5)
    place = {x: k for k, x in enumerate(languages)}
    for r in counts:
        table[r.bucket, place[r.lang]] += r.n
    return Model(languages, np.log(table / table.sum(axis=0)).astype(np.float32))


def _likelihoods(model: Model):
    def run(batches):
        for rows, data, at in ar.slices(batches):
            bucket, row = trigrams(data, at)
            n = len(at) - 1
            logs = np.stack([np.bincount(row, model.table[bucket, k], n) for k in range(len(model.languages))], axis=1)
            logs = WEIGHT * (logs - logs.max(axis=1, keepdims=True))
            kept = [c for i, c in enumerate(rows.columns) if rows.schema.names[i] != "text"]
            yield pa.RecordBatch.from_arrays([*kept, ar.lists(logs.ravel(), np.full(n, logs.shape[1]), pa.float64())], [*(x for x in rows.schema.names if x != "text"), "text_log"])

    return run


def visible(html: Column) -> Column:
    """The text between tags, without scripts and styles."""
    bare = F.regexp_replace(html, "(?is)<(script|style)\\b[^>]*+>.*?</\\1\\s*+>", " ")
    return F.regexp_replace(F.regexp_replace(bare, "<[^>]*+>", " "), "&[a-zA-Z#0-9]{1,10};", " ")


def page_evidence(pages: DataFrame) -> DataFrame:
    """Key, text, declared language, host, suffix and path language of each page."""
    html, url = F.coalesce(F.col("html").cast("string"), F.lit("")), F.coalesce(F.lower(F.col("url").cast("string")), F.lit(""))
    host = F.regexp_extract(url, "^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return pages.select(
        F.lit(None).cast("long").alias("doc_id"),
        F.col("page_id").cast("long").alias("page_id"),
        visible(html).alias("text"),
        F.lower(F.regexp_extract(html, "(?i)<html\\b[^>]*?\\blang\\s*=\\s*[\"']?([a-z]{2,3})(?![a-z])", 1)).alias("declared"),
        F.regexp_replace(host, "^www\\.", "").alias("host"),
        F.regexp_extract(host, "\\.([a-z]+)$", 1).alias("suffix"),
        F.regexp_extract(url, "^[^:]*://[^/?#]+/([a-z]{2,3})(?:[/?#]|$)", 1).alias("path"),
    )


def document_evidence(docs: DataFrame) -> DataFrame:
    """The same for plain documents: their source is the host, and nothing is declared."""
    none = F.lit("")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), F.col("text").cast("string").alias("text"),
        none.alias("declared"), F.coalesce(F.col("source").cast("string"), none).alias("host"), none.alias("suffix"), none.alias("path"),
    )


def _log_if(signal: Column, language: str, trust: float, known: list[str]) -> Column:
    """Log chance of the signal in a language; a signal outside the known languages says nothing."""
    right, wrong = float(np.log(trust)), float(np.log((1 - trust) / max(1, len(known) - 1)))
    return F.when(signal.isin(known), F.when(signal == language, F.lit(right)).otherwise(F.lit(wrong))).otherwise(F.lit(0.0))


def _posterior(logs: list[Column]) -> list[Column]:
    high = F.greatest(*logs) if len(logs) > 1 else logs[0]
    parts = [F.exp(x - high) for x in logs]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return [p / total for p in parts]


def identify(evidence: DataFrame, model: Model) -> DataFrame:
    """doc_id, page_id, lang, probability, text_lang and declared of each row of evidence."""
    langs = model.languages
    each = range(len(langs))
    measured = evidence.mapInArrow(
        _likelihoods(model), "doc_id long, page_id long, declared string, host string, suffix string, path string, text_log array<double>"
    )
    own = [F.col("text_log")[k] for k in each]
    rows = measured.select("*", *(p.alias(f"text_{k}") for k, p in zip(each, _posterior(own)))).withColumn("domain", F.regexp_extract("host", "([^.]+\\.[^.]+)$", 1))
    rows = stored(rows.drop("text_log").withColumns({f"log_{k}": F.log(F.greatest(F.col(f"text_{k}"), F.lit(1e-30))) for k in each}), "evidence")

    sums = [F.sum(f"text_{k}").alias(f"n_{k}") for k in each]
    hosts = rows.groupBy("domain", "host").agg(*sums)
    domains = hosts.groupBy("domain").agg(*(F.sum(f"n_{k}").alias(f"d_{k}") for k in each))
    top = domains.agg(*(F.coalesce(F.sum(f"d_{k}"), F.lit(0.0)).alias(f"a_{k}") for k in each)).first()
    total = sum(top)
    overall = [(x + 1.0) / (total + len(langs)) for x in top]

    def smoothed(prefix: str, above: list[Column]) -> list[Column]:
        count = sum((F.col(f"{prefix}_{k}") for k in each), F.lit(0.0))
        return [(F.col(f"{prefix}_{k}") + STRENGTH * above[k]) / (count + STRENGTH) for k in each]

    by_domain = domains.select("domain", *(p.alias(f"p_{k}") for k, p in zip(each, smoothed("d", [F.lit(x) for x in overall]))))
    by_host = hosts.join(by_domain, "domain").select("domain", "host", *(p.alias(f"h_{k}") for k, p in zip(each, smoothed("n", [F.col(f"p_{k}") for k in each]))))
    joined = rows.join(by_host, ["domain", "host"])
    logs = [
        F.col(f"log_{k}") + F.log(F.when(F.col("host") == "", F.lit(overall[k])).otherwise(F.col(f"h_{k}")))
        + _log_if(F.col("declared"), x, DECLARED, langs) + _log_if(F.coalesce(_country(F.col("suffix")), F.lit("")), x, SUFFIX, langs) + _log_if(F.col("path"), x, PATH, langs)
        for k, x in zip(each, langs)
    ]
    shares = joined.select("*", *(p.alias(f"q_{k}") for k, p in zip(each, _posterior(logs))))

    def best(prefix: str) -> tuple[Column, Column]:
        pairs = F.array(*(F.struct(F.col(f"{prefix}_{k}").alias("p"), F.lit(-k).alias("k"), F.lit(x).alias("lang")) for k, x in zip(each, langs)))
        return F.array_max(pairs)["lang"], F.array_max(pairs)["p"]

    return shares.select("doc_id", "page_id", best("q")[0].alias("lang"), best("q")[1].alias("probability"), best("text")[0].alias("text_lang"), "declared", "host")


def _country(suffix: Column) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for code, lang in COUNTRIES.items():
        out = out.when(suffix == code, F.lit(lang))
    return out
