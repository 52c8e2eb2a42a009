"""Allow and block rules for addresses, found by hash prefixes.

A rule is a host and a path. It fits every address whose host is the rule's or a subdomain of it and whose path
starts with the rule's. Each address is expanded into expressions, a host suffix with a path prefix, of the shapes (labels
of the host, characters of the path) that the rules have. Expressions meet the rules by equality of the first four bytes of
their SHA-256 digests; a match is confirmed by the whole digest. Of the rules confirmed, the longest wins (characters of host
and path together, then of the host; of the same rule given both ways, ``block``). An address without a rule gets ``default``.

Built-in functions only. Rules of at most ``broadcast_bytes`` (measured) go to every task, so expressions are not shuffled.
Beyond that, expressions meet the rules in a shuffled join, except those that more than one in ``spark.sql.shuffle.partitions``
addresses have: these are so few (that number times the expressions of an address) that their rules go to every task. Then the
best rule of a row is taken before the shuffle, which so moves one row for each row of ``pages``.

Defined cases: an address that is null or has no ``://`` has an empty host and path; an empty path starts with no rule's path
but an empty one; a rule with null as host, path or verdict is ignored; repeated rows each get a row; ties cannot remain; empty pages give no rows; empty rules
give every address ``default``; very long addresses are expanded only to the shapes of the rules; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_BYTES = 8 << 20
RULE_BYTES = 120  # of a rule in memory besides its own characters
#: Host, path and verdict of the rules that the query applies.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
_PARTS = r"://([^/?#]*)([^?#]*)"


def host_of(url: str = "url") -> Column:
    return F.translate(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), _PARTS, 1), UPPER, LOWER)


def path_of(url: str = "url") -> Column:
    return F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), _PARTS, 2)


def _digest(host: Column, path: Column) -> Column:
    """Neither host nor path of an address holds ``#``, so equal digests stand for equal pairs."""
    return F.unhex(F.sha2(F.concat(host, F.lit("#"), path), 256))


def _prefix(digest: Column) -> Column:
    return F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("long")


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.translate(host, ".", "")) + 1


def prepared(rules: DataFrame) -> DataFrame:
    """One row for each rule: prefix, digest and the precedence of what it says."""
    host = F.translate(F.col("host").cast("string"), UPPER, LOWER)
    given = rules.select(host.alias("h"), F.col("path").cast("string").alias("p"), F.col("verdict").cast("string").alias("v")).dropna()
    one = given.groupBy("h", "p").agg(F.max_by("v", F.struct(F.col("v") == "block", "v")).alias("v"))
    digest = _digest(F.col("h"), F.col("p"))
    wins = F.struct((F.length("h") + F.length("p")).alias("size"), F.length("h").alias("of_host"), F.concat("h", "p").alias("rule"), F.col("v").alias("verdict"))
    return one.select(digest.alias("rule_digest"), _prefix(digest).alias("rule_prefix"), _labels(F.col("h")).alias("labels"), F.length("p").alias("chars"), wins.alias("wins"))


def _expressions(rows: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """A row for each expression of a row, of the rules' shapes only; a row without any has one without digest."""
    wanted = F.array(*[F.struct(F.lit(n).alias("labels"), F.lit(c).alias("chars")) for n, c in shapes])
    fits = F.filter(wanted, lambda s: (s["labels"] <= _labels(F.col("host"))) & (s["chars"] <= F.length("path")))
    opened = rows.select("*", F.explode_outer(fits).alias("shape"))
    suffix = F.call_function("substring_index", F.col("host"), F.lit("."), -F.col("shape.labels"))
    digest = _digest(suffix, F.substring(F.col("path"), F.lit(1), F.col("shape.chars")))
    return opened.select(*rows.columns, digest.alias("digest")).withColumn("prefix", _prefix(F.col("digest")))


def _met(expressions: DataFrame, rules: DataFrame, how: str = "left") -> DataFrame:
    same = (F.col("prefix") == F.col("rule_prefix")) & (F.col("digest") == F.col("rule_digest"))
    return expressions.join(rules.select("rule_prefix", "rule_digest", "wins"), same, how)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict."""
    rows = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", host_of().alias("host"), path_of().alias("path"))
    known = prepared(rules)
    measured = known.groupBy("labels", "chars").agg(F.count("*").alias("n"), F.sum(F.length("wins.rule")).alias("of_rules")).collect()
    if not measured:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    expressions = _expressions(rows, sorted((r.labels, r.chars) for r in measured))
    if sum(RULE_BYTES * r.n + 2 * r.of_rules for r in measured) <= broadcast_bytes:
        met = _met(expressions, F.broadcast(known))
    else:
        parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        often = expressions.groupBy("digest").agg(F.count("*").alias("n")).filter(F.col("n") > F.lit(max(1, pages.count() // parts))).select("digest")
        hot = F.broadcast(often.withColumnRenamed("digest", "rule_digest"))
        few = _met(expressions, F.broadcast(known.join(hot, "rule_digest", "left_semi")))
        rest = expressions.join(F.broadcast(often), "digest", "left_anti").filter("digest is not null")
        met = few.unionByName(_met(rest, known, "inner"))
    best = met.groupBy("row", "page_id", "host", "path").agg(F.max("wins").alias("wins"))
    return best.select("page_id", "host", "path", F.col("wins.rule").alias("rule"), F.coalesce("wins.verdict", F.lit(default)).alias("verdict"))
