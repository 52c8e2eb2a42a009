"""Tables that stages leave in the shared folder, and connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_OPEN: list[set[str]] = []
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset, a local master gets a new
    folder, which all its tasks see; any other master must set it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/poiweave-{name}-{os.getpid()}-{uuid.uuid4().hex}"
    for paths in _OPEN:
        paths.add(path)
    return path


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """What operators write inside goes at the end, but for the stored tables that are handed to the function given."""
    paths: set[str] = set()
    _OPEN.append(paths)

    def keep(df: DataFrame) -> DataFrame:
        paths.discard(_PATHS[df])
        return df

    try:
        yield keep
    finally:
        _OPEN.remove(paths)
        for path in paths:
            remove(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet to the shared folder and read again: later steps, and tasks
    that run again after a lost executor, start from these files."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove the files of tables that ``stored`` wrote and nothing reads any more; other frames are left alone."""
    for df in tables:
        path = _PATHS.pop(df, None)
        if path is not None:
            remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    files, place = _files(spark, path)
    files.delete(place, True)


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def listed(spark: SparkSession) -> list[str]:
    """Names of what the operators have written to the shared folder and not yet removed."""
    files, place = _files(spark, shared_folder(spark))
    found = [x.getPath().getName() for x in files.listStatus(place)] if files.exists(place) else []
    return sorted(name for name in found if name.startswith("poiweave-"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``(doc_id, component)``: the smallest id that links reach from each node.

    ``nodes`` has ``doc_id`` and a starting ``component`` (an id of the same component);
    ``links`` has ``a`` and ``b``. Each round gives a node the smallest component among its own and its
    neighbours', then that component's own; a hub costs each task one row, as the minimum is taken before
    the shuffle. Only nodes with links take part. Ends when a round changes nothing.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = stored(nodes.join(both.select(F.col("a").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "component"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("doc_id", "b"), "b").groupBy("a").agg(F.min("component").alias("near"))
        lower = labels.join(near, labels.doc_id == near.a).select("doc_id", "component", F.least("component", "near").alias("next"))
        # What a component's members have found holds for its other members too.
        roots = lower.groupBy("component").agg(F.min("next").alias("root"))
        found = lower.join(roots, "component").select("doc_id", "component", "root")
        before, labels = labels, stored(found.select("doc_id", F.col("root").alias("component"), (F.col("root") < F.col("component")).alias("moved")), "labels")
        discard(before)
        if labels.filter("moved").isEmpty():
            break
    discard(both)
    reached = labels.select(F.col("doc_id").alias("_id"), F.col("component").alias("_component"))
    return nodes.join(reached, nodes.doc_id == F.col("_id"), "left").select("doc_id", F.coalesce("_component", "component").alias("component"))
