"""How rows are laid out over output files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F

from poiweave.schemas import PARTITION_COLUMNS
from poiweave.sinks.swap import swapped

MAX_RECORDS_PER_FILE = 1_000_000


def balanced(df: DataFrame, keys: list[str] = PARTITION_COLUMNS) -> DataFrame:
    """Gathers each output partition in few tasks; AQE splits one that is too large.

    Without it every task would write a small file into every language.
    """
    return df.hint("rebalance", *keys)


def writer(
    df: DataFrame, keys: list[str] = PARTITION_COLUMNS, max_records: int = MAX_RECORDS_PER_FILE, order: Sequence[str] = ()
) -> DataFrameWriter:
    """Writer that replaces the partitions present in ``df`` and leaves the others alone.

    A language without rows gets no directory, hence no empty file; ``replaced`` removes what it had. ``order`` sorts each
    file's rows: within the tasks, after the rows are gathered, so no row moves for it.
    """
    gathered = balanced(df, keys)
    if order:
        gathered = gathered.sortWithinPartitions(*keys, *order)
    return (
        gathered
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records)
        .partitionBy(*keys)
    )


def replaced(
    df: DataFrame,
    write: Callable[[DataFrame, str], None],
    path: str,
    handled: Callable[[dict[str, str]], bool],
    keys: list[str] = PARTITION_COLUMNS,
) -> dict[str, object]:
    """Writes ``df`` to ``path`` and removes the handled partitions that got no row this time, both in one step.

    Rows are counted while they are written. Returns their number and the partitions written, of which there are as many as
    wikis and languages.
    """
    counts = Observation()
    written = swapped(df.observe(counts, F.count("*").alias("rows")), write, path, handled, keys)
    # A plan that Spark finds to be empty runs nothing that could be counted.
    return {"rows": counts.get["rows"] if written else 0, "partitions": written}
