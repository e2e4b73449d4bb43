"""Writers: bucketed tables, partitioned folders and nested JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_bucketed(
    df: DataFrame,
    table: str,
    by: str,
    buckets: int = 3,
    path: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Overwrite a catalog table bucketed and sorted by a column, and return it as read back.

    Grouping or joining the table on that column later needs no shuffle.
    """
    # Rebalancing gives each task few buckets, hence few files, and splits a
    # value that is too large for one task over several files of its bucket.
    writer = (
        df.hint("rebalance", by)
        .write.format(fmt)
        .mode("overwrite")
        .bucketBy(buckets, by)
        .sortBy(by)
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def write_partitioned(df: DataFrame, path: str, by: list[str], fmt: str = "parquet") -> None:
    """Overwrite a folder with one subfolder per value combination.

    Rows of a combination are brought together before the write to avoid many
    small files; the rebalance hint splits a combination that is too large for
    one task.
    """
    df.hint("rebalance", *by).write.format(fmt).mode("overwrite").partitionBy(*by).save(path)


def rerun_partitions(
    df: DataFrame, path: str, by: str, values: Sequence[object], fmt: str = "parquet"
) -> None:
    """Replace some subfolders of a folder written by ``write_partitioned`` with one column.

    ``df`` holds the rows of the partitions ``values`` and no others; other rows are left
    out. Files of other partitions are not touched. A value without rows ends up without
    a subfolder. Running it again with the same rows gives the same folder, also after a
    run that was stopped: each replaced subfolder is emptied before its files come in.
    Readers should not read the replaced partitions meanwhile.
    """
    wanted = df.where(F.col(by).isin(*values))
    wanted.hint("rebalance", by).write.format(fmt).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(by).save(path)
    found = {row[0] for row in wanted.select(by).distinct().collect()}
    spark = df.sparkSession
    for value in set(values) - found:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{by}={value}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_json(df: DataFrame, path: str) -> None:
    """Overwrite a folder with JSON lines; structs and arrays stay nested."""
    df.write.mode("overwrite").json(path)


def append_json(df: DataFrame, path: str) -> None:
    """Add files of JSON lines to a folder, as a producer of events does."""
    df.write.mode("append").json(path)
