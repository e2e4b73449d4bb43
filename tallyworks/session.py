"""Session, catalog and shared-storage helpers.

Nothing here picks a master: the caller's session (or ``spark-submit``) does.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the joins and aggregates in this package are planned for: AQE
# re-plans from measured sizes and splits join partitions that one key fills.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app_name: str,
    master: str | None = None,
    hive: bool = False,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the recommended settings; ``hive`` adds a persistent catalog."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    for key, value in {**RECOMMENDED_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_conf(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Partition settings for a job whose largest shuffle moves about that many bytes.

    About 200 MB per partition and at least two per core; AQE merges what turns
    out smaller.
    """
    partitions = max(math.ceil(shuffle_bytes / 200_000_000), 2 * cores)
    return {"spark.sql.shuffle.partitions": str(partitions)}


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database if it is missing and make it the current one."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")
    spark.catalog.setCurrentDatabase(name)


def query_shared_view(df: DataFrame, view: str, predicate: str) -> DataFrame:
    """Publish ``df`` as a global temporary view and filter it through SQL."""
    df.createOrReplaceGlobalTempView(view)
    return df.sparkSession.sql(f"SELECT * FROM global_temp.`{view}` WHERE {predicate}")


def cost_based(spark: SparkSession) -> SparkSession:
    """A sister session that orders joins by column statistics.

    It shares the catalog, so tables stored and analysed by either are known to both; the
    given session keeps its settings.
    """
    sister = spark.newSession()
    for key, value in {
        **RECOMMENDED_CONF,
        "spark.sql.cbo.enabled": "true",
        "spark.sql.cbo.joinReorder.enabled": "true",
        "spark.sql.statistics.histogram.enabled": "true",
        "spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }.items():
        sister.conf.set(key, value)
    return sister


#: Rows, and about how many bytes, that go to a Python worker at once in ``small_batches``.
BATCH_ROWS, BATCH_BYTES = 500, "4m"


def small_batches(df: DataFrame) -> DataFrame:
    """The same rows in a sister session that sends few of them to a Python worker at a time.

    Spark's own batches of 10,000 rows may hold a whole file split of texts, once in the
    executor's memory outside its heap and once in the worker. What is built on the result
    belongs to the sister, which has the given session's settings but for the batches; the
    given session keeps its own.
    """
    spark = df.sparkSession
    sister = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            sister.conf.set(key, value)
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    sister.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS))
    sister.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    view = f"small_batches_{uuid.uuid4().hex}"
    df.createGlobalTempView(view)
    try:
        return sister.table(f"global_temp.`{view}`")
    finally:
        spark.catalog.dropGlobalTempView(view)


def analysed(spark: SparkSession, df: DataFrame, table: str, columns: Sequence[str], path: str) -> DataFrame:
    """Store ``df`` as a table at ``path`` and gather its row count and column statistics."""
    df.write.mode("overwrite").option("path", path).saveAsTable(table)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    return spark.table(table)


def shared_root(spark: SparkSession) -> str:
    """A folder every executor can reach: ``spark.checkpoint.dir``, else below the warehouse.

    The session is only read, never changed. A cluster that names neither has no such
    folder: the warehouse is then below the driver's working folder, and this fails.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    unset = warehouse.removeprefix("file:") == f"{os.getcwd()}/spark-warehouse"
    if unset and not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError(
            "Set spark.checkpoint.dir, or spark.sql.warehouse.dir, to a folder that all executors share"
        )
    return f"{warehouse}/_shared"


def new_shared_folder(spark: SparkSession, purpose: str) -> str:
    """A path not used before below the shared root; Spark creates it on write."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


# The paths that are to be deleted when the block around them ends.
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def passing_pins(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end, also after a failure, what ``pin`` wrote inside.

    For a block that writes its own result: no frame built inside may be read after it.
    A block inside another one deletes only its own files.
    """
    paths: list[str] = []
    outer = _PASSING.set(paths)
    try:
        yield
    finally:
        _PASSING.reset(outer)
        for path in paths:
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Deletes a folder and all in it, wherever it is stored; false if it was not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from there.

    Used where two branches must see the very same rows in the very same
    slices, also after executors are lost. The files are columnar, so a branch
    reads only its columns, and their size is known to the planner. The files stay,
    unless ``passing_pins`` is around.
    """
    path = new_shared_folder(df.sparkSession, "pinned")
    if (passing := _PASSING.get()) is not None:
        passing.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
