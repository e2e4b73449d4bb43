"""A stream sink that survives replays and malformed lines.

Spark promises that a micro-batch stopped halfway is run again with the same input and the
same number. So each batch writes one folder named by its number and replaces what may be
there: however often a batch runs, its rows are there once. A batch counts as soon as its
folder has the marker of a finished write; readers take only such folders.

Lines that are no JSON, or whose fields have other types, go to a folder of dead letters,
with the batch that met them; nothing that was read is lost.

Output and checkpoint belong together: numbers start anew with a new checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from tallyworks.streaming.clicks import project_clicks

CORRUPT = "_corrupt_record"
GOOD, DEAD = "good", "dead"


def read_lines(
    spark: SparkSession, folder: str, schema: StructType | str, files_per_trigger: int | None = None
) -> DataFrame:
    """A stream of JSON lines, with the whole line in ``CORRUPT`` where it does not fit."""
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = (
        spark.readStream.schema(StructType([*declared.fields]).add(CORRUPT, StringType()))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(folder)


def batch_folder(output: str, kind: str, batch: int) -> str:
    return f"{output.rstrip('/')}/{kind}/batch={batch}"


def write_batch(lines: DataFrame, batch: int, output: str) -> None:
    """The events and the dead letters of one micro-batch, replacing an earlier try."""
    # Both outputs come from one reading of the files; what does not fit in memory spills.
    lines.persist()
    try:
        fits = F.col(CORRUPT).isNull()
        events = project_clicks(lines.where(fits).drop(CORRUPT))
        events.write.mode("overwrite").parquet(batch_folder(output, GOOD, batch))
        dead = lines.where(~fits).select(F.col(CORRUPT).alias("line"))
        dead.write.mode("overwrite").parquet(batch_folder(output, DEAD, batch))
    finally:
        lines.unpersist()


def start(
    lines: DataFrame, name: str, output: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Start the job over ``read_lines``; a restart with its checkpoint goes on where it was."""
    writer = (
        lines.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, batch: write_batch(df, batch, output))
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def finished(spark: SparkSession, output: str, kind: str) -> list[str]:
    """The folders of the batches that were written to their end."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{batch_folder(output, kind, 0)[:-1]}*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(str(status.getPath().getParent()) for status in found or ())


def read_batches(spark: SparkSession, output: str, kind: str, schema: StructType | str) -> DataFrame:
    """The rows of all finished batches, with the number of their ``batch``."""
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    folders = finished(spark, output, kind)
    if not folders:
        return spark.createDataFrame([], StructType([*declared.fields]).add("batch", "long"))
    whole = StructType([*declared.fields]).add("batch", "long")
    base = f"{output.rstrip('/')}/{kind}"
    return spark.read.schema(whole).option("basePath", base).parquet(*folders)


def forget_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """Puts a stopped job back to where its last batch was written but not yet committed.

    The state a job is left in if it ends between the two; the next start runs that batch
    again. For drills and tests.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/*")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    numbers = [int(s.getPath().getName()) for s in fs.globStatus(pattern) if s.getPath().getName().isdigit()]
    last = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/{max(numbers)}")
    fs.delete(last, False)
