"""The click stream job: JSON files in, projected click events out.

Each file is either JSON lines or one array of events on a single line; both
read as one row per event. Producers should write to a temporary name and
rename, so that a half-written file is never picked up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyworks import schemas


def read_clicks(
    spark: SparkSession, folder: str, files_per_trigger: int | None = None
) -> DataFrame:
    """A stream over a folder of event files; the schema is declared, as streams require."""
    reader = spark.readStream.schema(schemas.CLICK_EVENT)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(folder)


def project_clicks(clicks: DataFrame) -> DataFrame:
    """Lifts the search text out of the metadata and drops the user agent; batch or stream."""
    return clicks.withColumn("user_query", F.col("metadata.query")).drop("user_agent")


def start_job(
    clicks: DataFrame,
    name: str,
    checkpoint: str,
    output: str | None = None,
    fmt: str = "json",
    available_now: bool = False,
) -> StreamingQuery:
    """Start the projection as a named, restartable query.

    With ``output`` rows are appended to files of ``fmt``; otherwise they go to
    the console. The checkpoint belongs to this query alone: a restart with
    the same one continues after the files already read.
    """
    writer = (
        project_clicks(clicks)
        .writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    writer = writer.format(fmt).option("path", output) if output else writer.format("console")
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_available(
    spark: SparkSession,
    source: str,
    output: str,
    checkpoint: str,
    name: str = "click_stream",
    files_per_trigger: int | None = None,
) -> None:
    """Process every file that is there, then stop.

    ``files_per_trigger`` cuts a large backlog into several batches.
    """
    stream = read_clicks(spark, source, files_per_trigger)
    start_job(stream, name, checkpoint, output, available_now=True).awaitTermination()
