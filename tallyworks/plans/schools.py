"""School attendance: enrolment by year and rankings of enrolment and absence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks import schemas
from tallyworks.functions import money
from tallyworks.operators import aggregates, windows
from tallyworks.sources import files


def load_attendance(spark: SparkSession, path: str) -> DataFrame:
    raw = files.csv_typed(spark, path, schemas.SCHOOL_ATTENDANCE)
    return raw.withColumnRenamed("School DBN", "school_id")


def school_count(attendance: DataFrame) -> DataFrame:
    return aggregates.distinct_count(attendance, "school_id", "schools")


def average_enrolment(attendance: DataFrame, ordered: bool = True) -> DataFrame:
    averages = attendance.groupBy("SchoolYear").agg(
        money.mean("Enrolled").alias("enrollment_avg")
    )
    return averages.orderBy("SchoolYear") if ordered else averages


def enrolment_rank(attendance: DataFrame) -> DataFrame:
    """Schools by yearly enrolment, largest first; of equals, the smaller id."""
    sums = attendance.groupBy("SchoolYear", "school_id").agg(F.sum("Enrolled").alias("enrolled"))
    return windows.ranked(sums, ["SchoolYear"], [F.desc("enrolled"), F.asc("school_id")])


def absence_rank(attendance: DataFrame) -> DataFrame:
    """Schools by yearly absence, smallest first; of equals, the smaller id."""
    sums = attendance.groupBy("SchoolYear", "school_id").agg(F.sum("Absent").alias("absent"))
    return windows.ranked(sums, ["SchoolYear"], [F.asc("absent"), F.asc("school_id")])
