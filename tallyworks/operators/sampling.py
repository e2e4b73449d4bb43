"""Samples of an exact size that do not depend on how rows are partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.operators import windows


def bottom_k(df: DataFrame, strata: Sequence[str], identity: str, k: int, salt: str = "") -> DataFrame:
    """k rows of each stratum, or all if there are fewer: those whose salted ids hash lowest.

    The hash is SHA-256 of the salt and the id as text, so the same rows are drawn under
    any partitioning and by any engine, another salt draws others, and a row that joins
    the table displaces one at most. Rows without id take part last. Each task keeps its k
    lowest per stratum before rows are shuffled; above 1000 rows are cut by sorted slices.
    """
    draw = "_draw"
    hashed = df.withColumn(draw, F.sha2(F.concat(F.lit(salt), F.col(identity).cast("string")), 256))
    order = [F.asc_nulls_last(draw), F.asc(identity)]
    order += [F.asc(c) for c in df.columns if c not in (identity, *strata)]
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    cut = windows.top_k if k <= limit else windows.first_rows
    return cut(hashed, strata, order, k, "_drawn").drop(draw, "_drawn")
