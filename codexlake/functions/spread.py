"""Small inputs in few files, dealt to all cores before heavy work."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Inputs of fewer bytes, by the optimizer's estimate, may well be one row group.
SMALL = 64 << 20


def spread(df: DataFrame) -> DataFrame:
    """df, dealt evenly to as many tasks as there are cores if it is small: a file
    of one row group is one task, whatever its rows cost. Larger inputs stay as
    they are and aren't shuffled. Rows lose their order in the table."""
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(estimate)) >= SMALL:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)
