"""Size checks behind the choice of join plans."""

from __future__ import annotations

from pyspark.sql import DataFrame


def broadcast_by_size(df: DataFrame) -> bool:
    """Whether the optimizer's size estimate lets Spark broadcast ``df`` on its own.

    Stored tables are estimated from their file sizes. Where no estimate can be had the answer is no.
    """
    try:
        limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except AttributeError:
        return False
    return int(str(size)) <= limit
