"""Event time: timestamp extraction (T1) and the late-data report (T5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.keyed import keyed_running

# Rows from which the one running maximum is split over tasks.
ARRIVAL_SPLIT = 1 << 16


def late_rows(df: DataFrame, ts: str, arrival: list[str], bound_ms: int = 0,
              split_rows: int = ARRIVAL_SPLIT) -> DataFrame:
    """T5: rows behind the watermark when they arrive. The watermark is the largest event
    time of all earlier arrivals minus ``bound_ms`` (0 = the running-max assigner).

    A running max over the whole input in arrival order, one key for the keyed scan: from
    ``split_rows`` rows on it is cut into ranges of that many arrivals. Rows whose time is
    null are never late and don't move the watermark."""
    x = df.withColumn("_all", F.lit(0))
    r = keyed_running(x, ["_all"], arrival, {"_wm_raw": ("max_before", F.col(ts))}, split_rows)
    wm = F.col("_wm_raw") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                               F.lit(bound_ms / 1000.0).cast("decimal(18,6)"))
    out = r.withColumn("watermark", wm.cast("timestamp_ntz"))
    return out.filter(F.col(ts) < F.col("watermark")).drop("_all", "_wm_raw")
