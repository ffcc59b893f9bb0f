"""Session helpers: one place that fixes time zone, AQE and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Settings every query in the package relies on.
BASE_CONF = {
    # Event times are wall-clock values; UTC keeps NTZ <-> TIMESTAMP casts lossless.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Session windows: merge sessions inside each map partition before the shuffle,
    # so a hot key ships one row per local session instead of every event.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "eddy",
                  extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the package defaults. Used by tests and bench."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("EDDY_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the SQL settings the operators depend on to an existing session."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql.") and k != "spark.sql.execution.arrow.pyspark.enabled":
            try:
                spark.conf.set(k, v)
            except AnalysisException:  # a setting fixed when the session started: leave it
                pass


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names (``spark.checkpoint.dir``).

    Only a local session (tests, a laptop: one machine) that names none gets a scratch
    folder, kept as the context's checkpoint folder. Anywhere else a missing setting is an
    error: a folder of the driver's machine is seen by no executor.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("start the session with spark.checkpoint.dir, a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="eddy-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d
