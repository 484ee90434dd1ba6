"""Session helpers: a local session for tests/bench, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "lapstats") -> SparkSession:
    """Local session with the settings the tests and the bench use.

    On a cluster the session comes from the launcher; nothing here is needed there.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    local_scratch(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or the one already set on the
    context; a folder that is set is never replaced, and none is made up."""
    found = spark.sparkContext._jsc.sc().getCheckpointDir()
    if found.isDefined():
        return spark.conf.get(CHECKPOINT_CONF, None) or os.path.dirname(found.get())
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(path)
    return path


def local_scratch(spark: SparkSession) -> str:
    """For a local session without a checkpoint folder (tests, bench): set one up."""
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("only a local session may use a machine-local folder")
    if not spark.conf.get(CHECKPOINT_CONF, None) and not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lapstats-ckpt-"))
    return ensure_checkpoint_dir(spark)
