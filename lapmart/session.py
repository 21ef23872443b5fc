"""Spark session helpers.

The library never builds its own session inside an operator: every public
function takes the caller's ``SparkSession``.  ``local_session`` exists for
tests, the benchmark and command-line use on one machine.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "lapmart", extra_conf: dict | None = None) -> SparkSession:
    """A local session configured the way the tests and bench expect.

    * AQE on (coalescing, skew-join splitting, runtime broadcast of
      shuffle outputs whose *measured* size is small).
    * The static, estimate-based broadcast threshold is switched off:
      dimensions are broadcast only behind an explicit size probe
      (``operators.joins.broadcast_if_bounded``) or when AQE has measured
      the materialised side.
    * UI off: no server is started.
    """
    builder = SparkSession.builder
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only on a local
    master (tests, bench) a private scratch folder is created and set where
    nothing is configured; on a cluster a missing setting is an error, since
    executors don't share a machine's folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="lapmart-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
