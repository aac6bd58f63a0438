"""Session helpers: a configured SparkSession and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "tallyho") -> SparkSession:
    """Session for local runs and tests; on a cluster the launcher's settings win."""
    builder = SparkSession.builder.appName(app)
    outside = SparkSession.getActiveSession() is None and not os.environ.get("PYSPARK_SUBMIT_ARGS") and not os.environ.get("SPARK_ENV_LOADED")
    if master or outside:  # a session of our own on this machine
        cpus = os.environ.get("BENCH_CPUS", "8")
        builder = builder.master(master or f"local[{cpus}]").config("spark.driver.memory", "16g")
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus)).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Materialized intermediate tables go there so that lineage is cut and a
    lost executor never forces a rescan of the fact tables.  A local folder is
    chosen only when the setting is absent *and* Spark runs in local mode.
    """
    d = spark.sparkContext.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="tallyho-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared scratch folder."""
    safe = re.sub(r"[^A-Za-z0-9_.-]+", "_", name)[:80]
    return f"{scratch_root(spark)}/tallyho/{safe}-{uuid.uuid4().hex}"
