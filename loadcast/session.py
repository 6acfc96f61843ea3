"""Session settings and the shared scratch location."""

from __future__ import annotations

import atexit
import os
import shutil
from contextlib import contextmanager
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the pipeline relies on: UTC so that epoch seconds never pass through
# a daylight-saving zone, AQE to coalesce the small post-pane shuffles and to
# split skewed partitions at run time, and decimals that keep their places when
# running sums are subtracted (else each level of a cascade loses one).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.decimalOperations.allowPrecisionLoss": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "loadcast", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster the session comes from spark-submit
    and only :data:`SESSION_CONF` needs to be applied (see :func:`configure`)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SESSION_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the pipeline depends on."""
    for k, v in SESSION_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Directory for lineage cuts and derived tables.

    Uses the cluster's ``spark.checkpoint.dir`` (a shared file system on a real
    cluster). Where none is configured, a local master gets a fresh local
    directory, which goes when the process ends; any other master is an error.
    """
    d = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="loadcast-ckpt-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(own)
        d = spark.sparkContext.getCheckpointDir()
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below :func:`shared_dir`."""
    return os.path.join(shared_dir(spark), "loadcast", f"{name}-{uuid.uuid4().hex[:12]}")


@contextmanager
def conf_override(spark: SparkSession, settings: dict):
    """Temporarily set runtime SQL settings, restoring the previous values."""
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield spark
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
