"""Session helpers: building a session for tests and locating shared scratch space.

Everything that writes (snapshots, streams, audits, round trips) writes below the
shared folder the cluster names in ``spark.checkpoint.dir``.  We read that setting
from the running session and only set our own when it is unset (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_TEST_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def local_session(cores: int | str = "*", app: str = "tablelab", **conf: str) -> SparkSession:
    """A local session with settings fit for tests and the bench (UI off, UTC)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**_TEST_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; a local master may do without one and gets
    a temporary folder, on any other the setting must name a folder that all share."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tablelab-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root.

    Nothing is ever deleted: every run takes a new folder, so a retried or
    concurrent job can never see another run's files.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tablelab-scratch/{name}-{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the driver's parquet tables."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


_FIXTURES: dict[tuple[str, str], object] = {}


def session_fixture(spark: SparkSession, key: str, build):
    """Build a derived input once per application (e.g. a log written from a table)
    and hand the same one to every plan that only reads it."""
    k = (spark.sparkContext.applicationId, key)
    if k not in _FIXTURES:
        _FIXTURES[k] = build()
    return _FIXTURES[k]
