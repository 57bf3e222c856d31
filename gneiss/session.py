"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


PARTITION_BYTES = 256 * 1024**2


def build_session(app="gneiss", master=None, input_bytes: int | None = None, **conf) -> SparkSession:
    """A session with the settings the operators assume: UTC, ANSI and adaptive execution.

    Skew splitting and runtime broadcast choice are left to adaptive execution, which
    checks real sizes; a broadcast is forced only for sides of a known bound.
    ``input_bytes`` sizes the shuffles of a job for its input; adaptive execution merges
    partitions that turn out small.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **({"spark.sql.shuffle.partitions": str(max(200, input_bytes // PARTITION_BYTES))} if input_bytes else {}),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine; elsewhere a missing
    setting is an error, since a machine-local folder is lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="gneiss-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def durable(df):
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    root, context = checkpoint_root(df.sparkSession), df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return df.checkpoint(eager=True)
