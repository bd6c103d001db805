"""Session builder and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

COMPRESSION = "zstd"  # of stored tables and work copies: a third smaller than Spark's default


def build_session(app: str = "flowloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect. ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A session in one process (master local) without the setting gets a folder of its own; a cluster
    session without it is an error, because a machine-local folder would be
    lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="flowloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def work_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_folder(spark)}/flowloom/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, label: str = "cut"):
    """Write ``df`` to the shared folder and read it back, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def reading_by(spark: SparkSession, task_bytes: int) -> Iterator[None]:
    """What is run inside reads files in tasks of at most ``task_bytes``, for steps whose work or memory is many times their bytes."""
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, str(task_bytes))
        yield
    finally:
        spark.conf.set(setting, before)
