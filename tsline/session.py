"""Spark session helpers and shared scratch locations.

Library code never creates machine-local scratch folders: every intermediate
table or checkpoint lives under the folder named in ``spark.checkpoint.dir``,
on any master.  Programs that run on one machine (tests, the benchmark) name a
folder of their own there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Tag / field maps are built from distinct role names; decoded lines with a
    # repeated key are flagged corrupt before a map is built, so the default
    # EXCEPTION policy never fires on good data.
}


def get_session(master: str | None = None, app: str = "tsline",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this library assumes."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of ``spark.checkpoint.dir``; an error where it is unset."""
    sc = spark.sparkContext
    configured = spark.conf.get(_CKPT_KEY, None) or sc.getConf().get(_CKPT_KEY, None)
    if not configured:
        raise RuntimeError(
            f"{_CKPT_KEY} is not set; point it at a folder every executor can reach")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_root(spark: SparkSession) -> str:
    """Folder for tables this library writes: the checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return (spark.conf.get(_CKPT_KEY, None)
            or spark.sparkContext.getConf().get(_CKPT_KEY)).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path under the shared root (not created here)."""
    return f"{shared_root(spark)}/tsline-{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Make ``tsline`` importable in Python workers (data source, pandas UDFs).

    The package is zipped once per application on the driver, and Spark's file
    server hands the zip to every executor.
    """
    import os
    import tempfile
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_tsline_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tsline-pkg-"), f"tsline-pkg-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(target)
    sc._tsline_shipped = True
