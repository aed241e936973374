"""Session construction and the shared checkpoint folder.

The library never hard-codes a cluster folder: lineage cuts go to the folder
the cluster names in ``spark.checkpoint.dir``. Only in local mode, where the
driver is the only machine, may it be unset; then a private folder is used and
deleted when the process ends. Stages written to the shared folder live as long
as the cluster keeps it: they are part of the lineage of every DataFrame built
on them, so nothing here deletes them.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale; every one is a public Spark SQL option.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.filterPushdown": "true",
    # HotSpot does not JIT-compile methods over 8000 bytes of bytecode; a wide
    # rule or record-layout stage above that would run interpreted. Past this
    # size Spark falls back to per-expression code, which stays compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, app: str = "recsmith",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Put the SQL defaults above on a session the caller built (e.g. on a
    cluster); every ``spark.sql.*`` one is a runtime setting. The shared
    checkpoint folder is resolved as in ``get_session``."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. Unset, it is an error except in local
    mode: on a cluster a machine's own folder would be unseen by the others."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="recsmith-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate written table inside the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def materialize(df, name: str = "stage"):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: cuts the lineage and pins values that depend on the physical
    layout (partition ids, row indexes) so every reader sees the same rows.
    """
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
