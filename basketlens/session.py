"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "basketlens", cpus: str | int = "*", **conf: str) -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own settings."""
    parts = "8" if cpus == "*" else str(cpus)
    settings = {
        "spark.sql.shuffle.partitions": parts,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A local session without that setting (a test) works below its warehouse folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; each call names another one."""
    return f"{shared_dir(spark).rstrip('/')}/basketlens/{label}-{uuid.uuid4().hex}"
