"""Session defaults, the package on the workers, and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
PACKAGE = Path(__file__).resolve().parent


def build_session(app_name: str = "ludoshelf", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, AQE, Arrow) and the package on its workers."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once a session's context: their functions are pickled by reference."""
    context = spark.sparkContext
    if getattr(context, "_ludoshelf_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="ludoshelf-package-")
    context.addPyFile(shutil.make_archive(f"{folder}/ludoshelf-package", "zip", PACKAGE.parent, PACKAGE.name))
    context._ludoshelf_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names for checkpoints. Only a local master may do without: it gets a fresh folder."""
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that the driver and all executors share")
    configured = tempfile.mkdtemp(prefix="ludoshelf-")
    spark.conf.set(CHECKPOINT_CONF, configured)
    return configured
