"""Written intermediate tables: cut lineage, parse a body once, survive the loss of executors."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ludoshelf.session import shared_dir


Stage = Callable[[DataFrame, str], DataFrame]
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files: what they have written is read instead. Else the files stay until the driver collects its garbage."""
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)


class Staging:
    """Writes tables below the cluster's shared checkpoint folder, one sub-folder per run."""

    def __init__(self, spark: SparkSession, run_id: str | None = None) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/ludoshelf/{run_id or uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def close(self) -> None:
        """Remove what this run has written; tables read from it are gone then."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        with shuffles_removed(self.spark):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def in_place(df: DataFrame, name: str) -> DataFrame:
    """No staging: the plan stays lazy."""
    return df
