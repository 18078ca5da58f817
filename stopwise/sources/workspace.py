"""Shared folder for intermediate tables of iterative jobs."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="stopwise-")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


class Workspace:
    """Tables of one job, written once and read back, so lost executors cost no recomputation.

    The tables outlive the job: results read them lazily. ``drop`` removes them.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/job-{uuid.uuid4().hex}"

    def write(self, name: str, data: DataFrame, **options: str) -> tuple[DataFrame, int]:
        """Store ``data`` with the writer's ``options``; return the stored table and its row count."""
        path = f"{self.root}/{name}"
        rows = Observation()
        data.observe(rows, F.count(F.lit(1)).alias("rows")).write.options(**options).parquet(path)
        return self.read(name, data.schema), rows.get["rows"]

    def read(self, name: str, schema) -> DataFrame:
        """A stored table; a trailing ``*`` in ``name`` reads several."""
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def drop(self) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
