"""Session settings, the shared work folder and lineage cuts."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, **extra) -> SparkSession:
    """A session for tests and for the bench. Clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("dockwise")
    settings = {**SETTINGS, "spark.sql.shuffle.partitions": str(partitions), **extra}
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _own_root() -> str:
    """Stands in for the shared folder where one machine is all there is."""
    return tempfile.mkdtemp(prefix="dockwise-")


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    return _own_root()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; an application's paths lie together."""
    run = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/dockwise/{run}/{name}-{uuid.uuid4().hex}"


def settle_all(tables: Mapping[str, DataFrame], at_once: int = 4) -> dict[str, DataFrame]:
    """Settle several tables, a few jobs at a time so that small ones share the cluster."""
    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(tables, pool.map(settle, tables.values())))


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage of a table that several later steps read.

    The rows are written to the shared folder and read back, so a lost executor
    costs a re-read and not a re-run of everything upstream, each reader takes
    only the columns it needs, and joins know the real size.
    """
    path = work_dir(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
