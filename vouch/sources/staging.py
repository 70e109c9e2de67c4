"""Store intermediate tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


#: Tables that are written side by side.
WRITERS = 8


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Where it is unset a local session gets a temporary one; a cluster must name a folder
    that all its machines see.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="vouch-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/vouch-{uuid.uuid4().hex}"


def stage(tables: dict[str, DataFrame], folder: str | None = None) -> dict[str, DataFrame]:
    """The tables written as Parquet and read back, by default in a new shared folder.

    Worth it before several passes over a join, a view or a text file: each pass then reads
    only its columns, and a lost executor costs no recomputation of the input. The tables
    are written side by side, so that small ones do not wait for the tail of a large one.
    """
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    folder = folder or new_folder(spark)

    def write(name: str) -> None:
        tables[name].write.mode("overwrite").parquet(f"{folder}/{name}")

    with ThreadPoolExecutor(max_workers=min(len(tables), WRITERS)) as pool:
        list(pool.map(write, tables))
    return {name: spark.read.parquet(f"{folder}/{name}") for name in tables}


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a staging folder once nothing reads it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Spark's setting by which the shuffle files of a query go when it ends, not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def passed(df: DataFrame) -> str:
    """The new shared folder that the frame is written to, once; its shuffle files go at the end of it."""
    conf, folder = df.sparkSession.conf, new_folder(df.sparkSession)
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """A small derived frame worked out once and kept in the shared folder.

    For frames of rule results and profiles, which several consumers read.
    """
    context = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return df.checkpoint()
