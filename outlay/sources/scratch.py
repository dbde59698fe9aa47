"""The shared folder for checkpoints and intermediate tables."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Paths handed out inside open scopes, innermost last.
_SCOPES: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir`` where it is set.

    A local session without that setting (tests) gets a temporary folder of its own. A session on
    a cluster without it is refused, because a driver-local folder would lose data there.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="outlay-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table written into the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the tables whose paths were handed out inside it, and nothing else.

    What is computed inside must have been written elsewhere by then, or be no longer needed.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _SCOPES.pop():
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends, and rows stay as they are."""
    spark = df.sparkSession
    path = new_table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
