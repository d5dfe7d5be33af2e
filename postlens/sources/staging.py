"""Tables written once in the cluster's shared folder and read back.

A written table cuts lineage: a lost executor re-reads files, it does not re-run
the parse, join and aggregation that made them.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Paths handed out within each open ``scratch``.
_open: list[list[str]] = []

# Folders of local applications without a setting.
_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, or by ``setCheckpointDir`` if that was called.

    An application in one process (master ``local``) that has neither uses a folder of its
    own; on a cluster that raises.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder and context.master.partition("[")[0] == "local":
        folder = _local.get(context.applicationId) or tempfile.mkdtemp(prefix="run-", dir="/tmp")
        _local[context.applicationId] = folder
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return folder.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_folder(spark)}/postlens/{name}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the tables staged within the block when it ends; results must be written by then."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table, in whichever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stage(
    df: DataFrame, path: str, schema: T.StructType | None = None, sort_by: Sequence[str] = ()
) -> DataFrame:
    """Write ``df`` as Parquet and return the table read back.

    ``schema`` replaces the written one, e.g. to read a struct as an ML vector.  With
    ``sort_by``, the rows of a file do not depend on the order in which shuffled blocks
    arrive, so that training on the table can be repeated.
    """
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)
