"""Written intermediate tables in the folder the cluster shares.

A few operators need a result twice, or need its exact size before they can
choose a join. They write it once as parquet and read it back: the lineage is
cut, lost executors cost nothing, later reads prune columns, and the planner
sees the real file size and picks broadcast or shuffle by itself.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None
_scope: ContextVar[str | None] = ContextVar("scope", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a ``local`` master, where driver and executors share one disk, may
    leave it unset; it then gets a temporary folder removed at exit.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="tablekit-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path below the shared folder, inside the innermost ``scratch`` block."""
    return f"{_scope.get() or f'{shared_folder(spark)}/tablekit'}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Removes at its end every table written inside the block.

    Results built in the block must be saved or collected before it ends.
    """
    with kept_scratch(spark) as folder:
        try:
            yield folder
        finally:
            remove(spark, folder)


@contextmanager
def kept_scratch(spark: SparkSession) -> Iterator[str]:
    """As :func:`scratch`, but the tables stay until the folder it gives is passed to :func:`remove`."""
    folder = f"{shared_folder(spark)}/tablekit/scope-{uuid.uuid4().hex}"
    before = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(before)


def remove(spark: SparkSession, folder: str) -> None:
    """Removes a folder of the shared file system, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return it as a scan of the written table."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
