"""Intermediate tables that outlive an executor.

Iterative operators cut their lineage by writing a table to the shared folder that the cluster names in
``spark.checkpoint.dir``. A local session without that setting gets a temporary folder of its own; a cluster
without it is an error, as a folder of one machine would be lost with the machine.

Results read the last of these tables, so an operator can't delete them itself. Run it within ``scope``, or call ``close_all`` once
its results are written.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_open: list[Workspace] = []


def shared_dir(spark: SparkSession) -> str:
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and (held := spark.sparkContext._jsc.sc().getCheckpointDir()).isDefined():
        found = held.get()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loomwork-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def opened(uri: str):
    """A file opened by its URI in a task, through Arrow's file systems: local and shared folders, and the stores that they know."""
    from pyarrow import fs

    system, where = fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", uri))
    return system.open_input_file(where)


def openable(path: str) -> bool:
    """Whether ``opened`` knows the store of a path."""
    from pyarrow import fs

    try:
        fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", path))
    except (OSError, ValueError, NotImplementedError):
        return False
    return True


class Workspace:
    """A folder of written tables for one run of one operator."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/loomwork-{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        _open.append(self)

    def save(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and read it back: its lineage is cut and its size is known to the planner."""
        self._n += 1
        path = f"{self.path}/{self._n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._loomwork_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Delete saved tables that no result reads any more."""
        for df in frames:
            self._delete(getattr(df, "_loomwork_path", None))

    def close(self) -> None:
        """Delete everything; results that read these tables must have been written before."""
        self._delete(self.path)
        if self in _open:
            _open.remove(self)

    def _delete(self, path: str | None) -> None:
        if path:
            jvm = self.spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scope() -> Iterator[None]:
    """Whatever operators write in the shared folder within the block is deleted at its end: write the results before."""
    before = list(_open)
    try:
        yield
    finally:
        close_all(before)


def close_all(but: list[Workspace] = ()) -> None:
    """Delete every table that operators of this process have written, but for those of the workspaces ``but``."""
    for ws in [w for w in _open if w not in but]:
        try:
            ws.close()
        except Exception:  # the session that wrote them is gone
            _open.remove(ws)
