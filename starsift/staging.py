"""Tables written once to the shared checkpoint folder and read many times.

Several operators aggregate one input along different keys and join the results
back. Reading the input from a written Parquet table means that its expensive
part (JSON parsing, text cleaning) runs once, that every later read is pruned
to the few columns it needs, and that a lost executor costs a re-read and not a
re-run of the whole lineage. A written aggregate is also a plain scan below the
join's exchange, the shape that adaptive skew-join splitting can handle.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Staged paths of each session, and those that are looked up by a key.
_written: dict[tuple, list[str]] = {}
_shared: dict[tuple, str] = {}


def _session(spark: SparkSession) -> tuple:
    return spark.sparkContext.applicationId, spark._jsparkSession.hashCode()


def stage_root(spark: SparkSession) -> str:
    """Shared folder for staged tables, as named by ``spark.checkpoint.dir``.

    Where it is unset and the session runs on this machine alone, a temporary
    folder stands in; it goes when the process ends. On a cluster it must be set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="starsift-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def stage_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, deleted by ``release_stages``."""
    path = f"{stage_root(spark)}/starsift-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(_session(spark), []).append(path)
    return path


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go as soon as it is written, not when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared folder and return a read of it."""
    path = stage_path(df.sparkSession, label)
    with shuffles_go(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_result(df: DataFrame, label: str, before: list[str]) -> DataFrame:
    """As ``stage``; tables staged after those of ``before``, of which only ``df`` was made, are deleted."""
    spark, held = df.sparkSession, stage(df, label)
    own = staged_so_far(spark)[-1]
    release(spark, [p for p in staged_so_far(spark) if p != own and p not in before])
    return held


def stage_once(spark: SparkSession, label: str, source: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table ``label`` of the folder ``source``: written at the first call of a session, then read.

    It stays for the session, so it is packed with zstd, and tables that ``build`` staged on the way go.
    """
    return stage_parts_once(spark, label, source, lambda: iter([build()]))


def stage_parts_once(spark: SparkSession, label: str, source: str, build: Callable[[], Iterator[DataFrame]]) -> DataFrame:
    """As ``stage_once``, for a table in parts: each is written before the next is built."""

    def written() -> str:
        path = stage_path(spark, label)
        before = set(staged_so_far(spark))
        for part in build():
            with shuffles_go(spark):
                part.write.mode("append").option("compression", "zstd").parquet(path)
        release(spark, [p for p in staged_so_far(spark) if p not in before and p not in _shared.values()])
        return path

    return stage_path_once(spark, label, source, written)


def stage_path_once(spark: SparkSession, label: str, source: str, write: Callable[[], str]) -> DataFrame:
    """As ``stage_once``, for a ``write`` that returns the path it wrote to. Files that are gone are written again."""
    key = (*_session(spark), label, source)
    path = _shared.get(key)
    if path is None or not _exists(spark, f"{path}/_SUCCESS"):
        path = _shared[key] = write()
    return spark.read.parquet(path)


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _exists(spark: SparkSession, path: str) -> bool:
    system, at = _file_system(spark, path)
    return system.exists(at)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables that no frame is read from any more."""
    own = _written[_session(spark)]
    for path in paths:
        system, at = _file_system(spark, path)
        system.delete(at, True)
        own.remove(path)


def staged_so_far(spark: SparkSession) -> list[str]:
    """Paths of the tables this session staged and has not deleted."""
    return list(_written.get(_session(spark), []))


def release_stages(spark: SparkSession) -> int:
    """Delete the tables this session staged; frames read from them end here."""
    own = _session(spark)
    for key in [k for k in _shared if k[:2] == own]:
        del _shared[key]
    n = 0
    for path in _written.pop(own, []):
        system, at = _file_system(spark, path)
        n += bool(system.delete(at, True))
    return n
