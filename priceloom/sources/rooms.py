"""Folders for intermediate and result tables, under the one that the driver and all executors share."""

from __future__ import annotations

import atexit
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_cleaned: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; set here only where it is unset and there is no cluster (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="priceloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/priceloom/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A new place in this application's own folder, which :func:`clean` removes, at the latest when the driver ends."""
    root = _own_dir(spark)
    if root not in _cleaned:
        _cleaned.add(root)
        atexit.register(_remove, spark._jvm, spark._jsc.hadoopConfiguration(), root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder and read it again, so that it is computed once and a lost executor costs no recomputation."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def tagged(spark: SparkSession, tag: str, most_s: float = 60) -> Iterator[Callable[[], None]]:
    """Jobs started inside bear ``tag``.  Gives a function that waits, ``most_s`` seconds at most, until no task of theirs runs any more: those of a job that failed
    are told to stop, but go on until they look."""
    sc = spark.sparkContext
    tracker, mine = sc.statusTracker(), sc._jsc.sc().statusTracker()

    def running() -> bool:
        jobs = [j for j in map(tracker.getJobInfo, mine.getJobIdsForTag(tag)) if j]
        stages = [s for j in jobs for s in map(tracker.getStageInfo, j.stageIds) if s]
        return any(j.status == "RUNNING" for j in jobs) or any(s.numActiveTasks for s in stages)

    def settle() -> None:
        end = time.monotonic() + most_s
        while running() and time.monotonic() < end:
            time.sleep(0.05)

    sc.addJobTag(tag)
    try:
        yield settle
    finally:
        sc.removeJobTag(tag)


def _remove(jvm, conf, root: str) -> None:
    try:
        path = jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(conf).delete(path, True)
    except Exception:  # noqa: BLE001, S110  the JVM may be gone before the driver's Python is; what it left is under the application's id
        pass


def clean(spark: SparkSession) -> None:
    """Remove all of this application's tables; frames that were not consumed yet are lost."""
    _remove(spark._jvm, spark._jsc.hadoopConfiguration(), _own_dir(spark))
