"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Event, Timer
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

T = TypeVar("T")
MAX_JOBS = 8

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# Only where a local session names no folder of its own.
LOCAL_FOLDER = "file:///tmp/checkpoints/sluice"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "sluice") -> SparkSession:
    """A session for tests and the local benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Large expressions are built faster when the place of each call is not recorded.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config(CHECKPOINT_SETTING, LOCAL_FOLDER)
        .config("spark.sql.warehouse.dir", f"{LOCAL_FOLDER}/warehouse")
        .getOrCreate()
    )


def _is_local(spark: SparkSession) -> bool:
    """Driver and executors are one process."""
    return spark.sparkContext.master.split("[")[0] == "local"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a work folder with its files, in whatever store it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, in whatever store it lies; none if it is not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in store.listStatus(place)] if store.exists(place) else []


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the folder that all executors share.

    The session names that folder in ``spark.checkpoint.dir``. Only a local
    session, where driver and executors are one process, may leave it unset.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError(f"{CHECKPOINT_SETTING} must name a folder shared by all executors")
        root = LOCAL_FOLDER
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result is needed more than once, so that it is computed once
    and a lost executor does not force the work to be done again.
    """
    return stored(df, label)[0]


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``written`` with its folder, for callers that delete it (``delete_folder``) when nothing reads it any more."""
    spark = df.sparkSession
    path = work_folder(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def side_by_side(spark: SparkSession, jobs: list[Callable[[], T]]) -> list[T]:
    """Run independent jobs at the same time, results in order; the first failure is raised."""
    if not jobs:
        return []
    with ThreadPoolExecutor(max_workers=min(len(jobs), MAX_JOBS)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


class TimeLimitExceeded(RuntimeError):
    """A block's jobs took longer than they may."""


@contextmanager
def time_limit(spark: SparkSession, millis: int | None) -> Iterator[None]:
    """Cancel the block's own jobs after so many milliseconds, and raise ``TimeLimitExceeded``; None or 0 is no limit."""
    if not millis:
        yield
        return
    context, group, expired = spark.sparkContext, uuid.uuid4().hex, Event()
    before = context.getLocalProperty("spark.jobGroup.id")

    def stop() -> None:
        expired.set()
        context.cancelJobGroup(group)

    timer = Timer(millis / 1000, stop)
    context.setJobGroup(group, f"limited to {millis} ms", interruptOnCancel=True)
    timer.start()
    try:
        yield
    except Exception as e:
        if expired.is_set():
            raise TimeLimitExceeded(f"time limit of {millis} ms exceeded") from e
        raise
    finally:
        timer.cancel()
        context.setLocalProperty("spark.jobGroup.id", before)
    if expired.is_set():
        raise TimeLimitExceeded(f"time limit of {millis} ms exceeded")


def save_table(writer: DataFrameWriter, spark: SparkSession, name: str) -> str:
    """Save as a Parquet table whose files lie in the shared folder, and give that folder; the warehouse need not be shared."""
    path = work_folder(spark, name)
    writer.format("parquet").option("path", path).saveAsTable(name)
    return path


class Scratch:
    """Tables that are written once, read as often as needed, and dropped with all their files.

    Their files lie in the folder that all executors share.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.names: list[str] = []
        self.folders: list[str] = []

    def written(self, df: DataFrame, label: str, parts: list[str] | None = None) -> DataFrame:
        """Write and read back; ``parts`` are columns whose values have folders of their own."""
        name = f"scratch_{label}_{uuid.uuid4().hex}"
        self.names.append(name)
        self.folders.append(save_table(df.write.partitionBy(*parts) if parts else df.write, self.spark, name))
        return self.spark.table(name)

    def drop(self) -> None:
        while self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.names.pop()}")
        while self.folders:
            delete_folder(self.spark, self.folders.pop())
