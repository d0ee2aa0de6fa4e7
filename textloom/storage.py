"""Where intermediate tables live and how lineage is cut.

A cluster names a folder that all executors share in ``spark.checkpoint.dir``; everything written in
between goes there, so a lost executor costs a re-read and never a result. Only where the setting is
absent and the session runs on one machine (tests, notebooks) a folder of this process is made and set.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder from ``spark.checkpoint.dir``; a temporary one if a local session names none.

    A session on a cluster without the setting is refused: executors do not share a machine's folders.
    """
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not set_dir:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        set_dir = tempfile.mkdtemp(prefix="textloom-")
        atexit.register(shutil.rmtree, set_dir, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", set_dir)
    return set_dir.rstrip("/")


#: Folders of the tables written by this process and not discarded yet.
_LIVE: dict[str, None] = {}


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as parquet under the shared folder and read it back (lineage is cut there)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("error").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    _LIVE[path] = None
    writer.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._written = path  # noqa: SLF001 (the folder, for discard and scratch)
    return back


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Tables written inside drop their shuffle files as soon as they are written.

    Without it the files stay until the driver happens to collect its garbage, so that the steps of a job add up on the
    disks. Nothing reads them any more once a table is written: each write is a plan of its own.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)  # noqa: SLF001
    _LIVE.pop(path, None)


def discard(df: DataFrame) -> None:
    """Delete the files behind a table that :func:`materialize` returned and nobody reads any more."""
    _delete(df.sparkSession, df._written)  # noqa: SLF001


def purge(spark: SparkSession) -> None:
    """Delete every table this process has written in between, once no result that reads them is needed."""
    for path in list(_LIVE):
        _delete(spark, path)


class _Kept:
    def __init__(self) -> None:
        self.paths: set[str] = set()

    def keep(self, df: DataFrame) -> DataFrame:
        self.paths.add(df._written)  # noqa: SLF001
        return df


@contextmanager
def scratch() -> Iterator[_Kept]:
    """Tables written inside are deleted at the end, but for those handed to ``keep``: what the result reads."""
    before, kept = set(_LIVE), _Kept()
    yield kept
    spark = SparkSession.active()
    for path in [p for p in _LIVE if p not in before and p not in kept.paths]:
        _delete(spark, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table by name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
