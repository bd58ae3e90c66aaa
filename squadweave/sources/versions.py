"""Directories of tables that change as a whole: each load is a version, and readers see the latest complete one."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

MARK = "_COMPLETE"
# One empty file per number that a load has taken.
CLAIMS = "claims"


def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _numbers(spark: SparkSession, root: str, under: str = "versions") -> list[int]:
    system, at = _files(spark, f"{root}/{under}")
    if not system.exists(at):
        return []
    names = [status.getPath().getName() for status in system.listStatus(at)]
    return sorted(int(name) for name in names if name.isdigit())


def begin(spark: SparkSession, root: str) -> str:
    """The directory of a new version, which readers do not see yet.

    A number is claimed by creating its file, which the file system lets only
    one of several loads do; the others take the next number.
    """
    number = max([0, *_numbers(spark, root), *_numbers(spark, root, CLAIMS)]) + 1
    while True:
        if _claimed(spark, f"{root}/{CLAIMS}/{number:08d}"):
            return f"{root}/versions/{number:08d}"
        number += 1


def _claimed(spark: SparkSession, path: str) -> bool:
    """Whether this call made the file. Hadoop's local file system looks first and creates then, which two loads may do at once."""
    system, at = _files(spark, path)
    if system.getUri().getScheme() == "file":
        system.mkdirs(at.getParent())
        try:
            open(system.makeQualified(at).toUri().getPath(), "x").close()
            return True
        except FileExistsError:
            return False
    try:
        system.create(at, False).close()
        return True
    except Py4JJavaError:
        if not system.exists(at):
            raise
        return False


def retain(spark: SparkSession, root: str, versions: int) -> list[str]:
    """Delete all but the latest ``versions`` complete versions, and older ones that were never completed; their directories.

    A load that is still at work is newer than the latest complete version or
    was claimed before it; so call this when no load older than that runs.
    """
    if versions < 1:
        raise ValueError("the latest complete version stays")
    done = [number for number in _numbers(spark, root) if _is_complete(spark, f"{root}/versions/{number:08d}")]
    if len(done) < versions:
        return []
    gone = [f"{root}/versions/{number:08d}" for number in _numbers(spark, root) if number < done[-versions]]
    for path in gone:
        system, at = _files(spark, path)
        system.delete(at, True)
    return gone


def _is_complete(spark: SparkSession, version: str) -> bool:
    system, at = _files(spark, f"{version}/{MARK}")
    return system.exists(at)


def complete(spark: SparkSession, version: str) -> None:
    """From now on readers see ``version``; the mark is one file, there or not."""
    system, at = _files(spark, f"{version}/{MARK}")
    system.create(at, True).close()


def latest(spark: SparkSession, root: str) -> str:
    """The directory of the latest complete version."""
    for number in reversed(_numbers(spark, root)):
        version = f"{root}/versions/{number:08d}"
        if _is_complete(spark, version):
            return version
    raise FileNotFoundError(f"no complete version in {root}")
