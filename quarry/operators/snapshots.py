"""Published snapshots behind a pointer (inventory M11, S6).

A snapshot is a folder ``root/v=<n>`` that is never changed once written. What
readers see is the *pointer*: the highest numbered file of ``root/_pointer``, which
holds the version's name. A file appears there whole or not at all (written under
another name, then renamed without overwriting), so:

* a writer that dies between any two steps leaves the pointer, and what readers see,
  as it was;
* two writers that start from the same pointer want the same next number; the second
  rename fails and its caller gets :class:`ConcurrentPublish`;
* rolling back is one more pointer file that names an earlier version. Nothing is
  deleted, and the history of the pointer files is the publishing record.

The rename is the file system's own; where it replaces a file instead of failing
(some object stores), the check for a second writer holds only between writers that
do not rename in the same moment.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

_NUMBER = re.compile(r"\d{10}")


class ConcurrentPublish(RuntimeError):
    """Another writer moved the pointer after this one had read it."""


def _path(spark: SparkSession, text: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)


def _fs(spark: SparkSession, root: str):
    return _path(spark, root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _pointers(spark: SparkSession, root: str) -> list[str]:
    fs, folder = _fs(spark, root), _path(spark, f"{root}/_pointer")
    if not fs.exists(folder):
        return []
    return sorted(name for s in fs.listStatus(folder) if _NUMBER.fullmatch(name := s.getPath().getName()))


def _read(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path), _path(spark, path)
    size = fs.getFileStatus(p).getLen()
    stream = fs.open(p)
    try:
        return bytes(stream.readNBytes(int(size))).decode()
    finally:
        stream.close()


def history(spark: SparkSession, root: str) -> list[str]:
    """The versions that the pointer has named, in order; the last is current."""
    return [_read(spark, f"{root}/_pointer/{name}") for name in _pointers(spark, root)]


def current_version(spark: SparkSession, root: str) -> str | None:
    names = _pointers(spark, root)
    return _read(spark, f"{root}/_pointer/{names[-1]}") if names else None


def read_snapshot(spark: SparkSession, root: str, version: str | None = None, fmt: str = "parquet") -> DataFrame:
    """The current snapshot, or ``version``. The pointer is read once: a publish
    during the query does not change what it reads."""
    version = version or current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    return spark.read.format(fmt).load(f"{root}/{version}")


def _point(spark: SparkSession, root: str, version: str, seen: int) -> None:
    """Name ``version`` in the pointer file after the ``seen`` ones that the caller knows of."""
    fs, target = _fs(spark, root), _path(spark, f"{root}/_pointer/{seen + 1:010d}")
    draft = _path(spark, f"{root}/_pointer/draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(version.encode()))
    finally:
        stream.close()
    jvm = spark.sparkContext._jvm
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()) \
        if target.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        files.rename(draft, target, none)  # fails where the target exists
    except Exception as error:
        fs.delete(draft, False)
        if fs.exists(target):
            raise ConcurrentPublish(f"{root}: pointer {seen + 1} was set by another writer") from error
        raise


def publish(df: DataFrame, root: str, checks: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
            fmt: str = "parquet", seen: int | None = None) -> DataFrame:
    """All-or-nothing publish (M11): write a new version, run every check on what was
    written (each returns a findings DataFrame), and move the pointer only when none
    finds anything. One row per check: ``check``, ``findings``, ``promoted``,
    ``version`` (NULL when not promoted); without checks one row ``none``.

    ``seen``: the length of the history that the caller built ``df`` from, to refuse
    a publish over somebody else's (default: the history when the call starts).
    """
    spark = df.sparkSession
    root = root.rstrip("/")
    seen = len(_pointers(spark, root)) if seen is None else seen
    version = f"v={seen + 1:010d}-{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").format(fmt).save(f"{root}/{version}")
    written = spark.read.format(fmt).load(f"{root}/{version}")
    counts = [(name, check(written).count()) for name, check in (checks or {}).items()] or [("none", 0)]
    clean = all(n == 0 for _, n in counts)
    if clean:
        _point(spark, root, version, seen)
    return spark.createDataFrame([(name, int(n), clean, version if clean else None) for name, n in counts],
                                 "check string, findings long, promoted boolean, version string")


def roll_back(spark: SparkSession, root: str, steps: int = 1) -> str:
    """Point at the version published before the current one (``steps`` of them
    back) and return it."""
    root = root.rstrip("/")
    past = history(spark, root)
    if not past:
        raise ValueError(f"nothing is published in {root}")
    published = sorted(set(past))  # names begin with the publish's number
    at = published.index(past[-1])
    if steps < 1 or at < steps:
        raise ValueError(f"{root} has no version {steps} before {past[-1]}")
    _point(spark, root, published[at - steps], len(past))
    return published[at - steps]
