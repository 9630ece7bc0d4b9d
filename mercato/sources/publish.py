"""Publishing a table so that readers see the old version or the new one, never a part.

``<path>/versions/<name>`` holds complete versions, ``<path>/_current`` the name of the one that
counts. A version is written, read back and checked first; replacing the pointer is the last step,
a rename. A driver that is lost before it leaves the old version in place, and the leftovers of
such a run are deleted by a later one.
"""

from __future__ import annotations

import re
import time
import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

POINTER = "_current"
VERSION = re.compile(r"v(\d{13})-[0-9a-f]{8}")
# A version folder that was never published is taken for a lost run's after so many hours.
ABANDONED_HOURS = 24


class PublishError(Exception):
    """The new version did not pass; readers still have the old one."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of the published version, or None if nothing is published at ``path``."""
    files, pointer = _files(spark, path), _path(spark, f"{path}/{POINTER}")
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()
    if not VERSION.fullmatch(name):
        raise PublishError(f"{path}/{POINTER} does not name a version: {name!r}")
    return name


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The published version; a frame that was opened keeps reading the version it began with."""
    path = path.rstrip("/")
    name = current_version(spark, path)
    if name is None:
        raise PublishError(f"nothing is published at {path}")
    return spark.read.parquet(f"{path}/versions/{name}")


def publish(
    df: DataFrame, path: str, check: Callable[[DataFrame], object] | None = None, keep: int = 2
) -> str:
    """Write ``df`` as the new version of the table at ``path`` and switch readers to it.

    The rows that were written must be the rows that are read back, and ``check`` may raise or
    return False for a version that must not be seen. ``keep`` published versions stay, so that
    readers of the one before can finish. Of two runs at once, the one that switches
    last counts; neither harms the other's files. Returns the name of the version.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    name = f"v{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"
    folder = f"{path}/versions/{name}"
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
    _verify(spark, folder, written.get["rows"], check)
    _switch(spark, path, name)
    _tidy(spark, path, name, keep)
    return name


def _verify(spark: SparkSession, folder: str, rows: int, check: Callable[[DataFrame], object] | None) -> None:
    made = spark.read.parquet(folder)
    found = made.count()
    if found != rows:
        raise PublishError(f"{folder}: {rows} rows were written, {found} are there")
    if check is not None and check(made) is False:
        raise PublishError(f"{folder} did not pass its check")


def _switch(spark: SparkSession, path: str, name: str) -> None:
    """Replace the pointer in one step."""
    files, new = _files(spark, path), _path(spark, f"{path}/{POINTER}.{uuid.uuid4().hex[:8]}")
    stream = files.create(new, True)
    stream.write(bytearray(name.encode()))
    stream.close()
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    pointer = files.makeQualified(_path(spark, f"{path}/{POINTER}"))
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri(), conf)
    overwrite = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = overwrite
    context.rename(files.makeQualified(new), pointer, options)


def _tidy(spark: SparkSession, path: str, name: str, keep: int) -> None:
    """Delete versions older than the ``keep`` newest up to this one, and abandoned ones."""
    files = _files(spark, path)
    held = files.listStatus(_path(spark, f"{path}/versions"))
    names = sorted(n for s in held if VERSION.fullmatch(n := s.getPath().getName()))
    old = [n for n in names if n <= name][: -max(keep, 1)]
    limit = int(time.time() * 1000) - ABANDONED_HOURS * 3_600_000
    current = current_version(spark, path)
    for n in old:
        done = files.exists(_path(spark, f"{path}/versions/{n}/_SUCCESS"))
        if n != current and (done or int(VERSION.fullmatch(n)[1]) < limit):
            if not files.delete(_path(spark, f"{path}/versions/{n}"), True):
                warnings.warn(f"could not delete {path}/versions/{n}", stacklevel=2)
