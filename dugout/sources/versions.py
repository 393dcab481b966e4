"""Tables whose rows are replaced all at once or not at all.

A replaced table lies in a folder of its own for each version, next to a small file that names
the versions, the current one first. A version is written first and named last, by a rename that
takes the old file's place in one step. Whoever fails before that leaves the old rows; whoever
has opened the version before can go on reading it. A table that was never replaced lies in its
plain folder. One writer at a time replaces a table.
"""

from __future__ import annotations

import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

#: Versions that stay: the current one, and the one before it for those who still read it.
KEPT = 2
_NAMES = "_names"


def table_path(root: str, name: str) -> str:
    """The plain folder of a table."""
    return f"{root.rstrip('/')}/{name}"


def _home(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_versions/{name}"


def _file(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """A path and its file system."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(context._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str, name: str) -> list[str]:
    """Versions of a table that are kept, the current one first; none if it was never replaced."""
    place, files = _file(spark, f"{_home(root, name)}/{_NAMES}")
    if not files.exists(place):
        return []
    stream = files.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split()
    finally:
        stream.close()


def version_path(root: str, name: str, version: str) -> str:
    """The folder of a version; that of a table that was never replaced is the plain one."""
    return f"{_home(root, name)}/{version}" if version else table_path(root, name)


def live_version(spark: SparkSession, root: str, name: str) -> str:
    """The current version, an empty text if the table was never replaced."""
    return next(iter(versions(spark, root, name)), "")


def live_path(spark: SparkSession, root: str, name: str) -> str:
    """Where the rows of a table are now."""
    return version_path(root, name, live_version(spark, root, name))


def new_version() -> str:
    return uuid.uuid4().hex


def publish(spark: SparkSession, root: str, name: str, version: str) -> None:
    """Make a written version the current one, and remove those that nobody needs any more."""
    context = spark.sparkContext
    names = [version, *(v for v in versions(spark, root, name) if v != version)][:KEPT]
    place, files = _file(spark, f"{_home(root, name)}/{_NAMES}")
    draft, _ = _file(spark, f"{_home(root, name)}/_{version}")
    out = files.create(draft, True)
    out.write(bytes("\n".join(names), "utf-8"))
    out.close()
    rename = context._jvm.org.apache.hadoop.fs.Options.Rename
    options = context._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    paths = context._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), context._jsc.hadoopConfiguration())
    paths.rename(draft, place, options)
    for status in files.listStatus(place.getParent()):
        if status.isDirectory() and status.getPath().getName() not in names:
            files.delete(status.getPath(), True)


def remove_folders(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place, files = _file(spark, path)
        files.delete(place, True)
