"""Paths on the storage Spark is configured for."""

from __future__ import annotations

import hashlib
import re
import tempfile
from collections.abc import Iterator

from pyspark.sql import SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}


def join_path(*parts: str) -> str:
    return "/".join([parts[0].rstrip("/"), *[part.strip("/") for part in parts[1:]]])


def _open(spark: SparkSession, path: str):
    """A path and the file system it is on."""
    located = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return located, located.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or a file that a glob path matches, exists."""
    located, files = _open(spark, path)
    return files.exists(located) or bool(files.globStatus(located))


def literal_path(spark: SparkSession, path: str) -> str:
    """The path as Spark's readers must be given it: glob characters of an existing path are escaped."""
    located, files = _open(spark, path)
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path) if files.exists(located) else path


def qualified(spark: SparkSession, path: str) -> str:
    """The folder part of a path without its scheme, up to the first glob character unless the path exists."""
    located, files = _open(spark, path)
    full = re.sub("^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", files.makeQualified(located).toString())
    return full if files.exists(located) else re.sub(r"/[^/]*[\[{*?].*$", "", full)


def _listed(spark: SparkSession, path: str) -> Iterator[tuple[str, int]]:
    """Path and size of the files under a path that Spark's readers see: hidden ones do not count."""
    located, files = _open(spark, path)
    roots = [located] if files.exists(located) else [status.getPath() for status in files.globStatus(located) or []]
    for root in roots:
        listed = files.listFiles(root, True)
        while listed.hasNext():
            status = listed.next()
            if not status.getPath().getName().startswith(("_", ".")):
                yield status.getPath().toString(), status.getLen()


def empty_files(spark: SparkSession, path: str) -> list[str]:
    """Files without a byte under a path, which Spark's readers pass over."""
    return [name for name, size in _listed(spark, path) if not size]


def largest_and_total(spark: SparkSession, path: str) -> tuple[int, int]:
    """Size of the largest file under a path, and of all."""
    sizes = [size for _, size in _listed(spark, path)]
    return max(sizes, default=0), sum(sizes)


def delete_path(spark: SparkSession, path: str) -> None:
    located, files = _open(spark, path)
    files.delete(located, True)


def move_path(spark: SparkSession, path: str, target: str) -> bool:
    """Put a folder in the place of another without copying it; False, with nothing done, if they are on different stores."""
    source, files = _open(spark, path)
    place, others = _open(spark, target)
    if not files.getUri().equals(others.getUri()):
        return False
    files.mkdirs(place.getParent())
    files.delete(place, True)
    if not files.rename(source, place):
        raise OSError(f"{path} could not be moved to {target}")
    return True


def rename_children(spark: SparkSession, path: str, pattern: str, name: str) -> None:
    """Rename the files directly under a folder whose names match a pattern."""
    located, files = _open(spark, path)
    for status in files.listStatus(located):
        old = status.getPath()
        if re.match(pattern, old.getName()):
            files.rename(old, old.suffix("").getParent().suffix("/" + re.sub(pattern, name, old.getName())))


def child_directories(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly under a path; empty if the path does not exist."""
    located, files = _open(spark, path)
    if not files.exists(located):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(located) if entry.isDirectory())


def path_bytes(spark: SparkSession, *paths: str) -> int:
    """Stored size of some paths."""
    total = 0
    for path in paths:
        located, files = _open(spark, path)
        total += files.getContentSummary(located).getLength() if files.exists(located) else 0
    return total


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share for intermediate tables: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.master.startswith("local"):
        if context.applicationId not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="touchline-")
        return _LOCAL_FOLDERS[context.applicationId]
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def staging_path(spark: SparkSession, *identity: str) -> str:
    """A folder for one intermediate table, the same for the same identity, so a rerun overwrites it."""
    digest = hashlib.sha256("\n".join(identity).encode()).hexdigest()[:16]
    return join_path(shared_folder(spark), "touchline", digest, identity[-1])
