"""Numbered commits in a folder: who creates the next number first has made the next version.

A commit is one small JSON file, ``<folder>/00000000000000000007.json``, that names data written
before it.  It is put there whole and only if it is absent: on a local file system by a hard
link, elsewhere by a rename that refuses an existing target, which HDFS and its kin do
atomically.  (An object store needs a connector whose rename or create is conditional; with
one that isn't, keep to one writer.)  Readers list the folder and follow the highest number, so
they see the version before or the version after, never a part of one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from releasekit.session import _file_system, child_names


class CommitConflict(RuntimeError):
    """Another writer has made the next version."""


def _java_error(e, name: str) -> bool:
    """Whether a Java exception or one that caused it is of the class ``name``."""
    cause = getattr(e, "java_exception", None)
    while cause is not None:
        if cause.getClass().getName() == name:
            return True
        cause = cause.getCause()
    return False


def rename_if_absent(spark: SparkSession, source: str, target: str) -> bool:
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(source), hadoop.Path(target)
    context = hadoop.FileContext.getFileContext(old.getFileSystem(sc._jsc.hadoopConfiguration()).getUri(), sc._jsc.hadoopConfiguration())
    try:
        context.rename(old, new, sc._gateway.new_array(hadoop.Options.Rename, 0))
    except Exception as e:
        if _java_error(e, "org.apache.hadoop.fs.FileAlreadyExistsException"):
            return False
        raise
    return True


def link_if_absent(spark: SparkSession, source: str, target: str) -> bool:
    sc = spark.sparkContext
    local = lambda p: sc._jvm.java.io.File(sc._jvm.org.apache.hadoop.fs.Path(p).toUri().getPath()).toPath()
    try:
        sc._jvm.java.nio.file.Files.createLink(local(target), local(source))
    except Exception as e:
        if _java_error(e, "java.nio.file.FileAlreadyExistsException"):
            return False
        raise
    return True


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file ``path`` with ``text``, whole; False if it is there already."""
    folder, _, name = path.rpartition("/")
    staged = f"{folder}/.{name}-{uuid.uuid4().hex[:12]}"
    fs, hpath = _file_system(spark, staged)
    out = fs.create(hpath, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        return (link_if_absent if fs.getUri().getScheme() == "file" else rename_if_absent)(spark, staged, path)
    finally:
        fs.delete(hpath, False)


def read_text(spark: SparkSession, path: str) -> str:
    fs, hpath = _file_system(spark, path)
    stream = fs.open(hpath)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _file(folder: str, number: int) -> str:
    return f"{folder.rstrip('/')}/{number:020d}.json"


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of all commits, in order; none if the folder does not exist."""
    return sorted(int(n[:-5]) for n in child_names(spark, folder) if n.endswith(".json") and n[:-5].isdigit())


def record(spark: SparkSession, folder: str, number: int) -> dict:
    return json.loads(read_text(spark, _file(folder, number)))


def head(spark: SparkSession, folder: str) -> tuple[int, dict] | None:
    """Number and record of the newest commit."""
    found = numbers(spark, folder)
    return (found[-1], record(spark, folder, found[-1])) if found else None


def commit(spark: SparkSession, folder: str, number: int, what: dict) -> bool:
    """Make ``what`` commit ``number``; False if that number is taken."""
    return put_if_absent(spark, _file(folder, number), json.dumps(what, sort_keys=True))


def expire(spark: SparkSession, folder: str, root: str, keep: int) -> list[str]:
    """Remove the data (``record["data"]``, relative to ``root``) of all commits but the newest
    ``keep``; the commits themselves stay, so numbers are never given twice."""
    if keep < 1:
        raise ValueError("the newest version can't be removed")
    found = [record(spark, folder, n).get("data") for n in numbers(spark, folder)]
    gone = [d for d in found[:-keep] if d and d not in found[-keep:]]
    for d in gone:
        fs, path = _file_system(spark, f"{root.rstrip('/')}/{d}")
        fs.delete(path, True)
    return gone
