"""Folder names and small folder operations, through Spark's own file systems."""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: a date inside a file or folder name.
DATE_IN_NAME = r"(\d{4}-\d{2}-\d{2})"


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return file_system, file_system.makeQualified(hadoop_path)


def exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _open(spark, path)
    return file_system.exists(hadoop_path)


def modified(spark: SparkSession, path: str) -> datetime | None:
    """When the file was last written; None if it is not there."""
    file_system, hadoop_path = _open(spark, path)
    if not file_system.exists(hadoop_path):
        return None
    return datetime.fromtimestamp(file_system.getFileStatus(hadoop_path).getModificationTime() / 1000, timezone.utc)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Direct sub-folders but hidden ones, sorted by name; none if the folder is not there."""
    file_system, hadoop_path = _open(spark, path)
    if not file_system.exists(hadoop_path):
        return []
    found = [status.getPath() for status in file_system.listStatus(hadoop_path) if status.isDirectory()]
    return sorted(path.toString() for path in found if not path.getName().startswith(("_", ".")))


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Direct files, sorted by name; none if the folder is not there."""
    file_system, hadoop_path = _open(spark, path)
    if not file_system.exists(hadoop_path):
        return []
    return sorted(status.getPath().toString() for status in file_system.listStatus(hadoop_path) if status.isFile())


def listed(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, size, time of change) of the files in a folder but hidden ones."""
    file_system, hadoop_path = _open(spark, path)
    found = [status for status in file_system.listStatus(hadoop_path) if status.isFile()]
    named = [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found]
    return sorted(entry for entry in named if not entry[0].startswith(("_", ".")))


def escaped(spark: SparkSession, value: str) -> str:
    """A partition value as Spark's writers name its folder."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def remove(spark: SparkSession, path: str) -> None:
    file_system, hadoop_path = _open(spark, path)
    file_system.delete(hadoop_path, True)


def remove_if_empty(spark: SparkSession, path: str) -> None:
    file_system, hadoop_path = _open(spark, path)
    try:
        file_system.delete(hadoop_path, False)
    except Py4JJavaError:
        pass  # something is in it


def qualified(spark: SparkSession, path: str) -> str:
    return _open(spark, path)[1].toUri().toString().rstrip("/")


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to a place where nothing is."""
    file_system, hadoop_path = _open(spark, source)
    _, to = _open(spark, target)
    file_system.mkdirs(to.getParent())
    if not file_system.rename(hadoop_path, to):
        raise OSError(f"could not move {source} to {target}")


def create_new(spark: SparkSession, path: str, text: str = "") -> bool:
    """Write a small file unless it is there; whether this call wrote it."""
    file_system, hadoop_path = _open(spark, path)
    local = hadoop_path.toUri().getScheme() == "file"
    if local and not _claimed(file_system, hadoop_path):
        return False
    try:
        out = file_system.create(hadoop_path, local)
    except Py4JJavaError:
        if file_system.exists(hadoop_path):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _claimed(file_system, hadoop_path) -> bool:
    """Hadoop's local file system looks and then creates, so two callers at once may both create; the machine's own
    exclusive open lets one."""
    file_system.mkdirs(hadoop_path.getParent())
    try:
        open(hadoop_path.toUri().getPath(), "x").close()
    except FileExistsError:
        return False
    return True


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in one step unless one is there: readers never see a part of it. Whether this call put it."""
    fresh = f"{path}.{uuid.uuid4().hex}"
    create_new(spark, fresh, text)
    try:
        _rename(spark, fresh, path)
    except Py4JJavaError:
        remove(spark, fresh)
        if exists(spark, path):
            return False
        raise
    return True


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step: readers see the old text or the new one."""
    fresh = f"{path}.{uuid.uuid4().hex}"
    create_new(spark, fresh, text)
    _rename(spark, fresh, path, overwrite=True)


def _rename(spark: SparkSession, source: str, target: str, overwrite: bool = False) -> None:
    """Rename a file in one step; fails if the target is there and must not be overwritten."""
    _, source = _open(spark, source)
    _, target = _open(spark, target)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsparkSession.sessionState().newHadoopConf()
    )
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE if overwrite else rename.NONE
    context.rename(source, target, options)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if it is not there."""
    file_system, hadoop_path = _open(spark, path)
    if not file_system.exists(hadoop_path):
        return None
    stream = file_system.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def literal(path: str) -> str:
    """The path with the signs escaped that a reader would take for a pattern."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def batch_folder(spark: SparkSession, root: str, file_path: Column | None = None) -> Column:
    """Name of the direct sub-folder of ``root`` a file lies in, '' for none.

    ``name=value`` folders, as Spark's writers make them, give the value.
    """
    _, qualified = _open(spark, root)
    # file:/a and file:///a name the same file.
    prefix = re.sub(r"^([a-z0-9+.-]+):/+", r"\1:/", qualified.toUri().toString().rstrip("/") + "/")
    file_path = F.col("_metadata.file_path") if file_path is None else file_path
    below = F.substring_index(F.regexp_replace(file_path, r"^([a-z0-9+.-]+):/+", "$1:/"), prefix, -1)
    return F.regexp_extract(below, r"^(?:[^/=]+=)?([^/]+)/", 1)


def file_date(name: Column) -> Column:
    """First date in a name, '' if there is none."""
    return F.regexp_extract(name, DATE_IN_NAME, 1)
