"""Names in a folder, replacing a folder by a finished one, and removing one."""

from __future__ import annotations

import time
import uuid
from functools import lru_cache

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@lru_cache(maxsize=1)
def _path_class(jvm):
    """Looked up once: each part of the name is a call to the JVM."""
    return jvm.org.apache.hadoop.fs.Path


def _file_system(spark: SparkSession, path: str):
    hadoop_path = _path_class(spark._jvm)(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_text(spark: SparkSession, uri) -> str:
    """The path that a Java URI stands for."""
    return _path_class(spark._jvm)(uri).toString()


def is_local(spark: SparkSession, path: str) -> bool:
    """Whether a path is in the file system of the machine, or mounted there."""
    return _file_system(spark, path)[0].getScheme() == "file"


# What a folder is called while a new one takes its place.
OLD = ".rollcall_old"


def child_names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly below a folder: one per table, whatever the data size.

    A folder that is aside while a new one takes its place counts under its own
    name; :func:`current` finds it. Listing changes nothing.
    """
    fs, path = _file_system(spark, folder)
    names = {status.getPath().getName() for status in fs.listStatus(path)}
    aside = {n[1:].removesuffix(OLD) for n in names if n.startswith(".") and n.endswith(OLD)}
    return sorted(name for name in names | aside if name[0] != ".")


def current(spark: SparkSession, target: str) -> str:
    """Where a folder is that may be aside while a new one takes its place."""
    fs, destination = _file_system(spark, target)
    _, aside = _file_system(spark, _aside(target))
    return _aside(target) if not fs.exists(destination) and fs.exists(aside) else target


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def folders_in(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _file_system(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())


def files_like(spark: SparkSession, folder: str, begin: str) -> list[str]:
    """Paths of the files directly below a folder whose name begins so."""
    fs, path = _file_system(spark, folder)
    if not fs.exists(path):
        return []
    return [s.getPath().toString() for s in fs.listStatus(path) if s.isFile() and s.getPath().getName().startswith(begin)]


def age_of(spark: SparkSession, path: str) -> float:
    """Seconds since a file or folder was last changed; 0 if it is gone."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return 0.0
    return time.time() - fs.getFileStatus(hadoop_path).getModificationTime() / 1000


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one; whether this call has made it."""
    fs, hadoop_path = _file_system(spark, path)
    try:
        # Makes the folders above as well.
        out = fs.create(hadoop_path, False)
    except Py4JJavaError as error:
        if "already exists" in str(error.java_exception) or fs.exists(hadoop_path):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def put_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is there as a whole or not at all, in place of an older one."""
    folder, _, name = path.rpartition("/")
    fs, target = _file_system(spark, path)
    unfinished = f"{folder}/.{name}-{uuid.uuid4().hex}"
    create_file(spark, unfinished, text)
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(_file_system(spark, unfinished)[1], target):
        raise OSError(f"could not write {path}")


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; none if there is no such file."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return None
    try:
        stream = fs.open(hadoop_path)
    except Py4JJavaError:
        return None
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def tables_in(spark: SparkSession, folder: str, suffix: str) -> dict[str, str]:
    """Table name -> path of the ``{table}{suffix}`` entries of a folder.

    An entry may be one file or a folder of files.
    """
    return {
        name.removesuffix(suffix): f"{folder.rstrip('/')}/{name}"
        for name in child_names(spark, folder)
        if name.endswith(suffix)
    }


def replace_folder(spark: SparkSession, finished: str, target: str) -> None:
    """Put a completely written folder in the place of ``target``.

    The old folder moves aside first and comes back if the new one cannot be
    moved, also when the next replacement finds it aside.
    """
    fs, source = _file_system(spark, finished)
    _, destination = _file_system(spark, target)
    if not fs.exists(source):
        raise OSError(f"nothing to move: {finished}")
    fs.mkdirs(destination.getParent())
    _finish_replacement(spark, target)
    _, aside = _file_system(spark, _aside(target))
    if fs.exists(destination) and not fs.rename(destination, aside):
        raise OSError(f"could not move {target} aside")
    if not fs.rename(source, destination):
        _finish_replacement(spark, target)
        raise OSError(f"could not move {finished} to {target}")
    fs.delete(aside, True)


def _aside(target: str) -> str:
    folder, _, name = target.rstrip("/").rpartition("/")
    return f"{folder}/.{name}{OLD}"


def _finish_replacement(spark: SparkSession, target: str) -> None:
    fs, destination = _file_system(spark, target)
    _, aside = _file_system(spark, _aside(target))
    if not fs.exists(aside):
        return
    if fs.exists(destination):
        fs.delete(aside, True)
    elif not fs.rename(aside, destination):
        raise OSError(f"could not move {target} back")


def make_folder(spark: SparkSession, folder: str) -> None:
    fs, path = _file_system(spark, folder)
    fs.mkdirs(path)


def remove_folder(spark: SparkSession, folder: str) -> None:
    fs, path = _file_system(spark, folder)
    fs.delete(path, True)
