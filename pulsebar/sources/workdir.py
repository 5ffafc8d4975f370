"""Folders for tables a job has to write on its way."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as named in ``spark.checkpoint.dir``.

    Only a local session, whose executors are this process, may go without.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="pulsebar-")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder path nobody has used yet."""
    return f"{shared_folder(spark)}/pulsebar/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return location.getFileSystem(conf), location


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in the file system it names."""
    system, location = _file_system(spark, path)
    return system.exists(location)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; none if there is no ``path``."""
    system, location = _file_system(spark, path)
    if not system.exists(location):
        return []
    return [entry.getPath().getName() for entry in system.listStatus(location) if entry.isDirectory()]


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder and those above it."""
    system, location = _file_system(spark, path)
    system.mkdirs(location)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder a job of ours wrote."""
    system, location = _file_system(spark, path)
    system.delete(location, True)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a folder."""
    system, location = _file_system(spark, path)
    return system.getContentSummary(location).getLength()


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files right in ``path``; none if there is no ``path``."""
    system, location = _file_system(spark, path)
    if not system.exists(location):
        return []
    return [entry.getPath().getName() for entry in system.listStatus(location) if entry.isFile()]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, whole."""
    system, location = _file_system(spark, path)
    stream = system.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place whole; False, and nothing changed, if one is there.

    It is written beside and renamed, which file systems such as HDFS do at once or not at all.
    """
    system, location = _file_system(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    beside = hadoop.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = system.create(beside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    how = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    how[0] = hadoop.Options.Rename.NONE
    try:
        hadoop.FileContext.getFileContext(location.toUri(), system.getConf()).rename(beside, location, how)
    except Py4JJavaError as error:
        system.delete(beside, False)
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True
