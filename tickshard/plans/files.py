"""Small files in the folder of a table: names that only one writer can take."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _system(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, folder: str) -> list[str]:
    system = _system(spark, folder)
    if not system.exists(_path(spark, folder)):
        return []
    return [status.getPath().getName() for status in system.listStatus(_path(spark, folder))]


def read_text(spark: SparkSession, name: str) -> str:
    stream = _system(spark, name).open(_path(spark, name))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_new(spark: SparkSession, name: str, text: str) -> bool:
    """Make the file *name* with *text*, whole or not at all; False if it is there already.

    The text goes to a file of another name first and is renamed without leave to replace.
    """
    folder, last = name.rsplit("/", 1)
    system, draft = _system(spark, name), f"{folder}/.{last}.{uuid.uuid4().hex}"
    stream = system.create(_path(spark, draft), True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    options = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    never = spark.sparkContext._gateway.new_array(options, 1)
    never[0] = options.NONE
    target = system.makeQualified(_path(spark, name))
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(system.makeQualified(_path(spark, draft)), target, never)
    except Py4JJavaError as failure:
        system.delete(_path(spark, draft), False)
        if "FileAlreadyExists" in failure.java_exception.getClass().getName():
            return False
        raise
    return True


def remove(spark: SparkSession, name: str) -> None:
    _system(spark, name).delete(_path(spark, name), True)
