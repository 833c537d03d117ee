"""File system calls through Spark's own layer, so any path Spark reads works the same way."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path for it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file and put it in place by a rename that replaces the old one.

    The rename is atomic on HDFS and local disks.  An object store copies instead: there a reader
    may for a moment find no pointer and has to look again, but never half of one."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs, _ = file_system(spark, path)
    new = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(new)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    context.rename(fs.makeQualified(new), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path)), options)


def fingerprint(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of what lies in a folder and the folders in it: changes when
    the data under it do."""
    fs, p = file_system(spark, folder)
    found, todo = [], [p]
    while todo:
        for status in fs.listStatus(todo.pop()):
            if status.isDirectory():
                todo.append(status.getPath())
            else:
                found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))
