"""Small files of a shared folder, through the cluster's file system API."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    p, fs = _fs(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def sizes(spark: SparkSession, path: str, ending: str) -> list[int]:
    """Lengths of a folder's files with names that end so."""
    p, fs = _fs(spark, path)
    return [x.getLen() for x in fs.listStatus(p) if x.getPath().getName().endswith(ending)]


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def read(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write or replace a file."""
    p, fs = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content in one step; False if there is one.

    A hard link on a local file system and a rename that does not overwrite on
    HDFS; an object store puts the object, if absent, when it is closed."""
    jvm = spark._jvm
    target, fs = _fs(spark, path)
    scheme = target.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toUri().getScheme()
    one_step = scheme not in ("file", "hdfs", "viewfs")
    fs.mkdirs(target.getParent())
    source = target if one_step else _fs(spark, f"{target.getParent()}/_{uuid.uuid4().hex}")[0]
    try:
        out = fs.create(source, False)
        out.write(bytearray(text.encode()))
        out.close()
        if scheme == "file":
            file = jvm.java.io.File
            jvm.java.nio.file.Files.createLink(file(target.toUri().getPath()).toPath(), file(source.toUri().getPath()).toPath())
        elif not one_step:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            context.rename(source, target, options)
        return True
    except Exception as e:
        if "AlreadyExist" in str(e) or "PreconditionFailed" in str(e):
            return False
        raise
    finally:
        if not one_step and fs.exists(source):
            fs.delete(source, False)
