"""Shared storage: working folders and file checks through Spark's file systems."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_local: dict[str, str] = {}  # folder by application


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder the session's ``spark.checkpoint.dir`` names.

    Only a local session without a checkpoint folder gets a machine-local one; the
    session's settings stay as they are.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="run-")
        _local[spark.sparkContext.applicationId] = base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, files = _path(spark, path)
    return files.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    target, files = _path(spark, path)
    files.delete(target, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    source, files = _path(spark, path)
    if not files.rename(source, _path(spark, target)[0]):
        raise OSError(f"{path} could not be renamed to {target}")


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Have ``write`` fill a folder aside and put it at ``path``; what was there stays until then.

    A write that fails or dies leaves the old output whole. Should the job die between
    the two renames, both lie next to ``path``, each whole, as ``.new-`` and ``.old-`` folders.
    """
    target, mark = path.rstrip("/"), uuid.uuid4().hex
    new, old = f"{target}.new-{mark}", f"{target}.old-{mark}"
    try:
        write(new)
    except BaseException:
        remove(spark, new)
        raise
    replaced = exists(spark, target)
    if replaced:
        move(spark, target, old)
    try:
        move(spark, new, target)
    except BaseException:
        if replaced:
            move(spark, old, target)
        raise
    if replaced:
        remove(spark, old)


def files_digest(spark: SparkSession, path: str) -> str:
    """A digest of the paths, sizes and times of change of the files at ``path`` or below it; Spark lists and adds up."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    sums = [F.sum(F.xxhash64("path", "length", "modificationTime", F.lit(seed)).cast("decimal(38,0)")) for seed in (1, 2)]
    return repr(tuple(files.select("path", "length", "modificationTime").agg(F.count("*"), *sums).first()))


def bucket_table(path: str) -> str:
    """The table name under which a session knows the buckets at ``path``."""
    return f"buckets_{hashlib.md5(path.rstrip('/').encode()).hexdigest()}"
