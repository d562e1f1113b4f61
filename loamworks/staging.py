"""Tables staged in the shared folder of the cluster: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Shuffle files of an SQL execution go when it ends, not when the driver next collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; only a local session without one gets a folder of this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loamworks-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def stage_path(spark: SparkSession) -> str:
    """A new path below the shared folder."""
    return f"{stage_dir(spark)}/loamworks/{uuid.uuid4().hex}"


@contextmanager
def conf_held(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The setting for the time of the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def staged(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it back."""
    spark = df.sparkSession
    path = stage_path(spark)
    with conf_held(spark, CLEANUP, "true"):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def _opened(spark: SparkSession, path: str):  # noqa: ANN202
    """A path and its file system, whichever it is."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _opened(spark, path)
    fs.delete(at, True)


def listed(spark: SparkSession, folder: str) -> list[str]:
    """The files of a folder, as full paths in order."""
    at, fs = _opened(spark, folder)
    return sorted(x.getPath().toString() for x in fs.listStatus(at) if x.isFile())


def exists(spark: SparkSession, path: str) -> bool:
    """path is a URI; one without a scheme is of the file system that Spark takes by default."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(path)) if path.startswith("file:") else _opened(spark, path)[0]
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """A file or a folder gets its name at once; what had the name before is replaced."""
    jvm = spark.sparkContext._jvm
    a, _ = _opened(spark, old)
    b, fs = _opened(spark, new)
    if fs.exists(b) and fs.getFileStatus(b).isDirectory():
        fs.delete(b, True)
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    where = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(b).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    where.rename(fs.makeQualified(a), fs.makeQualified(b), how)


def write_file(spark: SparkSession, path: str, data: bytes) -> None:
    """Writes a file whole, or not at all, on any file system that Spark writes to."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    at, fs = _opened(spark, part)
    try:
        out = fs.create(at, True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
        rename(spark, part, path)
    except BaseException:
        fs.delete(at, True)
        raise


def read_file(spark: SparkSession, path: str, start: int = 0, size: int | None = None) -> bytes:
    """So many bytes of a file from a place on, or all that follow; nothing else of it is read."""
    at, fs = _opened(spark, path)
    source = fs.open(at)
    try:
        source.seek(start)
        return bytes(source.readAllBytes() if size is None else source.readNBytes(size))
    finally:
        source.close()


def drop_staged(*tables: DataFrame) -> None:
    """Deletes staged tables that nothing reads any more."""
    for t in tables:
        delete(t.sparkSession, t.staged_path)
