"""File-system checks through the session's Hadoop configuration (HDFS, S3, local)."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def any_match(spark: SparkSession, pattern: str) -> bool:
    """Whether a glob matches anything."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty when it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def make_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.mkdirs(p))


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Path and length of the files in the folder ``path``, by name."""
    fs, p = _fs(spark, path)
    return sorted((s.getPath().toString(), s.getLen()) for s in fs.listStatus(p) if s.isFile())


@contextmanager
def opened(spark: SparkSession, path: str):
    """A function ``read(at, n)`` of bytes of one file, for small parts of it."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)

    def read(at: int, n: int) -> bytes:
        stream.seek(at)
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, n))

    try:
        yield read
    finally:
        stream.close()


def size(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path``."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def version(spark: SparkSession, path: str) -> tuple[int, int, int] | None:
    """Files, bytes and last change of ``path`` (a file, or a folder of files written at once); None
    where there is nothing.  Another one means other content."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    summary = fs.getContentSummary(p)
    return summary.getFileCount(), summary.getLength(), fs.getFileStatus(p).getModificationTime()


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, p = _fs(spark, path)
    fs.create(p).close()


def write_text(spark: SparkSession, path: str, content: str) -> None:
    """A small text file."""
    fs, p = _fs(spark, path)
    out = fs.create(p)
    out.write(bytearray(content.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file's content."""
    fs, p = _fs(spark, path)
    with opened(spark, path) as read:
        return read(0, fs.getFileStatus(p).getLen()).decode()
