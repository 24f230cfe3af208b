"""Small metadata files in any folder that Spark can reach, through the session's file systems."""

from pyspark.sql import SparkSession
import uuid


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if it is not there."""
    system = _system(spark, folder)
    if not system.exists(_path(spark, folder)):
        return []
    return sorted(found.getPath().getName() for found in system.listStatus(_path(spark, folder)))


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file whole or not at all; False if one of that name is there already.

    It is written beside its place and renamed, which file systems do in one step
    and refuse if the name is taken.
    """
    jvm = spark._jvm
    aside = f"{path}.{uuid.uuid4().hex}.tmp"
    out = _system(spark, aside).create(_path(spark, aside), False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, path).toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(_path(spark, aside), _path(spark, path), plain)
    except Exception:
        _system(spark, aside).delete(_path(spark, aside), False)
        if _system(spark, path).exists(_path(spark, path)):
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text, read on the driver."""
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files in a folder."""
    return _system(spark, path).getContentSummary(_path(spark, path)).getLength()


def changed(spark: SparkSession, path: str) -> float:
    """When a file or folder last changed, in seconds since 1970."""
    return _system(spark, path).getFileStatus(_path(spark, path)).getModificationTime() / 1000


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all that is in it."""
    _system(spark, path).delete(_path(spark, path), True)
