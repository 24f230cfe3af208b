"""Where written tables go."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

from skyledger.functions.text import identifier

_local_root: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session may do without it: it gets one temporary folder per
    process, which goes away with the process.
    """
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="skyledger-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{identifier(label)}_{uuid.uuid4().hex}"


def new_database(spark: SparkSession, label: str) -> str:
    """A fresh database whose managed tables live in the shared folder."""
    path = new_path(spark, label)
    name = path.rsplit("/", 1)[1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name
