"""Parquet in and out, path checks, and the shared folder for intermediate tables."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from tagloom.operators.contracts import not_null as with_values
from tagloom.operators.contracts import require_columns

#: Compression of written tables: much smaller than Spark's default, at little cost.
CODEC = "zstd"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on any file system Spark can reach."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()).exists(target)


def missing_paths(spark: SparkSession, *paths: str) -> list[str]:
    return [p for p in paths if not path_exists(spark, p)]


def require_paths(spark: SparkSession, *paths: str) -> None:
    missing = missing_paths(spark, *paths)
    if missing:
        raise FileNotFoundError("Missing required input(s): " + ", ".join(missing))


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a session of one machine without that setting gets a folder of its own;
    on a cluster an unset value is an error, since executors would not share it.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local["):
            raise ValueError("Set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tagloom-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless it is there; True for exactly one of any number of writers.

    A local file appears with its content at once, by a hard link; elsewhere the
    file system's own exclusive create decides.
    """
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(context._jsc.hadoopConfiguration())
    system.mkdirs(target.getParent())
    if system.getScheme() == "file":
        place = target.toUri().getPath()
        draft = os.path.join(os.path.dirname(place), f".{uuid.uuid4().hex}")
        with open(draft, "w", encoding="utf-8") as file:
            file.write(text)
        try:
            os.link(draft, place)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    try:
        stream = system.create(target, False)
    except Py4JJavaError:
        if system.exists(target):
            return False
        raise
    stream.write(text.encode())
    stream.close()
    return True


def small_files(spark: SparkSession, folder: str, ending: str = ".json") -> dict[str, str]:
    """{name without ending: path} of the files in a folder, in order of names; empty if it is not there."""
    if not path_exists(spark, folder):
        return {}
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(folder)
    names = [status.getPath().getName() for status in target.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(target)]
    return {name[: -len(ending)]: f"{folder}/{name}" for name in sorted(names) if name.endswith(ending) and not name.startswith(".")}


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that is no longer read, on any file system Spark can reach."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write once to the shared folder and read back.

    Later branches rescan files instead of recomputing the plan, and a lost
    executor costs one task, not the lineage. Column pruning and filters still
    reach the new scan.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", CODEC).parquet(path)
    table = df.sparkSession.read.parquet(path)
    table.__dict__["scratch"] = path
    return table


def forget(*tables: DataFrame) -> None:
    """Delete written intermediates that nothing reads any more, and let Spark drop the shuffles of finished jobs.

    Tables that ``materialise`` did not write are left alone. Spark's cleaner drops a
    shuffle once no plan refers to it, which its driver notices at a collection of garbage.
    """
    for table in tables:
        path = table.__dict__.pop("scratch", None)
        if path:
            remove(table.sparkSession, path)
    gc.collect()
    tables[0].sparkSession.sparkContext._jvm.java.lang.System.gc()


def scan(
    spark: SparkSession, path: str, *, required: Sequence[str] = (), not_null: Sequence[str] = ()
) -> DataFrame:
    """Parquet scan that checks its columns and drops rows with a null key."""
    df = spark.read.parquet(path)
    require_columns(df, required, path)
    return with_values(df, not_null) if not_null else df


def write_table(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    files: int | None = None,
    balance: bool = False,
) -> str:
    """Parquet sink.

    ``files`` forces a file count. ``balance`` lets adaptive execution size the
    output files (and split oversized partitions) instead; with
    ``partition_by`` the rows of one value are dealt over as many tasks as
    their volume needs, so a hot value does not end in one writer.
    """
    if files is not None and files > 0:
        df = df.repartition(files)
    elif balance:
        df = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    writer = df.write.mode(mode).option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_if_absent(df: DataFrame, path: str, *, force: bool = False) -> str:
    """Skip when the table is already there, unless ``force``."""
    return write_table(df, path, mode="overwrite" if force else "ignore")
