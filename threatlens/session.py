"""Session creation and the shared folder for intermediate tables."""

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def create_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session for the jobs in this package.

    Only the time zone is fixed. Master, shuffle width and memory belong to the
    cluster (spark-submit), and adaptive execution is on by default.
    """
    builder = SparkSession.builder.appName(app_name).config(
        "spark.sql.session.timeZone", "UTC"
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, path: str | None = None) -> str:
    """A fresh folder for intermediate tables that every executor can reach.

    A caller's path comes first, then spark.checkpoint.dir, then the warehouse folder,
    which Spark resolves to a full address; all three are shared by a cluster.
    """
    root = (
        path
        or spark.conf.get("spark.checkpoint.dir", None)
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    return f"{root.rstrip('/')}/threatlens-{uuid.uuid4().hex}"


def stage(rows: DataFrame, path: str) -> DataFrame:
    """Writes a table and reads it back: cuts the lineage, survives lost executors."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Holds a setting of the session; a stream keeps the one it is started with."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks for so many rows: up to one a core for 50,000 rows or more each, beyond that one
    for every 500,000."""
    return max(1, min(spark.sparkContext.defaultParallelism, -(-rows // 50_000)), -(-rows // 500_000))


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def delete_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder of intermediate tables through its own file system."""
    files, folder = _file_system(spark, path)
    files.delete(folder, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def move_files(spark: SparkSession, pattern: str, path: str, prefix: str) -> None:
    """Moves the files that a pattern matches below `path`, into folders of the same name, with a
    prefix to their names. A file appears there as a whole."""
    files, target = _file_system(spark, pattern)
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files.mkdirs(new(path))
    made = set()
    for status in files.globStatus(target) or []:
        source = status.getPath()
        folder = f"{path}/{source.getParent().getName()}"
        if folder not in made:
            files.mkdirs(new(folder))
            made.add(folder)
        if not files.rename(source, new(folder, prefix + source.getName())):
            raise OSError(f"could not move {source.toString()} to {folder}")


def create_marker(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a small file with this text; False, and nothing done, if it is there already."""
    files, target = _file_system(spark, path)
    try:
        out = files.create(target, False)
    except Py4JJavaError as error:
        if files.exists(target):
            return False
        raise error
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_markers(spark: SparkSession, pattern: str) -> dict[str, str]:
    """Name to text of the small files that a pattern matches."""
    files, target = _file_system(spark, pattern)
    jvm, found = spark.sparkContext._jvm, {}
    for status in files.globStatus(target) or []:
        stream = files.open(status.getPath())
        try:
            found[status.getPath().getName()] = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
    return found


def old_names(spark: SparkSession, pattern: str, age: timedelta, levels: int = 1) -> set[str]:
    """What a pattern matches and has not changed for `age`, as the last `levels` parts of its path."""
    files, target = _file_system(spark, pattern)
    oldest = (time.time() - age.total_seconds()) * 1000
    return {
        "/".join(status.getPath().toString().split("/")[-levels:])
        for status in files.globStatus(target) or [] if status.getModificationTime() <= oldest
    }


def delete_old(spark: SparkSession, path: str, pattern: str, age: timedelta, but: set[str]) -> set[str]:
    """Deletes what a pattern below a path matches and has not changed for `age`, but some names.

    Names are relative to the path; those deleted are returned.
    """
    gone = old_names(spark, f"{path}/{pattern}", age, pattern.count("/") + 1) - but
    for name in gone:
        delete_folder(spark, f"{path}/{name}")
    return gone


def count_files(spark: SparkSession, path: str) -> int:
    """Files below a folder, counted by the file system: no listing reaches the driver."""
    files, folder = _file_system(spark, path)
    return files.getContentSummary(folder).getFileCount()
