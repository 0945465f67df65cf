"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(name: str = "rxstrata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the pipelines rely on; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Make a session somebody else has started fit: dates are taken in UTC.

    Plans do not depend on the other settings, so the caller's stay as they are.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Where neither the session nor the context names one, a local-mode session (as
    in tests) gets a temporary folder; a cluster must name a shared one.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="rxstrata-")
        context.setCheckpointDir(named)
    return named.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a URI."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it; nothing happens where there is none."""
    fs, at = file_system(spark, path)
    fs.delete(at, True)


_folders: list[str] = []  # of the runs that are under way, innermost last
_ended_with: set[str] = set()


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """What is staged inside goes to one folder, which is deleted at the end."""
    folder = f"{_application_folder(spark)}/run-{uuid.uuid4().hex}"
    _folders.append(folder)
    try:
        yield folder
    finally:
        _folders.remove(folder)
        delete(spark, folder)


def _application_folder(spark: SparkSession) -> str:
    """Folder of this application; the file system deletes it when the JVM ends.

    A crashed driver leaves it behind: its name is the application's id, so a
    retention rule of the store can drop it.
    """
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    if folder not in _ended_with:
        fs, at = file_system(spark, folder)
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        _ended_with.add(folder)
    return folder


def staging_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody has used yet."""
    folder = _folders[-1] if _folders else _application_folder(spark)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage, survives lost executors, and gives Catalyst the real
    size of the table, so a join with it is broadcast only where it is small.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def discard(staged: DataFrame) -> None:
    """Delete what ``stage`` wrote, once nothing reads it any more."""
    delete(staged.sparkSession, staged.staged_at)
