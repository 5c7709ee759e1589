"""Session helpers: tables, the shared folder, parallelism."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
HOME = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package: by path where they share the driver's disk, else as a zip file."""
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        paths = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if HOME not in paths:
            sc.environment["PYTHONPATH"] = os.pathsep.join([HOME, *paths])
    elif not any(os.path.basename(f).startswith("registry_lens_") for f in sc._python_includes):
        base = os.path.join(tempfile.mkdtemp(), f"registry_lens_{uuid.uuid4().hex[:8]}")
        sc.addPyFile(shutil.make_archive(base, "zip", HOME, "registry_lens"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data directory."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that every executor can reach, as the session names it.

    Only a local session without the setting gets a folder of its own; on a cluster a
    missing setting is an error, since a machine's own temporary folder would lose data.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    return f"file://{tempfile.gettempdir()}/registry_lens_shared_{os.getpid()}"


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def persist_table(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there and a lost executor costs nothing."""
    path = work_dir(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_fs(spark: SparkSession, path: str):
    """(file system, path object, JVM) of a path, for the few metadata files that are not DataFrames."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def write_text_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file through a temporary name; refuse when ``path`` exists."""
    fs, target, jvm = hadoop_fs(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(tmp, target):
        fs.delete(tmp, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, p, jvm = hadoop_fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of the shared folder, if it is there."""
    fs, p, _ = hadoop_fs(spark, path)
    fs.delete(p, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names directly below a folder, empty when there is none."""
    fs, p, _ = hadoop_fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def spread(df: DataFrame) -> DataFrame:
    """The same rows in at least as many partitions as there are cores, for costly Python steps over few files.

    A table of more partitions than cores, as any large one is, stays as it lies.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df


def buckets_for(spark: SparkSession, least: int = 8) -> int:
    """Bucket count of a new store: as many as the session shuffles into."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
