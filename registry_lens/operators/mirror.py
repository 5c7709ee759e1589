"""Reconciling two listings of an archive: what is missing, what differs, what to copy next within a budget."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from registry_lens.config import CONFIG, Config
from registry_lens.functions.storage import copy_file
from registry_lens.session import hadoop_fs, persist_table, read_text, write_text_once


class SameStoreError(RuntimeError):
    """The two sides are one store."""


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(key, size) of every object below a path; files being written are left out. Contents are not read."""
    base = path.rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    key = F.element_at(F.split("path", r"\Q" + base.split("://")[-1] + r"\E", 2), 2)
    return files.select(key.alias("key"), F.col("length").alias("size")).where(~F.col("key").endswith(".tmp"))


def prefix_rank(key: str, prefixes: tuple[str, ...]) -> Column:
    """Position of the first listed prefix of a key; unlisted keys come last."""
    out = F.lit(len(prefixes))
    for rank in reversed(range(len(prefixes))):
        out = F.when(F.col(key).startswith(prefixes[rank]), rank).otherwise(out)
    return out


def diff(primary: DataFrame, mirror: DataFrame) -> DataFrame:
    """(key, size, mirror_size, state): missing, size_mismatch, vanished (on the mirror only) or same; an unknown size matches any."""
    here, there = F.col("here").isNotNull(), F.col("there").isNotNull()
    right = mirror.select("key", F.col("size").alias("mirror_size"), F.lit(True).alias("there"))
    state = F.when(~there, "missing").when(~here, "vanished").when(F.col("size") != F.col("mirror_size"), "size_mismatch").otherwise("same")
    return primary.select("key", "size", F.lit(True).alias("here")).join(right, "key", "full_outer").withColumn("state", state).drop("here", "there")


def content_mismatches(primary: DataFrame, mirror: DataFrame) -> DataFrame:
    """Keys on both sides whose digests differ; inputs have key and sha256."""
    return primary.join(mirror.select("key", F.col("sha256").alias("other")), "key").where("sha256 <> other").select("key", "sha256", "other")


def within_budget(keys: DataFrame, most: int, prefixes: tuple[str, ...] = CONFIG.mirror_prefixes) -> DataFrame:
    """The first ``most`` keys by prefix priority and name: a top list that never gathers the rest."""
    return keys.withColumn("priority", prefix_rank("key", prefixes)).orderBy("priority", "key").limit(most)


def sample_ends_stride(keys: DataFrame, order: str, n: int) -> DataFrame:
    """A fixed sample of n rows: both ends, and every k-th between.

    Positions come from counts per range partition, so no task sorts more than its range.
    """
    total = keys.count()
    if total <= n:
        return keys
    position = with_position(keys, order)
    step = F.lit((total - 1) / (n - 1))
    slot = F.floor(F.col("position") / step + 1e-9)
    hits = (F.floor(slot * step + 0.5) == F.col("position")) | (F.floor((slot + 1) * step + 0.5) == F.col("position"))
    return position.where(hits).drop("position")


def with_position(rows: DataFrame, order: str) -> DataFrame:
    """Adds ``position``, the 0-based global rank by ``order`` (distinct values): local ranks plus the counts of the parts before."""
    parts = max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = rows.repartitionByRange(parts, order).withColumn("__part", F.spark_partition_id())
    stored = persist_table(ranged, "positions")
    counts = {r["__part"]: r["n"] for r in stored.groupBy("__part").agg(F.count("*").alias("n")).collect()}  # one per part
    base, offsets = 0, []
    for part in sorted(counts):
        offsets += [F.lit(part), F.lit(base)]
        base += counts[part]
    start = F.create_map(*offsets)[F.col("__part")] if offsets else F.lit(0)
    local = F.row_number().over(Window.partitionBy("__part").orderBy(order))
    return stored.withColumn("position", (start + local - 1).cast("long")).drop("__part")


def summary(differences: DataFrame) -> DataFrame:
    """Per top prefix: objects, bytes, what is missing or differs, and whether the mirror is complete."""
    count = lambda s: F.count_if(F.col("state") == s).alias(s)
    rows = differences.groupBy(F.substring_index("key", "/", 1).alias("prefix")).agg(
        F.count_if(F.col("size").isNotNull()).alias("objects"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), count("missing"), count("size_mismatch"), count("vanished")
    )
    return rows.withColumn("complete", (F.col("missing") == 0) & (F.col("size_mismatch") == 0))


def verdict(totals: DataFrame) -> bool:
    """False when anything differs or vanished; being incomplete is no failure."""
    return totals.where((F.col("size_mismatch") > 0) | (F.col("vanished") > 0)).isEmpty()


def assert_distinct(spark: SparkSession, primary: str, mirror: str, config: Config = CONFIG) -> None:
    """Refuse two names of one store: by their resolved paths, then by a nonce written to one and looked for in the other."""
    fs_a, a, _ = hadoop_fs(spark, primary)
    fs_b, b, _ = hadoop_fs(spark, mirror)
    if fs_a.makeQualified(a).toString() == fs_b.makeQualified(b).toString():
        raise SameStoreError(primary)
    nonce, key = uuid.uuid4().hex, config.probe_key.replace(".json", f"-{uuid.uuid4().hex[:8]}.json")
    write_text_once(spark, f"{mirror.rstrip('/')}/{key}", nonce)
    try:
        fs, p, _ = hadoop_fs(spark, f"{primary.rstrip('/')}/{key}")
        if fs.exists(p) and read_text(spark, f"{primary.rstrip('/')}/{key}") == nonce:
            raise SameStoreError(primary)
    finally:
        fs, p, _ = hadoop_fs(spark, f"{mirror.rstrip('/')}/{key}")
        fs.delete(p, False)


def copy_keys(keys: DataFrame, primary: str, mirror: str, overwrite: bool = False) -> int:
    """Copy objects by key, in tasks; returns how many were copied. Existing objects stay unless ``overwrite`` (repair)."""
    source, target = primary.rstrip("/"), mirror.rstrip("/")

    def run(batches):
        for batch in batches:
            done = sum(copy_file(f"{source}/{key}", f"{target}/{key}", overwrite) for key in batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([done])], names=["n"])

    return keys.select("key").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
