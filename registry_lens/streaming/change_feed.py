"""Applying a stream of inserts, updates and deletes with keyed streaming state.

The state of a key is its newest change: payload, sequence and tombstone. A change enters
it only if its sequence is higher, so repeats and late arrivals leave it as it is. Each
micro-batch writes the state of the keys it touched to a folder named by the batch, which a
replay overwrites; readers take of each key the row of the highest sequence.

The state is a built-in streaming aggregate: it combines within each task before the
shuffle, so a key with a third of all rows sends one row per task.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registry_lens.session import list_names, remove, work_dir
from registry_lens.sources.jsonl import latest_text, replace_text

#: Spellings of a delete in the column op, lower case and trimmed.
DELETE_OPS = ("d", "del", "delete", "deleted", "deletion", "remove", "removed", "r", "tombstone")


def is_delete(op: str = "op", flag: str = "feedDeleted", dead: str = "is_dead") -> Column:
    """True if any of the three marks says so; nulls say nothing."""
    return (
        F.coalesce(F.col(flag), F.lit(False))
        | F.coalesce(F.col(dead) == 1, F.lit(False))
        | F.coalesce(F.lower(F.trim(F.col(op))).isin(*DELETE_OPS), F.lit(False))
    )


def change_rows(feed: DataFrame, key: str = "id", seq: str = "seq", payload: tuple[str, ...] = ("latest_version", "maintainers", "changes")) -> DataFrame:
    """The feed in the state's columns; changes without key or sequence cannot be ordered and are left out."""
    return feed.select(
        F.col(key).alias("key"),
        F.struct(F.col(seq).alias("seq"), is_delete().alias("tombstone"), F.struct(*(F.col(c) for c in payload)).alias("payload")).alias("change"),
    ).where("key is not null and change.seq is not null")


def newest_state(changes: DataFrame) -> DataFrame:
    """Newest change per key, for batch and streaming input alike.

    Rows of the same sequence are one change: it is a delete if any of them is marked so,
    as a tombstone orders above the lack of one.
    """
    return changes.groupBy("key").agg(F.max("change").alias("change"))


def upsert_writer(path: str):
    """foreachBatch function: the touched keys' state under batch=<id>, overwritten on a replay."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select("key", "change.*").write.mode("overwrite").parquet(f"{path}/batch={batch_id:010d}")

    return write


def _parts(spark: SparkSession, path: str) -> list[str]:
    """Folders that make up the state: the compacted one, and the batches after it."""
    seen = latest_text(spark, f"{path}/compacted")
    base = json.loads(seen) if seen else {"folder": None, "upto": ""}
    batches = [n for n in list_names(spark, path) if n.startswith("batch=") and n > base["upto"]]
    return [f"{path}/{n}" for n in ([base["folder"]] if base["folder"] else []) + batches]


def read_state(spark: SparkSession, path: str, schema) -> DataFrame:
    """Current state over all batches: key, seq, tombstone, payload (tombstones included)."""
    parts = _parts(spark, path)
    rows = spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)
    merged = rows.groupBy("key").agg(F.max(F.struct("seq", "tombstone", "payload")).alias("c"))
    return merged.select("key", "c.*")


def compact_state(spark: SparkSession, path: str, schema) -> None:
    """Merge the batches written so far into one folder; a small file puts it in force, then the old folders go.

    Call it between two drains: a batch that is replayed later overwrites its own folder
    and, as it lies below the compacted number, is not read again.
    """
    batches = [n for n in list_names(spark, path) if n.startswith("batch=")]
    if not batches:
        return
    folder, old = f"state-{uuid.uuid4().hex[:12]}", _parts(spark, path)
    read_state(spark, path, schema).write.parquet(f"{path}/{folder}")
    replace_text(spark, f"{path}/compacted", json.dumps({"folder": folder, "upto": batches[-1]}))
    for part in old:
        remove(spark, part)


def apply_feed(spark: SparkSession, feed_path: str, root: str | None = None, max_bytes_per_trigger: int = 64 << 30, payload: tuple[str, ...] = ("latest_version", "maintainers", "changes")) -> DataFrame:
    """Drain the feed's files through the stream and return the state.

    ``root`` holds output and checkpoint; calling again with the same one goes on where
    the last call ended. State lives in RocksDB, so it is bounded by disk, not by memory;
    that setting belongs to a copy of the session, which other queries don't see.
    """
    root = root or work_dir(spark, "feed")
    schema = spark.read.parquet(feed_path).schema
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    stream = own.readStream.schema(schema).option("maxBytesPerTrigger", int(max_bytes_per_trigger)).parquet(_as_glob(feed_path))
    state = newest_state(change_rows(stream, payload=payload))
    query = (
        state.writeStream.outputMode("update")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(upsert_writer(f"{root}/upserts"))
        .start()
    )
    query.awaitTermination()
    return read_state(spark, f"{root}/upserts", state.select("key", "change.*").schema)


def _as_glob(path: str) -> str:
    """The same path written as a pattern: the file source takes a single file only that way."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"
