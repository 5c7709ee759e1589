"""What changed between consecutive full snapshots, by key ordinals and compressed bitmaps.

Every key gets a persistent ordinal. Ordinals are cut into containers of fixed width; of each
snapshot and container the index holds a compressed bitmap of the keys present and, aligned
with the ordinals, one vector of 64-bit digests per compared column. Two consecutive
snapshots are compared container by container: AND-NOT of the bitmaps gives additions and
removals, and the vectors of the common keys give the changes. No join of rows with rows
takes place, and however many snapshots there are, a task holds two of one container.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from registry_lens.functions import bitmaps
from registry_lens.session import list_names, persist_table, work_dir

#: Keys in a container; a task of the comparison holds two snapshots of so many keys.
CONTAINER = 8192
#: Keys aimed at for a bucket of the dictionary.
BUCKET_KEYS = 4096


def set_digest(column: str) -> Column:
    """64-bit digest of a list as a set; null and empty lists are equal."""
    items = F.array_sort(F.array_distinct(F.col(column)))
    return F.when(F.coalesce(F.size(items), F.lit(0)) <= 0, F.lit(0).cast("long")).otherwise(F.xxhash64(items))


class OrdinalDictionary:
    """Persistent map from keys to (container, position); known keys keep theirs for ever.

    New keys are hashed to buckets, as many as the dictionary's size asks for by then.
    Within a bucket they are numbered on from the highest number given so far, so the
    numbering needs no global order, and every ``CONTAINER`` numbers of a bucket form one
    container.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self) -> DataFrame | None:
        """(key, bucket, number) of all generations, or None when there is none."""
        gens = [n for n in list_names(self.spark, self.path) if n.startswith("gen=")]
        return self.spark.read.parquet(*(f"{self.path}/{g}" for g in gens)) if gens else None

    def extend(self, keys: DataFrame) -> DataFrame:
        """Number the keys of the column ``key`` that are new; returns key, container, position."""
        old = self.read()
        fresh = keys if old is None else persist_table(keys.join(old, "key", "left_anti").select("key"), "new-keys")
        # the buckets grow with the dictionary; a key keeps the bucket it was given
        total = fresh.count() + (0 if old is None else old.count())
        buckets = max(1, -(-total // BUCKET_KEYS))
        top = None if old is None else old.groupBy("bucket").agg((F.max("number") + 1).alias("base"))
        fresh = fresh.select("key", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket"))
        numbered = fresh.withColumn("number", F.row_number().over(Window.partitionBy("bucket").orderBy("key")) - 1)
        if top is not None:
            numbered = numbered.join(top, "bucket", "left").withColumn("number", F.col("number") + F.coalesce("base", F.lit(0)))
        gen = len([n for n in list_names(self.spark, self.path) if n.startswith("gen=")])
        numbered.select("key", "bucket", "number").write.mode("overwrite").parquet(f"{self.path}/gen={gen:06d}")
        return self.read().select(
            "key",
            (F.col("bucket").cast("long") * 1_000_000 + F.floor(F.col("number") / CONTAINER)).alias("container"),
            (F.col("number") % CONTAINER).cast("int").alias("position"),
        )


def _pack(vectors: int):
    """Rows of one snapshot and container into one index row."""

    def pack(key, rows):
        pos = rows["position"].to_numpy()
        order = np.argsort(pos)
        pos, known = pos[order], rows["known"].to_numpy(zero_copy_only=False)[order]
        out = {
            "container": [key[0].as_py()],
            "run": [key[1].as_py()],
            "present": [bitmaps.encode(pos, CONTAINER)],
            "known": [bitmaps.encode(pos[known], CONTAINER)],
        }
        for k in range(vectors):
            dense = np.zeros(CONTAINER, dtype=np.int64)
            dense[pos] = rows[f"v{k}"].to_numpy()[order]
            used = int(pos[-1]) + 1 if len(pos) else 0
            out[f"v{k}"] = [dense[:used].tobytes()]
        return pa.table(out)

    return pack


CHANGES = pa.schema([("container", pa.int64()), ("position", pa.int32()), ("run", pa.string()), ("change", pa.string())])


class _Container:
    """The snapshots of one container in order: only the one before is kept."""

    def __init__(self, container: int, runs: list[str], vectors: int):
        self.container, self.runs, self.vectors, self.done = container, runs, vectors, 0
        self.none = np.zeros((CONTAINER + 7) // 8, dtype=np.uint8)
        self.before, self.state = self.none, np.zeros((vectors, CONTAINER), dtype=np.int64)

    def upto(self, place: int) -> list[pa.RecordBatch]:
        """Changes of the snapshots before ``place`` that lack the container."""
        out = []
        while self.done < place:
            if self.before.any():
                out += self._step(self.none, self.none, np.zeros_like(self.state))
            self.done += 1
        return out

    def add(self, place: int, row: dict) -> list[pa.RecordBatch]:
        out, now = self.upto(place), np.zeros_like(self.state)
        for v in range(self.vectors):
            got = np.frombuffer(row[f"v{v}"], dtype=np.int64)
            now[v, : len(got)] = got
        out += self._step(bitmaps.words(row["present"], CONTAINER), bitmaps.words(row["known"], CONTAINER), now)
        self.done += 1
        return out

    def _step(self, present: np.ndarray, known: np.ndarray, now: np.ndarray) -> list[pa.RecordBatch]:
        before, state, out = self.before, self.state, []
        # a key that is there but untold of keeps what it had in the snapshot before
        kept = np.unpackbits(present & ~known & before, count=CONTAINER).astype(bool)
        told = np.unpackbits(present & known, count=CONTAINER).astype(bool)
        now = np.where(kept, state, np.where(told, now, 0))
        if self.done:
            common = bitmaps.positions(present & before, CONTAINER)
            moved = common[(now[:, common] != state[:, common]).any(axis=0)]
            for change, pos in (("added", bitmaps.positions(present & ~before, CONTAINER)), ("removed", bitmaps.positions(before & ~present, CONTAINER)), ("changed", moved)):
                if len(pos):
                    n = len(pos)
                    columns = [pa.array(np.full(n, self.container)), pa.array(pos.astype(np.int32)), pa.array([self.runs[self.done]] * n), pa.array([change] * n)]
                    out.append(pa.RecordBatch.from_arrays(columns, schema=CHANGES))
        self.before, self.state = present, now
        return out


def _compare(runs: list[str], vectors: int):
    """Index rows by container and snapshot, in order, into changes."""
    place = {r: k for k, r in enumerate(runs)}

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Container | None = None
        for batch in batches:
            for k in range(batch.num_rows):
                (row,) = batch.slice(k, 1).to_pylist()
                if current is None or row["container"] != current.container:
                    if current is not None:
                        yield from current.upto(len(runs))
                    current = _Container(row["container"], runs, vectors)
                yield from current.add(place[row["run"]], row)
        if current is not None:
            yield from current.upto(len(runs))

    return compare


def snapshot_changes(
    snapshots: DataFrame,
    run: str,
    key: str,
    arrived: str,
    compared: Sequence[str],
    told: Column,
    dictionary_path: str | None = None,
) -> DataFrame:
    """(run, key, change) for every two consecutive snapshots; ``run`` is the later one.

    Of several rows of a snapshot and key the one that arrived last counts (the digests
    break a tie). ``compared`` are list columns, taken as sets. Where ``told`` is false or
    null the row only says that the key is there; its lists are those it had in the
    snapshot before, or empty when it was absent there. Rows without snapshot or key are
    left out; further columns are ignored; an empty table or a single snapshot has no
    changes. Digests are 64 bits wide and only ever compared for the same key.
    """
    spark = snapshots.sparkSession
    vectors = len(compared)
    narrow = snapshots.select(
        F.col(run).alias("run"),
        F.col(key).alias("key"),
        F.struct(
            F.col(arrived).alias("arrived"),
            F.coalesce(told, F.lit(False)).alias("known"),
            *(set_digest(c).alias(f"v{k}") for k, c in enumerate(compared)),
        ).alias("s"),
    ).where("run is not null and key is not null")
    latest = persist_table(
        narrow.groupBy("run", "key").agg(F.max("s").alias("s")).select("run", "key", "s.known", *(f"s.v{k}" for k in range(vectors))), "snapshot-rows"
    )
    runs = sorted(r[0] for r in latest.select("run").distinct().collect())  # one per snapshot
    ordinals = OrdinalDictionary(spark, dictionary_path or work_dir(spark, "ordinals")).extend(latest.select("key").distinct())
    index_schema = "container long, run string, present binary, known binary, " + ", ".join(f"v{k} binary" for k in range(vectors))
    index = persist_table(
        latest.join(ordinals, "key").drop("key").groupBy("container", "run").applyInArrow(_pack(vectors), index_schema), "snapshot-index"
    )
    ordered = index.repartition("container").sortWithinPartitions("container", "run")
    changes = ordered.mapInArrow(_compare(runs, vectors), "container long, position int, run string, change string")
    return changes.join(ordinals, ["container", "position"]).select("run", F.col("key").alias(key), "change")
