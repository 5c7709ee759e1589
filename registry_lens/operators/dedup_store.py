"""At-least-once messages: idempotent upsert into hash-bucketed sorted storage.

An upsert writes *sorted runs*: of every hash bucket of the identifier one file, sorted by
a 64-bit hash of the identifier, in which equal identifiers are collapsed already. The
manifest, replaced by a rename, names the runs and every delivered batch they hold, so a
batch that comes again, before or after a compaction, is skipped as a whole. Compaction
merges the sorted files of a bucket in one streaming pass: a task opens all of them, keeps
a stretch of each in memory, merges what lies below the least of their last hashes, and
collapses equal identifiers, which lie side by side. The merged base keeps the same order
and is one of the sorted inputs of the next compaction; nothing is sorted or shuffled.

Layout below the store's path::

    runs/ID/run=G/bucket=B/    sorted files of one upsert
    base/ID/part-B-...         the merged base, one sorted file per bucket
    manifest/V.json            live runs and base, batches, buckets; the newest one counts
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from registry_lens.functions.storage import data_files, row_batches
from registry_lens.session import buckets_for, list_names, read_text, remove, write_text_once

#: Rows aimed at for a bucket; a compaction splits the buckets when they have grown beyond twice that.
BUCKET_ROWS = 2_000_000
#: Rows of each sorted file that a merging task reads at a time.
STRETCH = 32_768
#: Runs written by one upsert of many batches.
GROUPS = 4
LATEST = 2**63 - 1


def comparable(kind: T.DataType) -> bool:
    """Whether Spark can hash and order values of the type."""
    if isinstance(kind, T.ArrayType):
        return comparable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(comparable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType, T.NullType))


# merging


def merge_order(runs: list[np.ndarray]) -> np.ndarray:
    """Places in the concatenation of sorted arrays, in merged order; equal values keep the order of the arrays."""
    starts = np.cumsum([0, *map(len, runs)])
    parts = [(r, np.arange(a, a + len(r))) for r, a in zip(runs, starts.tolist())]
    while len(parts) > 1:
        merged = []
        for (x, at_x), (y, at_y) in zip(parts[::2], parts[1::2]):
            to_x = np.arange(len(x)) + np.searchsorted(y, x, side="left")
            to_y = np.arange(len(y)) + np.searchsorted(x, y, side="right")
            values, at = np.empty(len(x) + len(y), dtype=x.dtype), np.empty(len(x) + len(y), dtype=np.int64)
            values[to_x], values[to_y] = x, y
            at[to_x], at[to_y] = at_x, at_y
            merged.append((values, at))
        parts = merged + parts[len(merged) * 2 :]
    return parts[0][1] if parts else np.zeros(0, dtype=np.int64)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def collapse_sorted(table: pa.Table, key: Sequence[str]) -> pa.Table:
    """A table sorted by ``__h`` with each identifier once: copies summed, of the other columns those of the first delivery."""
    n = table.num_rows
    if n < 2:
        return table
    h = _numbers(table, "__h")
    same_hash = h[1:] == h[:-1]
    if not same_hash.any():
        return table
    equal = same_hash.copy()
    for k in key:
        column = table[k].combine_chunks()
        a, b = column[1:], column[:-1]
        both = pc.fill_null(pc.equal(a, b), False)
        equal &= pc.or_(both, pc.and_(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)
    if (same_hash & ~equal).any():  # different identifiers of one hash may lie mixed: order these rows by identifier
        clash = np.isin(h, h[1:][same_hash & ~equal])
        at = np.flatnonzero(clash)
        order = pc.sort_indices(table.take(at), sort_keys=[("__h", "ascending"), *((k, "ascending") for k in key)]).to_numpy()
        places = np.arange(n)
        places[at] = at[order]
        return _collapse(table.take(places), key)
    return _collapse(table, key, equal)


def _collapse(table: pa.Table, key: Sequence[str], equal: np.ndarray | None = None) -> pa.Table:
    n = table.num_rows
    if equal is None:
        columns = [table[k].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False) for k in key]
        equal = np.logical_and.reduce([c[1:] == c[:-1] for c in (*columns, _numbers(table, "__h"))])
    first = np.flatnonzero(np.append(True, ~equal))
    group = np.cumsum(np.append(True, ~equal)) - 1
    copies = np.add.reduceat(_numbers(table, "copies"), first)
    # of each group the row of the least (__at, __tie); groups of one row, nearly all, are done
    order = np.lexsort((_numbers(table, "__tie"), _numbers(table, "__at"), group)) if len(first) < n else np.arange(n)
    out = table.take(order[first])
    place = out.schema.get_field_index("copies")
    return out.set_column(place, out.schema.field(place), pa.array(copies))


def merge_files(files: list[str], key: Sequence[str], schema: pa.Schema, stretch: int = STRETCH) -> Iterator[pa.Table]:
    """The rows of sorted files in one order, each identifier once; a stretch of each file is in memory at a time."""
    readers = [row_batches(f, stretch) for f in files]
    ahead: list[pa.Table | None] = [None] * len(readers)

    def fill(k: int) -> None:
        nxt = next(readers[k], None)
        while nxt is not None and not nxt.num_rows:
            nxt = next(readers[k], None)
        if nxt is None:
            done[k] = True
        else:
            nxt = nxt.select(schema.names).cast(schema)
            ahead[k] = nxt if ahead[k] is None else pa.concat_tables([ahead[k], nxt])

    done = [False] * len(readers)
    for k in range(len(readers)):
        fill(k)
    while any(t is not None for t in ahead):
        # what lies below every open file's last hash is complete
        limits = [t["__h"][-1].as_py() for t, d in zip(ahead, done) if t is not None and not d]
        limit = min(limits) if limits else None
        parts, hashes = [], []
        for k, t in enumerate(ahead):
            if t is None:
                continue
            h = _numbers(t, "__h")
            cut = len(h) if limit is None else int(np.searchsorted(h, limit, side="left"))
            if cut:
                parts.append(t.slice(0, cut))
                hashes.append(h[:cut])
                ahead[k] = t.slice(cut) if cut < len(h) else None
        if parts:
            whole = pa.concat_tables(parts).combine_chunks()
            yield collapse_sorted(whole.take(merge_order(hashes)) if len(parts) > 1 else whole, key)
        for k, t in enumerate(ahead):
            if not done[k] and (t is None or t["__h"][-1].as_py() == limit):
                fill(k)


class MessageStore:
    """Sorted runs of one message table. Columns: the identifier, ``copies`` (rows delivered), ``body`` (of the first delivery)."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], buckets: int | None = None):
        self.spark, self.path, self.key = spark, path.rstrip("/"), list(key)
        names = [n for n in list_names(spark, f"{self.path}/manifest") if n.endswith(".json")]
        seen = json.loads(read_text(spark, f"{self.path}/manifest/{names[-1]}")) if names else {}
        self.version: int = seen.get("version", 0)
        self.buckets: int | None = seen.get("buckets") or buckets
        self.schema: str | None = seen.get("schema")
        self.runs: list[str] = seen.get("runs", [])
        self.base: str | None = seen.get("base")
        self.rows: int = seen.get("rows", 0)
        self.batches: set[int] = set(seen.get("batches", []))

    def _commit(self) -> None:
        self.version += 1
        entry = {k: getattr(self, k) for k in ("version", "buckets", "schema", "runs", "base", "rows")} | {"batches": sorted(self.batches)}
        write_text_once(self.spark, f"{self.path}/manifest/{self.version:010d}.json", json.dumps(entry))

    def upsert(self, messages: DataFrame, batch: Column, order: Column, groups: int = 1) -> int:
        """Write the batches that the store doesn't hold yet as sorted runs; returns how many they were.

        ``batch`` is the number of a row's delivery (null is 0), ``order`` a number by which the first delivery of an identifier is told, nulls last; ties are
        broken by a hash of the other columns. The batches are spread over ``groups`` runs.
        The collapse combines before its one shuffle, so a message that makes up a third of
        all rows crosses it once per task; that shuffle is the bucketing.
        """
        number = F.coalesce(batch.cast("long"), F.lit(0))
        counted = {r[0]: r[1] for r in messages.groupBy(number).count().collect()}  # one row per batch
        fresh = sorted(set(counted) - self.batches)
        if not fresh:
            return 0
        if self.buckets is None:
            least, rows = buckets_for(self.spark), sum(counted.values())
            self.buckets = least * max(1, -(-rows // (BUCKET_ROWS * least)))
        rest = [c for c in messages.columns if c not in self.key]
        hashed = [c for c in rest if comparable(messages.schema[c].dataType)]
        group = F.pmod(F.xxhash64(number), F.lit(groups))
        rows = messages if len(fresh) == len(counted) else messages.where(number.isin(fresh))
        rows = rows.select(
            *self.key, group.alias("__g"), F.coalesce(order.cast("long"), F.lit(LATEST)).alias("__at"), (F.hash(*hashed) if hashed else F.lit(0)).alias("__tie"), F.struct(*rest).alias("body")
        )
        mine = [F.col("__g") == g for g in range(groups)]
        row = F.struct("__at", "__tie", "body")
        first = (lambda m: F.min(F.when(m, row))) if len(hashed) == len(rest) else (lambda m: F.min_by(row, F.when(m, F.struct("__at", "__tie"))))
        folded = rows.groupBy(*self.key).agg(*(F.count_if(m).alias(f"n{g}") for g, m in enumerate(mine)), *(first(m).alias(f"r{g}") for g, m in enumerate(mine)))
        each = F.array(*(F.struct(F.lit(g).alias("run"), F.col(f"n{g}").alias("copies"), F.col(f"r{g}").alias("r")) for g in range(groups)))
        one = folded.select(*self.key, F.explode(F.filter(each, lambda x: x["copies"] > 0)).alias("e"))
        stored = one.select(F.xxhash64(*self.key).alias("__h"), *self.key, "e.copies", "e.r.__at", "e.r.__tie", "e.r.body", "e.run", F.pmod(F.hash(*self.key), F.lit(self.buckets)).alias("bucket"))
        self.schema = stored.drop("run", "bucket").schema.json()
        name = f"runs/{uuid.uuid4().hex}"
        stored.sortWithinPartitions("run", "bucket", "__h", *self.key).write.partitionBy("run", "bucket").option("compression", "zstd").parquet(f"{self.path}/{name}")
        self.runs += [f"{name}/run={g}" for g in range(groups)]
        self.rows += sum(counted[b] for b in fresh)
        self.batches |= set(fresh)
        self._commit()
        return len(fresh)

    def merged(self) -> DataFrame:
        """All runs and the base merged, each identifier once; partition k of the result is bucket k, in order."""
        if self.schema is None:
            raise ValueError("the store is empty")
        schema = T.StructType.fromJson(json.loads(self.schema))
        arrow, key, path, runs = to_arrow_schema(schema), self.key, self.path, self.runs
        places: dict[int, list[str]] = {}
        if self.base:
            for f in data_files(f"{path}/{self.base}"):
                places.setdefault(int(re.match(r"part-(\d+)", f.rsplit("/", 1)[1])[1]), []).append(f)
        shared = self.spark.sparkContext.broadcast(places)  # a file name per bucket

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for bucket in batch.column(0).to_pylist():
                    files = shared.value.get(bucket, []) + [f for r in runs for f in data_files(f"{path}/{r}/bucket={bucket}")]
                    for table in merge_files(files, key, arrow):
                        yield from table.to_batches()

        return self.spark.range(0, self.buckets, 1, self.buckets).mapInArrow(run, schema)

    def compact(self) -> DataFrame:
        """Merge everything into a new base with each identifier once, and return it.

        Only when the buckets have outgrown their size the merged rows are shuffled into
        more of them.
        """
        rows, name = self.merged(), f"base/{uuid.uuid4().hex}"
        if self.rows > 2 * BUCKET_ROWS * self.buckets:
            self.buckets *= -(-self.rows // (BUCKET_ROWS * self.buckets))
            rows = rows.repartition(self.buckets, *self.key).sortWithinPartitions("__h", *self.key)
        rows.write.option("compression", "zstd").parquet(f"{self.path}/{name}")
        self.base, self.runs = name, []
        self._commit()
        return self.read()

    def read(self) -> DataFrame:
        """The base: what the last compaction made."""
        rows = self.spark.read.schema(T.StructType.fromJson(json.loads(self.schema))).parquet(f"{self.path}/{self.base}")
        return rows.select(*self.key, "copies", "body")

    def vacuum(self) -> int:
        """Delete runs and bases that the newest manifest doesn't name, leftovers of failed jobs included; returns how many."""
        live = {*(r.rsplit("/", 1)[0] for r in self.runs), self.base}
        old = [f"{kind}/{n}" for kind in ("runs", "base") for n in list_names(self.spark, f"{self.path}/{kind}") if f"{kind}/{n}" not in live]
        for name in old:
            remove(self.spark, f"{self.path}/{name}")
        return len(old)


def plain_name(column: str) -> Column:
    """A package name as the registry writes it, from padded and percent-encoded spellings; null becomes ''."""
    trimmed = F.regexp_replace(F.coalesce(F.col(column), F.lit("")), r"^\s+|\s+$", "")
    return F.regexp_replace(F.regexp_replace(trimmed, "(?i)%2f", "/"), "%40", "@")


def plain_run(column: str) -> Column:
    """A run id as 2026-03-02T07-15-09Z, from ISO spellings with colons, fractions, lower case or padding."""
    trimmed = F.upper(F.regexp_replace(F.coalesce(F.col(column), F.lit("")), r"^\s+|\s+$", ""))
    return F.regexp_replace(trimmed, r"^(\d{4}-\d{2}-\d{2})[T ](\d{2})[:-](\d{2})[:-](\d{2})(?:[.,]\d+)?(?:Z|\+00:?00)?$", "$1T$2-$3-$4Z")


def plain_messages(observations: DataFrame) -> DataFrame:
    """Deliveries with the identifier (name, run_id, rev) in plain form; the row as it came is in ``given``, other spellings in ``spelled``.

    Null and empty ``rev`` are one identifier, as are all spellings of a name or run; a
    null name or run is ''.
    """
    plain = {"name": plain_name("name"), "run_id": plain_run("run_id"), "rev": F.coalesce("rev", F.lit(""))}
    return observations.select(
        *(c.alias(n) for n, c in plain.items()),
        F.col("delivered_at"),
        F.struct(*(F.col(c).alias(c) for c in observations.columns if c not in {*plain, "delivered_at"})).alias("given"),
        F.struct(*(F.when(F.col(n) != c, F.col(n)).alias(n) for n, c in plain.items())).alias("spelled"),
    )


def collapse_deliveries(observations: DataFrame, path: str, groups: int = GROUPS) -> DataFrame:
    """Exactly one row per message (name, run_id, rev), with the number of its deliveries and the first one's columns.

    The batches are upserted as ``groups`` sorted runs, and a compaction merges these. An
    empty table gives no rows. The other columns, whatever their names, are in
    ``body.given``.
    """
    store = MessageStore(observations.sparkSession, path, ["name", "run_id", "rev"])
    rows = plain_messages(observations)
    if not store.upsert(rows, F.col("given.batch_id"), F.unix_micros(F.col("delivered_at").cast("timestamp")), groups) and store.schema is None:
        body = F.struct(*(F.col(c) for c in rows.columns if c not in store.key))
        return rows.limit(0).select(*store.key, F.lit(0).cast("long").alias("copies"), body.alias("body"))
    rows = store.compact()
    store.vacuum()
    return rows
