"""History of changing entity attributes by affected-chain rebuild.

A *chain* is the complete, ordered list of versions of one entity. The store keeps the raw
changes and the chains, both in hash buckets of the entity. A batch of late or corrected
changes never edits intervals in place: the entities it touches are listed, only their raw
changes are fetched again, all their intervals are rebuilt, and one rename of a manifest
file puts the new chains in place of the old ones.

Layout below the store's path::

    raw/gen=G/bucket=B/       raw changes as delivered
    chains/gen=G/bucket=B/    complete chains of the entities that generation G touched
    touched/gen=G/            those entities
    manifest/V.json           the committed generations; the newest one is the table

A generation's name is unique to the writer, so two writers never touch each other's files;
the manifest takes one of them and refuses the other.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry_lens.session import buckets_for, list_names, read_text, remove, write_text_once

#: Generations after which an update compacts them into one.
MOST_GENERATIONS = 16


@dataclass(frozen=True)
class Tracked:
    """An attribute under history; ``value`` is null where a change tells nothing about it."""

    name: str
    value: Column


def login_list(column: str) -> Column:
    """The logins of a JSON list as a sorted set; null where the text is null or no list."""
    parsed = F.from_json(F.col(column), "array<string>")
    return F.array_sort(F.array_distinct(F.filter(parsed, lambda x: x.isNotNull())))


def normalise(changes: DataFrame, entity: str, period: str, arrived: str, tracked: Sequence[Tracked]) -> DataFrame:
    """Raw changes in the store's own columns; rows without entity or period belong to no chain and are left out."""
    return changes.select(
        F.col(entity).alias("entity"),
        F.col(period).alias("period"),
        F.col(arrived).alias("arrived"),
        F.struct(*(t.value.alias(t.name) for t in tracked)).alias("attrs"),
    ).where("entity is not null and period is not null")


def build_chains(raw: DataFrame) -> DataFrame:
    """Chains of all entities in ``raw`` (entity, period, arrived, attrs).

    Of several changes of an entity and period the one that arrived last counts; the
    attributes break a tie, so the result never depends on row order. That reduction
    combines before the shuffle, so an entity holding a third of all rows reaches the
    window as one row per period.
    """
    names = raw.schema["attrs"].dataType.names
    latest = raw.groupBy("entity", "period").agg(F.max(F.struct("arrived", "attrs")).alias("m"))
    order = Window.partitionBy("entity").orderBy("period")
    known = latest.select(
        "entity", "period", *(F.last(f"m.attrs.{n}", ignorenulls=True).over(order).alias(n) for n in names)
    )
    before = known.select("*", F.lag(F.struct(*names)).over(order).alias("prev"), F.row_number().over(order).alias("nth"))
    differs = reduce(lambda a, b: a | b, (~F.col(n).eqNullSafe(F.col(f"prev.{n}")) for n in names))
    starts = before.where((F.col("nth") == 1) | differs)
    return starts.select(
        "entity",
        F.col("period").alias("valid_from"),
        F.lead("period").over(order).alias("valid_to"),
        F.row_number().over(order).alias("version_no"),
        *names,
    )


class ChainStore:
    """Versioned chains with atomic replacement; see the module text for the layout."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        seen = self._manifest()
        self.buckets = seen.get("buckets") or buckets or buckets_for(spark)
        self.schemas: dict[str, str] = seen.get("schemas", {})

    def _manifest(self) -> dict:
        names = [n for n in list_names(self.spark, f"{self.path}/manifest") if n.endswith(".json")]
        return json.loads(read_text(self.spark, f"{self.path}/manifest/{names[-1]}")) if names else {"version": 0, "generations": []}

    def _part(self, kind: str, gen: str) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.schemas[kind]))
        return self.spark.read.schema(schema).parquet(f"{self.path}/{kind}/gen={gen}")

    def _write(self, df: DataFrame, kind: str, gen: str) -> None:
        self.schemas[kind] = df.schema.json()
        df.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{kind}/gen={gen}")

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64("entity"), F.lit(self.buckets)).cast("int"))

    def _spread(self, df: DataFrame) -> DataFrame:
        """One shuffle so that few files are written; a hot bucket is split by AQE."""
        return df.hint("rebalance", F.col("bucket"))

    def apply(self, changes: DataFrame) -> int:
        """Add a batch of normalised changes and replace the chains it touches; returns the new version.

        A crash before the manifest is written leaves the table as it was. Raw changes of
        earlier generations are read only in the buckets that the batch touches.
        """
        seen = self._manifest()
        earlier, gen = seen["generations"], uuid.uuid4().hex
        self._write(self._spread(self._bucketed(changes)), "raw", gen)
        fresh = self._part("raw", gen)
        touched = fresh.select("bucket", "entity").distinct()
        if earlier:
            self._write(touched, "touched", gen)
            touched = self._part("touched", gen)
            buckets = sorted(r[0] for r in touched.select("bucket").distinct().collect())  # at most the number of buckets
            history = reduce(DataFrame.unionByName, (self._part("raw", g).where(F.col("bucket").isin(buckets)) for g in earlier)).join(touched, ["bucket", "entity"], "left_semi")
            fresh = history.unionByName(fresh)
        self._write(self._spread(self._bucketed(build_chains(fresh.drop("bucket")))), "chains", gen)
        version = self._commit(seen, [*earlier, gen])
        return self.compact() if len(earlier) + 1 > MOST_GENERATIONS else version

    def _commit(self, seen: dict, generations: list[str]) -> int:
        version = seen["version"] + 1
        entry = {"version": version, "buckets": self.buckets, "schemas": self.schemas, "generations": generations}
        write_text_once(self.spark, f"{self.path}/manifest/{version:010d}.json", json.dumps(entry))
        return version

    def compact(self) -> int:
        """Rewrite all generations as one, with the same raw changes and chains; returns the new version."""
        seen = self._manifest()
        if len(seen["generations"]) < 2:
            return seen["version"]
        gen = uuid.uuid4().hex
        self._write(self._spread(reduce(DataFrame.unionByName, (self._part("raw", g) for g in seen["generations"]))), "raw", gen)
        self._write(self._spread(self._bucketed(self.read())), "chains", gen)
        return self._commit(seen, [gen])

    def vacuum(self) -> int:
        """Delete generations that the newest manifest doesn't name, leftovers of failed writers included; returns how many folders."""
        live, gone = {f"gen={g}" for g in self._manifest()["generations"]}, 0
        for kind in ("raw", "chains", "touched"):
            for name in list_names(self.spark, f"{self.path}/{kind}"):
                if name not in live:
                    remove(self.spark, f"{self.path}/{kind}/{name}")
                    gone += 1
        return gone

    def read(self) -> DataFrame:
        """The current chains: of each entity those of the newest generation that touched it."""
        gens = self._manifest()["generations"]
        if not gens:
            raise ValueError("the store is empty")
        tagged = reduce(DataFrame.unionByName, (self._part("chains", g).withColumn("gen", F.lit(n)) for n, g in enumerate(gens)))
        if len(gens) == 1:
            return tagged.drop("gen", "bucket")
        newest = (
            reduce(DataFrame.unionByName, (self._part("touched", g).withColumn("newest", F.lit(n)) for n, g in enumerate(gens) if n))
            .groupBy("bucket", "entity")
            .agg(F.max("newest").alias("newest"))
        )
        return (
            tagged.join(newest, ["bucket", "entity"], "left")
            .where(F.col("gen") == F.coalesce("newest", F.lit(0)))
            .drop("gen", "newest", "bucket")
        )


def attribute_history(
    changes: DataFrame,
    path: str,
    entity: str,
    period: str,
    arrived: str,
    tracked: Sequence[Tracked],
    on_time_days: int = 2,
) -> DataFrame:
    """Load what arrived within ``on_time_days`` of its period, then apply the late and corrected rest as one update.

    Result: entity, valid_from, valid_to (the first period of the next version, null for
    the current one), version_no and the attributes. An empty input gives an empty result;
    columns of ``changes`` that are not named are ignored.
    """
    spark = changes.sparkSession
    rows = normalise(changes, entity, period, arrived, tracked)
    late = F.coalesce(F.col("arrived") >= F.date_add(F.col("period").try_cast("date"), on_time_days), F.lit(True))
    store = ChainStore(spark, path)
    store.apply(rows.where(~late))
    store.apply(rows.where(late))
    return store.read()
