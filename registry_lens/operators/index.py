"""Folds of the archive into index tables: which row of a key wins, and package rows from observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Of each key (nulls are a key of their own) the last row in the given order."""
    return _keep(df, keys, [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Of each key the first row in the given order."""
    return _keep(df, keys, [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order])


def _keep(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    # a window with rank 1 only: Spark limits each key within the task before the shuffle
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__nth", nth).where("__nth = 1").drop("__nth")


def newest_per_key(feed: DataFrame, key: str = "id", seq: str = "seq", arrival: str = "arrived_at") -> DataFrame:
    """The feed row of the highest sequence per key; of equal ones the first to arrive."""
    return _keep(feed, [key], [F.col(seq).desc_nulls_last(), F.col(arrival).asc_nulls_last()])


def last_known(value: str, order: Column) -> Column:
    """Last non-null value in an order; an aggregate that combines before the shuffle."""
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), order))


def fold_packages(obs: DataFrame) -> DataFrame:
    """One row per package: first and last sighting, last known attributes, count of distinct runs, whether it ever died.

    ``is_dead`` and ``unpublished_at`` stay once set; ``currently_dead`` is that of the last
    readable observation.
    """
    order = F.struct("fetchedAt", "run", "seq")
    return obs.where("name is not null").groupBy("name").agg(
        F.min("fetchedAt").alias("first_seen"),
        F.max("fetchedAt").alias("last_seen"),
        last_known("created", order).alias("created"),
        F.max_by(F.try_element_at("distTags", F.lit("latest")), F.when(F.try_element_at("distTags", F.lit("latest")).isNotNull(), order)).alias("latest_version"),
        last_known("versionCount", order).alias("version_count"),
        F.count_distinct("run").alias("observations"),
        F.max(F.coalesce(F.col("tombstone"), F.lit(False)).cast("int")).alias("is_dead"),
        last_known("unpublishedAt", order).alias("unpublished_at"),
        last_known("securityHolder", order).alias("security_holder"),
        last_known("maintainers", order).alias("maintainers"),
        F.max_by("flags", order).alias("flags"),
        F.max_by("tombstone", F.when(F.col("outcome").isin("ok", "tombstone"), order)).alias("currently_dead"),
    )


def build_meta(built_at: str, observations: DataFrame, events: DataFrame, popular: int) -> DataFrame:
    """Key and value rows about a build."""
    spark = observations.sparkSession
    counts = observations.agg(F.count("*").cast("string").alias("observations")).crossJoin(events.agg(F.count("*").cast("string").alias("events")))  # one row each
    fixed = spark.createDataFrame([(built_at, str(popular))], "builtAt string, popularListSize string")
    wide = counts.crossJoin(fixed)
    return wide.select(F.explode(F.create_map(*(x for c in wide.columns for x in (F.lit(c), F.col(c))))).alias("key", "value"))
