"""Feed rows before they are fetched: union and dedupe of queues, sanity of sequence numbers, counters of a run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registry_lens.config import CONFIG, Config
from registry_lens.operators.index import newest_per_key


def work_queue(*queues: DataFrame) -> DataFrame:
    """Recovered, deferred and drained rows as one queue: the newest row per package, highest sequence first."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), queues)
    return newest_per_key(rows).orderBy(F.col("seq").desc(), "id")


def sequence_ratio(feed: DataFrame, config: Config = CONFIG) -> DataFrame:
    """(rows, span, ratio, suspicious): sequence numbers per row, out of bounds only when there are more than 100 rows."""
    one = feed.agg(F.count("*").alias("n_rows"), (F.max("seq") - F.min("seq")).alias("span"))
    ratio = F.col("span") / F.nullif(F.col("n_rows"), F.lit(0))
    out = (F.col("n_rows") > 100) & ~ratio.between(config.feed_seq_per_row_min, config.feed_seq_per_row_max)
    return one.withColumn("ratio", ratio).withColumn("suspicious", F.coalesce(out, F.lit(False)))


def pages(feed: DataFrame, config: Config = CONFIG) -> DataFrame:
    """Rows, first and last sequence of each page, a page being a range of sequence numbers."""
    return feed.groupBy(F.floor(F.col("seq") / config.feed_page_limit).alias("page")).agg(F.count("*").alias("n_rows"), F.min("seq").alias("since"), F.max("seq").alias("last"))


def window_rows(feed: DataFrame, since: int, last: int) -> DataFrame:
    """The rows of a fixed range of the feed: after ``since`` up to ``last``; pushed down to the scan."""
    return feed.where((F.col("seq") > since) & (F.col("seq") <= last))


def max_seq_of_keys(keys: DataFrame, key: str = "key") -> DataFrame:
    """Highest number that ends a key's name."""
    return keys.agg(F.max(F.nullif(F.regexp_extract(key, r"(\d+)\D*$", 1), F.lit("")).try_cast("long")).alias("max_seq"))


def run_summary(observations: DataFrame, run: str = "run_id") -> DataFrame:
    """Counters of each run: rows, outcomes, true totals of withdrawn versions, deaths, truncated rows."""
    of: dict[str, Column] = {o: F.count_if(F.col("outcome") == o) for o in ("ok", "tombstone", "gone", "error", "too_large")}
    return observations.groupBy(run).agg(
        F.count("*").alias("n_rows"), *(c.alias(o) for o, c in of.items()), F.coalesce(F.sum("missing_count"), F.lit(0)).alias("yanks"), F.count_if(F.col("truncated") == 1).alias("truncated_rows")
    )
