"""Storage accounting: bytes by prefix, the tier they put the archive in, and counters that start anew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registry_lens.config import CONFIG, Config
from registry_lens.functions.scalars import run_mode, tier


def usage_by_prefix(listing: DataFrame) -> DataFrame:
    """Objects and bytes by top prefix, and their total in the row with a null prefix."""
    return listing.rollup(F.substring_index("key", "/", 1).alias("prefix")).agg(F.count("*").alias("objects"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


def tiers(usage: DataFrame, used: str, ceiling: float | None = None, config: Config = CONFIG) -> DataFrame:
    return usage.withColumn("tier", tier(F.col(used), ceiling or config.storage_free_bytes, config.soft_fraction, config.hard_fraction))


def modes(rows: DataFrame, queued: str, config: Config = CONFIG) -> DataFrame:
    """Run mode by tier and queue length."""
    return rows.withColumn("mode", run_mode(F.col("tier"), F.col(queued), config.backlog_threshold, config.triage_threshold))


def monthly(rows: DataFrame, at: str, amount: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Sums that start anew with each month."""
    return rows.groupBy(*keys, F.date_format(at, "yyyy-MM").alias("month")).agg(F.sum(amount).alias("total"))


def drift_since(rows: DataFrame, at: str, amount: str, anchor: Column) -> Column:
    """Amount added after an anchor, as an aggregate."""
    return F.coalesce(F.sum(F.when(F.col(at) > anchor, F.col(amount))), F.lit(0))


def running_month(rows: DataFrame, at: str, amount: str, key: str) -> DataFrame:
    """The counter as it stood after each row: a running sum within key and month."""
    order = Window.partitionBy(key, F.date_format(at, "yyyy-MM")).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("so_far", F.sum(amount).over(order))


def parse_ceiling(text: str | None, config: Config = CONFIG) -> float:
    """A positive number of bytes, or the free allowance."""
    if text is None or not text.strip():
        return float(config.storage_free_bytes)
    value = float(text)
    if not value > 0 or value == float("inf"):
        raise ValueError("the ceiling must be a positive number")
    return value


def human_bytes(n: float) -> str:
    """Decimal units with one digit."""
    for unit in ("B", "kB", "MB", "GB"):
        if abs(n) < 1000:
            return f"{n:.0f} {unit}" if unit == "B" else f"{n:.1f} {unit}"
        n /= 1000
    return f"{n:.1f} TB"
