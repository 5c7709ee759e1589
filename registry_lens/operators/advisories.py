"""External advisories: which packages and versions they name, kept by replace and by set, joined at query time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry_lens.operators.index import keep_last

AFFECTED = "array<struct<package:struct<ecosystem:string,name:string>,versions:array<string>,ranges:array<variant>>>"


def affected_pairs(records: DataFrame, ecosystem: str = "npm") -> DataFrame:
    """(osv_id, name, version, basis) of each package of the ecosystem.

    Listed versions give a row each (basis explicit); without any there is one row with a
    null version, basis range if ranges are given, else unknown. Distinct, nulls being
    equal; unreadable records give none.
    """
    doc = records.select("id", F.try_parse_json("raw").alias("doc"))
    rows = doc.select("id", F.explode(F.try_variant_get("doc", "$.affected", "array<variant>")).alias("a")).select(
        "id",
        F.try_variant_get("a", "$.package.ecosystem", "string").alias("ecosystem"),
        F.when(F.schema_of_variant(F.try_variant_get("a", "$.package.name", "variant")) == "STRING", F.try_variant_get("a", "$.package.name", "string")).alias("name"),
        F.try_variant_get("a", "$.versions", "array<string>").alias("versions"),
        F.coalesce(F.size(F.try_variant_get("a", "$.ranges", "array<variant>")), F.lit(0)).alias("ranges"),
    )
    named = rows.where((F.col("ecosystem") == ecosystem) & F.col("name").isNotNull())
    listed = F.coalesce(F.size("versions") > 0, F.lit(False))
    basis = F.when(listed, "explicit").when(F.col("ranges") > 0, "range").otherwise("unknown")
    return named.select(F.col("id").alias("osv_id"), "name", basis.alias("basis"), F.explode_outer(F.when(listed, F.col("versions"))).alias("version")).distinct()


def latest_records(records: DataFrame) -> DataFrame:
    """Of each id the record modified last, with the flag of malicious ones from their id."""
    last = keep_last(records.where("id is not null"), ["id"], ["modified", "published", "summary", "raw"])
    return last.withColumn("is_malicious", F.col("id").startswith("MAL-"))


def affects(records: DataFrame, pairs: DataFrame) -> DataFrame:
    """Distinct (id, name, summary, modified, is_malicious) of records and what they affect."""
    return records.join(pairs, records["id"] == pairs["osv_id"]).select("id", "name", "summary", "modified", "is_malicious").distinct()


def advisories_for(records: DataFrame, pairs: DataFrame, names: DataFrame) -> DataFrame:
    """Advisories of the given packages, malicious ones first, newest first."""
    wanted = pairs.join(names.select("name").distinct(), "name", "left_semi")
    return affects(records, wanted).orderBy(F.col("is_malicious").desc(), F.col("modified").desc(), "id", "name")


def delta(listing: DataFrame, watermark: str, most: int | None = None) -> DataFrame:
    """Changed ids after the watermark, oldest first, so that a capped run still makes progress."""
    rows = listing.where(F.col("modified") > watermark).orderBy("modified", "id")
    return rows if most is None else rows.limit(most)


def next_watermark(landed: DataFrame, wanted: DataFrame, watermark: str) -> str:
    """Up to where every wanted id has landed."""
    missing = wanted.join(landed.select("id").distinct(), "id", "left_anti").agg(F.min("modified")).first()[0]
    done = wanted if missing is None else wanted.where(F.col("modified") < missing)
    return done.agg(F.max("modified")).first()[0] or watermark
