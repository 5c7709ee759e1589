"""Hash-chained run manifests: stored bytes to ledger lines, anomalies by joins, and verification."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = (
    "runId string, prevRunId string, prevManifestSha256 string, sinceSeq bigint, lastSeq bigint, mode string, "
    "feedBlob struct<sha256:string,bytes:bigint>, obsShards array<struct<key:string,rows:bigint,bytes:bigint>>, retained array<struct<key:string,bytes:bigint>>, bytes bigint"
)
ANOMALY = "kind string, run_id string, parent string, sibling string"
#: The one kind that is no defect.
CHAIN_START = "chain-start"


def canonical(manifest: dict) -> bytes:
    """A manifest's bytes: JSON in the order of its fields, two blanks, one line end."""
    return (json.dumps(manifest, indent=2, ensure_ascii=False) + "\n").encode()


def is_canonical(data: bytes) -> bool:
    try:
        return canonical(json.loads(data)) == data
    except ValueError:
        return False


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Manifests below a path with the digest of their stored bytes; older ones lack arrays, which count as empty."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.from_json(F.decode("content", "UTF-8"), MANIFEST).alias("m")).select("path", "sha256", "m.*")


def run_lines(manifests: DataFrame) -> DataFrame:
    """One ledger line per run."""
    count = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    return manifests.select(
        F.col("runId").alias("run_id"), "sha256", F.col("prevManifestSha256").alias("prev"), F.col("prevRunId").alias("prev_run_id"), F.col("sinceSeq").alias("since_seq"), F.col("lastSeq").alias("last_seq"),
        "mode", F.col("feedBlob.sha256").alias("feed"), (1 + count("obsShards") + count("retained")).alias("objects"), F.coalesce("bytes", F.lit(0)).alias("bytes"),
    )


def anomalies(lines: DataFrame) -> DataFrame:
    """(kind, run_id, parent, sibling) of run lines: chain starts, forks, missing parents, edited parents.

    Two runs with one parent are a fork; it is suspicious when their sequence windows don't
    touch, as no crash leaves such a pair. Siblings meet in an equi-join on the parent's
    digest. A parent's absence counts only when the parent's day is among the lines.
    """
    runs = lines.select("run_id", "sha256", "prev", "prev_run_id", "since_seq", "last_seq")
    starts = runs.where("prev is null").select(F.lit(CHAIN_START).alias("kind"), "run_id", "prev", F.lit(None).cast("string").alias("sibling"))
    chained = runs.where("prev is not null")
    other = chained.select("prev", F.col("run_id").alias("sibling"), F.col("since_seq").alias("s"), F.col("last_seq").alias("l"))
    touch = (F.col("since_seq") <= F.col("l")) & (F.col("s") <= F.col("last_seq"))
    forks = chained.join(other, "prev").where("run_id <> sibling").select(F.when(touch, "fork").otherwise("fork-suspicious").alias("kind"), "run_id", "prev", "sibling")
    parents = runs.select(F.col("run_id").alias("prev_run_id"), F.col("sha256").alias("parent_sha"))
    days = runs.select(F.substring("run_id", 1, 10).alias("parent_day")).distinct()
    claims = chained.where("prev_run_id is not null").join(parents, "prev_run_id", "left").withColumn("parent_day", F.substring("prev_run_id", 1, 10)).join(days, "parent_day", "left_semi")
    kind = F.when(F.col("parent_sha").isNull(), "missing-parent").when(F.col("parent_sha") != F.col("prev"), "hash-mismatch")
    broken = claims.select(kind.alias("kind"), "run_id", "prev", F.col("prev_run_id").alias("sibling")).where("kind is not null")
    return starts.unionByName(forks).unionByName(broken).withColumnRenamed("prev", "parent").distinct()


def report(lines: DataFrame) -> DataFrame:
    """One row: runs, anomalies, defects."""
    found = anomalies(lines).agg(F.count("*").alias("anomalies"), F.count_if(F.col("kind") != CHAIN_START).alias("defects"))
    return lines.agg(F.count_distinct("run_id").alias("runs")).crossJoin(found)  # one row each


def uncommitted(stored: DataFrame, committed: DataFrame) -> DataFrame:
    """Stored manifests whose digest the committed ledger doesn't have."""
    return stored.join(committed.select("sha256").distinct(), "sha256", "left_anti")


def format_day(lines: DataFrame, day: str) -> str:
    """A day's ledger file: header, runs and anomalies in order; a day has few runs."""
    rows = lines.where(F.col("run_id").startswith(day))
    runs = [{"k": "run", **r.asDict()} for r in rows.orderBy("run_id").collect()]
    odd = [{"k": "anomaly", **r.asDict()} for r in anomalies(lines).where(F.col("run_id").startswith(day)).orderBy("run_id", "kind", "sibling").collect()]
    return "".join(json.dumps(x, ensure_ascii=False) + "\n" for x in [{"k": "ledgerhdr", "schema": 1, "day": day, "runs": len(runs)}, *runs, *odd])


def parse_ledger(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Run lines of committed ledger files, from a day on."""
    schema = "k string, run_id string, sha256 string, prev string, prev_run_id string, since_seq bigint, last_seq bigint, mode string, feed string, objects bigint, bytes bigint"
    rows = spark.read.schema(schema).json(path).where("k = 'run'").drop("k")
    return rows if since is None else rows.where(F.substring("run_id", 1, 10) >= since)
