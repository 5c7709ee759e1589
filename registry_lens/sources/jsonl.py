"""The archive as gzip JSON lines: readers that keep the archive's order, writers that can't be called without a guard."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registry_lens.config import CONFIG, Config
from registry_lens.functions.documents import is_kind
from registry_lens.functions.privacy import redact, redact_json
from registry_lens.session import hadoop_fs, list_names, read_text, remove, write_text_once

Guard = Callable[[DataFrame], DataFrame]

GAP = "k string, kind string, run string, name string, seq bigint, rev string, status int, detail string, at string"
FEED = "k string, seq bigint, id string, changes array<struct<rev:string>>, deleted boolean, since bigint, lastSeq bigint, atHead boolean"


def no_guard(df: DataFrame) -> DataFrame:
    """The explicit way to write without a check."""
    return df


def read_lines(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """(key, line_no, line) of all files below a path in archive order, blank lines dropped.

    A shard is bounded in size, so it is read whole and split, which gives its line
    numbers. ``since`` prunes by file name; take it only where no earlier baseline is needed.
    """
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).withColumn("key", F.col("_metadata.file_path"))
    if since is not None:
        files = files.where(F.col("_metadata.file_name") >= since)
    lines = files.select("key", F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    return lines.where(F.trim("line") != "")


def _pairs(doc: Column, path: str) -> Column:
    """[["1.0.0", 17], ...] as an array of structs; entries of another shape are dropped."""
    items = F.when(is_kind(doc, path, "ARRAY"), F.try_variant_get(doc, path, "array<variant>"))
    pairs = F.transform(items, lambda x: F.struct(F.try_variant_get(x, "$[0]", "string").alias("v"), F.try_variant_get(x, "$[1]", "bigint").alias("t")))
    return F.filter(pairs, lambda x: x["v"].isNotNull())


#: Details of a recent version: the archive's names and types, and the columns they become.
DETAILS = (
    ("v", "string", "v"), ("t", "bigint", "t"), ("by", "string", "by"), ("installScripts", "array<string>", "install_scripts"), ("deps", "int", "deps"), ("integrity", "string", "integrity"), ("shasum", "string", "shasum"),
    ("unpackedSize", "bigint", "unpacked_size"), ("fileCount", "bigint", "file_count"), ("license", "string", "license"), ("repoHost", "string", "repo_host"), ("deprecated", "string", "deprecated"),
)


def _details(doc: Column) -> Column:
    items = F.when(is_kind(doc, "$.recent", "ARRAY"), F.try_variant_get(doc, "$.recent", "array<variant>"))
    rows = F.transform(items, lambda x: F.struct(*(F.try_variant_get(x, f"$.{name}", kind).alias(column) for name, kind, column in DETAILS)))
    return F.filter(rows, lambda r: r["v"].isNotNull())


def archive_details(recent: Column) -> Column:
    """Details of recent versions under the archive's names."""
    return F.transform(recent, lambda r: F.struct(*(r[column].alias(name) for name, _, column in DETAILS)))


def read_observations(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Observation rows in archive order; unreadable lines and other kinds are dropped, missing fields are null."""
    doc = F.col("doc")
    rows = read_lines(spark, path, since).withColumn("doc", F.try_parse_json("line")).where(F.try_variant_get(doc, "$.k", "string") == "obs")
    get = lambda name, kind: F.try_variant_get(doc, f"$.{name}", kind).alias(name)
    return rows.select(
        "key", "line_no", get("run", "string"), get("name", "string"), get("seq", "bigint"), get("rev", "string"), get("revInt", "bigint"), get("feedDeleted", "boolean"), get("fetchedAt", "string"), get("status", "int"), get("outcome", "string"), get("bytes", "bigint"),
        get("created", "bigint"), get("modified", "bigint"), get("distTags", "map<string,string>"), get("maintainers", "array<string>"), get("maintainerHashes", "array<string>"), get("versionCount", "int"), _pairs(doc, "$.times").alias("times"), _pairs(doc, "$.missing").alias("missing"),
        get("missingCount", "int"), get("truncated", "boolean"), get("tombstone", "boolean"), get("unpublishedAt", "bigint"), get("unpublishedBy", "string"), get("unpublishedVersions", "array<string>"),
        get("securityHolder", "string"), get("isNew", "boolean"), get("packumentKey", "string"), get("flags", "array<string>"), _details(doc).alias("recent"),
    )


def read_gaps(spark: SparkSession, path: str) -> DataFrame:
    return read_lines(spark, path).select("key", "line_no", F.from_json("line", GAP).alias("g")).select("key", "line_no", "g.*").where("k = 'gap'")


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Rows of archived feed blobs, without their header rows."""
    rows = read_lines(spark, path).select("key", "line_no", F.from_json("line", FEED).alias("f")).select("key", "line_no", "f.*")
    return rows.where("k is null or k <> 'feedhdr'").select("key", "line_no", "seq", "id", "changes", F.coalesce("deleted", F.lit(False)).alias("deleted"))


def read_advisories(spark: SparkSession, path: str, salt: str) -> DataFrame:
    """Advisory records, redacted; the record itself stays as JSON text in ``raw``."""
    rows = read_lines(spark, path).select("key", "line_no", F.from_json("line", "id string, modified string, published string, summary string").alias("r"), F.col("line").alias("raw"))
    flat = rows.select("key", "line_no", "r.*", redact_json("raw", salt).alias("raw"))
    return flat.withColumns({c: redact(c, salt) for c in ("id", "summary")})


def read_documents(spark: SparkSession, sharded: str, legacy: str | None = None) -> DataFrame:
    """Retained documents from both layouts; ``layout`` tells which one a row came from."""
    of = lambda path, layout: read_lines(spark, path).select(F.lit(layout).alias("layout"), F.get_json_object("line", "$.name").alias("name"), F.get_json_object("line", "$.run").alias("run"), F.get_json_object("line", "$.doc").alias("raw"))
    rows = of(sharded, "sharded")
    return rows if legacy is None else rows.unionByName(of(legacy, "legacy"))


def read_popular(spark: SparkSession, path: str) -> DataFrame:
    """(target, rank) of a ranked list ``{"names": [...]}``."""
    names = spark.read.text(path, wholetext=True).select(F.from_json("value", "names array<string>").alias("j"))
    return names.select(F.posexplode("j.names").alias("pos", "target")).select("target", (F.col("pos") + 1).alias("rank"))


def read_delta(spark: SparkSession, path: str, watermark: str) -> DataFrame:
    """(modified, id) lines after a watermark of a headless listing; a last line without its end is cut off and dropped.

    The listing comes as files of bounded size, each read whole.
    """
    lines = spark.read.text(path, wholetext=True).select(F.split("value", "\n").alias("l")).select(F.explode(F.slice("l", 1, F.greatest(F.size("l") - 1, F.lit(0)))).alias("line"))
    parts = lines.select(F.split(F.regexp_replace("line", "\r$", ""), ",", 2).alias("p")).select(F.get("p", 0).alias("modified"), F.get("p", 1).alias("id"))
    return parts.where((F.col("id") != "") & F.col("modified").rlike(r"^\d{4}-\d{2}-\d{2}T") & (F.col("modified") > watermark))


def write_jsonl(df: DataFrame, path: str, guard: Guard, config: Config = CONFIG, mode: str = "errorifexists") -> None:
    """Guarded gzip JSON lines; nulls are written. A shard is closed by ``shard_max_rows`` rows or ``shard_max_bytes`` bytes, whatever comes first."""
    rows, limit = config.shard_max_rows, config.shard_max_bytes

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, count, size = uuid.uuid4().hex[:12], 0, 0
        n = 0
        for batch in batches:
            names = []
            for length in pc.binary_length(batch.column(0)).to_pylist():
                if count and (count >= rows or size + length + 1 > limit):
                    n, count, size = n + 1, 0, 0
                count, size = count + 1, size + length + 1
                names.append(f"{shard}-{n:05d}")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, type=pa.string())], names=["value", "shard"])

    guarded = guard(df)
    lines = guarded.select(F.to_json(F.struct(*guarded.columns), {"ignoreNullFields": "false"}).alias("value"))
    lines.mapInArrow(assign, "value string, shard string").write.mode(mode).partitionBy("shard").option("compression", "gzip").text(path)


def write_once(df: DataFrame, path: str, guard: Guard) -> bool:
    """Write only when the path does not exist; False when it does."""
    fs, p, _ = hadoop_fs(df.sparkSession, path)
    if fs.exists(p):
        return False
    write_jsonl(df, path, guard)
    return True


QUEUE = "seq bigint, id string, changes array<struct<rev:string>>, deleted boolean, arrived_at timestamp"


def write_queue(df: DataFrame, path: str) -> None:
    """The deferred queue, always replaced, also by an empty one: written beside the old rows, then a small file names the new ones.

    A job or machine lost on the way leaves the old queue in force. Rows that no queue
    names any more are deleted, but for those of the queue before.
    """
    spark = df.sparkSession
    before = latest_text(spark, f"{path}/current")
    name = f"rows-{uuid.uuid4().hex[:12]}"
    df.write.parquet(f"{path}/{name}")
    replace_text(spark, f"{path}/current", json.dumps({"rows": name}))
    keep = {name, json.loads(before)["rows"] if before else name}
    for old in list_names(spark, path):
        if old.startswith("rows-") and old not in keep:
            remove(spark, f"{path}/{old}")


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    current = latest_text(spark, f"{path}/current")
    return spark.read.schema(QUEUE).parquet(f"{path}/{json.loads(current)['rows']}") if current else spark.createDataFrame([], QUEUE)


def replace_text(spark: SparkSession, folder: str, text: str) -> str:
    """Keep a small mutable file as numbered versions, each written once; returns the new version's path."""
    names = [n for n in list_names(spark, folder) if n.endswith(".json")]
    version = int(names[-1].removesuffix(".json")) + 1 if names else 0
    path = f"{folder}/{version:010d}.json"
    write_text_once(spark, path, text)
    return path


def latest_text(spark: SparkSession, folder: str) -> str | None:
    names = [n for n in list_names(spark, folder) if n.endswith(".json")]
    return read_text(spark, f"{folder}/{names[-1]}") if names else None
