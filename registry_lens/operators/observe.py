"""From a landed document and its feed row to one absolute observation row, and gap rows for what went wrong."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registry_lens.config import CONFIG, Config
from registry_lens.functions.documents import Document, flags, map_at, outcome, retain
from registry_lens.functions.privacy import gate_violation, redact_json
from registry_lens.functions.scalars import rev_int, sha256_text

#: What a gap row can be about. The last four are about a run, with one row each.
GAP_KINDS = ("fetch_failed", "too_large", "pii_refused", "deferred", "triage", "recovered", "budget")


def observations(fetched: DataFrame, salt: str, config: Config = CONFIG) -> DataFrame:
    """Observations of fetched documents.

    Input: run, name, seq, rev (the feed's), feed_deleted, now (epoch seconds), status, raw.
    A row without a document, or with one above ``max_document_bytes`` (outcome too_large),
    has zero and empty values and the flag ``gone`` or ``fetch_failed``. One projection, no shuffle.
    """
    too_large = F.coalesce(F.octet_length("raw") > config.max_document_bytes, F.lit(False))
    rows = fetched.withColumn("doc", F.when(~too_large, F.try_parse_json("raw")))
    rows, doc = Document.shared(rows, "doc", "now", config)
    there = map_at(F.col("doc"), "$").isNotNull()
    no_versions = F.array().cast("array<struct<t:bigint,v:string>>")
    parts = rows.select(
        "run", "name", "seq", "rev", rev_int("rev").alias("rev_int"), F.coalesce("feed_deleted", F.lit(False)).alias("feed_deleted"), "now", "status",
        outcome(F.col("status"), F.when(there, F.col("doc")), too_large).alias("outcome"), F.coalesce(F.octet_length("raw"), F.lit(0)).alias("bytes"), there.alias("there"),
        doc.created().alias("created"), doc.modified().alias("modified"), doc.dist_tags().alias("dist_tags"), doc.maintainers().alias("maintainers"), doc.maintainer_hashes(salt).alias("maintainer_hashes"),
        F.greatest(F.coalesce(F.size(doc.versions()), F.lit(0)), F.lit(0)).alias("version_count"), doc.versions_digest().alias("versions_digest"), doc.times().alias("times"), doc.missing().alias("missing"),
        doc.recent().alias("recent"), F.when(there, F.size(doc.missing_all())).otherwise(0).alias("missing_count"), F.when(there, F.size(doc.recent_all())).otherwise(0).alias("recent_count"),
        (there & doc.tombstone()).alias("tombstone"), doc.unpublished_at().alias("unpublished_at"), doc.unpublished_by().alias("unpublished_by"), doc.unpublished_versions().alias("unpublished_versions"), doc.security_holder().alias("security_holder"), doc.is_new().alias("is_new"),
    )
    truncated = (F.size("missing") < F.col("missing_count")) | (F.size("recent") < F.col("recent_count"))
    marked = flags(F.col("is_new"), F.col("recent"), F.col("missing_count"), F.col("tombstone"), F.col("security_holder"), truncated)
    without = F.array(F.when(F.col("outcome") == "gone", "gone").otherwise("fetch_failed"))
    scripts = F.filter(F.transform("recent", lambda r: F.when(F.size(r["install_scripts"]) > 0, r["v"])), lambda x: x.isNotNull())
    return parts.select(
        *(c for c in parts.columns if c not in ("times", "missing", "there")),
        F.coalesce("times", no_versions).alias("times"),
        F.when(F.col("there"), F.col("missing")).otherwise(no_versions).alias("missing"),
        F.coalesce(truncated, F.lit(False)).alias("truncated"),
        scripts.alias("install_script_versions"),
        F.when(F.col("there"), marked).otherwise(without).alias("flags"),
    )


def gzip_size(c: Column) -> Column:
    """Bytes of each text when compressed, in Arrow batches; null for null."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else len(gzip.compress(t.encode(), 9)))

    return run(c)


def retained_rows(fetched: DataFrame, obs: DataFrame, salt: str, soft: bool = False, config: Config = CONFIG) -> DataFrame:
    """Redacted documents worth keeping by the flags of their observations, with what became of each.

    Columns: k, schema, run, name, rev, sha256 (of the text), doc, gz, verdict: ``kept``,
    ``refused`` (an address is left in it; ``rule`` says which rule it breaks) or
    ``too_large``. The limit holds for the compressed size, which is only computed where
    the text itself is above it. Rows without a document or revision are no candidates.
    """
    wanted = obs.where(retain(F.col("flags"), soft, config)).select("run", "name")
    there = fetched.where("raw is not null and rev is not null").join(wanted, ["run", "name"], "left_semi")
    rows = there.select("run", "name", "rev", redact_json("raw", salt, marker=True).alias("doc"))
    sized = rows.withColumn("gz", F.coalesce(gzip_size(F.when(F.octet_length("doc") > config.max_retained_bytes, F.col("doc"))), F.octet_length("doc").cast("long")))
    ruled = sized.withColumn("rule", gate_violation("doc"))
    verdict = F.when(F.col("rule").isNotNull(), "refused").when(F.col("gz") > config.max_retained_bytes, "too_large").otherwise("kept")
    return ruled.select(F.lit("pkg").alias("k"), F.lit(1).alias("schema"), "run", "name", "rev", sha256_text("doc").alias("sha256"), "doc", "gz", "rule", verdict.alias("verdict"))


def gap(kind: str, at: Column, name: Column | None = None, seq: Column | None = None, rev: Column | None = None, status: Column | None = None, detail: Column | None = None, run: Column | None = None) -> list[Column]:
    """Columns of a gap row; what is not given is null."""
    if kind not in GAP_KINDS:
        raise ValueError(kind)
    given = {"name": (name, "string"), "seq": (seq, "long"), "rev": (rev, "string"), "status": (status, "int"), "detail": (detail, "string"), "run": (run, "string")}
    return [F.lit("gap").alias("k"), F.lit(kind).alias("kind"), *((F.lit(None) if v is None else v).cast(t).alias(n) for n, (v, t) in given.items()), at.alias("at")]


def split_kinds(archive: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(observations, gaps) of an archive in which ``k`` tells them apart."""
    return archive.where("k = 'obs'"), archive.where("k = 'gap'")
