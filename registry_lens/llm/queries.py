"""Registered queries on texts, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry_lens.llm import bpe, packing, pii, splitting
from registry_lens.session import table


def _limits(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    return {r["limit_name"]: r["tokens"] for r in table(spark, sf_dir, "token_limits").collect()}  # three rows


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal(table(spark, sf_dir, "osv_records"))


def p6_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.redact(table(spark, sf_dir, "osv_records"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), _limits(spark, sf_dir).get("pack_capacity", 2048))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(spark, sf_dir).where("piece = 1").select("doc_id")


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(spark, sf_dir)


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = _limits(spark, sf_dir)
    return splitting.split_documents(table(spark, sf_dir, "documents"), limits.get("split_limit", 512), limits.get("split_overlap", 64))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces(spark, sf_dir).where("piece = 0").select("doc_id")


def p10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces(spark, sf_dir).select("doc_id", "piece", "start", "end", "text", F.size("ids").cast("long").alias("tokens"))


QUERIES = {f.__name__: f for f in (p6_found, p6_redacted, p8_ids, p9_found, p9_containers, p10_found, p10_pieces)}
ORACLES: dict[str, str] = {}
