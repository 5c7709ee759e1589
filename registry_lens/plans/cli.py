"""Command line: python -m registry_lens.plans.cli MODE --store DIR [...]."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registry_lens.operators import advisories, budget, derive, digest, feed, index, ledger, mirror, similarity
from registry_lens.plans import recorder
from registry_lens.session import read_text, ship, write_text_once
from registry_lens.sources import jsonl
from registry_lens.streaming.cursor import Cursor

SALTLESS = ("usage", "mirror", "verify-chain", "ledger", "store-check", "recover-cursor", "restore-drill")


def _exists(spark: SparkSession, path: str) -> bool:
    return recorder.hadoop_fs(spark, path)[0].exists(recorder.hadoop_fs(spark, path)[1])


def blob_key(c: str) -> Column:
    """The key of a feed blob from that of one of its files."""
    return F.regexp_replace(c, "(/shard=[^/]*)?/[^/]*$", "")


def build_index(spark: SparkSession, store: str, into: str, salt: str | None = None) -> dict[str, DataFrame]:
    """Rebuild the index tables from the archive and read them back."""
    raw = jsonl.read_observations(spark, f"{store}/raw/obs")
    obs = index.keep_last(raw, ["name", "run"], ["key", "line_no"])
    tables = {"observations": obs.drop("key", "line_no"), "packages": index.fold_packages(obs), "events": derive.derive_all(obs)}
    if _exists(spark, f"{store}/raw/gaps"):
        tables["gaps"] = jsonl.read_gaps(spark, f"{store}/raw/gaps")
    if salt and _exists(spark, f"{store}/raw/osv"):
        records = jsonl.read_advisories(spark, f"{store}/raw/osv", salt)
        tables["osv_records"] = advisories.latest_records(records).drop("key", "line_no")
        tables["osv_affects"] = advisories.affected_pairs(records)
    if _exists(spark, f"{store}/private/pkg"):
        tables["retained"] = jsonl.read_documents(spark, f"{store}/private/pkg", f"{store}/raw/pkg" if _exists(spark, f"{store}/raw/pkg") else None)
    popular = 0
    if _exists(spark, f"{store}/popular.json"):
        popular = jsonl.read_popular(spark, f"{store}/popular.json").count()
        fresh = obs.where(F.array_contains("flags", "new_package")).select("name")
        tables["typosquat"] = similarity.scores(fresh, jsonl.read_popular(spark, f"{store}/popular.json"))
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{into}/{name}")
    out = {name: spark.read.schema(df.schema).parquet(f"{into}/{name}") for name, df in tables.items()}
    built = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    index.build_meta(built, out["observations"], out["events"], popular).write.mode("overwrite").parquet(f"{into}/build_meta")
    return out


def report(tables: dict[str, DataFrame], date: str) -> tuple[str, str]:
    affected = advisories.affects(tables["osv_records"], tables["osv_affects"]) if "osv_records" in tables else None
    data = digest.collect(date, tables["events"], tables["observations"].withColumnRenamed("fetchedAt", "fetched_at"), tables["packages"], tables.get("typosquat"), affected, tables.get("gaps"))
    return digest.render(data)


def stored_lines(spark: SparkSession, store: str) -> DataFrame:
    return ledger.run_lines(ledger.read_manifests(spark, f"{store}/raw/runs"))


def verify_chain(lines: DataFrame, store_lines: DataFrame | None = None) -> tuple[bool, dict]:
    """Whether ledger lines hold together, and whether the store's manifests are all among them."""
    found = ledger.report(lines).first().asDict()
    if store_lines is not None:
        found["uncommitted"] = ledger.uncommitted(store_lines, lines).count()
    return found["defects"] == 0 and not found.get("uncommitted"), found


def run_mirror(spark: SparkSession, primary: str, copy: str, most: int, repair: bool = False) -> tuple[bool, list[dict]]:
    """Copy what is missing within a budget, then compare. A mismatch fails; an incomplete copy does not."""
    mirror.assert_distinct(spark, primary, copy)
    state = jsonl.latest_text(spark, f"{copy}/mirror/state")
    if state is not None and json.loads(state)["primary"] != primary:
        raise mirror.SameStoreError("the mirror was made from another primary")
    ours = lambda path: mirror.listing(spark, path).where(~F.col("key").startswith("mirror/"))
    here = ours(primary)
    there = ours(copy) if recorder.size_of(spark, copy) else spark.createDataFrame([], "key string, size long")
    gaps = mirror.diff(here, there)
    mirror.copy_keys(mirror.within_budget(gaps.where("state = 'missing'").select("key"), most), primary, copy)
    if repair:
        mirror.copy_keys(gaps.where("state = 'size_mismatch'").select("key"), primary, copy, overwrite=True)
    totals = mirror.summary(mirror.diff(here, ours(copy)))
    rows = [r.asDict() for r in totals.orderBy("prefix").collect()]
    jsonl.replace_text(spark, f"{copy}/mirror/state", json.dumps({"primary": primary, "prefixes": rows}, default=str))
    return mirror.verdict(totals), rows


def restore_drill(spark: SparkSession, copy: str, into: str, expected_graves: DataFrame, date: str) -> dict:
    """Rebuild from a mirror alone and compare the day's deaths with committed ones."""
    tables = build_index(spark, copy, into)
    graves = digest.graveyard(tables["events"], digest.Day(date)).select("id", "name", "at")
    keys = mirror.listing(spark, f"{copy}/raw/feed").select("key")
    last = feed.max_seq_of_keys(keys.withColumn("key", blob_key("key"))).first()[0]
    same = graves.exceptAll(expected_graves.select("id", "name", "at")).isEmpty() and expected_graves.select("id", "name", "at").exceptAll(graves).isEmpty()
    return {"events": tables["events"].count(), "max_seq": last, "graves_match": same}


def store_check(spark: SparkSession, store: str) -> None:
    """Put, get, a missing get, put-if-absent and list, as the recorder needs them."""
    key = f"{store}/check/{dt.datetime.now(dt.timezone.utc).timestamp()}"
    write_text_once(spark, f"{key}/a.json", "1")
    assert read_text(spark, f"{key}/a.json") == "1"
    try:
        write_text_once(spark, f"{key}/a.json", "2")
    except FileExistsError:
        pass
    else:
        raise RuntimeError("put-if-absent overwrote")
    assert not _exists(spark, f"{key}/b.json")
    fs, p, _ = recorder.hadoop_fs(spark, f"{store}/check")
    fs.delete(p, True)


def usage(spark: SparkSession, store: str, ceiling: str | None = None) -> list[dict]:
    """Bytes by prefix with the total and its tier; stored as the new anchor."""
    limit = budget.parse_ceiling(ceiling)
    rows = [r.asDict() for r in budget.tiers(budget.usage_by_prefix(mirror.listing(spark, store)), "bytes", limit).orderBy("prefix").collect()]
    jsonl.replace_text(spark, f"{store}/usage", json.dumps({"at": dt.datetime.now(dt.timezone.utc).isoformat(), "rows": rows}))
    return rows


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="registry_lens")
    p.add_argument("mode", choices=("record", "advisories", "bootstrap", "index", "store-check", "recover-cursor", "ledger", "verify-chain", "mirror", "restore-drill", "usage"))
    p.add_argument("--store", required=True)
    p.add_argument("--date")
    p.add_argument("--into")
    p.add_argument("--feed")
    p.add_argument("--documents")
    p.add_argument("--listing")
    p.add_argument("--records")
    p.add_argument("--ceiling")
    p.add_argument("--copy")
    p.add_argument("--ledger")
    p.add_argument("--hours", type=float, default=24)
    p.add_argument("--head", type=int)
    p.add_argument("--from", dest="since")
    p.add_argument("--force", action="store_true")
    p.add_argument("--force-rewind", action="store_true")
    p.add_argument("--repair", action="store_true")
    p.add_argument("--max-fetch", type=int, default=100_000)
    p.add_argument("--max-objects", type=int, default=100_000)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = arguments().parse_args(argv)
    salt = os.environ.get("LENS_SALT", "")
    if a.mode not in SALTLESS and len(salt) < 16:
        print("LENS_SALT needs at least 16 characters", file=sys.stderr)
        return 2
    spark = spark or SparkSession.builder.appName("registry_lens").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship(spark)
    need = lambda name: getattr(a, name) or arguments().error(f"--{name} is missing")
    if a.mode == "record":
        out = recorder.record(spark, a.store, need("feed"), spark.read.parquet(need("documents")), salt, dt.datetime.now(dt.timezone.utc), a.max_fetch, ceiling=budget.parse_ceiling(a.ceiling))
        print(json.dumps(out))
    elif a.mode == "advisories":
        print(json.dumps(recorder.sync_advisories(spark, a.store, need("listing"), spark.read.parquet(need("records")), salt, dt.datetime.now(dt.timezone.utc))))
    elif a.mode == "bootstrap":
        recorder.write_cursor(spark, a.store, Cursor.bootstrap(need("head"), a.hours, recorder.read_cursor(spark, a.store), a.force))
    elif a.mode == "recover-cursor":
        keys = mirror.listing(spark, f"{a.store}/raw/feed").select(blob_key("key").alias("key"))
        top = feed.max_seq_of_keys(keys).first()[0] or 0
        recorder.write_cursor(spark, a.store, Cursor.recover(top, recorder.read_cursor(spark, a.store), a.force_rewind))
    elif a.mode == "index":
        tables = build_index(spark, a.store, need("into"), salt)
        for text, ending in zip(report(tables, need("date")), ("md", "json")):
            write_text_once(spark, f"{a.into}/digests/{a.date}.{ending}", text)
    elif a.mode == "store-check":
        store_check(spark, a.store)
    elif a.mode == "ledger":
        write_text_once(spark, f"{need('ledger')}/{need('date')}.jsonl", ledger.format_day(stored_lines(spark, a.store), a.date))
    elif a.mode == "verify-chain":
        stored = stored_lines(spark, a.store) if _exists(spark, f"{a.store}/raw/runs") else None
        good, found = verify_chain(ledger.parse_ledger(spark, need("ledger"), a.since), stored)
        print(json.dumps(found))
        return int(not good)
    elif a.mode == "mirror":
        good, rows = run_mirror(spark, a.store, need("copy"), a.max_objects, a.repair)
        print(json.dumps(rows))
        return int(not good)
    elif a.mode == "usage":
        print(json.dumps(usage(spark, a.store, a.ceiling)))
    else:
        graves = spark.read.parquet(need("ledger"))
        found = restore_drill(spark, a.store, need("into"), graves, need("date"))
        print(json.dumps(found))
        return int(not found["graves_match"])
    return 0


if __name__ == "__main__":
    sys.exit(main())
