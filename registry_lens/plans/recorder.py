"""One recorder run over landed feed pages and documents, with its commit order.

A: the drained feed is stored. B: the cursor moves, with A's receipt. C: observations,
gaps, retained documents, the deferred queue and the manifest are stored. D: the cursor
notes the run as complete. A crash between two of them repeats work and loses none: B can't
precede A, and what is written again has the same names and ids. What a run chooses from
its queue is a table in the shared folder, so all steps see the same choice.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import warnings
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry_lens.config import CONFIG, Config
from registry_lens.functions import privacy
from registry_lens.functions.scalars import run_mode, tier
from registry_lens.operators import advisories, feed, ledger, mirror, observe
from registry_lens.session import hadoop_fs, persist_table, remove, write_text_once
from registry_lens.sources import feed_source, jsonl
from registry_lens.streaming.cursor import Cursor, store_feed


def read_cursor(spark: SparkSession, store: str) -> Cursor | None:
    text = jsonl.latest_text(spark, f"{store}/cursor")
    return None if text is None else Cursor.read(text)


def write_cursor(spark: SparkSession, store: str, cursor: Cursor) -> None:
    jsonl.replace_text(spark, f"{store}/cursor", cursor.text())


def size_of(spark: SparkSession, path: str) -> int:
    fs, p, _ = hadoop_fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def read_anchor(spark: SparkSession, store: str, now: dt.datetime, config: Config = CONFIG) -> tuple[dict | None, bool]:
    """(last usage measurement or None if unusable, whether it is missing or stale)."""
    try:
        data = json.loads(jsonl.latest_text(spark, f"{store}/usage") or "")
        return data, (now - dt.datetime.fromisoformat(data["at"])).total_seconds() > config.usage_stale_s
    except (ValueError, KeyError, TypeError):
        return None, True


def store_advisories(records: DataFrame, path: str, salt: str, config: Config = CONFIG, mode: str = "errorifexists") -> None:
    """Advisory records (id, modified, published, summary, details, ...) into the archive: redacted, then gated."""
    jsonl.write_jsonl(privacy.redact_columns(records, salt), path, privacy.gate, config, mode)


def sync_advisories(spark: SparkSession, store: str, listing: str, records: DataFrame, salt: str, now: dt.datetime, config: Config = CONFIG) -> dict:
    """Land the records changed since the cursor's watermark, and move it as far as every wanted one has landed.

    ``listing``: files of (modified, id) lines; ``records``: fetched ones, of which those
    that are wanted are stored. At most ``max_advisories`` are taken, oldest first.
    """
    cursor = read_cursor(spark, store) or Cursor(0)
    mark = cursor.osv_watermark or ""
    wanted = persist_table(advisories.delta(jsonl.read_delta(spark, listing, mark), mark, config.max_advisories), "wanted")
    landed = records.join(wanted.select("id"), "id", "left_semi")
    run = now.strftime("%Y-%m-%dT%H-%M-%SZ")
    key = f"raw/osv/{run[:10].replace('-', '/')}/{run}"
    store_advisories(landed, f"{store}/{key}", salt, config, mode="overwrite")
    found = jsonl.read_lines(spark, f"{store}/{key}").select(F.get_json_object("line", "$.id").alias("id"))
    moved = cursor.with_watermark(advisories.next_watermark(found, wanted, mark))
    write_cursor(spark, store, moved)
    return {"key": key, "wanted": wanted.count(), "stored": found.count(), "watermark": moved.osv_watermark or None}


def stored_shards(spark: SparkSession, store: str, key: str) -> list[dict]:
    """Key, rows, bytes and digest of each stored file below a key, the digest being that of its bytes."""
    path = f"{store}/{key}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path)
    rows = jsonl.read_lines(spark, path).groupBy(F.col("key").alias("path")).agg(F.count("*").alias("rows"))
    name = lambda p: F.regexp_replace(p, r"^.*/(?=" + r"[^/]*/[^/]*$)", "")
    found = files.select(name(F.col("path")).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")).join(rows.select(name(F.col("path")).alias("name"), "rows"), "name", "left")
    return [{"key": f"{key}/{r['name']}", "rows": r["rows"] or 0, "bytes": r["bytes"], "sha256": r["sha256"]} for r in found.orderBy("name").collect()]  # one per shard of a run


def _store_feed(drained: DataFrame, store: str, key: str, since: int, last: int, at_head: bool, config: Config) -> int:
    """Header row and rows of a drained stretch; returns the bytes stored."""
    spark = drained.sparkSession
    header = spark.range(1).select(F.lit("feedhdr").alias("k"), F.lit(since).cast("long").alias("since"), F.lit(last).cast("long").alias("lastSeq"), F.lit(at_head).alias("atHead"))
    jsonl.write_jsonl(header, f"{store}/{key}", privacy.gate, config, mode="overwrite")
    jsonl.write_jsonl(drained.select("seq", "id", F.transform("revs", lambda r: F.struct(r.alias("rev"))).alias("changes"), "deleted"), f"{store}/{key}", privacy.gate, config, mode="append")
    return size_of(spark, f"{store}/{key}")


def _archive_rows(obs: DataFrame, seen: str) -> DataFrame:
    """Observations as the archive has them."""
    pairs = lambda c: F.transform(c, lambda x: F.array(x["v"], x["t"].cast("string")))
    return obs.select(
        F.lit("obs").alias("k"), "run", "name", "seq", "rev", F.col("rev_int").alias("revInt"), F.col("feed_deleted").alias("feedDeleted"), F.lit(seen).alias("fetchedAt"), "status", "outcome", "bytes", "created", "modified", F.col("dist_tags").alias("distTags"), "maintainers",
        F.col("maintainer_hashes").alias("maintainerHashes"), F.col("version_count").alias("versionCount"), F.col("versions_digest").alias("versionsDigest"), pairs("times").alias("times"), pairs("missing").alias("missing"), F.col("missing_count").alias("missingCount"),
        jsonl.archive_details(F.col("recent")).alias("recent"), "truncated", "tombstone", F.col("unpublished_at").alias("unpublishedAt"), F.col("unpublished_by").alias("unpublishedBy"), F.col("unpublished_versions").alias("unpublishedVersions"),
        F.col("security_holder").alias("securityHolder"), F.col("is_new").alias("isNew"), "packumentKey", "flags",
    )


def _observe(spark: SparkSession, store: str, part: DataFrame, documents: DataFrame, run: str, day: str, now: dt.datetime, soft: bool, salt: str, config: Config) -> None:
    """Observations, gaps and retained documents of a stretch of the queue, appended to the run's folders."""
    fetched = part.select(F.lit(run).alias("run"), F.col("id").alias("name"), "seq", F.try_element_at("changes", F.lit(-1))["rev"].alias("rev"), F.col("deleted").alias("feed_deleted"), F.lit(int(now.timestamp())).alias("now")).join(
        documents.select("name", "status", "raw"), "name", "left"
    )
    landed, absent = fetched.where("status is not null"), fetched.where("status is null")
    seen = now.strftime("%Y-%m-%dT%H:%M:%S.000Z")
    at, key = F.lit(seen), f"private/pkg/{day}/{run}"
    obs = observe.observations(landed, salt, config)
    retained = persist_table(observe.retained_rows(landed, obs, salt, soft, config), "retained")
    kept = retained.where("verdict = 'kept'")
    jsonl.write_jsonl(kept.select("k", "schema", "run", "name", "rev", F.lit(seen).alias("fetchedAt"), "sha256", "doc"), f"{store}/{key}", privacy.gate, config, mode="append")
    marked = obs.join(kept.select("name", F.lit(key).alias("packumentKey")), "name", "left")
    good, refused = privacy.quarantine(_archive_rows(marked, seen))
    jsonl.write_jsonl(good, f"{store}/raw/obs/{day}/{run}", privacy.gate, config, mode="append")
    gap = lambda kind, detail=None: observe.gap(kind, at, F.col("name"), F.col("seq"), F.col("rev"), F.col("status"), detail, F.col("run"))
    failed = good.where("outcome in ('error', 'too_large')")
    of_document = retained.join(landed.select("name", "seq", "status"), "name")
    rows = [
        absent.select(*gap("fetch_failed", F.lit("no document has landed"))),
        failed.where("outcome = 'error'").select(*gap("fetch_failed")),
        failed.where("outcome = 'too_large'").select(*gap("too_large")),
        refused.select(*gap("pii_refused", F.concat(F.lit("row:"), "rule"))),
        of_document.where("verdict = 'refused'").select(*gap("pii_refused", F.concat(F.lit("packument:"), "rule"))),
        of_document.where("verdict = 'too_large'").select(*gap("too_large", F.concat(F.lit("packument_gz="), F.col("gz").cast("string")))),
    ]
    jsonl.write_jsonl(reduce(DataFrame.unionByName, rows), f"{store}/raw/gaps/{day}/{run}", privacy.gate, config, mode="append")


def record(
    spark: SparkSession, store: str, feed_folder: str, documents: DataFrame, salt: str, now: dt.datetime, max_fetch: int = 100_000, used_bytes: int | None = None, ceiling: float | None = None, config: Config = CONFIG, clock: Callable[[], dt.datetime] | None = None
) -> dict:
    """Drain the feed, observe what has a document, defer the rest; returns the run's manifest.

    ``documents``: name, status, raw, at most a row per name. The queue is taken highest
    sequence first, at most ``max_fetch`` packages, in stretches of ``fetch_wave``; none is
    begun after ``fetch_cut_s`` seconds of ``clock``. Packages that failed, are too large or
    have no document yet leave a gap row and stay in the queue, as do those not reached; an
    observation that breaks the gate is dropped and leaves a gap row. ``used_bytes``: stored
    so far, by default the last usage measurement and what was written since.
    """
    cursor = read_cursor(spark, store) or Cursor(0)
    clock = clock or (lambda: dt.datetime.now(dt.timezone.utc))
    cut = clock() + dt.timedelta(seconds=config.fetch_cut_s)
    pending = cursor.pending_key  # a blob whose run never completed: its rows are queued again
    run = now.strftime("%Y-%m-%dT%H-%M-%SZ")
    day = run[:10].replace("-", "/")
    head = feed_source.head(feed_folder)
    if head is not None:
        cursor.check_head(head)
    spark.dataSource.register(feed_source.FeedSource)
    drained = spark.read.format("registry_feed").option("path", feed_folder).option("since", cursor.last_seq).option("maxPages", config.max_pages).load()
    ratio = feed.sequence_ratio(drained, config).first()
    if ratio["suspicious"]:
        warnings.warn(f"the feed has {ratio['ratio']:.2f} sequence numbers per row", stacklevel=2)
    newest = drained.agg(F.max("seq")).first()[0]
    last = cursor.last_seq if newest is None else newest
    since, key = cursor.last_seq, f"raw/feed/{day}/{run}-{cursor.last_seq}-{last}"
    receipt = store_feed(lambda: _store_feed(drained, store, key, since, last, head is None or last >= head, config), key, last)  # A
    anchor, stale = read_anchor(spark, store, now, config)
    if anchor is not None:
        cursor = cursor.with_anchor(anchor["at"])
    cursor = cursor.advance(receipt, now)
    write_cursor(spark, store, cursor)  # B
    stored = jsonl.read_feed(spark, f"{store}/{key}").withColumn("arrived_at", F.lit(now.replace(tzinfo=None)))
    parts, recovered = [jsonl.read_queue(spark, f"{store}/queue"), stored], 0
    if pending is not None:
        again = jsonl.read_feed(spark, f"{store}/{pending}").withColumn("arrived_at", F.lit(now.replace(tzinfo=None)))
        recovered = again.count()
        parts.append(again)
    queue = feed.work_queue(*(p.select("seq", "id", "changes", "deleted", "arrived_at") for p in parts)).where("id is not null")
    ranked = mirror.with_position(queue.withColumn("__order", F.struct((-F.col("seq")).alias("s"), "id")), "__order").drop("__order")
    queue = persist_table(ranked, "queue")
    waiting = queue.count()
    if used_bytes is None:
        total = next((r["bytes"] for r in anchor["rows"] if r["prefix"] is None), 0) if anchor is not None else 0
        used_bytes = total + cursor.bytes_since_anchor
    limit = ceiling or config.storage_free_bytes
    state = spark.range(1).select(tier(F.lit(used_bytes), limit, config.soft_fraction, config.hard_fraction).alias("t"))
    level, mode = state.select("t", run_mode(F.col("t"), F.lit(waiting), config.backlog_threshold, config.triage_threshold)).first()
    # C: what an earlier attempt of this run left is replaced
    for part in (f"raw/obs/{day}/{run}", f"raw/gaps/{day}/{run}", f"private/pkg/{day}/{run}"):
        remove(spark, f"{store}/{part}")
    budget, taken = 0 if mode == "triage" else min(max_fetch, waiting), 0
    while taken < budget and clock() < cut:
        upto = min(budget, taken + config.fetch_wave)
        _observe(spark, store, queue.where(F.col("position").between(taken, upto - 1)).drop("position"), documents, run, day, now, level == "soft", salt, config)
        taken = upto
    gaps_path = f"{store}/raw/gaps/{day}/{run}"
    if taken:
        retry = jsonl.read_gaps(spark, gaps_path).where("kind = 'fetch_failed' or (kind = 'too_large' and not coalesce(detail, '') like 'packument_gz=%')").select(F.col("name").alias("id")).distinct()
        tried = queue.where(F.col("position") < taken).join(retry, "id", "left_semi").select(queue.columns)
        later = queue.where(F.col("position") >= taken).unionByName(tried).drop("position")
    else:
        later = queue.drop("position")
    jsonl.write_queue(later, f"{store}/queue")
    left = jsonl.read_queue(spark, f"{store}/queue").count()
    seen = now.strftime("%Y-%m-%dT%H:%M:%S.000Z")
    notes = [("recovered", f"rows={recovered}", recovered), ("triage", f"queue={waiting};tier={level}", mode == "triage"), ("deferred", f"count={left}", left), ("budget", f"tier={level};stored={used_bytes};ceiling={limit:.0f};anchor_stale={stale}", level == "soft")]
    own = [spark.range(1).select(*observe.gap(kind, F.lit(seen), detail=F.lit(detail), run=F.lit(run))) for kind, detail, due in notes if due]
    if own:
        jsonl.write_jsonl(reduce(DataFrame.unionByName, own), gaps_path, privacy.gate, config, mode="append")
    shards = {part: stored_shards(spark, store, part) if size_of(spark, f"{store}/{part}") else [] for part in (key, f"raw/obs/{day}/{run}", f"raw/gaps/{day}/{run}", f"private/pkg/{day}/{run}")}
    blob = shards[key]
    obs_shards, kept = [*shards[f"raw/obs/{day}/{run}"], *shards[f"raw/gaps/{day}/{run}"]], shards[f"private/pkg/{day}/{run}"]
    manifest = {
        "schema": 2, "runId": run, "prevRunId": cursor.prev_run_id, "prevManifestSha256": cursor.prev_sha256, "sinceSeq": since, "lastSeq": last, "mode": mode,
        "feedBlob": {"key": key, "sha256": hashlib.sha256("".join(s["sha256"] for s in blob).encode()).hexdigest(), "rows": sum(s["rows"] for s in blob), "bytes": receipt.size}, "obsShards": obs_shards, "retained": kept,
        "queued": waiting, "fetched": taken, "deferred": left, "budget": {"tier": level, "storedBytes": used_bytes, "ceiling": limit}, "bytes": receipt.size + sum(s["bytes"] for s in [*obs_shards, *kept]),
    }
    data = ledger.canonical(manifest)
    write_text_once(spark, f"{store}/raw/runs/{day}/{run}.json", data.decode())
    write_cursor(spark, store, cursor.complete(run, hashlib.sha256(data).hexdigest()))  # D
    return manifest
