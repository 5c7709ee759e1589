"""Feed source, recorder, index, ledger, mirror and command line on a small archive."""

from __future__ import annotations

import dataclasses
import datetime as dt
import hashlib
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from registry_lens.operators import derive, index, ledger, mirror
from registry_lens.plans import cli, recorder
from registry_lens.session import ship, work_dir
from registry_lens.sources import jsonl
from registry_lens.sources.feed_source import FeedSource
from registry_lens.streaming.cursor import Cursor, FeedReceipt, store_feed
from registry_lens.streaming.derive_stream import run_to_table

SALT = "sixteen characters and more"
DOCS = "name string, status int, raw string"
NOW = dt.datetime(2026, 3, 5, 12, tzinfo=dt.timezone.utc)


def local(spark, name):
    return work_dir(spark, name).removeprefix("file://")


def land(folder, since, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/feed-{since}-{rows[-1][0]}.jsonl", "w") as f:
        f.write(json.dumps({"k": "feedhdr", "since": since}) + "\n")
        for seq, name, *deleted in rows:
            f.write(json.dumps({"seq": seq, "id": name, "changes": [{"rev": f"{seq}-ab"}], **({"deleted": True} if deleted else {})}) + "\n\n")


def document(name, versions, people=("ann",), removed=(), died=None):
    times = {v: f"2026-03-0{d}T00:00:00.000Z" for v, d in {**versions, **dict(removed)}.items()}
    doc = {"_id": name, "name": name, "_rev": "7-x", "time": {"created": "2026-03-01T00:00:00.000Z", **times}, "maintainers": [{"name": p, "email": f"{p}@example.com"} for p in people]}
    if died:
        doc["time"]["unpublished"] = {"time": died, "name": "ann", "versions": list(versions)}
    else:
        doc |= {"dist-tags": {"latest": max(versions)}, "versions": {v: {"scripts": {"install": "x"} if v == "2.0.0" else {}} for v in versions}}
    return json.dumps(doc)


def test_feed_source_batch_and_stream(spark):
    ship(spark)
    folder, root = local(spark, "feed"), work_dir(spark, "stream")
    land(folder, 0, [(1, "a"), (2, "b")])
    land(folder, 2, [(3, "c", True), (5, "a")])
    spark.dataSource.register(FeedSource)
    read = spark.read.format("registry_feed").option("path", folder)
    assert [tuple(r) for r in read.option("since", 1).option("last", 3).load().orderBy("seq").collect()] == [(2, "b", ["2-ab"], False), (3, "c", ["3-ab"], True)]

    def drain():
        q = spark.readStream.format("registry_feed").option("path", folder).load().writeStream.option("checkpointLocation", f"{root}/c").trigger(availableNow=True).format("parquet").start(f"{root}/out")
        q.awaitTermination()
        return sorted(r["seq"] for r in spark.read.parquet(f"{root}/out").collect())

    assert drain() == [1, 2, 3, 5]
    land(folder, 5, [(6, "d")])
    assert drain() == [1, 2, 3, 5, 6]


@pytest.fixture(scope="module")
def archive(spark):
    """Two recorder runs over a small feed."""
    store, feed = local(spark, "store"), local(spark, "pages")
    land(feed, 0, [(1, "a"), (2, "b"), (3, "gone"), (4, "nodoc"), (5, "a")])
    one = [("a", 200, document("a", {"1.0.0": 2})), ("b", 200, document("b", {"1.0.0": 2, "1.1.0": 3})), ("gone", 404, None)]
    first = recorder.record(spark, store, feed, spark.createDataFrame(one, DOCS), SALT, NOW)
    land(feed, 5, [(6, "b"), (9, "a"), (10, "dead")])
    two = [("a", 200, document("a", {"1.0.0": 2, "2.0.0": 5}, people=("bob",))), ("b", 200, document("b", {"1.0.0": 2}, removed={"1.1.0": 3})), ("dead", 200, document("dead", {"1.0.0": 2}, died="2026-03-05T01:00:00.000Z"))]
    second = recorder.record(spark, store, feed, spark.createDataFrame(two, DOCS), SALT, NOW + dt.timedelta(hours=1))
    return store, first, second


def test_runs_and_cursor(spark, archive):
    store, first, second = archive
    assert (first["sinceSeq"], first["lastSeq"], second["sinceSeq"], second["lastSeq"]) == (0, 5, 5, 10)
    cursor = recorder.read_cursor(spark, store)
    assert cursor.last_seq == 10 and cursor.pending_key is None and cursor.runs == 2 and second["prevRunId"] == first["runId"]
    gaps = {(r["kind"], r["name"]) for r in jsonl.read_gaps(spark, f"{store}/raw/gaps").collect()}
    assert gaps == {("fetch_failed", "nodoc"), ("deferred", None)} and second["deferred"] == 1  # nodoc is tried again
    assert [r["id"] for r in jsonl.read_queue(spark, f"{store}/queue").collect()] == ["nodoc"]
    shard = second["obsShards"][0]
    assert hashlib.sha256(open(f"{store}/{shard['key']}", "rb").read()).hexdigest() == shard["sha256"] and sum(x["rows"] for x in second["obsShards"]) == 3 + 2
    kept = {r["name"]: r for r in jsonl.read_documents(spark, f"{store}/private/pkg").collect()}
    assert set(kept) == {"a", "dead"} and "@" not in kept["a"]["raw"] and sum(x["rows"] for x in second["retained"]) == 2
    assert ledger.is_canonical(open(f"{store}/raw/runs/2026/03/05/{first['runId']}.json", "rb").read())


def test_index_events_report(spark, archive, monkeypatch):
    store, _, _ = archive
    into = local(spark, "index")
    monkeypatch.setenv("LENS_SALT", SALT)
    assert cli.main(["index", "--store", store, "--into", into, "--date", "2026-03-05"], spark) == 0
    events = {(r["kind"], r["name"], r["version"], r["backfill"]) for r in spark.read.parquet(f"{into}/events").collect()}
    assert events == {
        ("publish", "a", "1.0.0", True), ("publish", "b", "1.0.0", True), ("publish", "b", "1.1.0", True), ("gone", "gone", None, True), ("publish", "a", "2.0.0", False), ("maintainer_change", "a", None, False),
        ("version_unpublish", "b", "1.1.0", False), ("rev_gap", "a", None, False), ("rev_gap", "b", None, False), ("package_unpublish", "dead", None, True), ("publish", "dead", "1.0.0", True),
    }
    packages = {r["name"]: r for r in spark.read.parquet(f"{into}/packages").collect()}
    assert packages["a"]["latest_version"] == "2.0.0" and packages["a"]["observations"] == 2 and packages["dead"]["is_dead"] == 1
    markdown, data = open(f"{into}/digests/2026-03-05.md").read(), json.load(open(f"{into}/digests/2026-03-05.json"))
    assert "dead" in markdown and data["totals"]["publishes"] == 1 and data["totals"]["version_unpublishes"] == 1
    assert data["graveyard"] == [{"id": "punpub|dead|1772672400", "name": "dead", "at": 1772672400, "by": "ann", "age_days": 4, "versions_lost": 1}]
    assert data["install_scripts"] == [{"name": "a", "version": "2.0.0", "at": 1772668800, "scripts": "install"}]
    assert data["operations"] == {"gaps": 4, "pii_refused": 0} and "4 gaps" in markdown
    details = {(r["kind"], r["name"], r["version"]): json.loads(r["detail"]) for r in spark.read.parquet(f"{into}/events").collect()}
    assert details["publish", "a", "2.0.0"] == {"by": None, "installScripts": ["install"], "deps": 0, "integrity": None, "unpackedSize": None, "fileCount": None, "license": None, "repoHost": None, "deprecated": None, "isNewPackage": False}
    assert details["package_unpublish", "dead", None]["versions"] == ["1.0.0"] and spark.read.parquet(f"{into}/retained").count() == 2


def test_stream_equals_batch(spark, archive):
    store, _, _ = archive
    obs = index.keep_last(jsonl.read_observations(spark, f"{store}/raw/obs"), ["name", "run"], ["key", "line_no"]).drop("key", "line_no")
    path, root = work_dir(spark, "o"), work_dir(spark, "d")
    for run in sorted(r[0] for r in obs.select("run").distinct().collect()):
        obs.where(F.col("run") == run).coalesce(1).write.mode("append").parquet(path)
    run_to_table(spark.readStream.schema(obs.schema).option("maxFilesPerTrigger", 1).parquet(path), root)
    got = derive.first_sightings(spark.read.parquet(f"{root}/events").drop("batch"))
    assert sorted(map(str, got.collect())) == sorted(map(str, derive.derive_all(obs).select(got.columns).collect()))


def test_chain_and_ledger(spark, archive):
    store, first, second = archive
    folder = local(spark, "ledger")
    assert cli.main(["ledger", "--store", store, "--ledger", folder, "--date", "2026-03-05"], spark) == 0
    lines = ledger.parse_ledger(spark, folder)
    assert {r["kind"] for r in ledger.anomalies(lines).collect()} == {"chain-start"}
    assert cli.main(["verify-chain", "--store", store, "--ledger", folder], spark) == 0
    edited = lines.withColumn("sha256", F.when(F.col("run_id") == first["runId"], "edited").otherwise(F.col("sha256")))
    assert {(r["kind"], r["run_id"]) for r in ledger.anomalies(edited).collect()} == {("chain-start", first["runId"]), ("hash-mismatch", second["runId"])}
    lost = lines.where(F.col("run_id") != first["runId"])
    assert {(r["kind"], r["run_id"]) for r in ledger.anomalies(lost).collect()} == {("missing-parent", second["runId"])}
    assert cli.verify_chain(lost, lines) == (False, {"runs": 1, "anomalies": 1, "defects": 1, "uncommitted": 1})
    twin = lines.where(F.col("prev").isNotNull()).withColumn("run_id", F.concat("run_id", F.lit("x"))).withColumn("sha256", F.lit("t"))
    kinds = lambda df: sorted(r["kind"] for r in ledger.anomalies(lines.unionByName(df)).collect())
    assert kinds(twin) == ["chain-start", "fork", "fork"]
    assert kinds(twin.withColumn("since_seq", F.lit(90).cast("long")).withColumn("last_seq", F.lit(99).cast("long"))) == ["chain-start", "fork-suspicious", "fork-suspicious"]


def test_mirror_and_restore(spark, archive):
    store, _, _ = archive
    copy = local(spark, "copy")
    os.makedirs(copy)
    good, rows = cli.run_mirror(spark, store, copy, 3)
    assert good and not all(r["complete"] for r in rows)  # within the budget, resumable
    good, rows = cli.run_mirror(spark, store, copy, 10_000)
    assert good and all(r["complete"] for r in rows)
    assert sum(1 for _ in os.scandir(copy)) >= 4
    tables = cli.build_index(spark, store, local(spark, "i1"))
    graves = tables["events"].where("kind = 'package_unpublish'").select("id", "name", "at")
    found = cli.restore_drill(spark, copy, local(spark, "i2"), graves, "2026-03-05")
    assert found["graves_match"] and found["max_seq"] == 10
    victim = next(os.path.join(d, f) for d, _, fs in os.walk(f"{copy}/raw/obs") for f in fs if f.endswith(".gz"))
    with open(victim, "ab") as f:
        f.write(b"x")
    assert not cli.run_mirror(spark, store, copy, 10)[0]
    assert cli.run_mirror(spark, store, copy, 10, repair=True)[0]
    with pytest.raises(mirror.SameStoreError):
        cli.run_mirror(spark, store, store + "/", 1)


def test_a_crash_loses_nothing(spark, monkeypatch):
    store, feed = local(spark, "crash"), local(spark, "crash-pages")
    land(feed, 0, [(1, "a"), (2, "b")])
    documents = spark.createDataFrame([("a", 200, document("a", {"1.0.0": 2})), ("b", 200, document("b", {"1.0.0": 2})), ("c", 200, document("c", {"1.0.0": 2}))], DOCS)
    real = jsonl.write_jsonl

    def feed_fails(df, path, *more, **kw):
        raise OSError("disk full")

    monkeypatch.setattr(jsonl, "write_jsonl", feed_fails)  # before A: the cursor must not move
    with pytest.raises(OSError):
        recorder.record(spark, store, feed, documents, SALT, NOW)
    assert recorder.read_cursor(spark, store) is None

    def observations_fail(df, path, *more, **kw):
        if "/raw/obs/" in path:
            raise OSError("killed")
        return real(df, path, *more, **kw)

    monkeypatch.setattr(jsonl, "write_jsonl", observations_fail)  # between B and C
    with pytest.raises(OSError):
        recorder.record(spark, store, feed, documents, SALT, NOW)
    stuck = recorder.read_cursor(spark, store)
    assert stuck.last_seq == 2 and stuck.pending_key is not None
    monkeypatch.setattr(jsonl, "write_jsonl", real)
    land(feed, 2, [(3, "c")])
    recorder.record(spark, store, feed, documents, SALT, NOW + dt.timedelta(hours=1), max_fetch=2)
    seen = lambda: sorted(r["name"] for r in jsonl.read_observations(spark, f"{store}/raw/obs").collect())
    assert seen() == ["b", "c"]  # newest first, a deferred
    recorder.record(spark, store, feed, documents, SALT, NOW + dt.timedelta(hours=2))
    assert seen() == ["a", "b", "c"] and recorder.read_cursor(spark, store).pending_key is None


def test_retained_documents_and_degraded_runs(spark):
    """Compressed size decides; addresses that redaction can't reach are refused; soft keeps deaths only, hard keeps to the feed."""
    from registry_lens.config import Config

    def big(name, readme, **kw):
        return json.dumps(json.loads(document(name, {"2.0.0": 4}, **kw)) | {"readme": readme})

    store, pages = local(spark, "retain"), local(spark, "retain-pages")
    noise = random.Random(4).randbytes(6000).hex()
    land(pages, 0, [(1, "bloated"), (2, "noise"), (3, "dead"), (4, "huge"), (5, "leak")])
    docs = [("bloated", 200, big("bloated", "the quick brown fox. " * 1000, died="2026-03-05T01:00:00.000Z")), ("noise", 200, big("noise", noise)), ("dead", 200, document("dead", {"1.0.0": 2}, died="2026-03-05T01:00:00.000Z")), ("huge", 200, big("huge", "y" * 40_000)), ("leak", 200, big("leak", "mailto:nobody"))]
    documents = spark.createDataFrame(docs, DOCS)
    config = Config(max_retained_bytes=4_000, max_document_bytes=30_000, fetch_wave=2)
    first = recorder.record(spark, store, pages, documents, SALT, NOW, config=config)
    names = lambda: {r["name"] for r in jsonl.read_documents(spark, f"{store}/private/pkg").collect()}
    gaps = lambda: {(r["kind"], r["name"], r["detail"] and r["detail"].split("=")[0]) for r in jsonl.read_gaps(spark, f"{store}/raw/gaps").collect()}
    assert names() == {"bloated", "dead"}
    assert gaps() == {("too_large", "noise", "packument_gz"), ("too_large", "huge", None), ("pii_refused", "leak", "packument:mailto"), ("deferred", None, "count")}
    assert (first["fetched"], first["deferred"], first["mode"]) == (5, 1, "steady")  # huge stays in the queue
    obs = {r["name"]: r for r in jsonl.read_observations(spark, f"{store}/raw/obs").collect()}
    assert obs["dead"]["packumentKey"].startswith("private/pkg/") and obs["noise"]["packumentKey"] is None and obs["dead"]["unpublishedVersions"] == ["1.0.0"]
    # a soft budget keeps what is lost elsewhere, a hard one defers all
    land(pages, 5, [(6, "dead"), (7, "noise2")])
    more = spark.createDataFrame([docs[2], ("noise2", 200, document("noise2", {"1.0.0": 2}))], DOCS)
    soft = recorder.record(spark, store, pages, more, SALT, NOW + dt.timedelta(hours=1), used_bytes=80, ceiling=100, config=config)
    assert soft["budget"]["tier"] == "soft" and [x["rows"] for x in soft["retained"]] == [1] and ("budget", None, "tier") in gaps()
    land(pages, 7, [(8, "late")])
    hard = recorder.record(spark, store, pages, more, SALT, NOW + dt.timedelta(hours=2), used_bytes=99, ceiling=100, config=config)
    assert hard["mode"] == "triage" and hard["fetched"] == 0 and ("triage", None, "queue") in gaps()
    # a clock that runs out after the first stretch
    ticks = iter([NOW, NOW, NOW + dt.timedelta(hours=9)])
    cut = recorder.record(spark, store, pages, more, SALT, NOW + dt.timedelta(hours=3), used_bytes=0, config=config, clock=lambda: next(ticks, NOW + dt.timedelta(hours=9)))
    assert cut["fetched"] == 2 and cut["deferred"] >= 1
    with pytest.raises(ValueError):
        recorder.write_cursor(spark, store, dataclasses.replace(recorder.read_cursor(spark, store), last_seq=99))
        recorder.record(spark, store, pages, more, SALT, NOW + dt.timedelta(hours=4))  # past the feed's head


def test_queue_is_never_lost(spark, monkeypatch):
    path = work_dir(spark, "q")
    rows = lambda n: spark.createDataFrame([(k, f"p{k}", [], False, None) for k in range(n)], jsonl.QUEUE)
    jsonl.write_queue(rows(3), path)
    jsonl.write_queue(jsonl.read_queue(spark, path).where("seq > 0"), path)  # out of itself
    assert jsonl.read_queue(spark, path).count() == 2
    held = jsonl.read_queue(spark, path)

    def fails(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(jsonl, "replace_text", fails)
        with pytest.raises(OSError):
            jsonl.write_queue(rows(0), path)
    assert jsonl.read_queue(spark, path).count() == 2
    jsonl.write_queue(rows(0), path)
    assert jsonl.read_queue(spark, path).count() == 0 and held.count() == 2  # readers of the queue before go on


def test_advisory_sync(spark, monkeypatch):
    store, folder = local(spark, "sync"), local(spark, "listing")
    os.makedirs(folder)
    with open(f"{folder}/a.csv", "w") as f:
        f.write("2026-03-05T00:00:00Z,MAL-3\n2026-03-04T00:00:00Z,MAL-2\nbroken\n2026-03-03T00:00:00Z,MAL-1\n2026-03-06T00:00:00Z,MAL-")
    records = lambda *ids: spark.createDataFrame([(i, "2026-03-05T00:00:00Z", "by ann@corp.test") for i in ids], "id string, modified string, summary string")
    out = recorder.sync_advisories(spark, store, folder, records("MAL-1", "MAL-3", "MAL-9"), SALT, NOW)
    assert (out["wanted"], out["stored"], out["watermark"]) == (3, 2, "2026-03-03T00:00:00Z")  # MAL-2 is missing
    records("MAL-2", "MAL-3").write.parquet(f"{store}/landed")
    monkeypatch.setenv("LENS_SALT", SALT)
    assert cli.main(["advisories", "--store", store, "--listing", folder, "--records", f"{store}/landed"], spark) == 0
    assert recorder.read_cursor(spark, store).osv_watermark == "2026-03-05T00:00:00Z"
    assert {r["id"] for r in jsonl.read_advisories(spark, f"{store}/raw/osv", SALT).collect()} == {"MAL-1", "MAL-2", "MAL-3"}


def test_advisories_are_stored_redacted(spark):
    from registry_lens.functions import privacy

    path = work_dir(spark, "osv")
    records = spark.createDataFrame([("MAL-1", "2026-03-05T00:00:00Z", "by ann@corp.test", [("Ann", ["mailto:ann@corp.test"])])], "id string, modified string, summary string, credits array<struct<name:string,contact:array<string>>>")
    recorder.store_advisories(records, path, SALT)
    (row,) = jsonl.read_advisories(spark, path, SALT).collect()
    assert row["id"] == "MAL-1" and "@" not in row["raw"] and row["summary"].startswith("by h:")
    folder = local(spark, "audit")
    os.makedirs(folder)
    with open(f"{folder}/a.txt", "w") as f:
        f.write("x@example.com y@sub.invalid z@real.dev git@host.dev")
    assert [r["address"] for r in privacy.audit_files(spark, folder).collect()] == ["z@real.dev"]


def test_usage_store_check_and_cli(spark, archive, monkeypatch):
    store, _, _ = archive
    monkeypatch.delenv("LENS_SALT", raising=False)
    cli.store_check(spark, store)
    rows = cli.usage(spark, store)
    total = next(r for r in rows if r["prefix"] is None)
    assert total["tier"] == "ok" and total["bytes"] == sum(r["bytes"] for r in rows if r["prefix"])
    assert recorder.read_anchor(spark, store, dt.datetime.now(dt.timezone.utc))[1] is False
    assert cli.main(["record", "--store", store], spark) == 2  # no salt
    other = local(spark, "other")
    monkeypatch.setenv("LENS_SALT", SALT)
    assert cli.main(["bootstrap", "--store", other, "--head", "100000", "--hours", "2"], spark) == 0
    assert recorder.read_cursor(spark, other).last_seq == 90000
    with pytest.raises(ValueError):
        cli.main(["bootstrap", "--store", other, "--head", "100000"], spark)


def test_cursor_rules():
    c = Cursor.read('{"last_seq": 7, "unknown": 1, "runs": null}')
    assert c == Cursor(7)
    for bad in ('{"last_seq": "7"}', '{"last_seq": true}', "{}"):
        with pytest.raises(ValueError):
            Cursor.read(bad)
    with pytest.raises(TypeError):
        FeedReceipt(object(), "k", 1, 1)
    receipt = store_feed(lambda: 10, "k", 9)
    moved = c.advance(receipt, NOW).advance(store_feed(lambda: 5, "k2", 9), NOW)
    assert (moved.last_seq, moved.month_bytes, moved.bytes_since_anchor) == (9, 15, 15)
    assert moved.advance(store_feed(lambda: 1, "k3", 10), NOW + dt.timedelta(days=40)).month_bytes == 1
    assert moved.with_anchor("2026-03-09").bytes_since_anchor == 0 and moved.with_watermark("b").with_watermark("a").osv_watermark == "b"
    with pytest.raises(ValueError):
        moved.advance(store_feed(lambda: 1, "k", 3), NOW)
    with pytest.raises(ValueError):
        Cursor.recover(99, moved)
    with pytest.raises(ValueError):
        moved.check_head(8)
    with pytest.raises(RuntimeError):
        store_feed(lambda: (_ for _ in ()).throw(RuntimeError("disk")), "k", 1)
    assert Cursor.read(moved.text()) == moved and dataclasses.is_dataclass(moved)


def test_writer_needs_a_guard_and_shards(spark):
    df = spark.createDataFrame([(k, "x" * 10) for k in range(25)], "n long, t string")
    with pytest.raises(TypeError):
        jsonl.write_jsonl(df, work_dir(spark, "w"))
    leak = spark.createDataFrame([(1, "ann@example.com")], "n long, t string")
    from registry_lens.functions import privacy

    with pytest.raises(Exception, match="refused by rule"):
        jsonl.write_jsonl(leak, work_dir(spark, "w"), privacy.gate)
    from registry_lens.config import Config

    def shards(config):
        path = work_dir(spark, "w")
        jsonl.write_jsonl(df.coalesce(1), path, jsonl.no_guard, config)
        return sorted(r["count"] for r in jsonl.read_lines(spark, path).groupBy("key").count().collect())

    assert shards(Config(shard_max_rows=10, shard_max_bytes=10**6)) == [5, 10, 10]
    assert shards(Config(shard_max_rows=10**6, shard_max_bytes=120)) == [1, 4, 4, 4, 4, 4, 4]
    assert shards(Config(shard_max_rows=10, shard_max_bytes=1)) == [1] * 25  # a row larger than a shard has one of its own
    path = work_dir(spark, "w")
    assert jsonl.write_once(df, path, jsonl.no_guard) and not jsonl.write_once(df, path, jsonl.no_guard)
    assert jsonl.read_lines(spark, path).count() == 25
