"""The training-data operators of the core: edge cases, replays and brute-force twins."""

from __future__ import annotations

import datetime as dt
import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from registry_lens.functions import bitmaps
from registry_lens.operators import dedup_store, history, late_events, nested, snapshot_diff
from registry_lens.session import work_dir
from registry_lens.streaming import change_feed

PACKAGES = "name string, snapshot_day string, delivered_at timestamp, maintainers string, latest_version string, security_holder string, entity string, period long"

def tracked():
    return [
        history.Tracked("maintainers", history.login_list("maintainers")),
        history.Tracked("latest_version", F.when(F.trim("latest_version") != "", F.col("latest_version"))),
        history.Tracked("security_holder", F.col("security_holder")),
    ]


def at(day: int, hour: int = 0) -> dt.datetime:
    return dt.datetime(2026, 3, day, hour)


def chains(spark, rows):
    df = spark.createDataFrame(rows, PACKAGES)
    out = history.attribute_history(df, work_dir(spark, "t"), "name", "snapshot_day", "delivered_at", tracked())
    return sorted((r["entity"], r["valid_from"], r["valid_to"], r["latest_version"], r["security_holder"]) for r in out.collect())


def test_history_late_and_corrected_rows(spark):
    rows = [
        ("a", "2026-03-02", at(3), '["x","y"]', "1.0", None, "clash", 1),
        ("a", "2026-03-03", at(4), '["y", "x", "x"]', "", None, None, None),  # nothing new
        ("a", "2026-03-04", at(5), None, "1.1", None, None, None),
        ("a", "2026-03-04", at(9), "[]", "1.2", None, None, None),  # correction, late
        ("a", "2026-03-03", at(8), '["x","y"]', "1.1", None, None, None),  # late
        ("b", "2026-03-05", at(6), "not json", None, "suspected", None, None),
        ("b", "2026-03-06", at(7), None, None, None, None, None),
        (None, "2026-03-06", at(7), None, None, None, None, None),
        ("z", "someday", None, '["q"]', "z" * 20000, "", None, None),
        ("c", None, at(7), None, None, None, None, None),
    ]
    assert chains(spark, rows + rows) == [
        ("a", "2026-03-02", "2026-03-03", "1.0", None),
        ("a", "2026-03-03", "2026-03-04", "1.1", None),
        ("a", "2026-03-04", None, "1.2", None),
        ("b", "2026-03-05", None, None, "suspected"),
        ("z", "someday", None, "z" * 20000, ""),
    ]


def test_history_empty_and_incremental_equals_full(spark):
    assert chains(spark, []) == []
    r = random.Random(3)
    rows = [
        (r.choice("abcd"), f"2026-03-{r.randint(2, 12):02d}", at(r.randint(2, 20), r.randint(0, 23)), r.choice([None, "[]", '["m"]', '["n","m"]']), r.choice([None, "", "1", "2"]), r.choice([None, "suspected"]), None, None)
        for _ in range(200)
    ]
    df = spark.createDataFrame(rows, PACKAGES)
    normal = history.normalise(df, "name", "snapshot_day", "delivered_at", tracked())
    store = history.ChainStore(spark, work_dir(spark, "inc"), buckets=3)
    for k in range(3):
        store.apply(normal.where(F.pmod(F.xxhash64("arrived"), F.lit(3)) == k))
    key = lambda x: tuple(map(str, x))
    columns = ["entity", "valid_from", "valid_to", "maintainers", "latest_version", "security_holder"]
    got = sorted((tuple(x) for x in store.read().select(*columns).collect()), key=key)
    assert got == sorted((tuple(x) for x in history.build_chains(normal).select(*columns).collect()), key=key)
    # a reader that opens the store anew sees the same version; the untouched chains stay in their generation
    again = history.ChainStore(spark, store.path)
    assert again.buckets == 3 and again.read().count() == len(got)


def test_history_two_writers_and_compaction(spark, monkeypatch):
    rows = [(e, f"2026-03-{d:02d}", at(d), '["m"]', str((d * k) % 3), None, None, None) for k, e in enumerate("abcdef") for d in range(2, 8)]
    normal = history.normalise(spark.createDataFrame(rows, PACKAGES), "name", "snapshot_day", "delivered_at", tracked())
    part = lambda n: normal.where(F.pmod(F.dayofmonth("arrived"), F.lit(3)) == n)
    one = history.ChainStore(spark, work_dir(spark, "writers"), buckets=2)
    one.apply(part(0))
    two = history.ChainStore(spark, one.path)
    seen = two._manifest()
    one.apply(part(1))
    with monkeypatch.context() as m:
        m.setattr(two, "_manifest", lambda: seen)  # began before the other ended
        with pytest.raises(FileExistsError):
            two.apply(part(2))
    read = lambda s: sorted(map(str, s.read().collect()))
    want = sorted(map(str, history.build_chains(part(0).unionByName(part(1))).select(one.read().columns).collect()))
    assert read(one) == want == read(two)
    monkeypatch.setattr(history, "MOST_GENERATIONS", 2)
    two.apply(part(2).where("entity in ('a', 'b')"))  # the third generation: compacted
    assert len(two._manifest()["generations"]) == 1
    want = sorted(map(str, history.build_chains(part(0).unionByName(part(1)).unionByName(part(2).where("entity in ('a', 'b')"))).select(one.read().columns).collect()))
    assert read(two) == want and two.vacuum() > 0 and two.vacuum() == 0 and read(two) == want
    two.apply(part(2))
    assert len(read(two)) >= len(want) and two.compact() == two.compact()


SNAP = "run string, name string, delivered_at timestamp, outcome string, times array<struct<v:string,t:bigint>>, missing array<struct<v:string,t:bigint>>, maintainerHashes array<string>, container long"


def changes(spark, rows):
    df = spark.createDataFrame(rows, SNAP)
    out = snapshot_diff.snapshot_changes(df, "run", "name", "delivered_at", ["times", "missing", "maintainerHashes"], ~F.coalesce(F.col("outcome").isin("error", "too_large"), F.lit(False)))
    return sorted(tuple(r) for r in out.collect())


def test_snapshot_changes(spark):
    t = lambda *v: [(x, 1) for x in v]
    rows = [
        ("r1", "a", at(2), "ok", t("1", "2"), None, ["h"], 7),
        ("r1", "gone", at(2), "ok", t("1"), None, None, None),
        ("r1", "err", at(2), "ok", t("1"), None, None, None),
        ("r2", "a", at(3), "ok", t("2", "1", "1"), [], ["h", "h"], None),  # the same sets
        ("r2", "err", at(3), "error", None, None, None, None),  # keeps what it had
        ("r2", "new", at(3), "too_large", None, None, None, None),
        ("r3", "a", at(4), "ok", t("9"), None, ["h"], None),
        ("r3", "a", at(5), "ok", t("1", "2", "3"), None, ["h"], None),  # delivered last
        ("r3", "err", at(4), "ok", t("1"), None, None, None),
        ("r3", "new", at(4), "ok", None, None, ["k"], None),
        ("r3", None, at(4), "ok", None, None, ["k"], None),
        (None, "x", at(4), "ok", None, None, ["k"], None),
    ]
    assert changes(spark, rows + rows) == [("r2", "gone", "removed"), ("r2", "new", "added"), ("r3", "a", "changed"), ("r3", "new", "changed")]
    assert changes(spark, rows[:3]) == [] and changes(spark, []) == []


def test_snapshot_brute_force_and_persistent_ordinals(spark):
    r = random.Random(5)
    rows, state = [], {}
    for k in range(4):
        for n in range(120):
            if r.random() < 0.8:
                state[f"r{k}", f"p{n}"] = (r.choice(["ok", "ok", "error"]), tuple(sorted({r.choice("abc") for _ in range(2)})))
    rows = [(run, n, at(2), o, None, None, list(h) if o == "ok" else None, None) for (run, n), (o, h) in state.items()]
    want, before = set(), {}
    for k in range(4):
        now = {}
        for (run, n), (o, h) in state.items():
            if run == f"r{k}":
                now[n] = h if o == "ok" else before.get(n, ())
        if k:
            want |= {(f"r{k}", n, "added") for n in now.keys() - before.keys()} | {(f"r{k}", n, "removed") for n in before.keys() - now.keys()}
            want |= {(f"r{k}", n, "changed") for n in now.keys() & before.keys() if now[n] != before[n]}
        before = now
    assert changes(spark, rows) == sorted(want)
    d = snapshot_diff.OrdinalDictionary(spark, work_dir(spark, "ord"))
    first = {r["key"]: (r["container"], r["position"]) for r in d.extend(spark.createDataFrame([(f"k{n}",) for n in range(50)], "key string")).collect()}
    then = {r["key"]: (r["container"], r["position"]) for r in d.extend(spark.createDataFrame([(f"k{n}",) for n in range(30, 90)], "key string")).collect()}
    assert all(then[k] == v for k, v in first.items()) and len(set(then.values())) == 90


def test_a_dictionary_grown_a_thousandfold(spark, monkeypatch):
    monkeypatch.setattr(snapshot_diff, "BUCKET_KEYS", 8)
    d = snapshot_diff.OrdinalDictionary(spark, work_dir(spark, "ord"))
    keys = lambda n: spark.range(n).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    first = {r["key"]: (r["container"], r["position"]) for r in d.extend(keys(3)).collect()}
    then = {r["key"]: (r["container"], r["position"]) for r in d.extend(keys(3000)).collect()}
    assert all(then[k] == v for k, v in first.items()) and len(set(then.values())) == 3000
    sizes = [r["count"] for r in d.read().groupBy("bucket").count().collect()]
    assert len(sizes) > 300 and max(sizes) < 40


def test_a_container_that_snapshots_lack():
    runs = ["r1", "r2", "r3", "r4", "r5"]
    row = lambda keys, known, value: {"present": bitmaps.encode(np.array(keys), snapshot_diff.CONTAINER), "known": bitmaps.encode(np.array(known), snapshot_diff.CONTAINER), "v0": np.full(10, value, dtype=np.int64).tobytes()}
    box = snapshot_diff._Container(4, runs, 1)
    got = [*box.add(0, row([1, 2, 3], [1, 2, 3], 7)), *box.add(2, row([2, 3], [2], 7)), *box.add(3, row([2, 3], [3], 8)), *box.upto(5)]
    assert sorted((b["run"][0].as_py(), b["change"][0].as_py(), b["position"].to_pylist()) for b in got) == [
        ("r2", "removed", [1, 2, 3]), ("r3", "added", [2, 3]), ("r4", "changed", [3]), ("r5", "removed", [2, 3]),
    ]


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 999)), st.sets(st.integers(0, 999)))
def test_bitmaps(a, b):
    size = 1000
    x, y = (bitmaps.words(bitmaps.encode(np.array(sorted(s), dtype=np.int64), size), size) for s in (a, b))
    assert set(bitmaps.positions(x & ~y, size).tolist()) == a - b
    assert set(bitmaps.positions(x & y, size).tolist()) == a & b


FEED = "seq long, id string, changes array<struct<rev string>>, feedDeleted boolean, is_dead int, op string, latest_version string, maintainers array<string>, batch_no int, key string"


def test_change_feed_order_repeats_and_resume(spark):
    path, root = work_dir(spark, "feed-in"), work_dir(spark, "feed-out")
    row = lambda seq, name, op=None, flag=None, dead=None, v="1": (seq, name, [("r",)], flag, dead, op, v, ["m"], 0, "clash")
    first = [row(5, "a", v="5"), row(3, "a", "delete"), row(4, "b", " Deleted "), row(2, "b", "update"), row(7, "c", dead=1), row(8, "d", flag=True), row(None, "e"), row(9, None), row(1, "f", "frobnicate")]
    spark.createDataFrame(first + first, FEED).write.parquet(f"{path}/one.parquet")
    read = lambda df: sorted((r["key"], r["seq"], r["payload"]["latest_version"]) for r in df.where("not tombstone").collect())
    assert read(change_feed.apply_feed(spark, path + "/one.parquet", root)) == [("a", 5, "5"), ("f", 1, "1")]
    # later files: an older change of a, b comes back, f dies; the last sequence seen twice with and without its mark
    spark.createDataFrame([row(4, "a", v="old"), row(6, "b", "upsert", v="6"), row(10, "f"), row(10, "f", "d")], FEED).write.mode("append").parquet(f"{path}/one.parquet")
    assert read(change_feed.apply_feed(spark, path + "/one.parquet", root)) == [("a", 5, "5"), ("b", 6, "6")]
    state = change_feed.apply_feed(spark, path + "/one.parquet", root)
    for _ in range(2):
        change_feed.compact_state(spark, f"{root}/upserts", state.schema)
        assert read(change_feed.read_state(spark, f"{root}/upserts", state.schema)) == [("a", 5, "5"), ("b", 6, "6")]
    spark.createDataFrame([row(11, "a", "d"), row(12, "g")], FEED).write.mode("append").parquet(f"{path}/one.parquet")
    assert read(change_feed.apply_feed(spark, path + "/one.parquet", root)) == [("b", 6, "6"), ("g", 12, "1")]
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    batch = change_feed.newest_state(change_feed.change_rows(spark.read.parquet(f"{path}/one.parquet").where("seq is null or seq < 11"))).where("not change.tombstone")
    assert sorted((r["key"], r["change"]["seq"]) for r in batch.collect()) == [("a", 5), ("b", 6)]


def test_upsert_is_idempotent(spark):
    root = work_dir(spark, "ups")
    rows = change_feed.newest_state(change_feed.change_rows(spark.createDataFrame([(1, "a", None, None, None, "i", "1", None, 0, "")], FEED)))
    write = change_feed.upsert_writer(root)
    write(rows, 0), write(rows, 0), write(rows, 1)
    assert change_feed.read_state(spark, root, rows.select("key", "change.*").schema).count() == 1


EVENTS = "id string, kind string, at long, observed_at string, backfill int, event_day string, seen_us long"


def test_late_events(spark):
    s = 1772582400  # 2026-03-04 00:00 UTC
    rows = [
        ("on", "publish", s + 10, "2026-03-04T23:59:59Z", 0, "x", 1),
        ("late", "publish", s + 10, "2026-03-05T00:00:00.000Z", 0, None, None),
        ("edge", "publish", s, "2026-03-07T00:00:00Z", None, None, None),  # exactly 72 h
        ("over", "publish", s, "2026-03-07T00:00:00.001Z", 0, None, None),
        ("zone", "publish", s + 10, "2026-03-05T02:00:00+05:00", 0, None, None),  # still the 4th in UTC
        ("bare", "publish", s + 10, "2026-03-05T02:00:00", 0, None, None),
        ("twice", "publish", s, "2026-03-09T00:00:00Z", 0, None, None),
        ("twice", "publish", s, "2026-03-04T01:00:00Z", 0, None, None),
        ("back", "publish", s, "2026-03-05T01:00:00Z", 1, None, None),
        ("early", "publish", s + 86400, "2026-03-04T01:00:00Z", 0, None, None),
        (None, "publish", s, "2026-03-05T01:00:00Z", 0, None, None),
        ("no at", "publish", None, "2026-03-05T01:00:00Z", 0, None, None),
        ("bad", "publish", s, "never", 0, None, None),
    ]
    df = spark.createDataFrame(rows + rows, EVENTS)
    got = {r["id"]: r["verdict"] for r in late_events.classify(df).collect()}
    assert got == {"on": "on_time", "late": "corrects", "edge": "corrects", "over": "too_late", "zone": "on_time", "bare": "corrects", "twice": "on_time", "early": "on_time"}
    tri = [(str(r["event_day"]), str(r["arrival_day"]), r["added"], r["total"], r["revision"], r["is_last"]) for r in late_events.revisions(df).orderBy("event_day", "arrival_day").collect()]
    assert tri == [("2026-03-04", "2026-03-04", 3, 3, 1, False), ("2026-03-04", "2026-03-05", 2, 5, 2, False), ("2026-03-04", "2026-03-07", 1, 6, 3, True), ("2026-03-05", "2026-03-05", 1, 1, 1, True)]
    assert late_events.revisions(df.limit(0)).count() == 0


def _naive_versions(raw):
    try:
        doc = json.loads(raw)
    except (TypeError, ValueError):
        return set()
    gone = doc.get("time") if isinstance(doc, dict) else None
    gone = gone.get("unpublished") if isinstance(gone, dict) else None
    if not isinstance(gone, dict):
        return set()
    v, by = gone.get("versions"), gone.get("name")
    names = [v] if isinstance(v, str) else list(v) if isinstance(v, dict) else [x if isinstance(x, str) else x.get("version") if isinstance(x, dict) else None for x in v] if isinstance(v, list) else []
    return {(n, by if isinstance(by, str) else "") for n in names if isinstance(n, str) and n}


NASTY = [
    '{"time":{"unpublished":{"versions":["1",null,"","1",2],"name":"me"}}}',
    ' {"readme":"\\"time\\":{\\"unpublished\\":{\\"versions\\":[\\"9\\"]}}","time" : {"unpublished" :{"versions":{"1.0":{"version":"x"},"a\\"b":{}}}}}',
    '{"time":{"unpublished":{"versions":[{"version":"1","deps":{"version":"no"}},{"v":{"version":"2"}},["3"],{"version":["4"]}],"name":null}}}',
    '{"time":{"unpublished":{"versions":"0.0.1","name":""}}}', '{"time":{"unpublished":null}}', '{"time":[{"unpublished":{"versions":["1"]}}]}', '[{"time":{"unpublished":{"versions":["1"]}}}]', "null", "", "   ", "{}", '{"time":{"unpublished":{"versions":["1"]}}',
    '{"time":{"unpublished":{"versions":["1"]}}} x', '{"time":{"unpublished":{"versions":["1"],}}}', '{"time":{"unpublished":{"versions":["1"]}},"time":{"unpublished":{"versions":["2"]}}}',
    '{"x":"\\\\","time":{"unpublished":{"name":"\\u00e9\\n","versions":["\\u0031","ü","\\\\"]}}}', '{"ti\\u006de":{"unpublished":{"versions":["1"]}}}', '{"a":{"time":{"unpublished":{"versions":["1"]}}}}', '{"time":{"unpublished":{"versions":[]}},"n":NaN}',
    '{"time":{"unpublished":{"versions":{}}}}', '{"mytime":{"unpublished":{"versions":["1"]}}}', '{"time":{"unpublished":{"versions":["' + "7" * 50000 + '"]}}}',
]


def test_nested_against_parser(spark):
    rows = [(k, raw, "clash") for k, raw in enumerate([*NASTY, None])]
    df = spark.createDataFrame(rows + rows[:5], "rec_id long, raw string, version string")
    got = {}
    for r in nested.unpublished_versions(df).collect():
        got.setdefault(r["rec_id"], set()).add((r["version"], r["by_name"]))
    want = {k: v for k, raw, _ in rows if (v := _naive_versions(raw))}
    assert got == want
    docs = nested.document_rows(df).collect()
    assert len(docs) == len(rows) and sum(r["usable"] for r in docs) == 14
    assert nested.flatten_documents(df.limit(0)).count() == 0


json_values = st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=6), lambda c: st.lists(c, max_size=3) | st.dictionaries(st.sampled_from(["time", "unpublished", "versions", "name", "version", 'a"b', "\\"]), c, max_size=4), max_leaves=12)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(json_values, st.booleans(), st.booleans()), max_size=6))
def test_nested_property(items):
    raws = []
    for value, escaped, wrap in items:
        value = {"time": {"unpublished": value}} if wrap else value
        raws.append(json.dumps(value, ensure_ascii=escaped).encode())
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raws]))).astype(np.int64)
    rows = nested._block_rows(np.frombuffer(b"".join(raws), dtype=np.uint8), offsets, list(range(len(raws))))
    for k, raw in enumerate(raws):
        assert {(r[6], r[3]) for r in rows if r[0] == k and r[6] is not None} == _naive_versions(raw)


def test_nested_beyond_the_parsers_depth():
    def document(depth, inner="", tail=""):
        return '{"x":' + '[{"y":' * (depth // 2) + f'[1, "]{{", null{inner}]' + "}]" * (depth // 2) + tail + ',"time":{"unpublished":{"name":"n","versions":["1","2"]}}}'

    good = [document(depth) for depth in (998, 1000, 9000, 20_000, 100_001)]
    bad = [document(20_000, ","), document(20_000, " 1"), document(20_000, ", NaN"), document(20_000, tail="1"), document(20_000)[:-1], document(20_000).replace("}]}]", "}]1}]", 1), document(20_000).replace("}]", "]]", 1), document(20_000) + "}{"]
    raws = [x.encode() for x in good + bad]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raws]))).astype(np.int64)
    rows = nested._block_rows(np.frombuffer(b"".join(raws), dtype=np.uint8), offsets, list(range(len(raws))))
    for k in range(len(raws)):
        assert [r[1:] for r in rows if r[0] == k] == ([(True, None, "n", 2, None, None), (True, None, "n", 2, 0, "1"), (True, None, "n", 2, 1, "2")] if k < len(good) else [(False, None, "", 0, None, None)])
    at_cut = "[" * 1000 + "{}%s[]" + "]" * 1000
    assert valid([at_cut % x for x in (",", "", "1", ",1", ":")]) == [True, False, False, False, False]


def valid(texts):
    raws = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raws]))).astype(np.int64)
    return nested.StructuralIndex(np.frombuffer(b"".join(raws), dtype=np.uint8), offsets).valid().tolist()


def parses(text):
    def no(constant):
        raise ValueError(constant)

    try:
        json.loads(text, parse_constant=no)
        return True
    except ValueError:
        return False


LITERALS = ["", " ", "1", "-1", "01", "1.", ".5", "-", "1e5", "1E+", "1e-07", "+1", "true", "True", "nul", "null", "NaN", "Infinity", "-Infinity", '"a', '"', '"\\"', '"\\u12G4"', '"\\u1234"', '"\\u12"', '"\\x"', '"\n"', '"\t"', '"\x7f"', '"é"', "[1 2]", "[1,]", "[,1]", "[]", "[[]", "]", "[}", "{]", '{"a"}', '{"a":}', '{"a":1,}', '{,}', '{"a":1 "b":2}', '{1:2}', '{"a":1:2}', '{"a" "b"}', '["a":1]', '{"a":{"b":[{}]}}', "1 2", "{}{}", "[] ,", ":", ",", "\\", "a", '"a" "b"', '{"a":"b"}', '[{"a":[1,{"b":null}]},"x"]', '{"a":[}]', "[{]}", "][", "\ufeff{}"]


def test_validity_from_the_index():
    assert valid(LITERALS) == [parses(t) for t in LITERALS]  # side by side in one block
    assert [valid([t])[0] for t in LITERALS] == [parses(t) for t in LITERALS]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(json_values, st.text(alphabet='{}[],:"\\u0aten1. -', max_size=3), st.integers(0, 40), st.booleans()), max_size=6))
def test_validity_property(items):
    """Texts with a stretch put in, or a character dropped, anywhere."""
    texts = []
    for value, more, at_, drop in items:
        t = json.dumps(value, ensure_ascii=False)
        k = at_ % (len(t) + 1)
        texts.append(t[:k] + more + t[k + drop :])
    assert valid(texts) == [parses(t) for t in texts]


def test_paths(spark):
    raws = [
        {"a": [{"b": [1, "x", None]}, {"b": []}, 3, {"c": 1, "b": ["y", {"z": True}]}], "m": {"k1": {"v": "p"}, "k2": {"w": 1}, "k3": {"v": [1, 2]}}, "s": "top"},
        {"a": {"b": 1}, "m": [], "s": 5},
        [1],
        {},
    ]
    df = spark.createDataFrame([(k, json.dumps(r), "clash") for k, r in enumerate(raws)] + [(9, '{"s":', "c"), (10, None, None), (0, json.dumps(raws[0]), "clash")], "rec_id long, raw string, path string")
    got = {tuple(r) for r in nested.flatten_paths(df, ["s", "a[].b[]", "m{}.v", "m{}", "[]", "a[].b[].z"]).collect()}
    assert got == {
        (0, "s", "", None, "top"), (1, "s", "", None, "5"), (0, "a[].b[]", "0.0", None, "1"), (0, "a[].b[]", "0.1", None, "x"), (0, "a[].b[]", "0.2", None, None), (0, "a[].b[]", "3.0", None, "y"), (0, "a[].b[]", "3.1", None, '{"z": true}'),
        (0, "m{}.v", "0", "k1", "p"), (0, "m{}.v", "2", "k3", "[1, 2]"), (0, "m{}", "0", "k1", '{"v": "p"}'), (0, "m{}", "1", "k2", '{"w": 1}'), (0, "m{}", "2", "k3", '{"v": [1, 2]}'), (0, "a[].b[].z", "3.1", None, "true"),
    }
    assert nested.flatten_paths(df.limit(0), ["s"]).count() == 0
    parents, children = nested.linked_tables(spark.createDataFrame([(1, '{"time":{"unpublished":{"versions":["2","1","2"]}}}'), (2, "x")], "rec_id long, raw string"))
    assert sorted(tuple(r) for r in children.collect()) == [(1, 0, "2", ""), (1, 1, "1", "")] and parents.count() == 2


OBS = "name string, run_id string, rev string, batch_id int, delivered_at timestamp, copies long, body string, extra map<string,string>"


def test_deliveries_collapse(spark):
    run = "2026-03-02T07-15-09Z"
    spelled = [(" @s/a\n", run), ("@s%2Fa", "2026-03-02T07:15:09.000Z"), ("%40s%2fa", " 2026-03-02t07-15-09z ")]
    rows = [(n, x, "1-a", k, at(2, k), 5, "b", {"k": "v"}) for k, (n, x) in enumerate(spelled)]
    rows += [("@s/a", run, None, 150, at(4), None, None, None), ("@s/a", run, "", None, at(3), None, None, None), ("one", run, "1-a", 3, None, None, None, None), (None, None, None, 3, at(2), None, None, None)]
    df = spark.createDataFrame(rows, OBS)
    got = sorted((r["name"], r["run_id"], r["rev"], r["copies"], r["body"]["delivered_at"]) for r in dedup_store.collapse_deliveries(df, work_dir(spark, "m")).collect())
    assert got == [("", "", "", 1, at(2)), ("@s/a", run, "", 2, at(3)), ("@s/a", run, "1-a", 3, at(2)), ("one", run, "1-a", 1, None)]
    assert dedup_store.collapse_deliveries(df.limit(0), work_dir(spark, "m")).count() == 0


def messages(spark, *rows):
    """(k, batch, v) as deliveries."""
    return spark.createDataFrame([(k, b, at(2), v) for k, b, v in rows], "k string, b long, delivered_at timestamp, v string")


def upsert(store, df, groups=1):
    return store.upsert(df, F.col("b"), F.unix_micros(F.col("delivered_at").cast("timestamp")), groups)


def stored(df):
    return sorted((r["k"], r["copies"]) for r in df.collect())


def test_store_takes_every_batch_once_and_merges_without_sort_or_shuffle(spark):
    path = work_dir(spark, "s")
    store = dedup_store.MessageStore(spark, path, ["k"], buckets=4)
    first = messages(spark, ("a", 1, "1"), ("b", 1, "1"), ("a", 1, "1"), ("c", 2, "1"), (None, 2, "1"))
    assert [upsert(store, first, 3) for _ in range(2)] == [2, 0]  # delivered twice
    assert upsert(store, messages(spark, ("a", 3, "0"), ("d", 3, "2"), ("b", 1, "again"))) == 1  # of it batch 1 is there already
    want = [("a", 3), ("b", 1), ("c", 1), ("d", 1)]
    merged = store.merged()
    assert stored(merged.where("k is not null")) == want and merged.where("k is null").count() == 1
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Aggregate" not in plan
    assert stored(store.compact().where("k is not null")) == want
    assert upsert(store, first) == 0  # compacted already
    again = dedup_store.MessageStore(spark, path, ["k"])
    assert upsert(again, messages(spark, ("a", 9, "9"), ("e", 9, "9"))) == 1
    assert stored(again.merged().where("k is not null")) == [("a", 4), *want[1:], ("e", 1)]
    assert stored(again.compact().where("k is not null")) == [("a", 4), *want[1:], ("e", 1)]
    assert again.vacuum() > 0 and again.vacuum() == 0 and again.read().count() == 6
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("rl_")]


def test_store_keeps_order_and_splits_grown_buckets(spark, monkeypatch):
    monkeypatch.setattr(dedup_store, "BUCKET_ROWS", 100)
    store = dedup_store.MessageStore(spark, work_dir(spark, "s"), ["k"], buckets=2)
    numbers = lambda a, b, batch: spark.range(a, b).select(F.col("id").cast("string").alias("k"), F.lit(batch).cast("long").alias("b"), F.lit(at(2)).alias("delivered_at"), F.lit("v").alias("v"))
    upsert(store, numbers(0, 500, 1).unionByName(numbers(300, 900, 2)), 2)
    rows = store.compact()
    assert store.buckets > 2 and rows.count() == 900 and rows.where("copies = 2").count() == 200
    upsert(store, numbers(800, 1000, 3))
    rows = store.compact()
    assert rows.count() == 1000 and rows.where("copies = 2").count() == 300
    hashes = spark.read.parquet(f"{store.path}/{store.base}").select(F.input_file_name().alias("p"), "__h").collect()
    by_part = {}
    for r in hashes:
        by_part.setdefault(r["p"], []).append(r["__h"])
    assert len(by_part) > 1 and all(h == sorted(h) for h in by_part.values())


def test_merging_sorted_files(tmp_path):
    """Stretches far shorter than the files, ties in order, and different identifiers of one hash."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    r = np.random.default_rng(3)
    schema = pa.schema([("__h", pa.int64()), ("k", pa.string()), ("copies", pa.int64()), ("__at", pa.int64()), ("__tie", pa.int64()), ("body", pa.string())])
    files, want = [], {}
    for n in range(4):
        rows = []
        for k in sorted(set(r.integers(0, 400, 300).tolist())):
            name = None if k == 7 else f"k{k}"
            row = (k // 3 - 50, name, int(r.integers(1, 4)), int(r.integers(0, 3)), int(r.integers(0, 3)), f"{n}-{k}")
            rows.append(row)
            copies, best = want.get(name, (0, None))
            want[name] = (copies + row[2], min(best or (row[3], row[4]), (row[3], row[4])))
        rows.sort(key=lambda x: (x[0], r.random()))  # of one hash in any order
        files.append(str(tmp_path / f"{n}.parquet"))
        pq.write_table(pa.table([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema), files[-1], row_group_size=50)
    for stretch in (1, 7, 64, 10_000):
        out = pa.concat_tables(list(dedup_store.merge_files(files, ["k"], schema, stretch))).to_pylist()
        assert {x["k"]: (x["copies"], (x["__at"], x["__tie"])) for x in out} == want and len(out) == len(want)
        assert [x["__h"] for x in out] == sorted(x["__h"] for x in out)
    assert list(dedup_store.merge_files([], ["k"], schema)) == []


@pytest.mark.parametrize("query", ["p1_found", "p2_found", "p3_found", "p4_found", "p5_found", "p5_paths", "p7_found"])
def test_found_queries_against_sql(spark, smallest, query):
    import os

    import duckdb

    from registry_lens.plans import pipeline

    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    for f in os.listdir(smallest):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{smallest}/{f}'")
    df = pipeline.QUERIES[query](spark, smallest)
    got = sorted(map(str, (tuple(r) for r in df.collect())))
    want = con.execute(f"select {', '.join(df.columns)} from ({pipeline.ORACLES[query]})").fetchall()
    assert got and got == sorted(map(str, want))
