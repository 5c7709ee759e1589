"""Registry operators on literals, and every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import hashlib
import json
import os
import random

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from registry_lens.functions import documents as docs
from registry_lens.functions import privacy, scalars
from registry_lens.operators import budget, derive, digest, index, mirror, observe, similarity
from registry_lens.plans import reference

SALT = "sixteen characters and more"
NOW = 1772712000  # 2026-03-05 12:00 UTC


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'long' if isinstance(v, int) else 'string'}" for k, v in values.items()))
    return df.select(column.alias("x")).first()[0]


# scalars and privacy


def test_scalars(spark):
    s = lambda c, v: one(spark, c, a=v)
    assert s(scalars.epoch("a"), "2026-03-05T12:00:00.999Z") == NOW and s(scalars.epoch("a"), "soon") is None
    assert s(scalars.rev_int("a"), "12-ab") == 12 and s(scalars.rev_int("a"), "x-1") is None and s(scalars.rev_int("a"), "99999999999999999999-a") is None
    assert s(scalars.normalize_name("a"), "@Scope/Co-re.rn_vv10") == "@scope/corem" + "wlo"
    assert s(scalars.scope_of("a"), "@s/x") == "s" and s(scalars.scope_of("a"), "x") is None
    assert s(scalars.repo_host("a"), "git+https://Git.Example.com/a.git") == "git.example.com" and s(scalars.repo_host("a"), "git://h.example/a") == "h.example" and s(scalars.repo_host("a"), "not a url") is None
    assert s(scalars.encode_key("a"), "@s/a b*") == "%40s%2Fa%20b%2A"
    assert s(scalars.run_instant("a"), "2026-03-05T12-00-00Z") == NOW and s(scalars.date_path("a"), "2026-03-05T12-00-00Z") == "2026/03/05"
    assert s(scalars.round_half_up(F.lit(-0.5)), "x") == 0
    assert s(scalars.hash_email("a", SALT), " Ann@Example.com ") == s(scalars.hash_email("a", SALT), "ann@example.com")
    with pytest.raises(ValueError):
        scalars.hash_email("a", "short")


def osa(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_osa_distance(spark):
    r = random.Random(1)
    pairs = [("ca", "abc"), ("raect", "react"), ("", "ab"), ("ab", ""), ("", ""), ("a", "a")] + [("".join(r.choice("abc") for _ in range(r.randint(0, 7))), "".join(r.choice("abc") for _ in range(r.randint(0, 7)))) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", scalars.osa_distance("a", "b", 9).alias("d"), scalars.osa_distance("a", "b", 2).alias("c")).collect()
    for x in got:
        want = osa(x["a"], x["b"])
        assert x["d"] == min(want, 10) and x["c"] == min(want, 3)
    assert osa("ca", "abc") == 3


def test_redaction_and_gate(spark):
    texts = ["mail ann@example.com,bob@example.org now", "git@git.example.com:x.git", "x" * 70 + "@example.com", "two alice@example.com bob@example.org", "", None, "mailto:someone", "no address", '{"contactEmail": null}']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = [r[0] for r in df.select(privacy.redact("t", SALT)).collect()]
    assert out[1] == texts[1] and out[4] == "" and out[5] is None and out[7] == texts[7] and "@" not in out[0] and out[0].count("h:") == 2 and out[2].startswith("x" * 6)
    clean = spark.createDataFrame([(t,) for t in out], "t string")
    assert {r[0] for r in clean.select(privacy.gate_violation("t")).collect()} == {None, "mailto"}
    assert [r[0] for r in df.select(privacy.gate_violation("t", strict=True)).collect()] == ["address", None, "address", "address", None, None, "mailto", None, "key"]
    assert df.select(privacy.scrub("t")).first()[0] == "mail [address removed],[address removed] now"
    good, bad = privacy.quarantine(df)
    assert good.count() + bad.count() == len(texts)
    nested = spark.createDataFrame([([("a@example.com", {"b@example.com": "c@example.com"})],)], "x array<struct<s:string,m:map<string,string>>>")
    assert "@" not in str(privacy.redact_columns(nested, SALT).first())
    raw = spark.createDataFrame([('{"a@example.com":["x\\na@example.com",1,null],"t":"\\u0061@example.com"}',), ("broken a@example.com",), (None,)], "t string")
    clean, text, none = [r[0] for r in raw.select(privacy.redact_json("t", SALT, marker=True)).collect()]
    assert "@" not in clean + text and none is None and list(json.loads(clean))[-1] == "_addresses_redacted" and json.loads(clean)["t"] == one(spark, scalars.hash_email("a", SALT), a="a@example.com")
    with pytest.raises(privacy.LeakError) as e:
        privacy.check_text("write to ann@example.com today")
    assert "ann@" not in str(e.value) and e.value.rule == "address"
    assert privacy.check_text("git@git.example.com") and privacy.check_text("mailto:h:" + "0" * 32)


# documents and observations


def observe_docs(spark, *given, now=NOW):
    rows = [("r", f"n{k}", k, "3-a", False, now, 200 if d is not None else 404, json.dumps(d) if isinstance(d, dict) else d) for k, d in enumerate(given)]
    df = spark.createDataFrame(rows, "run string, name string, seq long, rev string, feed_deleted boolean, now long, status int, raw string")
    return [r.asDict() for r in observe.observations(df, SALT).orderBy("seq").collect()]


def test_observations(spark):
    iso = lambda s: __import__("datetime").datetime.fromtimestamp(s, __import__("datetime").timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    live = {"name": "a", "_rev": "3-a", "time": {"created": iso(NOW - 9), "modified": iso(NOW), "1.0.0": iso(NOW - 90), "1.1.0": iso(NOW - 60), "2.0.0": "junk", "3.0.0": iso(NOW + 7200)}, "versions": {"1.1.0": {"scripts": {"postinstall": "x", "install": ""}, "dependencies": {"q": "1"}, "license": {"type": "MIT"}, "dist": {"shasum": "s", "unpackedSize": 5}}, "3.0.0": {}}, "dist-tags": {"latest": "1.1.0", "odd": 3}, "maintainers": [{"name": "z", "email": "z@example.com"}, {"name": "b"}, "text", None]}
    dead = {"name": "d", "time": {"created": iso(NOW - 900), "1.0.0": iso(NOW - 800), "unpublished": {"time": iso(NOW - 5), "name": "z", "versions": ["1.0.0"]}}}
    holder = {"name": "h", "dist-tags": {"latest": "0.0.1-security"}, "versions": {"0.0.1-security": {"repository": {"url": "git+https://github.com/npm/security-holder.git"}}}, "maintainers": [{"name": "npm", "email": "npm@npmjs.com"}], "time": {"0.0.1-security": iso(NOW)}}
    suspected = holder | {"maintainers": []}
    a, d, h, s, gone, broken, odd = observe_docs(spark, live, dead, holder, suspected, None, "{broken", {"time": 3, "versions": [], "maintainers": {}})
    assert (a["outcome"], a["version_count"], a["dist_tags"], a["maintainers"], a["missing_count"], a["recent_count"]) == ("ok", 2, {"latest": "1.1.0"}, ["b", "z"], 1, 1)
    assert [x["v"] for x in a["missing"]] == ["1.0.0"] and [x["v"] for x in a["times"]] == ["1.0.0", "1.1.0", "3.0.0"] and a["flags"] == ["new_package", "install_scripts", "version_unpublished"]
    detail = a["recent"][0]
    assert (detail["install_scripts"], detail["deps"], detail["license"], detail["shasum"], detail["unpacked_size"]) == (["postinstall"], 1, None, "s", 5) and len(a["maintainer_hashes"]) == 1
    assert (d["outcome"], d["tombstone"], d["unpublished_at"], d["unpublished_by"], d["missing_count"]) == ("tombstone", True, NOW - 5, "z", 0) and d["flags"] == ["new_package", "package_unpublished"]
    assert h["security_holder"] == "confirmed" and s["security_holder"] == "suspected" and "security_holder_confirmed" in h["flags"]
    assert (gone["outcome"], gone["flags"], gone["version_count"]) == ("gone", ["gone"], 0) and (broken["outcome"], broken["flags"]) == ("error", ["fetch_failed"])
    assert odd["outcome"] == "tombstone" and odd["maintainers"] == [] and odd["times"] == []


def test_retained(spark):
    raw = json.dumps({"name": "a", "versions": {}, "time": {}, "maintainers": [{"name": "z", "email": "z@example.com"}]})
    noise = json.dumps({"name": "c", "readme": random.Random(1).randbytes(600_000).hex()})
    rows = [("r", "a", "1-x", raw), ("r", "b", "1-x", raw), ("r", "c", "1-x", noise), ("r", "d", None, raw), ("r", "e", "1-x", None), ("r", "f", "1-x", json.dumps({"readme": "all the same " * 60_000}))]
    df = spark.createDataFrame(rows, "run string, name string, rev string, raw string")
    flagged = spark.createDataFrame([("r", n, ["truncated" if n == "b" else "package_unpublished"]) for n in "abcdef"], "run string, name string, flags array<string>")
    got = {r["name"]: r for r in observe.retained_rows(df, flagged, SALT).collect()}
    assert {n: r["verdict"] for n, r in got.items()} == {"a": "kept", "c": "too_large", "f": "kept"}  # f is large, but not when compressed
    assert "@" not in got["a"]["doc"] and got["a"]["sha256"] == hashlib.sha256(got["a"]["doc"].encode()).hexdigest()


def test_caps(spark):
    iso = lambda s: __import__("datetime").datetime.fromtimestamp(s, __import__("datetime").timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    names = [f"1.0.{k}" for k in range(1000)]
    churn = {"name": "c", "time": {v: iso(NOW - 5000 + k) for k, v in enumerate(names)}, "versions": {v: {} for k, v in enumerate(names) if k % 2}}
    (c,) = observe_docs(spark, churn)
    assert (len(c["times"]), c["times"][-1]["v"], c["missing_count"], len(c["missing"]), c["recent_count"], len(c["recent"]), c["truncated"]) == (100, "1.0.999", 500, 100, 500, 20, True)
    assert c["missing"][-1]["v"] == "1.0.998" and "truncated" in c["flags"]
    df = spark.createDataFrame([(["truncated"],), (["install_scripts"],), (["security_holder_suspected"],), ([],)], "f array<string>")
    assert [r[0] for r in df.select(docs.retain(F.col("f"))).collect()] == [False, True, True, False] and [r[0] for r in df.select(docs.retain(F.col("f"), soft=True)).collect()] == [False, False, True, False]


# events

OBS = "name string, run string, seq long, rev string, revInt long, fetchedAt string, status int, outcome string, created long, maintainers array<string>, maintainerHashes array<string>, times array<struct<v:string,t:bigint>>, missing array<struct<v:string,t:bigint>>, tombstone boolean, unpublishedAt long, flags array<string>, versionCount int, distTags map<string,string>, securityHolder string"


def obs(name, day, outcome="ok", rev=None, times=(), missing=(), hashes=("h1",), died=None, created=None, flags=()):
    return (name, f"2026-03-{day:02d}T00-00-00Z", day, f"{rev}-x" if rev else None, rev, f"2026-03-{day:02d}T00:00:00.000Z", 404 if outcome == "gone" else 200, outcome, created, ["m"], list(hashes), [(v, 1) for v in times], [(v, 1) for v in missing], died is not None, died, list(flags), len(times), {}, None)


def kinds(spark, rows):
    return sorted((r["kind"], r["name"], r["version"], r["backfill"]) for r in derive.derive_all(spark.createDataFrame(rows, OBS)).collect())


def test_derivation(spark):
    five = [f"1.0.{k}" for k in range(5)]
    assert kinds(spark, [obs("a", 1, times=five[:1]), obs("a", 2, times=five)]) == [("publish", "a", "1.0.0", True)] + [("publish", "a", v, False) for v in five[1:]]
    assert kinds(spark, [obs("a", 1, times=["x", "y"]), obs("a", 9, times=["y"])]) == [("publish", "a", "x", True), ("publish", "a", "y", True)]
    assert kinds(spark, [obs("a", 1, missing=["x"]), obs("a", 2, missing=["x"])]) == [("version_unpublish", "a", "x", True)]
    assert kinds(spark, [obs("a", 1), obs("a", 2, "error", hashes=()), obs("a", 3, hashes=["h2"])]) == [("maintainer_change", "a", None, False)]
    assert kinds(spark, [obs("a", 1, hashes=["p", "q"]), obs("a", 2, hashes=["q", "p", "p"]), obs("a", 3, hashes=[])]) == []
    assert kinds(spark, [obs("a", 1, rev=5), obs("a", 2, rev=9), obs("a", 3, rev=10)]) == [("rev_gap", "a", None, False)]
    assert kinds(spark, [obs("a", 1, "gone"), obs("a", 2, "gone")]) == [("gone", "a", None, True)]
    assert kinds(spark, [obs(None, 1, times=["x"])]) == [] and kinds(spark, []) == []
    died = 1772323200 - 86400 * 1500
    rows = [obs("a", d, "tombstone", died=died, created=died - 90 * 86400) for d in (1, 2, 3)]
    (event,) = derive.derive_all(spark.createDataFrame(rows, OBS)).collect()
    assert event["at"] == died and json.loads(event["detail"])["ageAtDeathDays"] == 90 and json.loads(event["detail"])["noticedAfterDays"] == 1500


def test_derivation_does_not_depend_on_row_order(spark):
    r = random.Random(2)
    rows = [obs(n, d, r.choice(["ok", "ok", "error", "gone", "tombstone"]), r.randint(1, 30), r.sample("abcde", 3), r.sample("xyz", 1), r.choice([["h1"], ["h2"]]), died=r.choice([None, 1772323200])) for n in "pqr" for d in range(1, 12)]
    want = kinds(spark, rows)
    for _ in range(2):
        r.shuffle(rows)
        assert kinds(spark, rows) == want


def test_folds(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), (None, 1, "n"), (None, 1, "n")], "k string, o int, v string")
    assert sorted(map(str, index.keep_last(df, ["k"], ["o"]).collect())) == sorted(map(str, [("a", 2, None), (None, 1, "n")])) or index.keep_last(df, ["k"], ["o"]).count() == 2
    assert index.keep_first(df, ["k"], ["o"]).where("k = 'a'").first()["v"] == "x"
    rows = [obs("a", 1, times=["1"]), obs("a", 2, "error"), obs("a", 2, "error"), obs("b", 1, "tombstone", died=5), obs("b", 2)]
    got = {r["name"]: r for r in index.fold_packages(spark.createDataFrame(rows, OBS)).collect()}
    assert (got["a"]["observations"], got["a"]["is_dead"], got["b"]["is_dead"], got["b"]["currently_dead"], got["b"]["unpublished_at"]) == (2, 0, 1, False, 5)


# similarity, report, mirror, budget


def test_parts_miss_no_pair_within_two_edits(spark):
    """Against all pairs of short texts, where transpositions across the parts' borders are frequent."""
    import itertools
    import random

    from registry_lens.functions.scalars import osa_distance

    r = random.Random(5)
    texts = sorted({"".join(r.choices("abc", k=r.randint(1, 7))) for _ in range(60)} | {"ab", "ba", "a", "abcdef", "bacdfe", "abdcef", "acbdfe"})
    all_pairs = spark.createDataFrame(list(itertools.product(texts, texts)), "name string, target string")
    want = {(x["name"], x["target"]) for x in all_pairs.where(osa_distance("name", "target", 2) <= 2).collect()}
    names = spark.createDataFrame([(t, 2) for t in texts], "name string, cutoff int")
    targets = spark.createDataFrame([(t,) for t in texts], "target string")
    assert want <= {tuple(x) for x in similarity.within_edits(names, targets).collect()}


def test_similarity(spark):
    popular = spark.createDataFrame([("react", 1), ("cross-env", 2), ("@babel/core", 3), ("abc", 4)], "target string, rank int")
    names = spark.createDataFrame([("raect",), ("crossenv",), ("@other/core",), ("react",), ("xyz",), ("reactxyz",), ("@babel/cores",), (None,), ("abd",)], "name string")
    got = {r["name"]: r for r in similarity.scores(names, popular).collect()}
    assert set(got) == {"raect", "crossenv", "@babel/cores", "abd"}
    assert got["raect"]["distance"] == 1 and got["crossenv"]["collision"] and got["@babel/cores"]["score"] == round(min(1, 0.7 * 2 / 3 + 0.3 * (1 - 3 / 5000) + 0.15), 3)
    assert similarity.scores(names.limit(0), popular).count() == 0


def test_report_of_an_empty_day(spark):
    events = spark.createDataFrame([], "id string, kind string, name string, version string, at long, observed_at string, backfill int, detail string")
    data = digest.collect("2026-03-05", events, spark.createDataFrame([], "name string, fetched_at string"), spark.createDataFrame([], "security_holder string"))
    markdown, _ = digest.render(data)
    assert "0 releases" in markdown and data["totals"]["packages_observed"] == 0
    with pytest.raises(ValueError):
        digest.Day("2026-3-5")


@settings(max_examples=10, deadline=None)
@given(st.integers(2, 40), st.integers(2, 12))
def test_sample_keeps_both_ends(spark, total, n):
    ids = [r[0] for r in mirror.sample_ends_stride(spark.range(total), "id", n).collect()]
    assert len(ids) == len(set(ids)) == min(total, n) and {0, total - 1} <= set(ids)


def test_tiers_and_sizes(spark):
    df = spark.createDataFrame([(1, 10), (75, 10), (92, 10), (50, 3001), (50, 50001)], "used long, queued long")
    got = budget.modes(budget.tiers(df, "used", 100), "queued").collect()
    assert [(r["tier"], r["mode"]) for r in got] == [("ok", "steady"), ("soft", "steady"), ("hard", "triage"), ("ok", "backlog"), ("ok", "triage")]
    assert budget.human_bytes(1234) == "1.2 kB" and budget.human_bytes(999) == "999 B" and budget.parse_ceiling(" ") == 10_000_000_000
    for bad in ("0", "-1", "inf", "nan"):
        with pytest.raises(ValueError):
            budget.parse_ceiling(bad)


# queries


@pytest.fixture(scope="module")
def con(smallest):
    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    for f in os.listdir(smallest):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{smallest}/{f}'")
    return con


@pytest.mark.parametrize("name", list(reference.ORACLES))
def test_query_against_sql(spark, smallest, con, name):
    df = reference.QUERIES[name](spark, smallest)
    norm = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    got = sorted(tuple(map(norm, r)) for r in df.collect())
    want = con.execute(f"select {', '.join(chr(34) + c + chr(34) for c in df.columns)} from ({reference.ORACLES[name]})").fetchall()
    assert got == sorted(tuple(map(norm, r)) for r in want)
