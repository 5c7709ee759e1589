"""Registered queries of the training-data problems that belong to the core, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry_lens.operators import dedup_store, history, late_events, nested, snapshot_diff
from registry_lens.session import table, work_dir
from registry_lens.streaming import change_feed


def p1_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracked = [
        history.Tracked("maintainers", history.login_list("maintainers")),
        history.Tracked("latest_version", F.when(F.trim("latest_version") != "", F.col("latest_version"))),
        history.Tracked("security_holder", F.when(F.trim("security_holder") != "", F.col("security_holder"))),
    ]
    chains = history.attribute_history(table(spark, sf_dir, "packages"), work_dir(spark, "history"), "name", "snapshot_day", "delivered_at", tracked)
    return chains.withColumnRenamed("entity", "name")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_history(spark, sf_dir).select("name", "valid_from")


def p1_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_history(spark, sf_dir).select(
        "name", "valid_from", "valid_to", F.col("version_no").cast("long").alias("version_no"), F.array_join("maintainers", ",").alias("maintainers"), "latest_version", "security_holder"
    )


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = ~F.coalesce(F.col("outcome").isin("error", "too_large"), F.lit(False))
    return snapshot_diff.snapshot_changes(table(spark, sf_dir, "obs_snapshots"), "run", "name", "delivered_at", ["times", "missing", "maintainerHashes"], told)


def _feed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_feed.apply_feed(spark, f"{sf_dir}/change_feed.parquet").where("not tombstone")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed_state(spark, sf_dir).select(F.col("key").alias("name"), "seq")


def p3_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed_state(spark, sf_dir).select(
        F.col("key").alias("name"), "seq", F.col("payload.latest_version").alias("latest_version"), F.array_join("payload.maintainers", ",").alias("maintainers")
    )


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_events.classify(table(spark, sf_dir, "tape_events")).where("verdict <> 'on_time'").select("id", "verdict")


def p4_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = late_events.revisions(table(spark, sf_dir, "tape_events"))
    return out.select(F.col("event_day").cast("string").alias("event_day"), "kind", F.col("arrival_day").cast("string").alias("arrival_day"), "added", "total", F.col("revision").cast("long").alias("revision"), "is_last")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.unpublished_versions(table(spark, sf_dir, "packuments")).select("rec_id", "version", "by_name")


def p5_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = nested.document_rows(table(spark, sf_dir, "packuments"))
    return out.withColumn("n_versions", F.col("n_versions").cast("long"))


def p5_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other nested lists of the same documents, as linked rows."""
    return nested.flatten_paths(table(spark, sf_dir, "packuments"), ("maintainers[].name", "versions{}.dist.shasum", "versions{}.scripts{}"))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_store.collapse_deliveries(table(spark, sf_dir, "observations"), work_dir(spark, "messages"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(spark, sf_dir).where("copies > 1").select("name", "run_id", "rev")


def p7_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(spark, sf_dir).select("name", "run_id", "rev", "copies", F.col("body.delivered_at").alias("first_delivered"))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_versions, p2_found, p3_found, p3_state, p4_found, p4_revisions, p5_found, p5_documents, p5_paths, p7_found, p7_messages)
}

_P1 = """
with norm as (
  select name, snapshot_day as d, delivered_at,
    case when maintainers is null or not json_valid(maintainers) then null
         else list_sort(list_distinct(list_filter(from_json(maintainers, '["VARCHAR"]'), lambda x: x is not null))) end as m,
    nullif(trim(latest_version), '') as v0, latest_version as v, nullif(trim(security_holder), '') as h
  from packages where name is not null and snapshot_day is not null
), one as (
  select * from (select *, row_number() over (partition by name, d order by delivered_at desc, m desc nulls last, v desc nulls last, h desc nulls last) as rn from norm) where rn = 1
), known as (
  select name, d, last_value(m ignore nulls) over w as m, last_value(case when v0 is null then null else v end ignore nulls) over w as v,
    last_value(h ignore nulls) over w as h, row_number() over w as n
  from one window w as (partition by name order by d rows between unbounded preceding and current row)
), cmp as (
  select *, lag(m) over w as pm, lag(v) over w as pv, lag(h) over w as ph from known window w as (partition by name order by d)
), starts as (
  select * from cmp where n = 1 or m is distinct from pm or v is distinct from pv or h is distinct from ph
)
"""

_P2 = """
with r as (
  select run, row_number() over (order by run) as n from (select distinct run from obs_snapshots where run is not null)
), one as (
  select * from (
    select run, name, outcome,
      list_sort(list_distinct(coalesce(times, []))) as a, list_sort(list_distinct(coalesce(missing, []))) as b, list_sort(list_distinct(coalesce(maintainerHashes, []))) as c,
      row_number() over (partition by run, name order by delivered_at desc) as rn
    from obs_snapshots where run is not null and name is not null) where rn = 1
), isl as (
  select one.*, r.n, r.n - row_number() over (partition by name order by r.n) as g from one join r using (run)
), st as (
  select run, name, n,
    last_value(case when outcome in ('error', 'too_large') then null else {'a': a, 'b': b, 'c': c} end ignore nulls)
      over (partition by name, g order by n rows between unbounded preceding and current row) as s
  from isl
), full_st as (select run, name, n, coalesce(s, {'a': [], 'b': [], 'c': []}) as s from st)
select cur.run, cur.name, case when prev.name is null then 'added' else 'changed' end as change
from full_st cur left join full_st prev on prev.name = cur.name and prev.n = cur.n - 1
where cur.n > 1 and (prev.name is null or prev.s is distinct from cur.s)
union all
select r.run, prev.name, 'removed' from full_st prev join r on r.n = prev.n + 1
left join full_st cur on cur.name = prev.name and cur.n = prev.n + 1 where cur.name is null
"""

_P3 = """
with marked as (
  select id, seq, coalesce(feedDeleted, false) or coalesce(is_dead, 0) = 1 or coalesce(lower(trim(op)) in ('d', 'del', 'delete', 'deleted', 'deletion', 'remove', 'removed', 'r', 'tombstone'), false) as gone,
    latest_version, maintainers
  from change_feed where id is not null and seq is not null
), last as (
  select * from (select *, bool_or(gone) over (partition by id, seq) as dead, row_number() over (partition by id order by seq desc, gone desc, latest_version desc nulls last, maintainers desc nulls last) as rn from marked) where rn = 1
)
"""

_P4 = """
with parsed as (
  select id, kind, "at"::bigint * 1000000 as at_us, backfill,
    epoch_us(try_cast(case when regexp_matches(observed_at, '([zZ]|[+-][0-9]{2}:?[0-9]{2})$') then observed_at else observed_at || 'Z' end as timestamptz)) as seen_us
  from tape_events where id is not null
), f as (
  select * from (select *, row_number() over (partition by id order by seen_us, at_us nulls first, backfill nulls first, kind nulls first) as rn from parsed where seen_us is not null) where rn = 1
), c as (
  select id, kind, make_date(1970, 1, 1) + (at_us // 86400000000)::int as event_day, make_date(1970, 1, 1) + (seen_us // 86400000000)::int as arrival_day,
    case when seen_us - at_us > 72 * 3600000000 then 'too_late' when seen_us // 86400000000 > at_us // 86400000000 then 'corrects' else 'on_time' end as verdict
  from f where at_us is not null and backfill is distinct from 1
)
"""

_P5 = """
with docs as (select distinct rec_id, raw from packuments),
obj as (
  select rec_id, raw, case when coalesce(json_valid(raw), false) then raw end as j from docs
), o as (select rec_id, raw, case when json_type(j) = 'OBJECT' then j end as j from obj),
u as (
  select rec_id, j, json_extract(j, '$.time.unpublished.versions') as v,
    case when json_type(j, '$.time.unpublished.name') = 'VARCHAR' then json_extract_string(j, '$.time.unpublished.name') else '' end as by_name
  from o
), names as (
  select rec_id, by_name, json_extract_string(v, '$') as version from u where json_type(v) = 'VARCHAR'
  union all
  select rec_id, by_name, unnest(json_keys(v)) from u where json_type(v) = 'OBJECT'
  union all
  select rec_id, by_name, case json_type(e) when 'VARCHAR' then json_extract_string(e, '$') when 'OBJECT' then case when json_type(e, '$.version') = 'VARCHAR' then json_extract_string(e, '$.version') end end
  from (select rec_id, by_name, unnest(from_json(v, '["JSON"]')) as e from u where json_type(v) = 'ARRAY')
), found as (select distinct rec_id, version, by_name from names where version is not null and version <> '')
"""

_P7 = r"""
with m as (
  select regexp_replace(regexp_replace(regexp_replace(coalesce(name, ''), '^\s+|\s+$', '', 'g'), '%2[fF]', '/', 'g'), '%40', '@', 'g') as name,
    regexp_replace(upper(regexp_replace(coalesce(run_id, ''), '^\s+|\s+$', '', 'g')), '^(\d{4}-\d{2}-\d{2})[T ](\d{2})[:-](\d{2})[:-](\d{2})(?:[.,]\d+)?(?:Z|\+00:?00)?$', '\1T\2-\3-\4Z') as run_id,
    coalesce(rev, '') as rev, delivered_at
  from observations
)
"""

ORACLES = {
    "p1_found": _P1 + "select name, d as valid_from from starts",
    "p1_versions": _P1
    + "select name, d as valid_from, lead(d) over w as valid_to, row_number() over w as version_no, array_to_string(m, ',') as maintainers, v as latest_version, h as security_holder from starts window w as (partition by name order by d)",
    "p2_found": _P2,
    "p3_found": _P3 + "select id as name, seq from last where not dead",
    "p3_state": _P3 + "select id as name, seq, latest_version, array_to_string(maintainers, ',') as maintainers from last where not dead",
    "p4_found": _P4 + "select id, verdict from c where verdict <> 'on_time'",
    "p4_revisions": _P4
    + ", cells as (select event_day, kind, greatest(arrival_day, event_day) as arrival_day, count(*) as n from c where verdict <> 'too_late' group by all) "
    "select event_day::varchar as event_day, kind, arrival_day::varchar as arrival_day, n as added, (sum(n) over w)::bigint as total, row_number() over w as revision, lead(arrival_day) over w is null as is_last from cells window w as (partition by event_day, kind order by arrival_day)",
    "p5_found": _P5 + "select rec_id, version, by_name from found",
    "p5_documents": _P5
    + "select u.rec_id, u.j is not null as usable, case when json_type(u.j, '$.name') = 'VARCHAR' then json_extract_string(u.j, '$.name') end as name, u.by_name, (select count(*) from found where found.rec_id = u.rec_id) as n_versions from u",
    "p5_paths": _P5
    + """, people as (select rec_id, l, unnest(range(len(l))) as i from (select rec_id, from_json(json_extract(j, '$.maintainers'), '["JSON"]') as l from o where json_type(j, '$.maintainers') = 'ARRAY')),
listed as (select rec_id, j, k, unnest(range(len(k))) as i from (select rec_id, j, json_keys(j, '$.versions') as k from o where json_type(j, '$.versions') = 'OBJECT')),
vs as (select rec_id, i, k[i + 1] as k, json_extract(j, '/versions/' || replace(replace(k[i + 1], '~', '~0'), '/', '~1')) as v from listed),
scripts as (select rec_id, i, v, s, unnest(range(len(s))) as n from (select rec_id, i, v, json_keys(v, '$.scripts') as s from vs where json_type(v, '$.scripts') = 'OBJECT')),
reached as (
  select rec_id, 'maintainers[].name' as path, i::varchar as position, null as key, json_extract(l[i + 1], '$.name') as x from people where json_type(l[i + 1], '$.name') is not null
  union all select rec_id, 'versions{}.dist.shasum', i::varchar, k, json_extract(v, '$.dist.shasum') from vs where json_type(v, '$.dist.shasum') is not null
  union all select rec_id, 'versions{}.scripts{}', i || '.' || n, s[n + 1], json_extract(v, '/scripts/' || replace(replace(s[n + 1], '~', '~0'), '/', '~1')) from scripts)
select distinct rec_id, path, position, key, case json_type(x) when 'VARCHAR' then json_extract_string(x, '$') when 'NULL' then null else x::varchar end as value from reached""",
    "p7_found": _P7 + "select name, run_id, rev from m group by all having count(*) > 1",
    "p7_messages": _P7 + "select name, run_id, rev, count(*) as copies, min(delivered_at) as first_delivered from m group by all",
}
