"""Registered queries of the registry operators, with the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry_lens.functions import documents as docs
from registry_lens.functions import privacy, scalars
from registry_lens.operators import advisories, budget, derive, digest, feed, index, ledger, mirror, observe, similarity
from registry_lens.session import table

DAY = "2026-03-15"
DAY_S = 1773532800
SALT = "a fixed salt for comparisons"
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# feed


@query("select id, max(seq) as seq from change_feed where id is not null group by id")
def feed_newest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.newest_per_key(table(spark, sf_dir, "change_feed").where("id is not null")).select("id", "seq")


@query("select id, max(seq) as seq from change_feed group by id")
def feed_union_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "change_feed")
    parts = [rows.where(F.pmod(F.coalesce("batch_no", F.lit(0)), F.lit(3)) == k) for k in range(3)]
    return feed.work_queue(*parts).select("id", "seq")


@query("with o as (select count(*) as n_rows, max(seq) - min(seq) as span from change_feed) select n_rows, span, round(span / n_rows, 6) as ratio, n_rows > 100 and not (span / n_rows between 1.5 and 12) as suspicious from o")
def feed_seq_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.sequence_ratio(table(spark, sf_dir, "change_feed")).withColumn("ratio", F.round("ratio", 6))


@query("select seq // 10000 as page, count(*) as n_rows, min(seq) as since, max(seq) as last from change_feed group by 1")
def feed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.pages(table(spark, sf_dir, "change_feed"))


@query("select id, seq, op from change_feed where seq > 410010000 and seq <= 410020000")
def feed_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.window_rows(table(spark, sf_dir, "change_feed"), 410010000, 410020000).select("id", "seq", "op")


@query("select max(last_seq) as max_seq from runs")
def keys_max_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "runs").select(F.concat(F.lit("raw/feed/"), "run_id", F.lit("-"), F.col("last_seq").cast("string"), F.lit(".jsonl.gz")).alias("key"))
    return feed.max_seq_of_keys(keys.withColumn("key", F.regexp_replace("key", r"\.jsonl\.gz$", "")))


@query(
    "select run_id, count(*) as n_rows, count(*) filter (where outcome = 'ok') as ok, count(*) filter (where outcome = 'tombstone') as tombstone, count(*) filter (where outcome = 'gone') as gone, "
    "count(*) filter (where outcome = 'error') as error, count(*) filter (where outcome = 'too_large') as too_large, coalesce(sum(missing_count), 0)::bigint as yanks, count(*) filter (where truncated = 1) as truncated_rows from observations group by run_id"
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.run_summary(table(spark, sf_dir, "observations"))


# observations and events

_OBS = "o as (select * from (select *, row_number() over (partition by run, name order by delivered_at desc) as rn from obs_snapshots) where rn = 1)"
_PREV = (
    f"with {_OBS}, p as (select *, epoch_us(fetchedAt::timestamptz) // 1000000 as seen, outcome in ('ok', 'tombstone') as readable, "
    "last_value(case when outcome in ('ok', 'tombstone') then {'times': times, 'h': list_sort(list_distinct(maintainerHashes)), 'm': maintainers, 'r': revInt, 'run': run} end ignore nulls) "
    "over (partition by name order by fetchedAt, run, seq rows between unbounded preceding and 1 preceding) as prev from o where name is not null)"
)
_EVENTS = (
    _PREV
    + """, e as (
  select 'gone|' || name || '|' || coalesce(rev, 'norev') as id, 'gone' as kind, name, null as version, seen as "at", fetchedAt as observed_at, run as run_id, seq, prev is null as backfill, json_object('status', status)::varchar as detail from p where outcome = 'gone'
  union all
  select 'punpub|' || name || '|' || unpublishedAt, 'package_unpublish', name, null, unpublishedAt, fetchedAt, run, seq, prev is null,
    json_object('by', null, 'versions', []::varchar[], 'createdAt', created, 'maintainers', maintainers, 'ageAtDeathDays', floor((unpublishedAt - created) / 86400 + 0.5)::bigint, 'noticedAfterDays', floor((seen - unpublishedAt) / 86400 + 0.5)::bigint)::varchar from p where readable and tombstone and unpublishedAt is not null
  union all
  select 'vunpub|' || name || '|' || m.v, 'version_unpublish', name, m.v, m.t, fetchedAt, run, seq, prev is null, json_object('originalPublishAt', m.t, 'noticedAt', seen)::varchar from (select *, unnest(missing) as m from p where readable)
  union all
  select 'publish|' || name || '|' || t.v, 'publish', name, t.v, t.t, fetchedAt, run, seq, prev is null,
    json_object('by', null, 'installScripts', []::varchar[], 'deps', null, 'integrity', null, 'unpackedSize', null, 'fileCount', null, 'license', null, 'repoHost', null, 'deprecated', null, 'isNewPackage', coalesce(list_contains(flags, 'new_package'), false))::varchar from (select *, unnest(times) as t from p where readable)
    where not coalesce(list_contains(list_transform(prev.times, lambda x: x.v), t.v), false)
  union all
  select 'maint|' || name || '|' || coalesce(rev, fetchedAt), 'maintainer_change', name, null, seen, fetchedAt, run, seq, false,
    json_object('from', prev.m, 'to', maintainers, 'fromCount', len(prev.h), 'toCount', len(list_distinct(maintainerHashes)))::varchar from p
    where readable and len(prev.h) > 0 and len(maintainerHashes) > 0 and prev.h is distinct from list_sort(list_distinct(maintainerHashes))
  union all
  select 'revgap|' || name || '|' || prev.r || '-' || revInt, 'rev_gap', name, null, seen, fetchedAt, run, seq, false, json_object('fromRev', prev.r, 'toRev', revInt, 'unexplained', revInt - prev.r - 1)::varchar from p where readable and revInt - prev.r >= 2
), f as (select * from (select *, row_number() over (partition by id order by run_id, observed_at, kind, name, version nulls first, "at" nulls first, seq, backfill, detail) as rn from e) where rn = 1)
"""
)


def _obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.keep_last(table(spark, sf_dir, "obs_snapshots"), ["run", "name"], ["delivered_at"])


def _derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.derive_all(_obs(spark, sf_dir))


@query(f"with {_OBS} select run, name, seq, outcome from o")
def obs_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _obs(spark, sf_dir).select("run", "name", "seq", "outcome")


@query(_PREV + " select name, run, prev.run as prev_run, prev.r as prev_rev, len(prev.times) as prev_times from p")
def prev_diffable(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive.with_baseline(_obs(spark, sf_dir), ("times", "revInt", "run"))
    return rows.select("name", "run", F.col("prev.run").alias("prev_run"), F.col("prev.revInt").alias("prev_rev"), F.size("prev.times").cast("long").alias("prev_times"))


@query(_EVENTS + "select id, kind, name, version, \"at\", observed_at, run_id, seq, backfill, detail from f")
def derive_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir)


@query(_EVENTS + "select id, name, \"at\", split_part(split_part(id, '|', -1), '-', 1)::bigint as from_rev, split_part(split_part(id, '|', -1), '-', 2)::bigint as to_rev, split_part(split_part(id, '|', -1), '-', 2)::bigint - split_part(split_part(id, '|', -1), '-', 1)::bigint - 1 as unexplained from f where kind = 'rev_gap'")
def derive_rev_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    get = lambda k: F.get_json_object("detail", f"$.{k}").cast("long")
    return _derived(spark, sf_dir).where("kind = 'rev_gap'").select("id", "name", "at", get("fromRev").alias("from_rev"), get("toRev").alias("to_rev"), get("unexplained").alias("unexplained"))


@query(
    _EVENTS
    + "select f.id, f.name, f.\"at\", floor((f.\"at\" - p.created) / 86400 + 0.5)::bigint as age_days, floor((p.seen - f.\"at\") / 86400 + 0.5)::bigint as noticed_days from f join p on p.name = f.name and p.run = f.run_id where f.kind = 'package_unpublish'"
)
def derive_package_unpublish(spark: SparkSession, sf_dir: str) -> DataFrame:
    get = lambda k: F.get_json_object("detail", f"$.{k}").cast("long")
    return _derived(spark, sf_dir).where("kind = 'package_unpublish'").select("id", "name", "at", get("ageAtDeathDays").alias("age_days"), get("noticedAfterDays").alias("noticed_days"))


@query(
    'select id, kind, name, "at" from (select *, row_number() over (partition by id order by run_id nulls first, observed_at, kind, name, version nulls first, "at") as rn from tape_events) where rn = 1'
)
def event_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.first_sightings(table(spark, sf_dir, "tape_events")).select("id", "kind", "name", "at")


@query(
    f"""with {_OBS}, w as (
  select name, min(fetchedAt) as first_seen, max(fetchedAt) as last_seen, count(distinct run)::bigint as observations, max(coalesce(tombstone, false)::int) as is_dead from o where name is not null group by name
), k as (
  select distinct name, last_value(created ignore nulls) over a as created, last_value(distTags['latest'] ignore nulls) over a as latest_version, last_value(versionCount ignore nulls) over a as version_count,
    last_value(unpublishedAt ignore nulls) over a as unpublished_at, last_value(securityHolder ignore nulls) over a as security_holder, array_to_string(last_value(maintainers ignore nulls) over a, ',') as maintainers,
    last_value(case when outcome in ('ok', 'tombstone') then tombstone end ignore nulls) over a as currently_dead, array_to_string(last_value(flags) over a, ',') as flags
  from o where name is not null window a as (partition by name order by fetchedAt, run, seq rows between unbounded preceding and unbounded following)
) select * from w join k using (name)"""
)
def package_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.fold_packages(_obs(spark, sf_dir)).withColumns({c: F.array_join(c, ",") for c in ("maintainers", "flags")})


@query(
    f"with {_OBS}, e as (select count(*) as n from ({_EVENTS.replace('with ' + _OBS + ',', 'with', 1)} select id from f)) "
    "select 'observations' as key, (select count(*) from o)::varchar as value union all select 'events', (select n from e)::varchar union all select 'builtAt', '2026-03-31' union all select 'popularListSize', '300'"
)
def build_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = _obs(spark, sf_dir)
    return index.build_meta("2026-03-31", obs, derive.derive_all(obs), 300)


# documents

_DOC = """with d as (select distinct rec_id, fetched_run, raw from packuments),
j as (select rec_id, raw, case when coalesce(json_valid(raw), false) and json_type(case when json_valid(raw) then raw end) = 'OBJECT' then raw end as j,
  epoch_us(try_cast(regexp_replace(fetched_run, 'T(\\d{2})-(\\d{2})-(\\d{2})Z$', 'T\\1:\\2:\\3Z') as timestamptz)) // 1000000 as now from d),
o as (select * from j where j is not null),
times as (
  select rec_id, now, k as v, epoch_us(try_cast(json_extract_string(j, '/time/' || replace(replace(k, '~', '~0'), '/', '~1')) as timestamptz)) // 1000000 as t,
    json_type(j, '/time/' || replace(replace(k, '~', '~0'), '/', '~1')) as ty, json_type(j, '/versions/' || replace(replace(k, '~', '~0'), '/', '~1')) as listed, j
  from (select rec_id, now, j, unnest(json_keys(j, '$.time')) as k from o where json_type(j, '$.time') = 'OBJECT') where k not in ('created', 'modified', 'unpublished')
), tv as (select * from times where ty = 'VARCHAR' and t is not null),
tomb as (select rec_id, json_type(j, '$.versions') is distinct from 'OBJECT' or json_type(j, '$.time.unpublished') is not null as tombstone from o)
"""

#: Versions of the last month, and the newest 20 of them with their documents and install hooks.
_RECENT = """, rec as (select rec_id, v, t, json_extract(j, '/versions/' || replace(replace(v, '~', '~0'), '/', '~1')) as d from tv where listed is not null and t between now - 2592000 and now + 3600),
det as (
  select rec_id, v, t, d, list_filter(list_transform(['preinstall', 'install', 'postinstall'], lambda h: case when json_type(d, '/scripts/' || h) = 'VARCHAR' and json_extract_string(d, '/scripts/' || h) <> '' then h end), lambda x: x is not null) as scripts,
    case when json_type(d, '$.dependencies') = 'OBJECT' then len(json_keys(d, '$.dependencies')) else 0 end::bigint as deps
  from (select *, row_number() over (partition by rec_id order by t desc, v desc) as n from rec) where n <= 20)
"""


def _documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, docs.Document]:
    rows = table(spark, sf_dir, "packuments").select("rec_id", "fetched_run", "raw").distinct()
    rows = rows.withColumn("doc", F.try_parse_json("raw")).withColumn("now", scalars.run_instant("fetched_run"))
    return rows.where(docs.is_kind(F.col("doc"), "$", "OBJECT")), docs.Document(F.col("doc"), F.col("now"))


@query(
    _DOC
    + """select rec_id, coalesce(nullif(case when json_type(j, '$.name') = 'VARCHAR' then json_extract_string(j, '$.name') end, ''), nullif(case when json_type(j, '$._id') = 'VARCHAR' then json_extract_string(j, '$._id') end, '')) as name,
  nullif(json_extract_string(j, '$._rev'), '') as rev, try_cast(nullif(regexp_extract(json_extract_string(j, '$._rev'), '^(\\d+)-', 1), '') as bigint) as rev_int,
  epoch_us(try_cast(json_extract_string(j, '$.time.created') as timestamptz)) // 1000000 as created, epoch_us(try_cast(json_extract_string(j, '$.time.modified') as timestamptz)) // 1000000 as modified,
  nullif(case when json_type(j, '$.\"dist-tags\".latest') = 'VARCHAR' then json_extract_string(j, '$.\"dist-tags\".latest') end, '') as latest,
  case when json_type(j, '$.versions') = 'OBJECT' then 'ok' else 'tombstone' end as outcome from o"""
)
def doc_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, d = _documents(spark, sf_dir)
    return rows.select("rec_id", d.name().alias("name"), d.rev().alias("rev"), d.rev_int().alias("rev_int"), d.created().alias("created"), d.modified().alias("modified"), d.latest().alias("latest"), docs.outcome(F.lit(200), F.col("doc")).alias("outcome"))


@query(_DOC + "select rec_id, v, t from tv")
def doc_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, d = _documents(spark, sf_dir)
    return rows.select("rec_id", F.explode(d.all_times()).alias("x")).select("rec_id", "x.v", "x.t")


@query(_DOC + "select rec_id, v, t from (select *, row_number() over (partition by rec_id order by t desc, v desc) as n from tv where t >= now - 604800) where n <= 100")
def doc_times_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, d = _documents(spark, sf_dir)
    return rows.select("rec_id", F.explode(d.times()).alias("x")).select("rec_id", "x.v", "x.t")


@query(_DOC + "select tv.rec_id, v, t from tv join tomb using (rec_id) where not tombstone and listed is null")
def doc_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, d = _documents(spark, sf_dir)
    return rows.select("rec_id", F.explode(d.missing_all()).alias("x")).select("rec_id", "x.v", "x.t")


@query(_DOC + "select rec_id, v, t from (select *, row_number() over (partition by rec_id order by t desc, v desc) as n from tv) where n <= 3")
def doc_newest_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, d = _documents(spark, sf_dir)
    return rows.select("rec_id", F.explode(d.newest(d.all_times(), 3)).alias("x")).select("rec_id", "x.v", "x.t")


@query(
    _DOC
    + "select o.rec_id, tombstone, epoch_us(try_cast(case when json_type(j, '$.time.unpublished.time') = 'VARCHAR' then json_extract_string(j, '$.time.unpublished.time') end as timestamptz)) // 1000000 as unpublished_at, "
    "case when json_type(j, '$.time.unpublished.time') = 'VARCHAR' and json_type(j, '$.time.unpublished.name') = 'VARCHAR' then nullif(json_extract_string(j, '$.time.unpublished.name'), '') end as unpublished_by from o join tomb using (rec_id)"
)
def doc_unpublish(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, d = _documents(spark, sf_dir)
    return rows.select("rec_id", d.tombstone().alias("tombstone"), d.unpublished_at().alias("unpublished_at"), d.unpublished_by().alias("unpublished_by"))


@query(
    _DOC
    + """select rec_id, case when json_type(j, '$.versions') = 'OBJECT' then 'sha256:' || substr(sha256(array_to_string(list_sort(json_keys(j, '$.versions')), chr(10))), 1, 32) end as digest,
  array_to_string(list_sort(list_filter(list_transform(from_json(case when json_type(j, '$.maintainers') = 'ARRAY' then json_extract(j, '$.maintainers') else '[]' end, '["JSON"]'), lambda m: case when json_type(m, '$.name') = 'VARCHAR' then nullif(json_extract_string(m, '$.name'), '') end), lambda x: x is not null)), ',') as maintainers,
  array_to_string(list_sort(list_transform(list_filter(list_transform(from_json(case when json_type(j, '$.maintainers') = 'ARRAY' then json_extract(j, '$.maintainers') else '[]' end, '["JSON"]'), lambda m: case when json_type(m, '$.email') = 'VARCHAR' then nullif(json_extract_string(m, '$.email'), '') end), lambda x: x is not null),
    lambda e: 'h:' || substr(sha256('"""
    + SALT
    + """' || chr(0) || lower(trim(e))), 1, 32))), ',') as hashes from o"""
)
def doc_people_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, d = _documents(spark, sf_dir)
    return rows.select("rec_id", d.versions_digest().alias("digest"), F.array_join(d.maintainers(), ",").alias("maintainers"), F.array_join(d.maintainer_hashes(SALT), ",").alias("hashes"))


@query(
    _DOC
    + _RECENT
    + """select rec_id, v, t, case when json_type(d, '$._npmUser.name') = 'VARCHAR' then nullif(json_extract_string(d, '$._npmUser.name'), '') end as by, array_to_string(scripts, ',') as install_scripts, deps,
  case when json_type(d, '$.dist.integrity') = 'VARCHAR' then nullif(json_extract_string(d, '$.dist.integrity'), '') end as integrity, case when json_type(d, '$.dist.shasum') = 'VARCHAR' then nullif(json_extract_string(d, '$.dist.shasum'), '') end as shasum,
  case when json_type(d, '$.dist.unpackedSize') in ('BIGINT', 'UBIGINT', 'DOUBLE') then try_cast(json_extract_string(d, '$.dist.unpackedSize') as bigint) end as unpacked_size, case when json_type(d, '$.dist.fileCount') in ('BIGINT', 'UBIGINT', 'DOUBLE') then try_cast(json_extract_string(d, '$.dist.fileCount') as bigint) end as file_count,
  case when json_type(d, '$.license') = 'VARCHAR' then nullif(json_extract_string(d, '$.license'), '') end as license,
  case when json_type(d, '$.repository.url') = 'VARCHAR' then nullif(lower(regexp_extract(regexp_replace(regexp_replace(json_extract_string(d, '$.repository.url'), '^git\\+', ''), '^git:', 'https:'), '^[A-Za-z+]+://(?:[^/@]*@)?([^/:?#]+)', 1)), '') end as repo_host,
  case when json_type(d, '$.deprecated') = 'VARCHAR' then nullif(json_extract_string(d, '$.deprecated'), '') end as deprecated from det"""
)
def doc_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, d = _documents(spark, sf_dir)
    x = rows.select("rec_id", F.explode(d.recent()).alias("x")).select("rec_id", "x.*")
    return x.withColumns({"install_scripts": F.array_join("install_scripts", ","), "deps": F.col("deps").cast("long")})


def _fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "packuments").select("rec_id", "name", "fetched_run", "raw").distinct()
    return rows.select(F.col("fetched_run").alias("run"), "name", F.col("rec_id").alias("seq"), F.lit(None).cast("string").alias("rev"), F.lit(False).alias("feed_deleted"), scalars.run_instant("fetched_run").alias("now"), F.lit(200).alias("status"), "raw")


@query(
    _DOC
    + _RECENT
    + f""", base as (select distinct rec_id, name, fetched_run, raw from packuments),
c as (
  select b.rec_id as seq, b.name, b.fetched_run as run, o.j is not null as there, o.j, o.now, coalesce(t.tombstone, false) as tombstone,
    case when json_type(o.j, '$.versions') = 'OBJECT' then len(json_keys(o.j, '$.versions')) else 0 end::bigint as version_count,
    case when coalesce(t.tombstone, false) then 0 else (select count(*) from tv where tv.rec_id = b.rec_id and listed is null) end as missing_count,
    (select count(*) from rec where rec.rec_id = b.rec_id) as recent_count, coalesce((select bool_or(len(scripts) > 0) from det where det.rec_id = b.rec_id), false) as scripted,
    case when json_type(o.j, '$.time.unpublished.time') = 'VARCHAR' then epoch_us(try_cast(json_extract_string(o.j, '$.time.unpublished.time') as timestamptz)) // 1000000 end as unpublished_at,
    coalesce(epoch_us(try_cast(case when json_type(o.j, '$.time.created') = 'VARCHAR' then json_extract_string(o.j, '$.time.created') end as timestamptz)) // 1000000 >= o.now - 172800, false) as is_new,
    case when json_type(o.j, '$."dist-tags".latest') = 'VARCHAR' then json_extract_string(o.j, '$."dist-tags".latest') end as latest,
    coalesce((select bool_or(coalesce(json_extract_string(m, '$.name') = '{docs.CONFIG.holder_login}' and json_extract_string(m, '$.email') = '{docs.CONFIG.holder_email}', false))
      from (select unnest(from_json(case when json_type(o.j, '$.maintainers') = 'ARRAY' then json_extract(o.j, '$.maintainers') else '[]' end, '["JSON"]')) as m)), false) as owner
  from base b left join o on o.rec_id = b.rec_id left join tomb t on t.rec_id = b.rec_id
), h as (
  select *, coalesce(latest like '%-security', false) as named, coalesce(json_extract_string(j, '/versions/' || replace(replace(latest, '~', '~0'), '/', '~1') || '/repository/url') = '{docs.CONFIG.holder_repo}', false) as repo, missing_count > 100 or recent_count > 20 as truncated from c
), s as (
  select *, case when named and repo and owner then 'confirmed' when named and (repo or owner) then 'suspected' end as holder from h
), f as (
  select *, case when not there then ['fetch_failed'] else list_filter([case when is_new then 'new_package' end, case when scripted then 'install_scripts' end, case when missing_count > 0 then 'version_unpublished' end,
    case when tombstone then 'package_unpublished' end, case when holder is not null then 'security_holder_' || holder end, case when truncated then 'truncated' end], lambda x: x is not null) end as flags from s
)
select seq, name, run, case when not there then 'error' when json_type(j, '$.versions') = 'OBJECT' then 'ok' else 'tombstone' end as outcome, version_count, missing_count, recent_count, truncated, tombstone, unpublished_at, holder as security_holder, is_new,
  array_to_string(flags, ',') as flags, len(list_filter(flags, lambda x: x in ('new_package', 'package_unpublished', 'install_scripts') or x like 'security_holder_%')) > 0 as retained from f"""
)
def doc_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observe.observations(_fetched(spark, sf_dir), SALT)
    return obs.select("seq", "name", "run", "outcome", *(F.col(c).cast("long").alias(c) for c in ("version_count", "missing_count", "recent_count")), "truncated", "tombstone", "unpublished_at", "security_holder", "is_new", F.array_join("flags", ",").alias("flags"), docs.retain(F.col("flags")).alias("retained"))


# advisories

_AFFECTS = """with r as (select distinct id, raw from osv_records where json_valid(raw)),
a as (select id, unnest(from_json(json_extract(raw, '$.affected'), '["JSON"]')) as a from r where json_type(raw, '$.affected') = 'ARRAY'),
n as (select id, json_extract_string(a, '$.package.name') as name, from_json(json_extract(a, '$.versions'), '["VARCHAR"]') as versions, coalesce(json_array_length(a, '$.ranges'), 0) as ranges from a where json_extract_string(a, '$.package.ecosystem') = 'npm' and json_type(a, '$.package.name') = 'VARCHAR'),
f as (select distinct id as osv_id, name, basis, version from (
  select id, name, 'explicit' as basis, unnest(versions) as version from n where len(versions) > 0
  union all select id, name, case when ranges > 0 then 'range' else 'unknown' end, null from n where coalesce(len(versions), 0) = 0)),
l as (select id, modified, summary, id like 'MAL-%' as is_malicious from (select *, row_number() over (partition by id order by modified desc nulls last, published desc nulls last, summary desc nulls last, raw desc nulls last) as rn from osv_records where id is not null) where rn = 1)
"""


@query(_AFFECTS + "select osv_id, name, basis, version from f")
def advisory_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return advisories.affected_pairs(table(spark, sf_dir, "osv_records"))


@query(_AFFECTS + "select id, modified, summary, is_malicious from l")
def advisory_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return advisories.latest_records(table(spark, sf_dir, "osv_records")).select("id", "modified", "summary", "is_malicious")


def _affected(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "osv_records")
    return advisories.affects(advisories.latest_records(records).drop("raw"), advisories.affected_pairs(records))


@query(_AFFECTS + "select distinct l.id, f.name, l.summary, l.modified, l.is_malicious from l join f on f.osv_id = l.id")
def advisory_join_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _affected(spark, sf_dir)


@query(_AFFECTS + "select distinct l.id, f.name, l.summary, l.modified, l.is_malicious from l join f on f.osv_id = l.id where f.name in (select name from packages where security_holder is not null)")
def advisory_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, names = table(spark, sf_dir, "osv_records"), table(spark, sf_dir, "packages").where("security_holder is not null")
    return advisories.advisories_for(advisories.latest_records(records).drop("raw"), advisories.affected_pairs(records), names)


@query("select id, modified from (select id, max(modified) as modified from osv_records where id is not null group by id) where modified > '2026-03-20T00:00:00Z'")
def advisory_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = table(spark, sf_dir, "osv_records").where("id is not null").groupBy("id").agg(F.max("modified").alias("modified"))
    return advisories.delta(listing, "2026-03-20T00:00:00Z")


# similarity

# the names are those of the packages, and with them three misspellings of each
_NAMES = """with real as (select name, max(version_count) as popularity from packages where name is not null group by name),
m as (select distinct name from (select name from real union all select replace(name, '-', '.') from real union all select substr(name, 1, 3) || substr(name, 5) from real union all select substr(name, 1, 4) || substr(name, 6, 1) || substr(name, 5, 1) || substr(name, 7) from real)),
pop as (select name as target, row_number() over (order by popularity desc nulls last, name) as rank from real qualify rank <= 300),
nf as (select name, replace(replace(regexp_replace(lower(name), '[-_.]', '', 'g'), 'rn', 'm'), 'vv', 'w') as x from m),
f as (select name, translate(x, '10', 'lo') as form, length(name) as size, name like '@%' as scoped, case when length(name) >= 5 then 2 else 1 end as cutoff from nf),
c as (select a.name, b.name as target, rank, a.cutoff, a.form = b.form as collision, least(damerau_levenshtein(a.name, b.name), a.cutoff + 1) as distance
  from f a join f b on a.scoped = b.scoped and (a.form = b.form or abs(a.size - b.size) <= a.cutoff) join pop on pop.target = b.name where a.name not in (select target from pop)),
hits as (select * from c where distance <= cutoff or collision)
"""


def _names(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    real = table(spark, sf_dir, "packages").where("name is not null").groupBy("name").agg(F.max("version_count").alias("popularity"))
    part = lambda a, n=None: F.substring("name", a, 1000 if n is None else n)
    spellings = F.array("name", F.replace("name", F.lit("-"), F.lit(".")), F.concat(part(1, 3), part(5)), F.concat(part(1, 4), part(6, 1), part(5, 1), part(7)))
    return real.select(F.explode(spellings).alias("name")).distinct(), similarity.ranked(real, "popularity", 300)


@query(_NAMES + "select name, target, rank, collision, distance from hits")
def similarity_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.candidates(*_names(spark, sf_dir)).select("name", "target", F.col("rank").cast("long").alias("rank"), "collision", F.col("distance").cast("long").alias("distance"))


_SCORES = (
    _NAMES
    + """, b as (select * from (select *, row_number() over (partition by name order by distance, rank, target) as rn from hits) where rn = 1),
s as (select name, target, distance, collision, round(least(1.0, (case when collision then 1.0::double else (cutoff + 1 - distance)::double / (cutoff + 1) end) * 0.7::double + (1 - least(rank, 5000)::double / 5000) * 0.3::double
  + case when regexp_extract(name, '^@([^/]+)/', 1) <> '' and regexp_extract(name, '^@([^/]+)/', 1) in (select regexp_extract(target, '^@([^/]+)/', 1) from pop) then 0.15::double else 0 end), 3) as score from b),
near as (select name, array_to_string(list(target order by distance, rank, target)[1:3], ',') as nearest from (select distinct name, target, distance, rank from hits) group by name)
"""
)


@query(_SCORES + "select name, target, distance, collision, score, nearest from s join near using (name)")
def similarity_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.scores(*_names(spark, sf_dir)).select("name", "target", F.col("distance").cast("long").alias("distance"), "collision", "score", F.array_join("nearest", ",").alias("nearest"))


@query(_NAMES + "select form, count(*) as names, min(name) as first from f group by form having count(*) > 1")
def normalize_collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, _ = _names(spark, sf_dir)
    return names.groupBy(scalars.normalize_name("name").alias("form")).agg(F.count("*").alias("names"), F.min("name").alias("first")).where("names > 1")


@query(_NAMES + "select m.name as a, target as b, damerau_levenshtein(m.name, target)::bigint as distance from m join pop on m.name <> target and abs(length(m.name) - length(target)) <= 2 where damerau_levenshtein(m.name, target) <= 2")
def osa_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling and every popular name within two edits."""
    names, popular = _names(spark, sf_dir)
    pairs = similarity.within_edits(names.withColumn("cutoff", F.lit(2)), popular.select("target")).where("name <> target").select(F.col("name").alias("a"), F.col("target").alias("b")).distinct()
    return pairs.withColumn("distance", scalars.osa_distance("a", "b", 2).cast("long")).where("distance <= 2")


# daily report

_DAY_EVENTS = (
    "with ev as (select * from (select *, row_number() over (partition by id order by run_id nulls first, observed_at, kind, name, version nulls first, \"at\", seq, backfill nulls first, detail) as rn from tape_events where id is not null) where rn = 1), "
    f"e as (select *, epoch_us(try_cast(observed_at as timestamptz)) // 1000000 as seen, \"at\" >= {DAY_S} and \"at\" < {DAY_S + 86400} as today, coalesce(backfill, 0) = 0 as fresh from ev), "
    f"t as (select *, seen >= {DAY_S} and seen < {DAY_S + 86400} as seen_today from e)"
)


def _first_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.first_sightings(table(spark, sf_dir, "tape_events").where("id is not null"))


@query(
    _DAY_EVENTS
    + "select count(*) filter (where kind = 'publish' and today) as publishes, count(*) filter (where kind = 'publish' and today and json_extract_string(detail, '$.isNewPackage') = 'true') as new_packages, count(*) filter (where kind = 'package_unpublish' and today) as package_unpublishes, "
    "count(*) filter (where kind = 'version_unpublish' and seen_today and fresh) as version_unpublishes, count(*) filter (where kind = 'maintainer_change' and today) as maintainer_changes, count(*) filter (where kind = 'rev_gap' and today) as rev_gaps, count(*) filter (where kind = 'gone' and today) as gone from t"
)
def digest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.totals(_first_events(spark, sf_dir), digest.Day(DAY))


@query(_DAY_EVENTS + "select kind, count(*) as n from t where today group by kind")
def day_counts_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.counts_by_kind(_first_events(spark, sf_dir), digest.Day(DAY))


@query(
    f"select count(distinct name) as packages_observed, count(*) as observations from observations where epoch_us(try_cast(fetched_at as timestamptz)) // 1000000 >= {DAY_S} and epoch_us(try_cast(fetched_at as timestamptz)) // 1000000 < {DAY_S + 86400}"
)
def distinct_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.observed_counts(table(spark, sf_dir, "observations"), digest.Day(DAY))


_GRAVE = "select id, name, \"at\", json_extract_string(detail, '$.by') as by, try_cast(json_extract_string(detail, '$.ageAtDeathDays') as bigint) as age_days, case when json_type(detail, '$.versions') = 'ARRAY' then json_array_length(detail, '$.versions') else 0 end::bigint as versions_lost from t where kind = 'package_unpublish'"


@query(f"{_DAY_EVENTS} {_GRAVE} and today")
def graveyard_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.graveyard(_first_events(spark, sf_dir), digest.Day(DAY))


@query(f"{_DAY_EVENTS} {_GRAVE} and \"at\" < {DAY_S} and seen_today order by \"at\" desc, name, id limit 25")
def resurfaced_top25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.resurfaced(_first_events(spark, sf_dir), digest.Day(DAY))


@query(
    _DAY_EVENTS
    + ", v as (select name, version, count(*) as c, min(\"at\") as oldest, row_number() over (partition by name order by version nulls last) as nth from t where kind = 'version_unpublish' and seen_today and fresh group by name, version) "
    "select name, sum(c)::bigint as n, min(oldest) as oldest, coalesce(string_agg(version, ',' order by nth) filter (where nth <= 5), '') as versions from v group by name order by n, oldest, name limit 25"
)
def yank_groups_top25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.version_yanks(_first_events(spark, sf_dir), digest.Day(DAY))


@query(_DAY_EVENTS + "select name, score from (select name, max(version_count)::double as score from packages group by name) where name in (select name from t where kind = 'publish' and today) order by score desc, name limit 10")
def watchlist_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = table(spark, sf_dir, "packages").groupBy("name").agg(F.max("version_count").cast("double").alias("score"))
    return digest.watchlist(scores, _first_events(spark, sf_dir), digest.Day(DAY))


@query(
    _AFFECTS
    + f"select distinct l.id, f.name, regexp_replace(l.summary, '[A-Za-z0-9._%+-]{{1,64}}@[A-Za-z0-9.-]{{1,255}}\\.[A-Za-z]{{2,24}}', '[address removed]', 'g') as summary, l.modified from l join f on f.osv_id = l.id where is_malicious and l.modified::timestamptz >= '{DAY}T00:00:00Z' and l.modified::timestamptz < '2026-03-16T00:00:00Z' order by l.modified desc, l.id, f.name limit 50"
)
def malicious_day_top50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.malicious(_affected(spark, sf_dir), digest.Day(DAY))


@query(
    _DAY_EVENTS
    + "select name, version, \"at\", array_to_string(from_json(json_extract(detail, '$.installScripts'), '[\"VARCHAR\"]'), ',') as scripts from t where kind = 'publish' and today and json_array_length(detail, '$.installScripts') > 0 order by \"at\" desc, name, version limit 25"
)
def install_scripts_top25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.install_scripts(_first_events(spark, sf_dir), digest.Day(DAY))


# ledger: an adapter turns the runs into manifests in which every seventh digest is edited and every eleventh parent is claimed twice

_LINES = """with r as (select *, row_number() over (order by run_id) as n, lag(run_id) over (order by run_id) as prev_run_id, lag(last_seq) over (order by run_id) as since_seq, lead(parent_hash) over (order by run_id) as own from runs),
one as (select run_id, case when n % 7 = 0 then sha256(run_id) else coalesce(own, sha256(run_id)) end as sha256, parent_hash as prev, prev_run_id, coalesce(since_seq, 0) as since_seq, last_seq, mode from r),
lines as (select * from one union all select run_id || '-b', sha256(run_id || 'b'), parent_hash, prev_run_id, case when n % 2 = 0 then since_seq else last_seq + 5 end, case when n % 2 = 0 then last_seq else last_seq + 9 end, mode from r where n % 11 = 0),
anomaly as (
  select distinct 'chain-start' as kind, run_id, prev as parent, null as sibling from lines where prev is null
  union select case when a.since_seq <= b.last_seq and b.since_seq <= a.last_seq then 'fork' else 'fork-suspicious' end, a.run_id, a.prev, b.run_id from lines a join lines b on a.prev = b.prev and a.run_id <> b.run_id
  union select case when p.run_id is null then 'missing-parent' else 'hash-mismatch' end, a.run_id, a.prev, a.prev_run_id from lines a left join lines p on p.run_id = a.prev_run_id
    where a.prev is not null and a.prev_run_id is not null and substr(a.prev_run_id, 1, 10) in (select substr(run_id, 1, 10) from lines) and (p.run_id is null or p.sha256 <> a.prev))
"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "runs")  # a fixed table of a few rows
    r = spark.sql(
        "select *, row_number() over (order by run_id) as n, lag(run_id) over (order by run_id) as prev_run_id, lag(last_seq) over (order by run_id) as since_seq, lead(parent_hash) over (order by run_id) as own from {runs}", runs=runs
    )
    one = spark.sql("select run_id, case when n % 7 = 0 then sha2(run_id, 256) else coalesce(own, sha2(run_id, 256)) end as sha256, parent_hash as prev, prev_run_id, coalesce(since_seq, 0) as since_seq, last_seq, mode from {r}", r=r)
    twice = spark.sql(
        "select run_id || '-b' as run_id, sha2(run_id || 'b', 256) as sha256, parent_hash as prev, prev_run_id, case when n % 2 = 0 then since_seq else last_seq + 5 end as since_seq, case when n % 2 = 0 then last_seq else last_seq + 9 end as last_seq, mode from {r} where n % 11 = 0", r=r
    )
    return one.unionByName(twice)


@query(_LINES + "select kind, run_id, parent, sibling from anomaly")
def chain_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.anomalies(_lines(spark, sf_dir))


@query(_LINES + "select (select count(distinct run_id) from lines) as runs, count(*) as anomalies, count(*) filter (where kind <> 'chain-start') as defects from anomaly")
def chain_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.report(_lines(spark, sf_dir))


@query(_LINES + "select run_id, sha256 from lines where sha256 not in (select parent_hash from runs where parent_hash is not null)")
def anti_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    committed = table(spark, sf_dir, "runs").select(F.col("parent_hash").alias("sha256")).where("sha256 is not null")
    return ledger.uncommitted(_lines(spark, sf_dir), committed).select("run_id", "sha256")


# mirror and budget: the archive's objects are the observations, one per name and run

_KEYS = """with k as (select case when outcome = 'error' then 'private/' when truncated = 1 then 'raw/feed/' else 'raw/obs/' end || run_id || '/' || name as key, sum(version_count)::bigint as size, sha256(min(coalesce(rev, ''))) as sha256 from observations group by 1),
m as (select key, case when length(key) % 13 = 0 then size + 1 else size end as size, case when length(key) % 17 = 0 then 'edited' else sha256 end as sha256 from k where length(key) % 11 <> 0 union all select key || '.old', size, sha256 from k where length(key) % 29 = 0),
d as (select coalesce(k.key, m.key) as key, k.size, m.size as mirror_size, case when m.key is null then 'missing' when k.key is null then 'vanished' when k.size <> m.size then 'size_mismatch' else 'same' end as state from k full join m on k.key = m.key)
"""


def _listings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    prefix = F.when(F.col("outcome") == "error", "private/").when(F.col("truncated") == 1, "raw/feed/").otherwise("raw/obs/")
    k = table(spark, sf_dir, "observations").groupBy(F.concat(prefix, "run_id", F.lit("/"), "name").alias("key")).agg(F.sum("version_count").alias("size"), scalars.sha256_text(F.min(F.coalesce("rev", F.lit("")))).alias("sha256"))
    n = F.length("key")
    size, sha = F.when(n % 13 == 0, F.col("size") + 1).otherwise(F.col("size")), F.when(n % 17 == 0, "edited").otherwise(F.col("sha256"))
    m = k.where(n % 11 != 0).select("key", size.alias("size"), sha.alias("sha256")).unionByName(k.where(n % 29 == 0).withColumn("key", F.concat("key", F.lit(".old"))))
    return k, m


@query(_KEYS + "select key, size, mirror_size, state from d where state <> 'same'")
def listing_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mirror.diff(*_listings(spark, sf_dir)).where("state <> 'same'")


@query(
    _KEYS
    + "select split_part(key, '/', 1) as prefix, count(size) as objects, coalesce(sum(size), 0)::bigint as bytes, count(*) filter (where state = 'missing') as missing, count(*) filter (where state = 'size_mismatch') as size_mismatch, count(*) filter (where state = 'vanished') as vanished, count(*) filter (where state in ('missing', 'size_mismatch')) = 0 as complete from d group by 1"
)
def mirror_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mirror.summary(mirror.diff(*_listings(spark, sf_dir)))


@query(_KEYS + "select k.key, k.sha256, m.sha256 as other from k join m on k.key = m.key where k.sha256 <> m.sha256")
def content_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mirror.content_mismatches(*_listings(spark, sf_dir))


@query(_KEYS + "select key, case when key like 'raw/feed/%' then 0 when key like 'raw/obs/%' then 2 else 4 end as priority from d where state = 'missing' order by priority, key limit 200")
def budget_prefix_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = mirror.diff(*_listings(spark, sf_dir)).where("state = 'missing'").select("key")
    return mirror.within_budget(missing, 200)


@query(
    "with p as (select c_custkey as id, row_number() over (order by c_custkey) - 1 as pos, count(*) over () as total from customer), s as (select distinct floor(i * ((total - 1) / 49.0::double) + 0.5)::bigint as pos from (select any_value(total) as total from p), range(50) t(i)) select p.id from p join s using (pos)"
)
def sample_ends_stride(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mirror.sample_ends_stride(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), "id", 50)


@query(_KEYS + "select split_part(key, '/', 1) as prefix, count(*) as objects, sum(size)::bigint as bytes from k group by 1 union all select null, count(*), sum(size)::bigint from k")
def usage_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget.usage_by_prefix(_listings(spark, sf_dir)[0])


@query(
    "with u as (select run_id, feed_rows, sum(feed_rows) over (order by run_id) * 20000 as used from runs) select run_id, case when used >= 9.2e9 then 'hard' when used >= 7.5e9 then 'soft' else 'ok' end as tier, case when used >= 9.2e9 or feed_rows > 50000 then 'triage' when feed_rows > 3000 then 'backlog' else 'steady' end as mode from u"
)
def tier_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql("select run_id, feed_rows, sum(feed_rows) over (order by run_id) * 20000 as used from {runs}", runs=table(spark, sf_dir, "runs"))  # a fixed table
    return budget.modes(budget.tiers(rows, "used"), "feed_rows").select("run_id", "tier", "mode")


@query("select user_id, strftime(ts, '%Y-%m') as month, round(sum(value), 4) as total from events group by all")
def monthly_reset_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget.monthly(table(spark, sf_dir, "events"), "ts", "value", ("user_id",)).withColumn("total", F.round("total", 4))


@query("select user_id, round(coalesce(sum(value) filter (where ts > timestamp '2024-01-15 00:00:00'), 0), 4) as drift from events group by user_id")
def drift_since_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    anchor = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    rows = table(spark, sf_dir, "events")
    return rows.groupBy("user_id").agg(F.round(budget.drift_since(rows, "ts", "value", anchor), 4).alias("drift"))


# privacy and scalars

_EMAIL = "[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]{1,255}\\.[A-Za-z]{2,24}"
_EXEMPT = "(regexp_matches(x, '^(git|hg|svn)@', 'i') or lower(x) in ('npm@npmjs.com', '41898282+github-actions[bot]@users.noreply.github.com'))"


@query(f"select distinct id, array_to_string(list_filter(regexp_extract_all(raw, '{_EMAIL}'), lambda x: not {_EXEMPT}), ',') as found from osv_records where len(list_filter(regexp_extract_all(raw, '{_EMAIL}'), lambda x: not {_EXEMPT})) > 0")
def email_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = privacy.personal_addresses("raw")
    return table(spark, sf_dir, "osv_records").where(F.size(found) > 0).select("id", F.array_join(found, ",").alias("found")).distinct()


@query(
    f"with s as (select distinct id, raw as text, regexp_split_to_array(raw, '{_EMAIL}') as p, regexp_extract_all(raw, '{_EMAIL}') as m from osv_records where raw is not null) select id, sha256(array_to_string(flatten(list_transform(p, lambda x, i: [x, coalesce(list_transform(m, lambda x: case when {_EXEMPT} then x else 'h:' || substr(sha256('{SALT}' || chr(0) || lower(trim(x))), 1, 32) end)[i], '')])), '')) as digest from s"
)
def email_redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "osv_records").where("raw is not null").select("id", scalars.sha256_text(privacy.redact("raw", SALT)).alias("digest")).distinct()


@query(f"select distinct id, sha256(regexp_replace(raw, '{_EMAIL}', '[address removed]', 'g')) as digest from osv_records where raw is not null")
def scrub_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "osv_records").where("raw is not null").select("id", scalars.sha256_text(privacy.scrub("raw")).alias("digest")).distinct()


@query(f"select distinct id from osv_records where len(list_filter(regexp_extract_all(raw, '{_EMAIL}'), lambda x: not {_EXEMPT})) > 0 or regexp_matches(raw, '\"[A-Za-z_]*e-?mail[A-Za-z_]*\"\\s*:', 'i') or len(list_filter(regexp_extract_all(raw, 'mailto:[^\\s\"''<>)\\]]+', 0, 'i'), lambda x: not regexp_matches(x, '^mailto:h:[0-9a-f]{{32}}\\b', 'i'))) > 0")
def gate_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "osv_records").where(privacy.gate_violation("raw", strict=True).isNotNull()).select("id").distinct()


@query(f"select c_custkey, 'h:' || substr(sha256('{SALT}' || chr(0) || lower(trim(c_name))), 1, 32) as pseudonym from customer")
def pseudonym_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", scalars.hash_email("c_name", SALT).alias("pseudonym"))


@query("select distinct rev, try_cast(nullif(regexp_extract(rev, '^(\\d+)-', 1), '') as bigint) as n from observations")
def rev_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "observations").select("rev", scalars.rev_int("rev").alias("n")).distinct()


@query("select distinct observed_at, epoch_us(try_cast(observed_at as timestamptz)) // 1000000 as s from tape_events")
def epoch_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "tape_events").select("observed_at", scalars.epoch("observed_at").alias("s")).distinct()


@query("select distinct name, nullif(regexp_extract(name, '^@([^/]+)/', 1), '') as scope, case when length(name) >= 5 then 2 else 1 end as cutoff, replace(replace(name, '@', '%40'), '/', '%2F') as key from packages where name is not null")
def name_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "packages").where("name is not null").select("name", scalars.scope_of("name").alias("scope"), scalars.distance_cutoff("name").alias("cutoff"), scalars.encode_key("name").alias("key")).distinct()


@query("select run_id, strftime(started_at, '%Y-%m-%dT%H-%M-%SZ') as rebuilt, replace(substr(run_id, 1, 10), '-', '/') as path, epoch_us(started_at) // 1000000 as s from runs")
def run_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "runs").select("run_id", scalars.run_id("started_at").alias("rebuilt"), scalars.date_path("run_id").alias("path"), scalars.run_instant("run_id").alias("s"))


@query("select distinct host as url_host from (select lower(regexp_extract(u, '^https?://([^/:?#]+)', 1)) as host from (select unnest(regexp_extract_all(text, 'https?://[A-Za-z0-9.-]+/[A-Za-z0-9]+')) as u from (select raw as text from osv_records)))")
def url_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = table(spark, sf_dir, "osv_records").select(F.explode(F.regexp_extract_all("raw", F.lit("https?://[A-Za-z0-9.-]+/[A-Za-z0-9]+"), F.lit(0))).alias("u"))
    return urls.select(scalars.repo_host(F.concat(F.lit("git+"), "u")).alias("url_host")).distinct()
