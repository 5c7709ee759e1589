"""Typed events from consecutive observations of a package: one window, one explode.

The baseline of an observation is the last earlier one of its package that could be read
(outcome ok or tombstone); failed ones are skipped. Events carry canonical ids, so running
again changes nothing; of one id the first sighting is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registry_lens.functions.scalars import epoch, round_half_up

EVENT = "struct<kind:string,id:string,version:string,at:bigint,detail:string>"
DIFFABLE = ("ok", "tombstone")


def diffable(c: str = "outcome") -> Column:
    return F.col(c).isin(*DIFFABLE)


def with_baseline(obs: DataFrame, fields: tuple[str, ...] = ("times", "maintainerHashes", "maintainers", "revInt")) -> DataFrame:
    """Adds ``prev``: the named fields of the last earlier readable observation of the package, else null."""
    order = Window.partitionBy("name").orderBy("fetchedAt", "run", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return obs.withColumn("prev", F.last(F.when(diffable(), F.struct(*fields)), ignorenulls=True).over(order))


def _event(kind: str, ident: Column, version: Column | None, at: Column, **detail: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"),
        F.concat(F.lit(f"{_PREFIX[kind]}|"), F.col("name"), F.lit("|"), ident).alias("id"),
        (F.lit(None).cast("string") if version is None else version).alias("version"),
        at.cast("long").alias("at"),
        F.to_json(F.struct(*(v.alias(k) for k, v in detail.items())), {"ignoreNullFields": "false"}).alias("detail"),
    )


#: What an id of each kind begins with.
_PREFIX = {"gone": "gone", "package_unpublish": "punpub", "version_unpublish": "vunpub", "publish": "publish", "maintainer_change": "maint", "rev_gap": "revgap"}


def derive(obs: DataFrame) -> DataFrame:
    """Events of all observations, before equal ids are collapsed.

    Rows without name have no chain and give none. One shuffle by name; reduce ``obs`` to a
    row per package and run first, which bounds a package's rows by the number of runs.
    """
    return events_of(with_baseline(obs.where("name is not null")))


def events_of(rows: DataFrame) -> DataFrame:
    """The rules, on observations that carry their baseline in ``prev``; the same for batch and stream."""
    seen, none = epoch("fetchedAt"), F.array().cast(f"array<{EVENT}>")
    read, first = diffable(), F.col("prev").isNull()
    when = lambda c, e: F.when(c, F.array(e)).otherwise(none)
    day = F.lit(86400)
    given = lambda c, kind, instead=None: F.coalesce(F.col(c), F.lit(instead).cast(kind) if instead is None else instead) if c in rows.columns else (F.lit(None).cast(kind) if instead is None else instead)
    no_texts = F.array().cast("array<string>")
    gone = when(F.col("outcome") == "gone", _event("gone", F.coalesce("rev", F.lit("norev")), None, seen, status=F.col("status")))
    dead = when(
        read & F.col("tombstone") & F.col("unpublishedAt").isNotNull(),
        _event(
            "package_unpublish", F.col("unpublishedAt").cast("string"), None, F.col("unpublishedAt"),
            by=given("unpublishedBy", "string"), versions=given("unpublishedVersions", "array<string>", no_texts), createdAt=F.col("created"), maintainers=F.col("maintainers"),
            ageAtDeathDays=round_half_up((F.col("unpublishedAt") - F.col("created")) / day), noticedAfterDays=round_half_up((seen - F.col("unpublishedAt")) / day),
        ),
    )
    yanks = F.when(read, F.transform(F.coalesce("missing", F.array().cast("array<struct<v:string,t:bigint>>")), lambda m: _event("version_unpublish", m["v"], m["v"], m["t"], originalPublishAt=m["t"], noticedAt=seen))).otherwise(none)
    known = F.transform(F.col("prev.times"), lambda t: t["v"])
    fresh = F.filter(F.coalesce("times", F.array().cast("array<struct<v:string,t:bigint>>")), lambda t: ~F.coalesce(F.array_contains(known, t["v"]), F.lit(False)))
    details = F.coalesce(F.map_from_entries(F.transform("recent", lambda r: F.struct(r["v"], r))), F.create_map()) if "recent" in rows.columns else None
    flagged = F.array_contains(F.coalesce("flags", no_texts), "new_package")
    is_new = F.coalesce(F.col("isNew"), flagged) if "isNew" in rows.columns else flagged
    known_kinds = {"by": "string", "deps": "int", "integrity": "string", "unpackedSize": "bigint", "fileCount": "bigint", "license": "string", "repoHost": "string", "deprecated": "string"}

    def publish(t: Column) -> Column:
        more = {k: F.lit(None).cast(v) for k, v in known_kinds.items()}
        scripts = no_texts
        if details is not None:
            r = F.try_element_at(details, t["v"])
            more = {"by": r["by"], "deps": r["deps"], "integrity": r["integrity"], "unpackedSize": r["unpacked_size"], "fileCount": r["file_count"], "license": r["license"], "repoHost": r["repo_host"], "deprecated": r["deprecated"]}
            scripts = F.coalesce(r["install_scripts"], no_texts)
        return _event("publish", t["v"], t["v"], t["t"], by=more.pop("by"), installScripts=scripts, **more, isNewPackage=is_new)

    published = F.when(read, F.transform(fresh, publish)).otherwise(none)
    before, now = (F.array_sort(F.array_distinct(c)) for c in ("prev.maintainerHashes", "maintainerHashes"))
    moved = when(
        read & (F.size(before) > 0) & (F.size(now) > 0) & ~before.eqNullSafe(now),
        _event("maintainer_change", F.coalesce("rev", "fetchedAt"), None, seen, **{"from": F.col("prev.maintainers"), "to": F.col("maintainers"), "fromCount": F.size(before), "toCount": F.size(now)}),
    )
    jump = F.col("revInt") - F.col("prev.revInt")
    skipped = when(
        read & (jump >= 2),
        _event("rev_gap", F.concat(F.col("prev.revInt").cast("string"), F.lit("-"), F.col("revInt").cast("string")), None, seen, fromRev=F.col("prev.revInt"), toRev=F.col("revInt"), unexplained=jump - 1),
    )
    events = rows.select("name", "run", "seq", "fetchedAt", first.alias("backfill"), F.explode(F.concat(gone, dead, yanks, published, moved, skipped)).alias("e"))
    return events.select("e.id", "e.kind", "name", "e.version", "e.at", F.col("fetchedAt").alias("observed_at"), F.col("run").alias("run_id"), "seq", "backfill", "e.detail")


def first_sightings(events: DataFrame) -> DataFrame:
    """Of each id the first event by run and observation time (the other columns break a tie); combines before its shuffle."""
    rest = [c for c in events.columns if c not in ("id", "run_id", "observed_at")]
    return events.groupBy("id").agg(F.min(F.struct("run_id", "observed_at", *rest)).alias("e")).select("id", *(f"e.{c}" for c in events.columns if c != "id"))


def derive_all(obs: DataFrame) -> DataFrame:
    """Events, one per id."""
    return first_sightings(derive(obs))
