"""The daily report: counts and short lists over the index tables, rendered on the driver and gated."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registry_lens.functions.privacy import check_text, scrub
from registry_lens.functions.scalars import epoch


class Day:
    """A UTC day by event time and by observation time; the two rules differ on purpose."""

    def __init__(self, date: str):
        self.date = dt.date.fromisoformat(date)
        if self.date.isoformat() != date:
            raise ValueError("a date is YYYY-MM-DD")
        self.start = int(dt.datetime(self.date.year, self.date.month, self.date.day, tzinfo=dt.timezone.utc).timestamp())

    def happened(self, at: str = "at") -> Column:
        return (F.col(at) >= self.start) & (F.col(at) < self.start + 86400)

    def observed(self, seen: str = "observed_at") -> Column:
        return (epoch(seen) >= self.start) & (epoch(seen) < self.start + 86400)


def fresh() -> Column:
    return F.coalesce(F.col("backfill").cast("int"), F.lit(0)) == 0


def totals(events: DataFrame, day: Day) -> DataFrame:
    """One row of counts, in one pass: by event time per kind; withdrawn versions by observation time and only fresh ones."""
    happened = day.happened()
    of = lambda kind: F.count_if((F.col("kind") == kind) & happened)
    return events.agg(
        of("publish").alias("publishes"),
        F.count_if((F.col("kind") == "publish") & happened & F.coalesce(F.get_json_object("detail", "$.isNewPackage") == "true", F.lit(False))).alias("new_packages"),
        of("package_unpublish").alias("package_unpublishes"),
        F.count_if((F.col("kind") == "version_unpublish") & day.observed() & fresh()).alias("version_unpublishes"),
        of("maintainer_change").alias("maintainer_changes"),
        of("rev_gap").alias("rev_gaps"),
        of("gone").alias("gone"),
    )


def counts_by_kind(events: DataFrame, day: Day) -> DataFrame:
    return events.where(day.happened()).groupBy("kind").agg(F.count("*").alias("n"))


def observed_counts(observations: DataFrame, day: Day, seen: str = "fetched_at") -> DataFrame:
    """Distinct packages and rows observed on the day."""
    return observations.where(day.observed(seen)).agg(F.count_distinct("name").alias("packages_observed"), F.count("*").alias("observations"))


def operations(gaps: DataFrame, day: Day) -> DataFrame:
    """One row: gaps of the day, and how many of them were refused by the gate."""
    return gaps.where(day.observed("at")).agg(F.count("*").alias("gaps"), F.count_if(F.col("kind") == "pii_refused").alias("pii_refused"))


def graveyard(events: DataFrame, day: Day) -> DataFrame:
    """Packages that died on the day, latest first."""
    return _graves(events.where((F.col("kind") == "package_unpublish") & day.happened())).orderBy(F.col("at").desc(), "name", "id")


def resurfaced(events: DataFrame, day: Day, most: int = 25) -> DataFrame:
    """Earlier deaths first seen on the day."""
    old = (F.col("kind") == "package_unpublish") & (F.col("at") < day.start) & day.observed()
    return _graves(events.where(old)).orderBy(F.col("at").desc(), "name", "id").limit(most)


def _graves(rows: DataFrame) -> DataFrame:
    get = lambda path: F.get_json_object("detail", path)
    lost = F.coalesce(F.size(F.from_json(get("$.versions"), "array<string>")), F.lit(0))
    return rows.select("id", "name", "at", get("$.by").alias("by"), get("$.ageAtDeathDays").try_cast("long").alias("age_days"), F.greatest(lost, F.lit(0)).cast("long").alias("versions_lost"))


def version_yanks(events: DataFrame, day: Day, most: int = 25, shown: int = 5) -> DataFrame:
    """Packages whose versions were seen withdrawn on the day, fewest first; the first versions in order.

    Equal versions are counted before anything is gathered, and of a package no more than
    ``shown`` versions are put in a list.
    """
    rows = events.where((F.col("kind") == "version_unpublish") & day.observed() & fresh())
    per_version = rows.groupBy("name", "version").agg(F.count("*").alias("c"), F.min("at").alias("oldest"))
    nth = F.row_number().over(Window.partitionBy("name").orderBy(F.col("version").asc_nulls_last()))
    few = per_version.withColumn("nth", nth)
    grouped = few.groupBy("name").agg(
        F.sum("c").alias("n"), F.min("oldest").alias("oldest"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("nth") <= shown, F.struct("nth", "version")))), lambda x: x["version"]), ",").alias("versions")
    )
    return grouped.orderBy("n", "oldest", "name").limit(most)


def watchlist(scores: DataFrame, events: DataFrame, day: Day, most: int = 10) -> DataFrame:
    """Look-alike names with a release on the day, highest score first."""
    released = events.where((F.col("kind") == "publish") & day.happened()).select("name")
    return scores.join(released, "name", "left_semi").orderBy(F.col("score").desc(), "name").limit(most)


def malicious(affected: DataFrame, day: Day, most: int = 50) -> DataFrame:
    """Malicious advisories modified on the day with the packages they name; summaries without addresses."""
    rows = affected.where(F.col("is_malicious") & day.observed("modified"))
    return rows.select("id", "name", scrub("summary").alias("summary"), "modified").distinct().orderBy(F.col("modified").desc(), "id", "name").limit(most)


def install_scripts(events: DataFrame, day: Day, most: int = 25) -> DataFrame:
    """Releases of the day with install hooks."""
    scripts = F.from_json(F.get_json_object("detail", "$.installScripts"), "array<string>")
    rows = events.where((F.col("kind") == "publish") & day.happened() & (F.size(scripts) > 0))
    return rows.select("name", "version", "at", F.array_join(scripts, ",").alias("scripts")).orderBy(F.col("at").desc(), "name", "version").limit(most)


def collect(date: str, events: DataFrame, observations: DataFrame, packages: DataFrame, scores: DataFrame | None = None, affected: DataFrame | None = None, gaps: DataFrame | None = None) -> dict:
    """The report as a dictionary of plain values; every list in it is a top list or one day's deaths."""
    day = Day(date)
    rows = lambda df: [r.asDict() for r in df.collect()]
    return {
        "date": date,
        "totals": totals(events, day).first().asDict() | observed_counts(observations, day).first().asDict(),
        "operations": operations(gaps, day).first().asDict() if gaps is not None else {"gaps": 0, "pii_refused": 0},
        "security_holders": packages.where("security_holder is not null").count(),
        "graveyard": rows(graveyard(events, day)),
        "resurfaced": rows(resurfaced(events, day)),
        "version_yanks": rows(version_yanks(events, day)),
        "watchlist": rows(watchlist(scores, events, day)) if scores is not None else [],
        "malicious": rows(malicious(affected, day)) if affected is not None else [],
        "install_scripts": rows(install_scripts(events, day)),
    }


def plural(n: int, word: str) -> str:
    return f"{n:,} {word}{'' if n == 1 else 's'}"


def render(data: dict) -> tuple[str, str]:
    """(markdown, JSON) of a report; both pass the strict gate or nothing is returned."""
    t = data["totals"]
    lines = [f"# Registry report {data['date']}", "", f"{plural(t['publishes'], 'release')}, {plural(t['package_unpublishes'], 'package death')}, {plural(t['version_unpublishes'], 'withdrawn version')}.", ""]
    for title, key, fields in (
        ("Deaths", "graveyard", ("name", "by", "age_days", "versions_lost")),
        ("Older deaths seen today", "resurfaced", ("name", "by", "age_days")),
        ("Withdrawn versions", "version_yanks", ("name", "n", "versions")),
        ("Look-alike names", "watchlist", ("name", "target", "score")),
        ("Malicious packages", "malicious", ("id", "name", "summary")),
        ("Install scripts", "install_scripts", ("name", "version", "scripts")),
    ):
        if data[key]:
            lines += [f"## {title}", "", "| " + " | ".join(fields) + " |", "|" + "---|" * len(fields)]
            lines += ["| " + " | ".join(str(r[f] if r[f] is not None else "").replace("|", "\\|") for f in fields) + " |" for r in data[key]] + [""]
    o = data["operations"]
    lines += [f"{plural(t['observations'], 'observation')} of {plural(t['packages_observed'], 'package')}, {plural(o['gaps'], 'gap')}, {plural(o['pii_refused'], 'refusal')}, {plural(data['security_holders'], 'security holder')}.", ""]
    return check_text("\n".join(lines)), check_text(json.dumps(data, indent=2, ensure_ascii=False, default=str))
