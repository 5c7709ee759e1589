"""Projections of a registry document. A document is a VARIANT; every reader is total: it yields null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registry_lens.config import CONFIG, Config
from registry_lens.functions.scalars import epoch, hash_email, none_if_empty, repo_host, rev_int, versions_digest

VERSION_MAP = "map<string,variant>"
#: Keys of ``time`` that are no versions, and install hooks in their order.
TIME_KEYS = ("created", "modified", "unpublished")
HOOKS = ("preinstall", "install", "postinstall")


def is_kind(v: Column, path: str, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")).startswith(kind), F.lit(False))


def text_at(v: Column, path: str) -> Column:
    """The string at a path; null for other types and for ''."""
    return none_if_empty(F.when(is_kind(v, path, "STRING"), F.try_variant_get(v, path, "string")))


def map_at(v: Column, path: str) -> Column:
    return F.when(is_kind(v, path, "OBJECT"), F.try_variant_get(v, path, VERSION_MAP))


def own_text(v: Column) -> Column:
    return none_if_empty(F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")))


def let(value: Column, f) -> Column:
    """``f(value)`` with the value computed once, also where ``f`` uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), f), 1)


class Document:
    """Column expressions over one document column.

    ``shared`` adds to a DataFrame what several of them need, so that it is computed once a
    row; without it every expression computes its own.
    """

    def __init__(self, doc: Column, now: Column, config: Config = CONFIG, versions: Column | None = None, timed: Column | None = None):
        self.doc, self.now, self.c, self._versions, self._timed = doc, now, config, versions, timed

    @classmethod
    def shared(cls, rows: DataFrame, doc: str, now: str, config: Config = CONFIG) -> tuple[DataFrame, Document]:
        plain = cls(F.col(doc), F.col(now), config)
        with_versions = rows.withColumn("__versions", plain.versions())
        half = cls(F.col(doc), F.col(now), config, F.col("__versions"))
        return with_versions.withColumn("__timed", half.timed()), cls(F.col(doc), F.col(now), config, F.col("__versions"), F.col("__timed"))

    def name(self) -> Column:
        return F.coalesce(text_at(self.doc, "$.name"), text_at(self.doc, "$._id"))

    def rev(self) -> Column:
        return text_at(self.doc, "$._rev")

    def rev_int(self) -> Column:
        return rev_int(self.rev())

    def created(self) -> Column:
        return epoch(text_at(self.doc, "$.time.created"))

    def modified(self) -> Column:
        return epoch(text_at(self.doc, "$.time.modified"))

    def dist_tags(self) -> Column:
        """Tags with a text as their version."""
        texts = F.transform_values(map_at(self.doc, "$['dist-tags']"), lambda k, x: own_text(x))
        return F.map_filter(texts, lambda k, x: x.isNotNull())

    def latest(self) -> Column:
        return F.try_element_at(self.dist_tags(), F.lit("latest"))

    def _people(self, path: str, field: str) -> Column:
        people = F.when(is_kind(self.doc, path, "ARRAY"), F.try_variant_get(self.doc, path, "array<variant>"))
        found = F.filter(F.transform(people, lambda p: text_at(p, f"$.{field}")), lambda x: x.isNotNull())
        return F.array_sort(F.coalesce(found, F.array().cast("array<string>")))

    def maintainers(self) -> Column:
        return self._people("$.maintainers", "name")

    def maintainer_hashes(self, salt: str) -> Column:
        return F.array_sort(F.transform(self._people("$.maintainers", "email"), lambda e: hash_email(e, salt)))

    def versions(self) -> Column:
        if self._versions is not None:
            return self._versions
        return map_at(self.doc, "$.versions")

    def version_names(self) -> Column:
        return F.map_keys(self.versions())

    def timed(self) -> Column:
        """(t, v, listed) of every version in ``time`` whose instant can be read, ascending; ``listed`` as it is in ``versions`` or not.

        The two maps are joined by their keys, so the cost is linear in the versions.
        """
        if self._timed is not None:
            return self._timed
        times = F.coalesce(map_at(self.doc, "$.time"), F.create_map().cast(VERSION_MAP))
        listed = F.transform_values(F.coalesce(self.versions(), F.create_map().cast(VERSION_MAP)), lambda k, x: F.lit(True))
        both = F.map_entries(F.map_zip_with(times, listed, lambda k, t, there: F.struct(epoch(own_text(t)).alias("t"), there.isNotNull().alias("listed"))))
        rows = F.filter(both, lambda e: ~e["key"].isin(*TIME_KEYS) & e["value"]["t"].isNotNull())
        return F.array_sort(F.transform(rows, lambda e: F.struct(e["value"]["t"].alias("t"), e["key"].alias("v"), e["value"]["listed"].alias("listed"))))

    @staticmethod
    def plain(items: Column) -> Column:
        return F.transform(items, lambda x: F.struct(x["t"].alias("t"), x["v"].alias("v")))

    def all_times(self) -> Column:
        """(t, v) of every version in ``time`` whose instant can be read, ascending."""
        return self.plain(self.timed())

    @staticmethod
    def newest(items: Column, n: int) -> Column:
        """The last n of an ascending list."""
        return F.slice(items, F.greatest(F.size(items) - n + 1, F.lit(1)), n)

    def times(self) -> Column:
        """Versions of the last days, capped to the newest."""
        recent = F.filter(self.all_times(), lambda x: x["t"] >= self.now - self.c.times_window_s)
        return self.newest(recent, self.c.times_cap)

    def tombstone(self) -> Column:
        """``time`` has the key unpublished, or there are no versions."""
        return F.coalesce(F.map_contains_key(map_at(self.doc, "$.time"), "unpublished"), F.lit(False)) | self.versions().isNull()

    def unpublished_at(self) -> Column:
        return epoch(text_at(self.doc, "$.time.unpublished.time"))

    def unpublished_by(self) -> Column:
        return F.when(self.unpublished_at().isNotNull(), text_at(self.doc, "$.time.unpublished.name"))

    def unpublished_versions(self) -> Column:
        """The versions a tombstone lists as texts; none without its instant."""
        items = F.when(is_kind(self.doc, "$.time.unpublished.versions", "ARRAY"), F.try_variant_get(self.doc, "$.time.unpublished.versions", "array<variant>"))
        names = F.filter(F.transform(items, own_text), lambda x: x.isNotNull())
        return F.when(self.unpublished_at().isNotNull(), F.coalesce(names, F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>"))

    def missing_all(self) -> Column:
        """Timed versions that are no longer listed; none for a tombstone."""
        gone = self.plain(F.filter(self.timed(), lambda x: ~x["listed"]))
        return F.when(self.tombstone(), F.array().cast("array<struct<t:bigint,v:string>>")).otherwise(gone)

    def missing(self) -> Column:
        return self.newest(self.missing_all(), self.c.missing_cap)

    def recent_all(self) -> Column:
        """Listed versions of the last month, up to an hour ahead of now, ascending."""
        low, high = self.now - self.c.recent_lookback_s, self.now + self.c.clock_skew_s
        return self.plain(F.filter(self.timed(), lambda x: x["t"].between(low, high) & x["listed"]))

    def recent(self) -> Column:
        """Details of the newest of them."""

        def detail(versions: Column, x: Column) -> Column:
            return let(F.try_element_at(versions, x["v"]), lambda v: fields(v, x))

        def fields(v: Column, x: Column) -> Column:
            scripts = F.array_compact(F.array(*(F.when(text_at(v, f"$.scripts.{h}").isNotNull(), F.lit(h)) for h in HOOKS)))
            deps = F.coalesce(F.size(map_at(v, "$.dependencies")), F.lit(0))
            number = lambda p: F.when(F.schema_of_variant(F.try_variant_get(v, p, "variant")).rlike("BIGINT|DECIMAL|DOUBLE|FLOAT"), F.try_variant_get(v, p, "long"))
            return F.struct(
                x["v"].alias("v"), x["t"].alias("t"), text_at(v, "$._npmUser.name").alias("by"), scripts.alias("install_scripts"), F.greatest(deps, F.lit(0)).alias("deps"), text_at(v, "$.dist.integrity").alias("integrity"),
                text_at(v, "$.dist.shasum").alias("shasum"), number("$.dist.unpackedSize").alias("unpacked_size"), number("$.dist.fileCount").alias("file_count"), text_at(v, "$.license").alias("license"),
                repo_host(text_at(v, "$.repository.url")).alias("repo_host"), text_at(v, "$.deprecated").alias("deprecated"),
            )

        newest = self.newest(self.recent_all(), self.c.recent_cap)
        return let(self.versions(), lambda versions: F.transform(newest, lambda x: detail(versions, x)))

    def security_holder(self) -> Column:
        """confirmed, suspected or null, by the latest version's name, repository and maintainer."""
        latest = F.try_element_at(self.versions(), self.latest())
        repo = F.coalesce(text_at(latest, "$.repository.url") == self.c.holder_repo, F.lit(False))
        people = F.when(is_kind(self.doc, "$.maintainers", "ARRAY"), F.try_variant_get(self.doc, "$.maintainers", "array<variant>"))
        owner = F.coalesce(F.exists(people, lambda p: F.coalesce((text_at(p, "$.name") == self.c.holder_login) & (text_at(p, "$.email") == self.c.holder_email), F.lit(False))), F.lit(False))
        named = F.coalesce(self.latest().endswith("-security"), F.lit(False))
        return F.when(named & repo & owner, "confirmed").when(named & (repo | owner), "suspected")

    def is_new(self) -> Column:
        return F.coalesce(self.created() >= self.now - self.c.new_package_window_s, F.lit(False))

    def versions_digest(self) -> Column:
        return versions_digest(self.version_names())

    def truncated(self) -> Column:
        """A list of missing or recent versions is shorter than its total."""
        return (F.size(self.missing_all()) > self.c.missing_cap) | (F.size(self.recent_all()) > self.c.recent_cap)


def outcome(status: Column, doc: Column, too_large: Column | None = None) -> Column:
    """Outcome of a fetch by status and document."""
    out = F.when(status == 404, "gone")
    if too_large is not None:
        out = out.when(too_large, "too_large")
    return out.when(status == 304, "ok").when((status == 200) & map_at(doc, "$.versions").isNotNull(), "ok").when((status == 200) & doc.isNotNull(), "tombstone").otherwise("error")


def flags(is_new: Column, recent: Column, missing_count: Column, tombstone: Column, holder: Column, truncated: Column) -> Column:
    """Flags of an observation in their fixed order."""
    scripts = F.exists(recent, lambda r: F.size(r["install_scripts"]) > 0)
    return F.array_compact(
        F.array(
            F.when(is_new, F.lit("new_package")),
            F.when(scripts, F.lit("install_scripts")),
            F.when(missing_count > 0, F.lit("version_unpublished")),
            F.when(tombstone, F.lit("package_unpublished")),
            F.when(holder.isNotNull(), F.concat(F.lit("security_holder_"), holder)),
            F.when(truncated, F.lit("truncated")),
        )
    )


def retain(flag_list: Column, soft: bool = False, config: Config = CONFIG) -> Column:
    """Whether the document is worth keeping: an allowed flag, or any security holder."""
    allowed = config.retain_flags_soft if soft else config.retain_flags
    return F.exists(flag_list, lambda f: f.isin(*allowed) | f.startswith("security_holder_"))
