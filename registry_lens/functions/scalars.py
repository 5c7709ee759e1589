"""Scalar rules as Column expressions, all inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch(c: str | Column) -> Column:
    """Seconds since 1970 of an ISO text, rounded down; null if it can't be read."""
    return F.unix_seconds(F.try_to_timestamp(col(c)))


def rev_int(c: str | Column) -> Column:
    """The number before the dash of a revision, else null."""
    return F.nullif(F.regexp_extract(col(c), r"^(\d+)-", 1), F.lit("")).try_cast("long")


def none_if_empty(c: str | Column) -> Column:
    return F.when(col(c) != "", col(c))


def sha256_text(c: str | Column) -> Column:
    return F.sha2(col(c).cast("binary"), 256)


def short_digest(c: str | Column, prefix: str = "sha256:") -> Column:
    """Prefix and the first 32 hex digits of a SHA-256."""
    return F.concat(F.lit(prefix), F.substring(sha256_text(c), 1, 32))


def versions_digest(versions: Column) -> Column:
    """Digest of the sorted version names; null without a list."""
    return short_digest(F.array_join(F.array_sort(versions), "\n"))


def hash_email(c: str | Column, salt: str) -> Column:
    """Pseudonym of an address: its trimmed lower-case form under a salt of at least 16 characters."""
    if len(salt) < 16:
        raise ValueError("the salt needs at least 16 characters")
    return F.concat(F.lit("h:"), F.substring(sha256_text(F.concat(F.lit(salt + "\0"), F.lower(F.trim(col(c))))), 1, 32))


def round_half_up(c: Column) -> Column:
    """Nearest whole number, halves towards plus infinity."""
    return F.floor(c + 0.5)


def normalize_name(c: str | Column) -> Column:
    """Form under which look-alike names meet; the scope is kept."""
    x = F.regexp_replace(F.lower(col(c)), "[-_.]", "")
    x = F.regexp_replace(F.regexp_replace(x, "rn", "m"), "vv", "w")
    return F.translate(x, "10", "lo")


def scope_of(c: str | Column) -> Column:
    """Text between the at sign and the first slash, null without scope."""
    return none_if_empty(F.regexp_extract(col(c), r"^@([^/]+)/", 1))


def distance_cutoff(c: str | Column) -> Column:
    """Edits allowed for a name of that length."""
    return F.when(F.length(col(c)) >= 5, 2).otherwise(1)


def repo_host(c: str | Column) -> Column:
    """Host of a repository address, from git+ and git: spellings too; null if it is none."""
    url = F.regexp_replace(F.regexp_replace(col(c), r"^git\+", ""), "^git:", "https:")
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def run_id(ts: str | Column) -> Column:
    """Run id of an instant: ISO with dashes in the time and no fraction."""
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH-mm-ss'Z'")


def run_instant(c: str | Column) -> Column:
    """Epoch seconds of a run id."""
    return epoch(F.regexp_replace(col(c), r"T(\d{2})-(\d{2})-(\d{2})Z$", "T$1:$2:$3Z"))


def date_path(run: str | Column) -> Column:
    """yyyy/mm/dd of a run id."""
    return F.regexp_replace(F.substring(col(run), 1, 10), "-", "/")


def encode_key(c: str | Column) -> Column:
    """A package name as one path segment: percent-encoded, a space as %20."""
    return F.regexp_replace(F.regexp_replace(F.url_encode(col(c)), r"\+", "%20"), r"\*", "%2A")


def tier(used: Column, ceiling: float, soft: float, hard: float) -> Column:
    """ok, soft or hard, by the used share."""
    return F.when(used >= ceiling * hard, "hard").when(used >= ceiling * soft, "soft").otherwise("ok")


def run_mode(tier_col: Column, queued: Column, backlog: int, triage: int) -> Column:
    """triage, backlog or steady."""
    return F.when((tier_col == "hard") | (queued > triage), "triage").when(queued > backlog, "backlog").otherwise("steady")


def osa_distance(a: str | Column, b: str | Column, cutoff: Column | int) -> Column:
    """Optimal string alignment distance, cutoff + 1 where it is exceeded.

    Rows of the dynamic program are folded with ``aggregate``: an accumulator holds the two
    last rows. It stays inside the JVM; block candidates first, since it is quadratic.
    """
    a, b, cutoff = col(a), col(b), F.lit(cutoff) if isinstance(cutoff, int) else cutoff
    n, m = F.length(a), F.length(b)
    first = F.sequence(F.lit(0), m)
    start = F.struct(first.alias("prev"), F.array_repeat(F.lit(0), m + 1).alias("prev2"))

    def row(acc: Column, i: Column) -> Column:
        def cell(r: Column, j: Column) -> Column:
            same = F.substr(a, i, F.lit(1)) == F.substr(b, j, F.lit(1))
            up, diag, left = F.get(acc["prev"], j) + 1, F.get(acc["prev"], j - 1) + F.when(same, 0).otherwise(1), F.get(r, j - 1) + 1
            best = F.least(up, diag, left)
            swapped = (i > 1) & (j > 1) & (F.substr(a, i, F.lit(1)) == F.substr(b, j - 1, F.lit(1))) & (F.substr(a, i - 1, F.lit(1)) == F.substr(b, j, F.lit(1)))
            return F.concat(r, F.array(F.when(swapped, F.least(best, F.get(acc["prev2"], j - 2) + 1)).otherwise(best)))

        new = F.when(m > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(m, F.lit(1))), F.array(i), cell)).otherwise(F.array(i))
        return F.struct(new.alias("prev"), acc["prev"].alias("prev2"))

    full = F.when(n == 0, m).otherwise(F.element_at(F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), start, row)["prev"], -1))
    return F.when(F.abs(n - m) > cutoff, cutoff + 1).otherwise(F.least(full, cutoff + 1))
