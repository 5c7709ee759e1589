"""Names that look like popular ones.

Candidates come from equi-joins: the same normal form, or a part in common. A target is cut
into three parts; two edits can't touch all of them, once transpositions across a border
are undone, so within two edits a name has one part at its place, give or take the letters
added or removed before it. Target and name meet on (length, part, letters), of which a name
has at most 39 and a target 12, and the edit distance runs on those that meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registry_lens.functions.scalars import distance_cutoff, normalize_name, osa_distance, scope_of


def ranked(names: DataFrame, order: str, size: int = 20_000) -> DataFrame:
    """(target, rank) of the ``size`` most popular names, 1 being the most popular: a top list, by whose size the window is bounded."""
    top = names.where("name is not null").orderBy(F.col(order).desc(), "name").limit(size)
    return top.select(F.col("name").alias("target"), F.row_number().over(Window.orderBy(F.col(order).desc(), "name")).alias("rank"))


PARTS = 3


def _border(size: Column, k: int | Column) -> Column:
    """Where a part begins; whole numbers throughout."""
    return F.floor(size * k / PARTS).cast("int")


def _swapped(text: Column, at: Column) -> Column:
    """The text with the letters on both sides of a border exchanged."""
    inside = (at > 0) & (at < F.length(text))
    piece = lambda start, size: F.substr(text, start, size)
    one = F.lit(1)
    return F.when(inside, F.concat(piece(one, at - 1), piece(at + 1, one), piece(at, one), piece(at + 2, F.length(text)))).otherwise(text)


def target_parts(targets: DataFrame) -> DataFrame:
    """``targets`` (target, ...) with a row per part: tsize, part, letters."""
    size = F.length("target")
    first, second = _border(size, 1), _border(size, 2)
    forms = F.array_distinct(F.array(F.col("target"), _swapped(F.col("target"), first), _swapped(F.col("target"), second), _swapped(_swapped(F.col("target"), first), second)))
    cut = lambda form, k: F.substr(form, _border(size, k) + 1, _border(size, k + 1) - _border(size, k))
    parts = F.array_distinct(F.flatten(F.transform(forms, lambda f: F.array(*(F.struct(F.lit(k).alias("part"), cut(f, k).alias("letters")) for k in range(PARTS))))))
    return targets.select("*", size.alias("tsize"), F.explode(parts).alias("p")).select("*", "p.part", "p.letters").drop("p")


def name_parts(names: DataFrame, longest_edit: int = 2) -> DataFrame:
    """``names`` (name, cutoff, ...) with a row per place at which a part of a target within the cutoff can stand: tsize, part, letters."""
    places = [
        (longer, k, shift) for longer in range(-longest_edit, longest_edit + 1) for k in range(PARTS) for shift in range(-longest_edit, longest_edit + 1) if abs(shift) + abs(longer - shift) <= longest_edit
    ]  # longer: letters the name has more than the target; shift: those of them before the part
    table = F.array(*(F.struct(F.lit(a).alias("longer"), F.lit(k).alias("part"), F.lit(b).alias("shift"), F.lit(abs(b) + abs(a - b)).alias("edits")) for a, k, b in places))
    rows = names.select("*", F.length("name").alias("size"), F.explode(table).alias("p")).select("*", "p.*", (F.col("size") - F.col("p.longer")).alias("tsize"))
    start, end = _border(F.col("tsize"), F.col("part")), _border(F.col("tsize"), F.col("part") + 1)
    fits = (F.col("cutoff") >= F.col("edits")) & (F.col("tsize") >= 1) & (start + F.col("shift") >= 0) & (end + F.col("shift") <= F.col("size"))
    return rows.where(fits).select(*names.columns, "tsize", "part", F.substr(F.col("name"), start + F.col("shift") + 1, end - start).alias("letters"))


def within_edits(names: DataFrame, targets: DataFrame, longest_edit: int = 2) -> DataFrame:
    """(name, target) that may be within the cutoff (at most two), of ``names`` (name, cutoff) and ``targets`` (target); a pair may come several times, and none within it is missing."""
    joined = name_parts(names, longest_edit).join(target_parts(targets), ["tsize", "part", "letters"])
    return joined.where(F.levenshtein("name", "target", 2 * longest_edit) >= 0).select("name", "target")  # a transposition is two plain edits: a cheap necessary condition


def candidates(names: DataFrame, popular: DataFrame, longest_edit: int = 2) -> DataFrame:
    """(name, target, rank, distance, collision) of every name that isn't popular itself and every target within its cutoff.

    The normal form is one more key to meet on, so names are read and joined once.
    """
    own = names.select("name").where("name is not null").distinct().join(popular.select(F.col("target").alias("name")), "name", "left_anti")
    shaped = own.select("name", distance_cutoff("name").alias("cutoff"))
    whole = lambda df, c: df.select(*df.columns, F.lit(0).alias("tsize"), F.lit(PARTS).alias("part"), normalize_name(c).alias("letters"))
    ranked_parts = target_parts(popular.select("target", "rank"))
    right = ranked_parts.unionByName(whole(popular.select("target", "rank"), "target"))
    left = name_parts(shaped, longest_edit).unionByName(whole(shaped, "name"))
    scope = lambda c: F.col(c).startswith("@")
    met = left.join(right, ["tsize", "part", "letters"]).where((scope("name") == scope("target")) & ((F.col("part") == PARTS) | (F.levenshtein("name", "target", 2 * longest_edit) >= 0)))
    both = met.groupBy("name", "target", "rank", "cutoff").agg(F.max(F.col("part") == PARTS).alias("collision"))
    measured = both.withColumn("distance", osa_distance("name", "target", F.col("cutoff")))
    return measured.where((F.col("distance") <= F.col("cutoff")) | F.col("collision"))


def score(distance: Column, cutoff: Column, collision: Column, rank: Column, known_scope: Column) -> Column:
    """0 to 1: seven parts closeness, three parts prominence, a little more when the scope is a popular one; three decimals."""
    closeness = F.when(collision, 1.0).otherwise((cutoff + 1 - distance) / (cutoff + 1))
    prominence = 1 - F.least(rank, F.lit(5000)) / 5000
    base = closeness * 0.7 + prominence * 0.3
    return F.round(F.least(F.lit(1.0), base + F.when(known_scope, 0.15).otherwise(0.0)), 3)


def scores(names: DataFrame, popular: DataFrame) -> DataFrame:
    """(name, score, target, distance, collision, nearest): the best hit and the three nearest; names without a hit have no row."""
    found = candidates(names, popular)
    scopes = popular.select(scope_of("target").alias("scope")).where("scope is not null").distinct().withColumn("known", F.lit(True))
    best = found.groupBy("name").agg(
        F.min(F.struct("distance", "rank", "target", "cutoff", "collision")).alias("b"),
        F.slice(F.array_sort(F.collect_set(F.struct("distance", "rank", "target"))), 1, 3).alias("nearest"),
    )
    tagged = best.withColumn("scope", scope_of("name")).join(scopes, "scope", "left")
    value = score(F.col("b.distance"), F.col("b.cutoff"), F.col("b.collision"), F.col("b.rank"), F.coalesce("known", F.lit(False)))
    return tagged.select("name", value.alias("score"), "b.target", "b.distance", "b.collision", F.transform("nearest", lambda x: x["target"]).alias("nearest"))
