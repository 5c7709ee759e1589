"""Filling fixed-capacity containers by linear grouping, configurations and best fit.

Sizes are whole tokens, so everything that has to be decided depends on the histogram of
sizes alone: at most ``capacity`` numbers, however many items there are. From it the driver
draws up a plan. Large items, in falling order, are cut into groups of equal cardinality
and rounded up to the largest of their group; with so few sizes the configurations of a
container are optimised by column generation; the real items take the places of the
rounded ones; small items then go, size by size, where they fit best. The plan is a list of
rank intervals, and each item finds its container from its rank among all items, so the
assignment needs no further decision and no task sees more than its share.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registry_lens.llm.bpe import count_tokens
from registry_lens.session import persist_table

#: Salts that spread the items of one size; with the sizes they bound what the driver collects.
MOST_SALTS = 512


@dataclass(frozen=True)
class Plan:
    """Rank intervals: item r >= start[k] (the last such k) goes to first[k] + (r - start[k]) // per[k]."""

    start: np.ndarray
    first: np.ndarray
    per: np.ndarray
    containers: int
    above: np.ndarray  # items larger than a size, by size: the rank of the first item of that size


def best_pattern(value: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """How often each size stands in the most valuable container."""
    most = capacity // int(sizes.min())
    best, taken = np.zeros(capacity + 1), []
    for _ in range(most):  # one more item in each round
        choice, gain = np.full(capacity + 1, -1), best.copy()
        for g, (v, s) in enumerate(zip(value, sizes)):
            with_it = best[: capacity + 1 - s] + v
            better = with_it > gain[s:] + 1e-12
            gain[s:][better] = with_it[better]
            choice[s:][better] = g
        taken.append(choice)
        best = gain
    counts, room = np.zeros(len(sizes), dtype=np.int64), capacity
    for choice in reversed(taken):
        if choice[room] >= 0:
            counts[choice[room]] += 1
            room -= int(sizes[choice[room]])
    return counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, most_rounds: int = 400) -> list[tuple[np.ndarray, int]]:
    """(pattern, copies) covering the demand: column generation over whole patterns, rounded down, the rest by first fit decreasing."""
    n = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    x = np.linalg.solve(basis, demand.astype(float))
    for _ in range(most_rounds):
        price = np.linalg.solve(basis.T, np.where(basis.min(axis=0) < 0, 0.0, 1.0))
        if price.min() < -1e-9:  # a surplus enters
            column, gain = -np.eye(n)[int(price.argmin())], -price.min()
        else:
            column = best_pattern(price, sizes, capacity).astype(float)
            gain = price @ column - 1
        if gain < 1e-7:
            break
        d = np.linalg.solve(basis, column)
        up = d > 1e-9
        ratio = np.full(n, np.inf)
        ratio[up] = np.maximum(x[up], 0) / d[up]
        out = int(ratio.argmin())
        x = x - ratio[out] * d
        x[out] = ratio[out]
        basis[:, out] = column
    plan, left = [], demand.copy()
    for k in np.argsort(-x, kind="stable"):
        pattern, copies = basis[:, k].astype(np.int64), int(np.floor(x[k] + 1e-7))
        if pattern.min() >= 0 and copies > 0:
            plan.append((pattern, copies))
            left = np.maximum(left - pattern * copies, 0)
    while left.any():
        pattern, room = np.zeros(n, dtype=np.int64), capacity
        for g in np.argsort(-sizes, kind="stable"):
            pattern[g] = min(int(left[g]), room // int(sizes[g]))
            room -= int(pattern[g] * sizes[g])
        copies = int((left[pattern > 0] // pattern[pattern > 0]).min())
        plan.append((pattern, max(1, copies)))
        left = left - pattern * max(1, copies)
    return plan


#: (groups, share of the capacity up to which an item is small) of the plans that are drawn up. More groups round
#: less but leave more patterns to round down.
VARIANTS = ((32, 0.125), (64, 0.125), (64, 0.25), (64, 0.34))


def make_plan(histogram: np.ndarray, capacity: int, variants: tuple[tuple[int, float], ...] = VARIANTS) -> Plan:
    """The plan of the fewest containers for ``histogram[s]`` items of each size s up to the capacity.

    Size 0 takes no space and no part. Drawing up a plan costs about a second, whatever the
    number of items.
    """
    return min((_plan(histogram, capacity, groups, small) for groups, small in variants), key=lambda p: p.containers)


def _plan(histogram: np.ndarray, capacity: int, groups: int, small: float) -> Plan:
    counts = histogram.astype(np.int64).copy()
    counts[0] = 0
    above = np.concatenate((np.cumsum(counts[::-1])[::-1][1:], [0]))
    edges = np.concatenate((np.cumsum(counts[::-1]),))  # ranks at which, going down in size, a size ends

    def size_at(rank: int) -> int:
        return capacity - int(np.searchsorted(edges, rank, side="right"))

    least = int(capacity * small)
    large = int(counts[least + 1 :].sum())
    starts, firsts, pers, used = [], [], [], 0
    free: dict[int, list[tuple[int, int]]] = {}  # room left -> (first container, how many)
    if large:
        cut = np.unique(np.linspace(0, large, min(groups, large) + 1).astype(np.int64))
        first_rank, demand = cut[:-1].copy(), np.diff(cut)
        sizes = np.array([size_at(int(r)) for r in first_rank])
        place, end = first_rank.copy(), cut[1:]
        merged = sorted(set(sizes.tolist()), reverse=True)  # groups of one rounded size share their patterns
        of = {s: np.flatnonzero(sizes == s) for s in merged}
        total = np.array([int(demand[of[s]].sum()) for s in merged])
        for pattern, copies in configurations(np.array(merged), total, capacity):
            slots = []
            for g, times in enumerate(pattern):
                members = of[merged[g]]
                at, stop = int(place[members[0]]), int(end[members[-1]])
                for _ in range(int(times)):
                    take = min(copies, stop - at)
                    if take > 0:
                        slots.append((at, take))
                        starts.append(at), firsts.append(used), pers.append(1)
                        at += take
                place[members[0]] = at
            # containers of one pattern differ in room only where the size in one of their places changes
            cuts = {0, copies}
            for at, take in slots:
                cuts.add(take)
                a, b = size_at(at), size_at(at + take - 1)
                cuts.update(int(edges[capacity - s]) - at for s in range(b + 1, a + 1) if counts[s] and 0 < edges[capacity - s] - at < take)
            bounds = sorted(c for c in cuts if 0 <= c <= copies)
            for a, b in zip(bounds[:-1], bounds[1:]):
                room = capacity - sum(size_at(at + a) for at, take in slots if a < take)
                free.setdefault(room, []).append((used + a, b - a))
            used += copies
    rooms = sorted(free)
    for s in range(least, 0, -1):
        rank, left = int(above[s]), int(counts[s])
        while left:
            k = bisect.bisect_left(rooms, s)
            if k == len(rooms):  # nothing fits: open as many containers as this size fills
                n = -(-left // (capacity // s))
                free.setdefault(capacity, []).append((used, n))
                bisect.insort(rooms, capacity)
                used += n
                continue
            room = rooms[k]
            at, n = free[room].pop()
            if not free[room]:
                del free[room]
                rooms.pop(k)
            per = room // s
            whole = min(n, left // per)
            rest = left - whole * per if whole < n else 0
            pieces = [(at, whole, per)] * (whole > 0) + [(at + whole, 1, rest)] * (rest > 0)
            for c, m, each in pieces:
                starts.append(rank), firsts.append(c), pers.append(each)
                rank, left = rank + m * each, left - m * each
            back = [(room - each * s, c, m) for c, m, each in pieces]
            touched = whole + (rest > 0)
            if touched < n:
                back.append((room, at + touched, n - touched))
            for r, c, m in back:
                if r not in free:
                    free[r] = []
                    bisect.insort(rooms, r)
                free[r].append((c, m))
    order = np.argsort(np.array(starts, dtype=np.int64), kind="stable")
    return Plan(np.array(starts, dtype=np.int64)[order], np.array(firsts, dtype=np.int64)[order], np.array(pers, dtype=np.int64)[order], used, above)


def cut_items(lengths: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, piece, start, size): texts as they are, larger ones in pieces of the capacity and a rest."""
    pieces = F.greatest(F.lit(1), F.ceil(F.col("tokens") / capacity)).cast("int")
    rows = lengths.select("doc_id", "tokens", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"))
    start = F.col("piece").cast("long") * capacity
    return rows.select("doc_id", "piece", start.alias("start"), F.least(F.lit(capacity), F.col("tokens") - start).cast("int").alias("size"))


def pack(lengths: DataFrame, capacity: int = 2048, variants: tuple[tuple[int, float], ...] = VARIANTS) -> DataFrame:
    """(doc_id, piece, start, size, container) for (doc_id, tokens): every token of every text in exactly one container.

    Only texts of more tokens than the capacity have several pieces. Empty and null texts
    take no space; they are put in container 0. Of equal rows each is an item of its own.
    An empty table gives an empty result.
    """
    spark = lengths.sparkSession
    salts = min(MOST_SALTS, max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    known = persist_table(lengths, "token-lengths")
    items = cut_items(known, capacity).withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    cells = np.zeros((salts, capacity + 1), dtype=np.int64)
    for salt, size, n in items.groupBy("salt", "size").count().collect():  # at most salts x capacity cells
        cells[salt, size] = n
    plan = make_plan(cells.sum(axis=0), capacity, variants)
    base = np.cumsum(cells, axis=0) - cells + plan.above  # rank before the first item of a salt and size
    shared = spark.sparkContext.broadcast((plan, base))
    ranked = items.withColumn("nth", F.row_number().over(Window.partitionBy("salt", "size").orderBy("doc_id", "piece")))
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("size", pa.int32()), ("container", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, base = shared.value
        for batch in batches:
            salt, size, nth = (batch.column(k).to_numpy() for k in (4, 3, 5))
            container = np.zeros(len(size), dtype=np.int64)
            real = size > 0
            rank = base[salt[real], size[real]] + nth[real] - 1
            k = np.searchsorted(plan.start, rank, side="right") - 1
            container[real] = plan.first[k] + (rank - plan.start[k]) // plan.per[k]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(4)), pa.array(container)], schema=schema)

    return ranked.select("doc_id", "piece", "start", "size", "salt", "nth").mapInArrow(place, "doc_id long, piece int, start long, size int, container long")


def pack_documents(documents: DataFrame, capacity: int = 2048, tokenizer: str = "byte_bpe_50k", folder: str | None = None, variants: tuple[tuple[int, float], ...] = VARIANTS) -> DataFrame:
    """Containers of the texts of ``documents`` (doc_id, text), measured in tokens."""
    return pack(count_tokens(documents, tokenizer=tokenizer, folder=folder), capacity, variants)
