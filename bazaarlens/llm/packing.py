"""Problem 9: filling fixed-capacity containers by best-fit decreasing, over all items at once.

Items of one size are interchangeable, so best-fit decreasing is run on the histogram of sizes: a
segment tree over the remaining capacities 0..C counts the open containers, and each step finds
the tightest one that still takes the size in O(log C). A step places a whole run of equal items
into a run of equally full containers, so driver memory depends on C alone, never on the number of
items, and the plan is exactly the one best-fit decreasing would give item by item. Items learn
their place from their rank within their size, which is counted in hash buckets, so one size held
by a third of all rows is spread over all tasks.

Defined results: an item larger than C is cut into full containers and one remainder, which is
packed like any item; an item of size 0 goes to the tightest container there is (to container 0
if there is no other); a null size counts as 0; repeated ids are packed as separate items.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.session import cut_lineage


class CapacityTree:
    """Segment tree over remaining capacities with the number of open containers at each."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1
        while self.leaves < capacity + 1:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, number: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += number
            at //= 2

    def tightest(self, size: int) -> int:
        """The least remaining capacity of at least ``size`` that some container has, or -1."""
        at = size + self.leaves
        if self.count[at]:
            return size
        while at > 1:
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return -1


@dataclass(frozen=True)
class Run:
    """Items of ``size`` with ranks from ``first_rank`` fill containers from ``container``, ``each`` items in every one."""

    size: int
    first_rank: int
    container: int
    each: int


def plan_best_fit_decreasing(histogram: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """Runs in order of (size descending, rank) and the number of containers opened."""
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    tree, ranges, runs, opened = CapacityTree(capacity), {}, [], 0

    def put(room: int, first: int, number: int) -> None:
        if number > 0:
            ranges.setdefault(room, []).append((first, number))
            tree.add(room, number)

    for size in sorted(histogram, reverse=True):
        if not 0 <= size <= capacity:
            raise ValueError(f"size {size} is outside 0..{capacity}")
        rank, left = 0, histogram[size]
        while left > 0:
            room = tree.tightest(size)
            if room < 0:  # open as many as the rest needs
                each = capacity // size if size else left
                need = -(-left // each)
                put(capacity, opened, need)
                opened += need
                room = capacity
            first, number = ranges[room].pop()
            tree.add(room, -number)
            each = room // size if size else left  # the tightest stays the tightest until it is full
            full, rest = divmod(left, each)
            used = min(number, full)
            if used:
                runs.append(Run(size, rank, first, each))
                put(room - each * size, first, used)
                rank, left = rank + used * each, left - used * each
            if used < number and left and left < each:
                runs.append(Run(size, rank, first + used, rest))
                put(room - rest * size, first + used, 1)
                rank, left, used = rank + rest, 0, used + 1
            put(room, first + used, number - used)
    return runs, opened


def pack(items: DataFrame, id_col: str, size_col: str, capacity: int, buckets: int | None = None) -> DataFrame:
    """Columns id, piece_no, piece_size, container_id: every item, whole unless it exceeds ``capacity``.

    ``buckets`` splits the ranking within a size; by default it follows the number of shuffle partitions.
    """
    spark = items.sparkSession
    buckets = buckets or max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    size = F.coalesce(F.col(size_col).cast("long"), F.lit(0))
    # Equal (id, size) rows are interchangeable, so the ranking below needs no further tie-break.
    pieces = items.select(
        F.col(id_col),
        F.greatest(size, F.lit(0)).alias("_size"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(buckets)).cast("int").alias("_bucket"),
    ).withColumn("_n", F.greatest(F.ceil(F.col("_size") / capacity), F.lit(1)).cast("int"))
    pieces = pieces.select(id_col, "_bucket", "_size", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("piece_no"))
    pieces = cut_lineage(pieces.select(id_col, "_bucket", "piece_no", F.least(F.lit(capacity), F.col("_size") - F.col("piece_no") * capacity).cast("int").alias("piece_size")))

    by_bucket = pieces.groupBy("piece_size", "_bucket").agg(F.count("*").alias("_n"))
    counts = cut_lineage(by_bucket)  # at most (capacity + 1) * buckets rows
    histogram = {r[0]: r[1] for r in counts.groupBy("piece_size").agg(F.sum("_n")).collect()}  # at most capacity + 1 rows
    runs, _ = plan_best_fit_decreasing(histogram, capacity)
    places: dict[int, tuple[list[int], list[int], list[int]]] = {}
    for run in runs:
        ranks, containers, each = places.setdefault(run.size, ([], [], []))
        ranks.append(run.first_rank)
        containers.append(run.container)
        each.append(run.each)
    shared = spark.sparkContext.broadcast({s: tuple(np.asarray(x, dtype=np.int64) for x in p) for s, p in places.items()})

    before = Window.partitionBy("piece_size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("piece_size", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("piece_size", "_bucket").orderBy(F.col(id_col), F.col("piece_no"))
    ranked = pieces.withColumn("_row", F.row_number().over(within)).join(offsets, ["piece_size", "_bucket"])
    ranked = ranked.select(id_col, "piece_no", "piece_size", (F.col("_before") + F.col("_row") - 1).alias("_rank"))

    schema = T.StructType([items.schema[id_col], T.StructField("piece_no", T.IntegerType()), T.StructField("piece_size", T.IntegerType()), T.StructField("container_id", T.LongType())])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            sizes, ranks = batch["piece_size"].to_numpy(), batch["_rank"].to_numpy()
            out = np.empty(len(batch), dtype=np.int64)
            for s in np.unique(sizes):
                at = sizes == s
                first, container, each = known[int(s)]
                run = np.searchsorted(first, ranks[at], side="right") - 1
                out[at] = container[run] + (ranks[at] - first[run]) // each[run]
            yield batch.drop(columns="_rank").assign(container_id=out)

    return ranked.mapInPandas(place, schema)


def container_report(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: containers, tokens, the lower bound on containers and the share of space that is filled."""
    bins = packed.groupBy("container_id").agg(F.sum("piece_size").alias("_fill"), F.count("*").alias("_pieces"))
    total = F.sum("_fill")
    return bins.agg(
        F.count("*").alias("containers"),
        F.sum("_pieces").alias("pieces"),
        total.alias("tokens"),
        F.ceil(total / capacity).alias("least_containers"),
        F.max("_fill").alias("fullest"),
        (total / (F.count("*") * capacity)).alias("filled_share"),
    )


def place_by_hand(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing item by item, the plain form that tests compare with: sizes in each container."""
    rooms: list[tuple[int, int]] = []
    bins: list[list[int]] = []
    for size in sorted(sizes, reverse=True):
        at = bisect_right(rooms, (size, -1))
        if at == len(rooms):
            bins.append([size])
            room, which = capacity - size, len(bins) - 1
        else:
            room, which = rooms.pop(at)
            bins[which].append(size)
            room -= size
        rooms.insert(bisect_right(rooms, (room, which)), (room, which))
    return bins
