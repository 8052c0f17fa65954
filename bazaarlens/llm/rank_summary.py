"""Problem 1: percentiles with a stated bound from mergeable rank-interval summaries.

A summary of n values is a sorted list of tuples (value, rmin, rmax): the value's rank lies surely
in rmin..rmax. Merging adds the rank intervals of the other side's neighbours, which keeps every
interval sure, so errors of parts add up to at most the same share of the whole; compressing drops
tuples as long as the widest gap stays within the permitted uncertainty, 2 * share * n ranks.
Building is one pass over the partitions with no shuffle of rows; only summaries travel. They are
merged in a tree of ``FAN`` summaries a node whose height follows the largest number of summaries
that a group has, so a group that holds a third of all rows costs no task more than ``FAN`` summaries,
each of bounded size.

Every summary carries the ``epsilon`` that it promises and its depth in the tree. Compressing at depth
d may bring the error to ``budget(d)`` of epsilon, a series that grows with d and never reaches the
whole, so results of days, files or earlier merges can be combined as often as one likes and still
keep epsilon; what grows with depth is the size, by the square of it at most. ``rank_error`` states
the error that was really accumulated: the answer for a percentile differs from the true one by at
most that many ranks. Groups of up to about (1 / epsilon) values are never compressed and come out exact.

Defined results: null and NaN values are left out of ranks and counted in ``n_missing``; null
group keys form their own group; infinities are ordinary extreme values; the percentile q of n
values is the ascending value of rank max(1, ceil(q * n)); a group without values has null
percentiles; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.session import cut_lineage, small_side

Summary = tuple[np.ndarray, np.ndarray, np.ndarray]
COLUMNS = ("n", "n_missing", "epsilon", "depth", "part", "tuple_values", "rmin", "rmax")
SUMMARY_FIELDS = "n long, n_missing long, epsilon double, depth int, part long, tuple_values array<double>, rmin array<long>, rmax array<long>"
#: Summaries that one task merges into one.
FAN = 64


def budget(depth: int) -> float:
    """Share of epsilon that may be spent up to a depth: the sum of 1 / k^2 to depth + 1 over its limit."""
    return sum(1.0 / (k * k) for k in range(1, depth + 2)) * 6.0 / math.pi**2


def exact(values: np.ndarray) -> Summary:
    """The summary of sorted values with sure ranks; equal values share one tuple spanning their ranks."""
    n = len(values)
    rank = np.arange(1, n + 1, dtype=np.int64)
    return values, rank, rank.copy()


def merge(a: Summary, b: Summary) -> Summary:
    """The summary of both sides together; no rank interval loses its certainty."""
    if not len(a[0]) or not len(b[0]):
        return b if not len(a[0]) else a

    def shifted(x: Summary, y: Summary, ties_before: bool) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(y[0], x[0], side="right" if ties_before else "left")
        below = np.where(at > 0, y[1][np.maximum(at - 1, 0)], 0)
        above = np.where(at < len(y[0]), y[2][np.minimum(at, len(y[0]) - 1)] - 1, y[2][-1])
        return x[1] + below, x[2] + above

    lo_a, hi_a = shifted(a, b, False)
    lo_b, hi_b = shifted(b, a, True)
    values = np.concatenate([a[0], b[0]])
    order = np.argsort(values, kind="stable")
    return values[order], np.concatenate([lo_a, lo_b])[order], np.concatenate([hi_a, hi_b])[order]


def widest_gap(s: Summary) -> int:
    """The largest distance between sure bounds of neighbours, in ranks."""
    return int(np.max(s[2][1:] - s[1][:-1], initial=0)) if len(s[0]) else 0


def compress(s: Summary, permitted: float) -> Summary:
    """Drop tuples while every gap of neighbours stays within ``permitted`` ranks; ends are kept."""
    values, rmin, rmax = s
    n = len(values)
    if n < 3 or permitted < 2:
        return s
    keep, at = [0], 0
    while at < n - 1:
        # the farthest tuple whose upper rank is still within reach of this one's lower rank
        reach = int(np.searchsorted(rmax, rmin[at] + permitted, side="right")) - 1
        at = min(max(at + 1, reach), n - 1)
        keep.append(at)
    k = np.asarray(keep)
    return values[k], rmin[k], rmax[k]


def rank_error(s: Summary) -> int:
    """The most ranks by which an answer can be off; 0 if all ranks are known."""
    gap = widest_gap(s)
    return 0 if gap <= 1 else math.ceil(gap / 2)


def query(s: Summary, q: float) -> float | None:
    """The value whose rank interval is nearest to the rank of percentile ``q``."""
    values, rmin, rmax = s
    if not len(values):
        return None
    rank = max(1, math.ceil(round(q * int(rmax[-1]), 9)))
    return float(values[int(np.argmin(np.maximum(rank - rmin, rmax - rank)))])


#: Rows that a task sorts at once, and tuples it holds before it sends its summaries on.
BUFFER_ROWS, HELD_TUPLES = 100_000, 2_000_000


def summarize(df: DataFrame, keys: Sequence[str], value_col: str | Column, epsilon: float = 0.0005) -> DataFrame:
    """One summary row for each group: ``keys`` and ``COLUMNS``.

    ``part`` and ``depth`` belong to the merge tree; results of separate days or files can be
    unioned and given to :func:`combine`.
    """
    value = F.col(value_col) if isinstance(value_col, str) else value_col
    # positions instead of the caller's names, so that clashing names do no harm
    rows = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], value.cast("double").alias("v"))
    key_cols = [f"k{i}" for i in range(len(keys))]
    key_fields = [T.StructField(f"k{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
    share = epsilon * budget(0)
    schema = T.StructType(key_fields + T.StructType.fromDDL(SUMMARY_FIELDS).fields)

    columns = [*key_cols, *COLUMNS]

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        kept: dict[tuple, list] = {}

        def flush() -> pd.DataFrame:
            out = [(*(None if x == "\0null" else x for x in name), n, m, epsilon, 0, part, *compress(s, 2 * share * n)) for name, (n, m, s) in kept.items()]
            kept.clear()
            return pd.DataFrame(out, columns=columns)

        def add(buffer: list[pd.DataFrame]) -> None:
            rows_of = pd.concat(buffer, ignore_index=True)
            code = np.zeros(len(rows_of), dtype=np.int64)
            for k in key_cols:
                c, u = pd.factorize(rows_of[k], use_na_sentinel=False)
                code = np.unique(code * len(u) + c, return_inverse=True)[1]
            v = rows_of["v"].to_numpy(dtype=float, na_value=np.nan)
            order = np.lexsort((v, code))  # missing values last in each group
            v, code = v[order], code[order]
            ends = np.flatnonzero(np.diff(code, append=-1)) + 1
            firsts = rows_of[key_cols].iloc[order[np.concatenate([[0], ends[:-1]])]].itertuples(index=False, name=None) if key_cols else iter([()])
            start = 0
            for end, key in zip(ends, firsts, strict=True):
                values = v[start:end]
                total = len(values)
                seen = values[: np.searchsorted(values, np.nan)] if total and np.isnan(values[-1]) else values
                start = end
                name = tuple("\0null" if pd.isna(x) else x for x in key)
                state = kept.setdefault(name, [0, 0, exact(seen[:0])])
                state[0] += len(seen)
                state[1] += total - len(seen)
                state[2] = merge(state[2], exact(seen))
                if len(state[2][0]) > 4 / share:
                    state[2] = compress(state[2], 2 * share * state[0])

        buffer, held = [], 0
        for batch in batches:
            if len(batch):
                buffer.append(batch)
                held += len(batch)
            if held >= BUFFER_ROWS:
                add(buffer)
                buffer, held = [], 0
            if sum(len(x[2][0]) for x in kept.values()) > HELD_TUPLES or len(kept) > HELD_TUPLES // 16:
                yield flush()
        if held:
            add(buffer)
        if kept:
            yield flush()

    merged = _merge_tree(rows.mapInPandas(build, schema), key_cols)
    return merged.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], *COLUMNS)


def _merge_tree(summaries: DataFrame, key_cols: list[str]) -> DataFrame:
    """Merge level by level, up to ``FAN`` summaries of a group at a time, until each group has one."""
    schema = summaries.schema
    names = [f.name for f in schema.fields]

    def close(key: tuple, rows: list[tuple]) -> tuple:
        if len(rows) == 1:
            return (*key, *rows[0])
        n, epsilon, depth = sum(r[0] for r in rows), max(r[2] for r in rows), max(r[3] for r in rows) + 1
        sides = [r[5:] for r in rows]
        while len(sides) > 1:
            sides = [merge(sides[i], sides[i + 1]) if i + 1 < len(sides) else sides[i] for i in range(0, len(sides), 2)]
        return (*key, n, sum(r[1] for r in rows), epsilon, depth, rows[0][4], *compress(sides[0], 2 * epsilon * budget(depth) * n))

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # rows of a node follow each other, so one node is held at a time
        key, rows = None, []
        for batch in batches:
            out = []
            clean = [batch[k].astype(object).where(batch[k].notna(), None) for k in key_cols]
            for *new, n, m, epsilon, depth, part, v, lo, hi in zip(*clean, *(batch[c] for c in names[len(key_cols):]), strict=True):
                mark = (*new, part)
                if mark != key:
                    if rows:
                        out.append(close(key[:-1], rows))
                    key, rows = mark, []
                rows.append((n, m, epsilon, depth, part, v, lo, hi))
            if out:
                yield pd.DataFrame(out, columns=names)
        if rows:
            yield pd.DataFrame([close(key[:-1], rows)], columns=names)

    summaries = cut_lineage(summaries)
    most = summaries.groupBy(*key_cols).agg(F.count("*").alias("_n")).agg(F.max("_n")).first()[0] or 0
    while most > 1:
        most = math.ceil(most / FAN)
        nodes = summaries.withColumn("part", F.pmod(F.col("part"), F.lit(most)).cast("long"))
        summaries = nodes.repartition(*key_cols, "part").sortWithinPartitions(*key_cols, "part").mapInPandas(join, schema)
    return summaries


def combine(summaries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge summary rows of days, files or runs into one row for each group of ``keys``, within the largest epsilon that they promise.

    A hash of each row's counts spreads the rows of a group over the nodes of the tree, so that a group
    of any number of rows never goes through one task.
    """
    part = F.xxhash64("n", "n_missing", F.element_at("tuple_values", 1), F.element_at("tuple_values", -1), "part")
    rows = summaries.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *[F.when(F.col("n") > 0, part).otherwise(0).cast("long").alias(c) if c == "part" else c for c in COLUMNS])
    return _merge_tree(rows, [f"k{i}" for i in range(len(keys))]).select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], *COLUMNS)


def percentiles(summaries: DataFrame, keys: Sequence[str], probabilities: dict[str, float]) -> DataFrame:
    """``keys``, n, n_missing, one column for each name in ``probabilities``, rank_error, error_share."""
    fields = [summaries.schema[k] for k in keys]
    out = [T.StructField("n", T.LongType()), T.StructField("n_missing", T.LongType()), *[T.StructField(p, T.DoubleType()) for p in probabilities], T.StructField("rank_error", T.LongType()), T.StructField("error_share", T.DoubleType())]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.to_dict("records"):
                s = (np.asarray(r["tuple_values"], float), np.asarray(r["rmin"], np.int64), np.asarray(r["rmax"], np.int64))
                off = rank_error(s)
                rows.append([*(r[k] for k in keys), r["n"], r["n_missing"], *(query(s, q) for q in probabilities.values()), off, off / r["n"] if r["n"] else 0.0])
            yield pd.DataFrame(rows, columns=[f.name for f in [*fields, *out]])

    return summaries.select(*keys, "n", "n_missing", "tuple_values", "rmin", "rmax").mapInPandas(run, T.StructType([*fields, *out]))


def rank_check(rows: DataFrame, keys: Sequence[str], value_col: str, answers: DataFrame, probabilities: dict[str, float], epsilon: float) -> DataFrame:
    """``keys``, n, exact_ranks, bound_holds: whether each answer's true rank is within the stated error, and that within epsilon of n.

    The ranks of the answers are counted over all rows, by equal values first.
    """
    named = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    same = reduce(and_, [F.col(f"k{i}").eqNullSafe(F.col(f"a{i}")) for i in range(len(keys))])
    counted = rows.select(*named, F.col(value_col).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy(*[f"k{i}" for i in range(len(keys))], "v").agg(F.count("*").alias("c"))
    found = answers.select(*[F.col(k).alias(f"a{i}") for i, k in enumerate(keys)], "n", "rank_error", *probabilities)
    below = [F.sum(F.when(F.col("v") < F.col(p), F.col("c")).otherwise(0)).alias(f"{p}_below") for p in probabilities]
    upto = [F.sum(F.when(F.col("v") <= F.col(p), F.col("c")).otherwise(0)).alias(f"{p}_upto") for p in probabilities]
    ranked = counted.join(small_side(found), same).groupBy(*[f"a{i}" for i in range(len(keys))], "n", "rank_error").agg(*below, *upto)
    wanted = {p: F.greatest(F.lit(1), F.ceil(F.round(F.lit(q) * F.col("n"), 9))) for p, q in probabilities.items()}
    fits = reduce(and_, [(F.col(f"{p}_below") + 1 - F.col("rank_error") <= w) & (w <= F.col(f"{p}_upto") + F.col("rank_error")) for p, w in wanted.items()])
    return ranked.select(*[F.col(f"a{i}").alias(k) for i, k in enumerate(keys)], "n", fits.alias("exact_ranks"), (F.col("rank_error") <= F.greatest(F.lit(1.0), F.lit(epsilon) * F.col("n") + 1)).alias("bound_holds"))
