"""Group statistics with fall-back from fine to coarse groups, and the filters built on them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.session import small_side


def group_statistics(df: DataFrame, value: Column, levels: Sequence[Sequence[str]], least: int, alive: Column | None = None) -> DataFrame:
    """``df`` with stat_median, stat_q1, stat_q3, stat_n of the first level whose group has at least ``least`` rows.

    Levels go from fine to coarse, and each coarser one drops keys of the finer, so all of them come
    out of one scan: rows are counted by finest key and value first, and exact weighted percentiles
    are taken over the counts, level by level. Each finest group then chooses its level among these
    aggregates, and the rows are joined once, by the finest key. Rows of no qualifying level have null
    statistics; a null key is a group of its own.
    """
    rows = df if alive is None else df.where(alive)
    finest = list(dict.fromkeys(k for level in levels for k in level))
    counted = rows.select(*finest, value.alias("_value")).groupBy(*finest, "_value").agg(F.count("*").alias("_n"))
    # every group that a row can ask for, also those whose rows do not count
    chosen = df.select(*[F.col(k).alias(f"_f{j}") for j, k in enumerate(finest)]).distinct()
    place, picks = {k: f"_f{j}" for j, k in enumerate(finest)}, []
    for i, level in enumerate(levels):
        stats = counted.groupBy(*[F.col(k).alias(f"_k{i}_{j}") for j, k in enumerate(level)]).agg(
            F.sum("_n").alias(f"_n{i}"), F.percentile("_value", [0.25, 0.5, 0.75], F.col("_n")).alias(f"_p{i}")
        ).where(F.col(f"_n{i}") >= least)
        same = reduce(and_, [F.col(place[k]).eqNullSafe(F.col(f"_k{i}_{j}")) for j, k in enumerate(level)])
        chosen = chosen.join(stats, same, "left").drop(*[f"_k{i}_{j}" for j in range(len(level))])
        picks.append(F.when(F.col(f"_n{i}").isNotNull(), F.struct(F.col(f"_p{i}").alias("p"), F.col(f"_n{i}").alias("n"), F.lit(i).alias("level"))))
    chosen = chosen.select(*place.values(), F.coalesce(*picks).alias("_pick"))
    out = df.join(small_side(chosen), reduce(and_, [F.col(k).eqNullSafe(F.col(f)) for k, f in place.items()]), "left")
    p = F.col("_pick.p")
    return out.select(*df.columns, p[1].alias("stat_median"), p[0].alias("stat_q1"), p[2].alias("stat_q3"), F.col("_pick.n").alias("stat_n"), F.col("_pick.level").alias("stat_level"))


def outside_fence(value: Column, multiplier: float = 2.0, least_iqr: float = 0.05) -> Column:
    """Beyond the quartiles by more than ``multiplier`` times their distance; false where there are no statistics."""
    iqr = F.greatest(F.col("stat_q3") - F.col("stat_q1"), F.lit(least_iqr))
    return F.coalesce((value < F.col("stat_q1") - multiplier * iqr) | (value > F.col("stat_q3") + multiplier * iqr), F.lit(False))


def far_below_median(value: Column, floor: Column | float) -> Column:
    """exp(value - median) under ``floor``, for values on a log scale; false where there are no statistics."""
    return F.coalesce(F.exp(value - F.col("stat_median")) < floor, F.lit(False))


def fill_group_median(df: DataFrame, field: str, group: str, reference: Column, fallback: float, direct: Column | None = None) -> DataFrame:
    """``field`` filled, where null, from ``direct`` if given, else the group's median, else the whole median, else a constant; half-even.

    ``reference`` says which rows count for medians. Adds <field>_known (0 or 1).
    """
    known = df.where(reference & F.col(field).isNotNull())
    counted = known.groupBy(group, field).agg(F.count("*").alias("_n"))
    medians = counted.groupBy(group).agg(F.percentile(field, 0.5, F.col("_n")).alias("_median"))
    overall = counted.agg(F.percentile(field, 0.5, F.col("_n"))).first()[0]  # one number
    out = df.join(small_side(medians.withColumnRenamed(group, "_group")), df[group].eqNullSafe(F.col("_group")), "left")
    estimate = F.bround(F.coalesce(F.col("_median"), F.lit(overall).cast("double"), F.lit(float(fallback))), 0)
    filled = F.coalesce(F.col(field).cast("double"), *([direct.cast("double")] if direct is not None else []), estimate).cast("bigint")
    return out.select(*[filled.alias(c) if c == field else F.col(c) for c in df.columns], F.col(field).isNotNull().cast("bigint").alias(f"{field}_known"))
