"""Problem 4: missing values filled from similar records by label propagation, every fill marked.

Records are linked through the groups they belong to ("hubs"): fine ones such as model, storage,
condition and age band, and coarser ones down to the whole table. A hub's value is the mean of its
members (a distribution over categories for categorical fields); a record without a value takes the
weighted mean of its hubs' values, finer and better supported hubs counting more; observed values
are clamped. This repeats until values stand still, so that values travel over hubs that share
members to groups in which nothing was observed; if they do not within ``max_rounds``, that is an error.

Records with the same hubs move in step, so the rows are first aggregated to cells (distinct
combinations of hub keys) and the iteration runs over cells alone; a key held by a third of all
rows costs one cell. Rows are read twice and, if the cells are few, never shuffled again.

Defined results: a null or unusable value is missing; a record none of whose hubs ever gets a value
stays null with status 'unfilled'; a hub does not apply to a record that lacks one of its keys;
means are rounded half-even for whole-number fields and kept within the given bounds; ties of
categories go to the smallest; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.session import cut_lineage, small_side, unused_name


#: Cells that listen to a hub beyond which, and beyond a thousandth of all, its value is broadcast.
CROWDED = 20_000


@dataclass(frozen=True)
class Target:
    """A field to fill: ``usable`` says which values count as observed; ``categorical`` fields get the likeliest category."""

    field: str
    usable: Column
    categorical: bool = False
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class Hub:
    """A group key over named key columns and its weight in a member's mean."""

    keys: tuple[str, ...]
    weight: float


def fill(df: DataFrame, targets: Sequence[Target], keys: dict[str, Column], hubs: Sequence[Hub], support: float = 3.0, carried: float = 0.25, tolerance: float = 0.01, max_rounds: int = 50) -> DataFrame:
    """``df`` with the targets filled and a column ``<field>_status`` for each: observed, filled or unfilled.

    ``support`` is the number of observations at which a hub counts half its weight; ``carried``
    is the share of an observation that a filled value counts for.
    """
    names = {k: unused_name(df, f"_key_{k}") for k in keys}
    cell = unused_name(df, "_cell")
    rows = df.withColumns({names[k]: c for k, c in keys.items()})
    # the hash passes over nulls, so they are written out
    rows = rows.withColumn(cell, F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in names.values()]))

    # cells: for each target and channel (category, or '' for means) the observed mass, and the missing members
    per_target = [
        F.struct(
            F.lit(i).alias("target"),
            F.when(t.usable, F.col(t.field).cast("string") if t.categorical else F.lit("")).alias("channel"),
            F.when(t.usable, F.lit(1.0) if t.categorical else F.col(t.field).cast("double")).alias("mass"),
        )
        for i, t in enumerate(targets)
    ]
    members = rows.select(cell, *names.values(), F.explode(F.array(*per_target)).alias("t"))
    cells = cut_lineage(members.groupBy(F.col(cell).alias("cell"), "t.target", "t.channel").agg(F.sum("t.mass").alias("mass"), F.count("*").alias("n"), *[F.first(c).alias(k) for k, c in names.items()]))
    links = [F.when(F.array(*[F.col(k).isNotNull() for k in h.keys] or [F.lit(True)]).cast("string").contains("false"), None).otherwise(F.struct(F.lit(i).alias("hub"), F.xxhash64(F.lit(i), *h.keys).alias("hub_key"), F.lit(h.weight).alias("w"))) for i, h in enumerate(hubs)]
    edges = cut_lineage(
        cells.dropDuplicates(["cell"]).select("cell", F.explode(F.array(*links)).alias("l")).where(F.col("l").isNotNull()).select("cell", "l.*")
    )
    known = cells.where(F.col("channel").isNotNull()).select("cell", "target", "channel", "mass", "n")
    waiting = cells.where(F.col("channel").isNull()).select("cell", "target", F.col("n").alias("waiting"))
    categorical = F.array(*[F.lit(t.categorical) for t in targets])[F.col("target")]

    # what a hub knows by observation: the mass of each channel, and the number of members that stand behind it
    observed = cut_lineage(edges.join(known, "cell").groupBy("hub_key", "target", "channel").agg(F.sum("mass").alias("mass"), F.sum("n").cast("double").alias("behind")))
    asking = cut_lineage(edges.join(waiting, "cell").select("cell", "hub_key", "w", "target", "waiting"))
    listeners = asking.groupBy("hub_key", "target").agg(F.count("*").alias("_n"))
    least = max(CROWDED, asking.count() // 1_000)
    crowded = cut_lineage(listeners.where(F.col("_n") > least).select("hub_key", "target", F.lit(True).alias("crowded")))  # under a thousand hubs
    asking = cut_lineage(asking.join(F.broadcast(crowded), ["hub_key", "target"], "left").withColumn("crowded", F.coalesce("crowded", F.lit(False))))

    state: DataFrame | None = None
    for _ in range(max_rounds):
        told = observed
        if state is not None:
            sent = asking.join(state, ["cell", "target"])
            lent = sent.groupBy("hub_key", "target", "channel").agg((F.sum(F.col("value") * F.col("waiting")) * carried).alias("mass"), (F.sum("waiting") * carried).alias("behind"))
            # of a category's value, only its share of the members stands behind it
            lent = lent.select("hub_key", "target", "channel", "mass", F.when(categorical, F.col("mass")).otherwise(F.col("behind")).alias("behind"))
            told = observed.unionByName(lent).groupBy("hub_key", "target", "channel").agg(F.sum("mass").alias("mass"), F.sum("behind").alias("behind"))
        hub_values = told.groupBy("hub_key", "target").agg(F.collect_list(F.struct("channel", "mass")).alias("channels"), F.sum("behind").alias("weight"))
        loud = F.broadcast(hub_values.join(F.broadcast(crowded), ["hub_key", "target"], "left_semi"))
        heard = asking.where("not crowded").join(hub_values, ["hub_key", "target"]).unionByName(asking.where("crowded").join(loud, ["hub_key", "target"]))
        trust = F.col("w") * F.col("weight") / (F.col("weight") + support)
        spoken = heard.select("cell", "target", trust.alias("trust"), "weight", F.explode("channels").alias("c"))
        summed = spoken.groupBy("cell", "target", "c.channel").agg(F.sum(F.col("trust") * F.col("c.mass") / F.col("weight")).alias("v"), F.sum("trust").alias("t"))
        # means are divided by the trust in all hubs, categories are made to sum to one
        cells_heard = summed.groupBy("cell", "target").agg(F.collect_list(F.struct("channel", "v", "t")).alias("all"), F.sum("v").alias("whole"))
        after = cells_heard.select("cell", "target", "whole", F.explode("all").alias("a")).select("cell", "target", "a.channel", (F.col("a.v") / F.when(categorical, F.col("whole")).otherwise(F.col("a.t"))).alias("value"))
        after = cut_lineage(after)
        if state is None:
            moved = float("inf")
        else:
            old = state.select("cell", "target", "channel", F.col("value").alias("old"))
            moved = after.join(old, ["cell", "target", "channel"], "left").agg(F.max(F.abs(F.col("value") - F.coalesce("old", F.lit(0.0))) / (F.abs("value") + 1))).first()[0] or 0.0
        state = after
        if moved < tolerance:
            break
    else:
        raise ArithmeticError(f"values did not stand still within {max_rounds} rounds")

    best = state.groupBy("cell", "target").agg(F.max(F.struct(F.round("value", 9).alias("v"))).alias("top"))
    chosen = state.join(best, ["cell", "target"]).where(F.round("value", 9) == F.col("top.v")).groupBy("cell", "target").agg(F.min("channel").alias("channel"), F.max("value").alias("value"))
    fills = chosen.groupBy("cell").agg(*[F.max(F.when(F.col("target") == i, F.col("channel") if t.categorical else F.col("value"))).alias(f"_fill_{i}") for i, t in enumerate(targets)])
    fills = cut_lineage(fills.withColumnRenamed("cell", cell))

    renamed = {f"_fill_{i}": unused_name(rows, f"_fill_{i}") for i in range(len(targets))}
    out = rows.join(small_side(fills.withColumnsRenamed(renamed)), cell, "left")
    columns = {}
    for i, t in enumerate(targets):
        kind = df.schema[t.field].dataType
        value = F.col(renamed[f"_fill_{i}"])
        if not t.categorical:
            value = F.bround(value, 0) if kind.simpleString() in ("int", "bigint", "smallint", "tinyint") else value
            value = F.least(F.greatest(value, F.lit(t.low)), F.lit(t.high)) if t.low is not None else value
        usable = F.coalesce(t.usable, F.lit(False))
        columns[t.field] = F.when(usable, F.col(t.field)).otherwise(value.cast(kind))
        columns[unused_name(df, f"{t.field}_status")] = F.when(usable, "observed").when(value.isNotNull(), "filled").otherwise("unfilled")
    extra = [c for c in columns if c not in df.columns]
    return out.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in df.columns], *[columns[c].alias(c) for c in extra])


def to_fill(filled: DataFrame, fields: Sequence[str], id_col: str) -> DataFrame:
    """Columns row_key, field_name of every value that had to be filled."""
    marks = F.array(*[F.when(F.col(f"{f}_status") != "observed", F.lit(f)) for f in fields])
    return filled.select(F.col(id_col).cast("string").alias("row_key"), F.explode(F.array_compact(marks)).alias("field_name"))
