"""Problem 2: one surviving record for each group of captures, by iterative truth discovery.

Captures of one advertisement make claims about its fields. Sources (hosts) have a reliability that
is not known beforehand: the support of a value is the sum of its claims' weights, each the source's
reliability times the claim's share of the vote; the best supported value of each field is taken for
true, and a source's reliability is the share of its disputed claims that agree with what is taken
for true. Both are estimated in turn until reliabilities stand still.

Fields without a time of their own (title, model) give every claim the same share. Fields that change
over time (battery, price) give the freshest claim a whole vote and let all others share ``stale``
votes, so the freshest one stands against any number of older ones, unless its source is so much
less reliable than theirs that their shared vote outweighs it.

A field on which the valid captures of a group agree needs no iteration; those groups are settled by
one partial aggregate. Only the claims of disputed groups are looked at again, aggregated by group,
field, value and source, so a group that holds a third of all rows is never gathered in one task.

Defined results: rows without a key belong to no group; null, blank and invalid values claim nothing,
except that a field whose captures are all like that survives with its latest capture's value;
unreadable times count as earliest; ties go to the smallest row id; exact copies vote like any
capture; groups of one capture are not reported; an empty table gives no rows. Reliabilities that do
not stand still within ``max_rounds`` are an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.scalars import utc_micros
from bazaarlens.session import BROADCAST_LIMIT, cut_lineage, estimated_bytes, small_side, unused_name

#: Reliability of a source before anything is known, and the number of claims that it counts for.
PRIOR, PRIOR_CLAIMS = 0.8, 5


@dataclass(frozen=True)
class Rule:
    """Which values of a field are valid (``low``..``high`` if given), and whether it changes over time."""

    latest: bool = False
    low: float | None = None
    high: float | None = None

    def valid(self, value: Column) -> Column:
        text = value.cast("string")
        usable = text.isNotNull() & (F.trim(text) != "")
        if self.low is not None:
            number = text.try_cast("double")
            usable = usable & number.isNotNull() & number.between(self.low, self.high)
        return F.coalesce(usable, F.lit(False))


def item_number(item_id: Column, url: Column) -> Column:
    """Digits of the item id, or where it has none the number that ends the path of the address; else null."""
    said = F.regexp_replace(F.regexp_replace(F.trim(item_id), r"\.0+\s*$", ""), r"[^0-9]", "")
    path_end = F.regexp_extract(F.regexp_replace(F.trim(url), r"[?#].*$", ""), r"(\d+)/*$", 1)
    return F.coalesce(F.nullif(said, F.lit("")), F.nullif(path_end, F.lit("")))


def host(url: Column) -> Column:
    """Host of an address, or an empty text."""
    return F.lower(F.coalesce(F.regexp_extract(F.trim(url), r"^[A-Za-z]+://([^/?#]+)", 1), F.lit("")))


capture_time = utc_micros


def discover(captures: DataFrame, key: Column, row_id: str, time: Column, source: Column, rules: dict[str, Rule], stale: float = 0.5, tolerance: float = 0.001, max_rounds: int = 100) -> DataFrame:
    """Columns group_key, field, value (text), row_id, support (share of all support), claims for every field of every group of two or more captures."""
    names = list(rules)
    group = unused_name(captures, "_group")
    keyed = captures.withColumn(group, key).where(F.col(group).isNotNull())

    def claims_of(rows: DataFrame) -> DataFrame:
        """A row for each capture and field; ``at`` orders captures, the latest and of those the smallest row id being the greatest."""
        at = F.struct(F.coalesce(time, F.lit(-(2**62))).alias("time"), (-F.col(row_id).cast("long")).alias("minus_row"))
        fields = [F.struct(F.lit(i).alias("field"), F.col(f).cast("string").alias("value"), rules[f].valid(F.col(f)).alias("valid"), F.lit(rules[f].latest).alias("latest")) for i, f in enumerate(names)]
        one = rows.select(F.col(group).alias("group_key"), source.alias("source"), at.alias("at"), (fields[0] if len(fields) == 1 else F.explode(F.array(*fields))).alias("c"))
        return one.select("group_key", "source", "at", "c.*")

    said = F.when(F.col("valid"), F.col("value"))
    tops = claims_of(keyed).groupBy("group_key", "field").agg(
        F.count("*").alias("claims"), F.max(F.struct("valid", "at", "value")).alias("top"), F.min(said).alias("least"), F.max(said).alias("most"), F.count(said).alias("voices"), F.first("latest").alias("latest")
    )
    tops = cut_lineage(tops.where(F.col("claims") >= 2))
    open_ones = F.coalesce(F.col("least") != F.col("most"), F.lit(False))
    settled = tops.where(~open_ones).select("group_key", "field", "top.value", (-F.col("top.at.minus_row")).alias("row_id"), F.lit(1.0).alias("support"), "claims")

    disputed = cut_lineage(_disputed_claims(keyed, group, claims_of, tops.where(open_ones).select("group_key", "field", F.col("top.at").alias("fresh"), "claims", "voices"), stale))
    sources = cut_lineage(disputed.groupBy("source").agg(F.sum("n").alias("n")).withColumn("r", F.lit(PRIOR)))
    for _ in range(max_rounds):
        true = _winners(disputed, sources).select("group_key", "field", F.col("value").alias("true_value"))
        agreed = disputed.join(true, ["group_key", "field"]).groupBy("source").agg(F.sum(F.when(F.col("value") == F.col("true_value"), F.col("n")).otherwise(0)).alias("agreed"))
        after = cut_lineage(sources.join(agreed, "source").select("source", "n", F.col("r").alias("before"), ((F.col("agreed") + PRIOR * PRIOR_CLAIMS) / (F.col("n") + PRIOR_CLAIMS)).alias("r")))
        moved = after.agg(F.max(F.abs(F.col("r") - F.col("before")))).first()[0] or 0.0
        sources = after.drop("before")
        if moved < tolerance:
            break
    else:
        raise ArithmeticError(f"reliabilities did not stand still within {max_rounds} rounds")

    found = settled.unionByName(_winners(disputed, sources))
    return found.withColumn("field", F.array(*[F.lit(f) for f in names])[F.col("field")])


def _disputed_claims(keyed: DataFrame, group: str, claims_of, disputes: DataFrame, stale: float) -> DataFrame:  # noqa: ANN001
    """Valid claims on disputed fields by group, field, value and source, with the number of captures and their share of the vote.

    Few disputed groups are sent to all rows; many are joined with the claims after these are aggregated.
    """
    few = estimated_bytes(disputes) <= BROADCAST_LIMIT
    if few:
        groups = disputes.select(F.col("group_key").alias(f"{group}_key")).distinct()
        keyed = keyed.join(F.broadcast(groups), F.col(group) == F.col(f"{group}_key"), "left_semi")
    by = ["group_key", "field", "value", "source"]
    claims = claims_of(keyed).where("valid").groupBy(*by).agg(F.count("*").alias("n"), F.max("at").alias("at"), F.first("latest").alias("latest"))
    claims = claims.join(F.broadcast(disputes) if few else disputes, ["group_key", "field"])
    fresh = (F.col("at") == F.col("fresh")).cast("int")
    vote = F.when(F.col("latest"), fresh + stale * (F.col("n") - fresh) / F.col("voices")).otherwise(F.col("n") / F.col("voices"))
    return claims.select(*by, "n", "at", "claims", vote.alias("vote"))


def _winners(disputed: DataFrame, sources: DataFrame) -> DataFrame:
    """The best supported value of each disputed field, with the latest capture that claims it."""
    voted = disputed.join(small_side(sources.select("source", "r")), "source")
    values = voted.groupBy("group_key", "field", "value").agg(F.sum(F.col("vote") * F.col("r")).alias("support"), F.max("at").alias("at"), F.first("claims").alias("claims"))
    top = values.groupBy("group_key", "field").agg(F.max(F.struct(F.round("support", 9).alias("rounded"), "at", "value")).alias("top"), F.sum("support").alias("all"), F.first("claims").alias("claims"))
    return top.select("group_key", "field", "top.value", (-F.col("top.at.minus_row")).alias("row_id"), (F.col("top.rounded") / F.col("all")).alias("support"), "claims")


def survivors(found: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One wide row for each group: group_key, the surviving value of each field and the row it comes from."""
    at = lambda f, c: F.max(F.when(F.col("field") == f, F.col(c)))
    return found.groupBy("group_key").agg(*[at(f, "value").alias(f) for f in fields], *[at(f, "row_id").alias(f"{f}_row") for f in fields])
