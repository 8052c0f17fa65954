"""Ordered cascade of row rules with a count of the rows that each one drops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.session import cut_lineage, unused_name

Rule = tuple[str, Column]


def first_reason(rules: Sequence[Rule]) -> Column:
    """Name of the first rule whose predicate is true; a null predicate keeps the row."""
    out = F.lit(None).cast("string")
    for name, predicate in reversed(rules):
        out = F.when(F.coalesce(predicate, F.lit(False)), name).otherwise(out)
    return out


def apply_rules(df: DataFrame, rules: Sequence[Rule], reason: str = "drop_reason") -> DataFrame:
    """``df`` with the reason of its drop; rows that an earlier cascade dropped keep theirs."""
    found = first_reason(rules)
    return df.withColumn(reason, F.coalesce(F.col(reason), found) if reason in df.columns else found)


def drop_report(df: DataFrame, order: Sequence[str], reason: str = "drop_reason") -> DataFrame:
    """Columns position, rule, rows for rules with drops, in the order of the rules; rows kept are counted as 'kept'."""
    position = F.array_position(F.array(*[F.lit(x) for x in [*order, "kept"]]), F.col("rule"))
    return df.groupBy(F.coalesce(F.col(reason), F.lit("kept")).alias("rule")).agg(F.count("*").alias("rows")).select(position.alias("position"), "rule", "rows")


def report_text(report: DataFrame) -> str:
    """One line for each rule that dropped rows."""
    rows = report.orderBy("position").collect()  # one row for each rule
    total, kept = sum(r["rows"] for r in rows), sum(r["rows"] for r in rows if r["rule"] == "kept")
    lines = [f"  -{r['rows']:<6} {r['rule']}" for r in rows if r["rule"] != "kept"]
    return "\n".join([f"input rows: {total}", *lines, f"output rows: {kept}"])


#: A key with more rows than this, and than a thousandth of all rows, is answered by broadcast; there are fewer than a thousand such keys.
HOT_ROWS = 10_000


def drop_repeats(df: DataFrame, order: str, stages: Sequence[tuple[str, Sequence[Column], Column]], reason: str = "drop_reason") -> DataFrame:
    """Later rows of equal keys get a reason, stage by stage, among the rows still alive.

    Each stage is (name, keys, applies); the row with the least ``order``, a unique column, is kept.
    The stages run over narrow rows (order, reason, hashed keys), and the result is joined back once
    by ``order``. The first row of a key is found by a partial minimum. Rows that a stage does not
    concern carry a hash of their order in place of a key, so they spread over all tasks; keys that
    hold very many rows are answered from a broadcast of their first rows and spread likewise.
    """
    narrow = df.select(
        F.col(order).alias("_order"), F.col(reason).alias("_reason"),
        *[F.when(F.coalesce(applies, F.lit(False)), F.xxhash64(*[F.coalesce(k.cast("string"), F.lit("\u0000")) for k in keys])).alias(f"_key{i}") for i, (_, keys, applies) in enumerate(stages)],
    )
    narrow = cut_lineage(narrow)
    hot_rows = max(HOT_ROWS, narrow.count() // 1_000)
    for i, (name, _, _) in enumerate(stages):
        keyed = narrow.withColumn("_k", F.when(F.col("_reason").isNull(), F.col(f"_key{i}")))
        first = cut_lineage(keyed.where(F.col("_k").isNotNull()).groupBy("_k").agg(F.min("_order").alias("_first"), F.count("*").alias("_c")).where("_c > 1"))
        hot = first.where(F.col("_c") > hot_rows).select(F.col("_k").alias("_hot"), F.col("_first").alias("_hot_first"))  # under a thousand rows
        keyed = keyed.join(F.broadcast(hot), F.col("_k") == F.col("_hot"), "left")
        spread = F.col("_k").isNull() | F.col("_hot").isNotNull()
        keyed = keyed.withColumns({"_spread": spread, "_at": F.when(spread, F.xxhash64("_order")).otherwise(F.col("_k"))})
        cold = first.where(F.col("_c") <= hot_rows).select(F.col("_k").alias("_at"), F.lit(False).alias("_spread"), F.col("_first"))
        known = F.coalesce("_hot_first", "_first")
        again = F.coalesce(F.col("_order") > known, F.lit(False))
        narrow = keyed.join(cold, ["_at", "_spread"], "left").select("_order", F.when(again, name).otherwise(F.col("_reason")).alias("_reason"), *[f"_key{j}" for j in range(i + 1, len(stages))])
    found = unused_name(df, "_found")
    out = df.join(narrow.select(F.col("_order").alias(order), F.col("_reason").alias(found)), order)
    return out.select(*[F.col(found).alias(reason) if c == reason else F.col(c) for c in df.columns])


def first_of(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``, by a partial minimum, so a hot key is not sorted in one task."""
    first = F.min_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("_row")).select("_row.*")


def not_seen(new: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` with a key that ``known`` lacks, one for each key; empty keys pass undisturbed."""
    named = new.where(F.coalesce(F.col(key), F.lit("")) != "")
    fresh = named.join(known.select(key).where(F.col(key) != "").distinct(), key, "left_anti").dropDuplicates([key])
    return fresh.unionByName(new.where(F.coalesce(F.col(key), F.lit("")) == "")).select(*new.columns)
