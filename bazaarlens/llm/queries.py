"""Queries of the operators in this subpackage; each takes (spark, folder of tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm import gazetteer, packing, pii, products, rank_summary, reading, residue, tokens, truth
from bazaarlens.session import cut_lineage, small_side
from bazaarlens.sources.tables import table

#: Percentiles that the price queries report.
PRICE_PERCENTILES = {"p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}
#: Container size, in tokens, of the packing queries.
CONTAINER_TOKENS = 2048


def p1_price_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Price percentiles with a stated rank error for each model and storage."""
    keys = ["model", "storage_gb"]
    rows = table(spark, folder, "clean_listings", *keys, "price")
    return rank_summary.percentiles(rank_summary.summarize(rows, keys, "price"), keys, PRICE_PERCENTILES)


def p1_model_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Price percentiles for each model, from summaries of single days of capture that are combined."""
    rows = table(spark, folder, "clean_listings", "model", "price", "scraped_at").withColumn("day", F.substring("scraped_at", 1, 10))
    by_day = rank_summary.summarize(rows, ["model", "day"], "price")
    return rank_summary.percentiles(rank_summary.combine(by_day, ["model"]), ["model"], PRICE_PERCENTILES)


def p1_rank_check(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles for each model from combined daily summaries of an epsilon so coarse that they are compressed, checked against the true ranks of all rows."""
    epsilon = 0.01
    rows = table(spark, folder, "clean_listings", "model", "price", "scraped_at").withColumn("day", F.substring("scraped_at", 1, 10))
    days = rank_summary.summarize(rows, ["model", "day"], "price", epsilon)
    answers = rank_summary.percentiles(rank_summary.combine(days, ["model"]), ["model"], PRICE_PERCENTILES)
    return rank_summary.rank_check(rows, ["model"], "price", answers, PRICE_PERCENTILES, epsilon)


#: Which captures win each field of an advertisement.
CAPTURE_RULES = {
    "battery_health": truth.Rule(latest=True, low=40, high=100),
    "price": truth.Rule(latest=True),
    "title": truth.Rule(),
    "model": truth.Rule(),
    "storage_gb": truth.Rule(low=1, high=1_000_000),
    "condition": truth.Rule(),
    "location": truth.Rule(),
}


def _captures(spark: SparkSession, folder: str, *fields: str) -> DataFrame:
    rows = table(spark, folder, "raw_listings", "listing_row", "item_id", "listing_url", "scraped_at", *fields)
    number = truth.item_number(F.col("item_id"), F.col("listing_url"))
    return truth.discover(rows, number, "listing_row", truth.capture_time(F.col("scraped_at")), truth.host(F.col("listing_url")), {f: CAPTURE_RULES[f] for f in fields})


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """The capture that gives each advertisement's surviving battery health."""
    return _captures(spark, folder, "battery_health").select(F.col("group_key").alias("item_id"), F.col("row_id").alias("listing_row"))


def p2_survivors(spark: SparkSession, folder: str) -> DataFrame:
    """One record for each advertisement that was captured more than once."""
    return truth.survivors(_captures(spark, folder, *CAPTURE_RULES), list(CAPTURE_RULES)).withColumnRenamed("group_key", "item_id")


def p2_fresh_fields(spark: SparkSession, folder: str) -> DataFrame:
    """The captures that give the fields that change over time."""
    found = truth.survivors(_captures(spark, folder, "battery_health", "price"), ["battery_health", "price"])
    return found.select(F.col("group_key").alias("item_id"), F.col("battery_health_row"), F.col("price_row"))


def _mapped_regions(spark: SparkSession, folder: str) -> DataFrame:
    """table_name, row_key, typed, region_id of every value that is not an entry as it stands."""
    listed = table(spark, folder, "region_list")
    entries = gazetteer.load_entries(listed, "region_id", "region_name", "known_aliases")
    raw = table(spark, folder, "raw_listings", "listing_row", "location").select(F.lit("raw_listings").alias("table_name"), F.col("listing_row").cast("string").alias("row_key"), F.col("location").alias("typed"), F.substring_index("location", ",", 1).alias("_head"))
    clean = table(spark, folder, "clean_listings", "item_id", "region").select(F.lit("clean_listings").alias("table_name"), F.col("item_id").alias("row_key"), F.col("region").alias("typed"), F.col("region").alias("_head"))
    open_values = raw.unionByName(clean).where(F.col("typed").rlike(r"(?U)\S")).join(small_side(listed.select(F.col("region_name").alias("_head"))), "_head", "left_anti")
    return open_values.select("table_name", "row_key", "typed", gazetteer.map_to_list(F.col("typed"), entries).alias("region_id"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """The region that each freely typed location or region means."""
    return _mapped_regions(spark, folder).select("table_name", "row_key", "region_id")


def p3_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """Typed values that mean no region of the list, with their rows."""
    return gazetteer.unmatched_report(_mapped_regions(spark, folder), "typed", "region_id")


def p3_recased_names(spark: SparkSession, folder: str) -> DataFrame:
    """Of the mapped values, those that differ from a name of the list in case and outer blanks alone."""
    names = table(spark, folder, "region_list", "region_name").select(F.lower("region_name").alias("_name"))
    return _mapped_regions(spark, folder).where(F.col("region_id").isNotNull()).join(small_side(names), F.lower(F.trim("typed")) == F.col("_name"), "left_semi").select("table_name", "row_key", "region_id")


def p5_residue(spark: SparkSession, folder: str) -> DataFrame:
    """Residue in titles and descriptions with its kind and evidence."""
    rows = table(spark, folder, "raw_listings", "listing_row", "title", "description", "listing_url")
    return residue.flag_fields(rows, "listing_row", "title", "description", "listing_url")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Fields that hold residue."""
    return p5_residue(spark, folder).select("listing_row", "field_name").distinct()


def p5_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Of the fields that detectors flag, by field and kind, those that the comparison of slug, title and body finds without any list of words; kind 'none' is what it finds alone."""
    found = cut_lineage(p5_residue(spark, folder).distinct())
    alone = found.where("evidence = 'comparison'").select("listing_row", "field_name").distinct().withColumn("compared", F.lit(1))
    known = found.where("evidence = 'detector'").select("listing_row", "field_name", "kind")
    both = known.join(alone, ["listing_row", "field_name"], "full").select("field_name", F.coalesce("kind", F.lit("none")).alias("kind"), "compared")
    return both.groupBy("field_name", "kind").agg(F.count("*").alias("fields"), F.count("compared").alias("compared"))


def p5_clean_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of raw_listings without residue."""
    return residue.exclude(table(spark, folder, "raw_listings"), "listing_row", "title", "description", "listing_url")


def p5_balance(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of raw_listings, and those that are neither flagged nor kept, or both."""
    flagged = p5_residue(spark, folder).select("listing_row").distinct()
    kept = p5_clean_rows(spark, folder).select("listing_row")
    seen = flagged.unionByName(kept).groupBy("listing_row").agg(F.count("*").alias("n"))
    rows = table(spark, folder, "raw_listings", "listing_row").join(seen, "listing_row", "left")
    return rows.agg(F.count("*").alias("rows"), F.count_if(F.coalesce("n", F.lit(0)) != 1).alias("wrong"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Kinds of personal data in descriptions and locations."""
    rows = table(spark, folder, "raw_listings", "listing_row", "description", "location")
    return pii.find_kinds(rows, "listing_row", ["description", "location"])


def p6_masked(spark: SparkSession, folder: str) -> DataFrame:
    """raw_listings with placeholders in place of personal data."""
    return pii.mask_fields(table(spark, folder, "raw_listings"), ["description", "location"])


def p6_untouched(spark: SparkSession, folder: str) -> DataFrame:
    """Fields of raw_listings by whether they are null; fields without personal data that masking changed, and masked ones without a placeholder."""
    rows = table(spark, folder, "raw_listings", "listing_row", "description", "location")
    long = lambda df, c: df.select("listing_row", F.explode(F.create_map(F.lit("description"), "description", F.lit("location"), "location")).alias("field_name", c))
    masked = pii.mask_fields(rows, ["description", "location"])
    kinds = p6_found(spark, folder).select("listing_row", "field_name").distinct().withColumn("has", F.lit(True))
    both = long(rows, "before").join(long(masked, "after"), ["listing_row", "field_name"]).join(kinds, ["listing_row", "field_name"], "left")
    has, same = F.col("has").isNotNull(), F.col("before").eqNullSafe(F.col("after"))
    return both.agg(F.count("*").alias("fields"), F.count("before").alias("texts"), F.count_if(~has & ~same).alias("changed"), F.count_if(has & (same | ~F.col("after").rlike(r"\[(EMAIL|PHONE|ID_NUMBER|ADDRESS|NAME)\]"))).alias("unmasked"))


def _offers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "dealer_offers", "offer_id", "title", "description", "params")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of offers of the same product."""
    return products.pairs_of_groups(products.group_offers(_offers(spark, folder), "offer_id"))


def p7_groups(spark: SparkSession, folder: str) -> DataFrame:
    """The product of every offer."""
    return products.group_offers(_offers(spark, folder), "offer_id").withColumnRenamed("offer", "offer_id")


def p7_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Offers, different texts of offers, and texts whose copies lie in different groups."""
    c = F.col
    texts = _offers(spark, folder).select("offer_id", F.sha2(F.to_json(F.struct("title", "description", "params")), 256).alias("text"))
    copies = p7_groups(spark, folder).join(texts, "offer_id").groupBy("text").agg(F.count("*").alias("n"), F.min("product").alias("a"), F.max("product").alias("b"))
    return copies.agg(F.sum("n").alias("offers"), F.count("*").alias("texts"), F.count_if(c("a") != c("b")).alias("parted"))


def p7_recall(spark: SparkSession, folder: str) -> DataFrame:
    """Recall of the index against exact search."""
    return products.recall_report(_offers(spark, folder), "offer_id")


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document."""
    return tokens.encode_column(table(spark, folder, "documents", "doc_id", "text"), "doc_id", "text")


def p8_token_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Corpus totals of the encoding."""
    return tokens.token_statistics(p8_ids(spark, folder))


def p8_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Documents, those without tokens, and those whose ids do not give their text again."""
    documents = table(spark, folder, "documents", "doc_id", "text")
    ids = tokens.encode_column(documents, "doc_id", "text")
    again = documents.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("before")).join(tokens.decode_column(ids, "doc_id").select("doc_id", F.sha2("text", 256).alias("after"), (F.col("text") == "").alias("none")), "doc_id")
    return again.agg(F.count("*").alias("documents"), F.count_if("none").alias("without_tokens"), F.count_if(F.col("before") != F.col("after")).alias("wrong"))


def p9_containers(spark: SparkSession, folder: str) -> DataFrame:
    """The container of every piece of every document."""
    counted = tokens.count_column(table(spark, folder, "documents", "doc_id", "text"), "doc_id", "text")
    return packing.pack(counted, "doc_id", "n_tokens", CONTAINER_TOKENS)


def p9_report(spark: SparkSession, folder: str) -> DataFrame:
    """How well the containers are filled."""
    return packing.container_report(p9_containers(spark, folder), CONTAINER_TOKENS)


def p9_check(spark: SparkSession, folder: str) -> DataFrame:
    """Documents; of them those that lost or won tokens, those cut although they fit, and containers over capacity."""
    packed = cut_lineage(p9_containers(spark, folder))
    counted = tokens.count_column(table(spark, folder, "documents", "doc_id", "text"), "doc_id", "text")
    pieces = packed.groupBy("doc_id").agg(F.sum("piece_size").alias("size"), F.count("*").alias("pieces"))
    both = counted.join(pieces, "doc_id", "full")
    over = packed.groupBy("container_id").agg(F.sum("piece_size").alias("fill")).agg(F.count_if(F.col("fill") > CONTAINER_TOKENS).alias("overfull"))
    found = both.agg(F.count("n_tokens").alias("documents"), F.count_if(~F.col("n_tokens").eqNullSafe(F.col("size"))).alias("lost"), F.count_if((F.col("n_tokens") <= CONTAINER_TOKENS) & (F.col("pieces") > 1)).alias("cut"))
    return found.crossJoin(over)  # one row each


def _reading_model(spark: SparkSession, folder: str) -> reading.LevelModel | None:
    return reading.fit(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "reading_labels"))


def p10_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Reading level of every document."""
    return reading.assign(table(spark, folder, "documents", "doc_id", "text"), _reading_model(spark, folder))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of level 5."""
    return p10_levels(spark, folder).where(F.col("level") == 5).select("doc_id").distinct()


def p10_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Documents, those with a level outside 1 to 5 or a confidence outside 1/5 to 1, and those whose level and number of known words do not go together."""
    c = F.col
    levels = p10_levels(spark, folder)
    outside = ~(c("level").between(1, 5) & c("confidence").between(0.2 - 1e-9, 1 + 1e-9) & c("expected_level").between(1, 5))
    return levels.agg(F.count("*").alias("documents"), F.count_if(c("level").isNotNull() & outside).alias("outside"), F.count_if(c("level").isNull() != (c("n_words") < 3)).alias("unfounded"))


def p10_held_out(spark: SparkSession, folder: str) -> DataFrame:
    """Confusion counts of a held-out fifth of the labelled documents."""
    return reading.held_out_accuracy(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "reading_labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name[:1] == "p" and name[1:2].isdigit()}
