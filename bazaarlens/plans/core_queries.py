"""Queries of the core operators; each takes (spark, folder of tables)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.functions import scalars as S
from bazaarlens.functions import text as X
from bazaarlens.functions.signs import signs
from bazaarlens.operators import features as E
from bazaarlens.operators.forest import isolation_outliers
from bazaarlens.operators.models import BoostedTrees, LogLinear, cross_validate, training_statistics
from bazaarlens.operators.rules import apply_rules, drop_repeats, drop_report, first_of, not_seen
from bazaarlens.operators.stats import far_below_median, fill_group_median, group_statistics, outside_fence
from bazaarlens.operators.valuation import RESULTS, evaluate
from bazaarlens.plans import fill_queries
from bazaarlens.plans.clean import CONDITION_CODE, Settings, clean, read_attributes
from bazaarlens.plans.training import price_features
from bazaarlens.session import cut_lineage, small_side, unused_view, work_path
from bazaarlens.sources import files, html
from bazaarlens.sources.catalog import catalog, lookup_key, offered, storage_set, with_model
from bazaarlens.sources.synthetic import synthetic_listings
from bazaarlens.sources.tables import table
from bazaarlens.streaming.resume import stream_append, stream_latest_counts


def hier_iqr_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Prices outside the fence of the finest group that is large enough."""
    rows = table(spark, folder, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_extendedprice").withColumn("log_price", F.log("l_extendedprice"))
    levels = [("l_partkey", "l_returnflag", "l_linestatus"), ("l_partkey", "l_returnflag"), ("l_partkey",)]
    found = group_statistics(rows, F.col("log_price"), levels, 10)
    return found.where(outside_fence(F.col("log_price"), 1.0)).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "stat_level", "stat_n", F.round("stat_median", 6).alias("stat_median"))


def group_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Rows by the level that supplies their statistics; level -1 has none."""
    rows = table(spark, folder, "clean_listings", "model", "storage_gb", "condition", "price").where("price > 0")
    found = group_statistics(rows, F.log("price"), [("model", "storage_gb", "condition"), ("model", "condition"), ("model",)], 10)
    return found.groupBy(F.coalesce("stat_level", F.lit(-1)).alias("stat_level")).agg(F.count("*").alias("n"), F.round(F.avg("stat_median"), 6).alias("mean_median"), F.sum("stat_n").alias("sum_n"))


def cheap_vs_group_median(spark: SparkSession, folder: str) -> DataFrame:
    """Orders under 0.3 of the geometric median of their comparable orders."""
    rows = table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice").join(table(spark, folder, "customer", "c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")).withColumn("log_price", F.log("o_totalprice"))
    found = group_statistics(rows, F.col("log_price"), [("c_mktsegment", "o_orderpriority"), ("c_mktsegment",)], 10)
    return found.where(far_below_median(F.col("log_price"), 0.3)).select("o_orderkey", "o_totalprice", "c_mktsegment", "o_orderpriority", F.round(F.exp("stat_median"), 2).alias("usual"))


def rule_cascade_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rows dropped by each of several ordered rules; a row counts under its first."""
    rows = table(spark, folder, "orders", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate")
    rules = [("not_final", F.col("o_orderstatus") != "F"), ("low_price", F.col("o_totalprice") < 20_000), ("high_price", F.col("o_totalprice") > 400_000), ("urgent", F.col("o_orderpriority").startswith("1")), ("late", F.col("o_orderdate") >= "1998-01-01")]
    return drop_report(apply_rules(rows, rules), [r[0] for r in rules])


def impute_group_median(spark: SparkSession, folder: str) -> DataFrame:
    """Event values taken away by rule and filled from the median of their type."""
    rows = table(spark, folder, "events", "event_id", "event_type", "value").withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value")).cast("bigint"))
    return fill_group_median(rows, "value", "event_type", F.lit(True), 90.0)


def dedup_cascade(spark: SparkSession, folder: str) -> DataFrame:
    """Repeats by number, then by address, then by content, each among the survivors of the former."""
    rows = table(spark, folder, "raw_listings", "listing_row", "item_id", "listing_url", "title", "price").withColumn("drop_reason", F.lit(None).cast("string"))
    c = F.col
    stages = [("item_id", [F.trim("item_id")], F.trim("item_id") != ""), ("listing_url", [F.trim("listing_url")], F.trim("listing_url") != ""), ("content", [c("title"), c("price")], F.length("title") >= 10)]
    return drop_repeats(rows, "listing_row", stages).select("listing_row", "drop_reason")


def content_fingerprint_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """First row of each description fingerprint of 30 characters or more."""
    rows = table(spark, folder, "raw_listings", "listing_row", "description").withColumn("print", X.fingerprint(F.col("description"))).where(F.length("print") >= 30)
    return rows.groupBy("print").agg(F.min("listing_row").alias("listing_row"), F.count("*").alias("copies"))


def normalize_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "raw_listings", "listing_row", "title", "description").select("listing_row", X.normalize(F.col("title")).alias("title"), F.md5(X.normalize(F.col("description"))).alias("description_md5"))


def json_params_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Attributes read from the JSON of a listing, by exact key, then by part of a key."""
    p = S.params_map(F.col("params"))
    rows = table(spark, folder, "raw_listings", "listing_row", "params").select("listing_row", p.alias("p"))
    return rows.select("listing_row", S.find_param(F.col("p"), ["модель"], X.normalize).alias("model"), S.find_param(F.col("p"), ["память"], X.normalize).alias("memory"), F.size("p").alias("keys"))


def url_canonical(spark: SparkSession, folder: str) -> DataFrame:
    u = F.col("listing_url")
    return table(spark, folder, "raw_listings", "listing_row", "listing_url").where("listing_url is not null").select("listing_row", S.canonical_url(u).alias("url"), S.url_tail_number(u).alias("tail"), S.url_origin(u, "https://board.example").alias("origin"), S.page_url(u, F.lit(3)).alias("page_3"))


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer", "c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    page = F.concat(
        F.lit('<html><head><title>x</title></head><body><h1 data-marker="item-view/title-info">  '), "c_name", F.lit('</h1><span itemprop="price" content="'), F.abs(F.col("c_acctbal")).cast("bigint").cast("string"),
        F.lit('">-</span><div itemprop="description"><p>a<br>'), "c_mktsegment", F.lit('</p></div><ul class="params-paramsList-1"><li>Key: '), "c_mktsegment", F.lit("</li><li>Key: second</li></ul></body></html>"),
    )
    return c.select(F.col("c_custkey").alias("page_id"), page.alias("html"))


def html_item_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Fields of captured item pages."""
    found = html.item_details(_pages(spark, folder))
    return found.select("page_id", "title", F.coalesce("price", F.lit(0)).alias("price"), "description", F.col("params")["Key"].alias("key"), "is_block")


def html_search_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Cards of captured search pages, the first of each id."""
    card = F.concat(F.lit('<div data-marker="item"><a data-marker="item-title" href="/x_'), (F.col("s_suppkey") + 1_000_000).cast("string"), F.lit('?c=1">'), "s_name", F.lit('</a><p data-marker="item-price">1 000 ₽</p></div>'))
    pages = table(spark, folder, "supplier", "s_suppkey", "s_nationkey", "s_name").groupBy(F.col("s_nationkey").alias("page_id")).agg(F.concat_ws("", F.sort_array(F.collect_list(card))).alias("cards"))
    pages = pages.select("page_id", F.concat(F.lit("<body>"), "cards", "cards", F.lit('<a rel="next" href="?p=2">next</a></body>')).alias("html"))
    return html.search_cards(pages, "https://board.example").select("page_id", "has_next", "item_id", "url", "title", "price")


def months_elapsed(spark: SparkSession, folder: str) -> DataFrame:
    """Whole months between order and shipment."""
    rows = table(spark, folder, "lineitem", "l_orderkey", "l_shipdate").join(table(spark, folder, "orders", "o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.groupBy(S.whole_months(F.col("o_orderdate"), F.col("l_shipdate")).alias("months")).agg(F.count("*").alias("n"))


def catalog_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Listings by tier and release year of their model, case and blanks aside."""
    found = with_model(table(spark, folder, "clean_listings", "model"), table(spark, folder, "phone_catalog"))
    return found.groupBy(F.coalesce("tier", F.lit(E.OTHER)).alias("tier"), F.year("release_date").alias("year")).agg(F.count("*").alias("n"))


def option_membership(spark: SparkSession, folder: str) -> DataFrame:
    """Listings by model, whether it offers their storage, and the storage's place among the options."""
    found = with_model(table(spark, folder, "clean_listings", "model", "storage_gb"), table(spark, folder, "phone_catalog"))
    gb = F.col("storage_gb").cast("int")
    rows = found.where("storage_gb is not null and storage_options is not null")
    return rows.groupBy("model", offered(gb).alias("offered"), (F.array_position("storage_options", gb) - 1).alias("step")).agg(F.count("*").alias("n"))


def catalog_storages(spark: SparkSession, folder: str) -> DataFrame:
    """The set of all storage options and their labels."""
    sizes = table(spark, folder, "phone_catalog").agg(storage_set(None).alias("s")).select(F.explode("s").alias("storage_gb"))
    return sizes.select("storage_gb", S.storage_label(F.col("storage_gb")).alias("label"))


def builtin_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Models of the table that the built-in catalogue has with the same date and options."""
    own = catalog(spark).select("name", "tier", "release_date", "storage_options")
    return table(spark, folder, "phone_catalog", "name", "tier", "release_date", "storage_options").intersect(own).select("name")


def resume_append(spark: SparkSession, folder: str) -> DataFrame:
    """Events of unseen users: one row for each, against those already stored."""
    rows = table(spark, folder, "events", "event_id", "user_id").withColumn("user", F.col("user_id").cast("string"))
    new = first_of(rows.where("event_id % 2 = 0").select("user", "event_id"), ["user"], ["event_id"])
    return not_seen(new, rows.where("event_id % 97 = 1"), "user").select("user", "event_id")


def first_capture(spark: SparkSession, folder: str) -> DataFrame:
    """The first capture of each address."""
    rows = table(spark, folder, "raw_listings", "listing_row", "listing_url", "title").where("listing_url is not null")
    return first_of(rows, ["listing_url"], ["listing_row"])


def frequent_categories(spark: SparkSession, folder: str) -> DataFrame:
    """Customers by nation, nations under 1/25 of all customers folded into one."""
    rows = table(spark, folder, "customer", "c_custkey", "c_nationkey").join(table(spark, folder, "nation", "n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    least = rows.count() // 25
    return E.fold_rare(rows, "n_name", E.frequent_values(rows, "n_name", least)).groupBy("n_name").agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))


def default_category(spark: SparkSession, folder: str) -> DataFrame:
    """The most frequent region of listings, ties to the first in order."""
    return spark.createDataFrame([(E.most_frequent(table(spark, folder, "clean_listings", "region"), "region"),)], "region string")


def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return E.frequent_values(table(spark, folder, "clean_listings", "region"), "region", 10)


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice").join(table(spark, folder, "part", "p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(E.fold_of(F.col("l_orderkey"), 5).alias("fold"), F.col("l_extendedprice").alias("y"), (F.col("p_retailprice") * F.col("l_quantity")).alias("a"), (F.col("l_quantity") * 1500).alias("b"))


def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).agg(*[F.round(m, 4).alias(n) for m, n in zip(E.regression_metrics(F.col("y"), F.col("a")), ("rmse", "mae", "mape"), strict=True)])


def fold_metrics(spark: SparkSession, folder: str) -> DataFrame:
    found = E.fold_metrics(_scored(spark, folder).withColumnRenamed("a", "y_hat"))
    return found.select("fold", "n", *[F.round(m, 4).alias(m) for m in ("rmse", "mae", "mape")])


def model_selection(spark: SparkSession, folder: str) -> DataFrame:
    """The better of two estimates by mean MAPE over folds."""
    rows = _scored(spark, folder)
    both = rows.select("fold", "y", F.explode(F.array(F.struct(F.lit(0).alias("ordinal"), F.col("a").alias("y_hat")), F.struct(F.lit(1).alias("ordinal"), F.col("b").alias("y_hat")))).alias("m")).select("fold", "y", "m.*")
    summary = E.metric_summary(E.fold_metrics(both, ["fold", "ordinal"]), ["ordinal"])
    return E.best_model(summary).select("ordinal", F.round("mape_mean", 3).alias("mape_mean"))


def delta_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Line items by the class of their deviation from the list price."""
    d = S.percent_delta(F.col("y"), F.col("a"))
    return _scored(spark, folder).groupBy(S.classify_delta(d, 10).alias("verdict")).agg(F.count("*").alias("n"), F.round(F.avg(S.half_even(F.col("y"), 500)), 3).alias("mean_rounded"))


def prices_read(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "raw_listings", "listing_row", "price").select("listing_row", X.price(F.col("price")).alias("price"))


def regions_read(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "raw_listings", "listing_row", "location").select("listing_row", X.region(F.col("location")).alias("region"))


def numbers_read(spark: SparkSession, folder: str) -> DataFrame:
    """Whole numbers and bounded values of listings."""
    b = S.as_whole(F.col("battery_health"))
    return table(spark, folder, "raw_listings", "listing_row", "battery_health", "item_id").select("listing_row", S.within(b, 40, 100).alias("battery"), S.as_whole(F.col("item_id")).alias("number"))


def features_of_listings(spark: SparkSession, folder: str) -> DataFrame:
    return E.feature_frame(table(spark, folder, "clean_listings"), table(spark, folder, "phone_catalog"), ["item_id"])


def negated_keyword_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Wording of box, receipt and instalments, negations seen."""
    rows = table(spark, folder, "raw_listings", "listing_row", "title", "description").withColumn("s", signs(F.col("title"), F.col("description")))
    return rows.select("listing_row", F.col("s.box").alias("box"), F.col("s.receipt").alias("receipt"), F.col("s.installment").alias("instalment"))


def junk_reasons(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "raw_listings", "listing_row", "title", "description").withColumn("s", signs(F.col("title"), F.col("description")))
    return rows.select("listing_row", F.col("s.junk").alias("junk_reason"))


def attributes_read(spark: SparkSession, folder: str) -> DataFrame:
    return read_attributes(table(spark, folder, "raw_listings"), "listing_row")


def clean_listings_e2e(spark: SparkSession, folder: str) -> DataFrame:
    return clean(table(spark, folder, "raw_listings"), table(spark, folder, "phone_catalog"), Settings(), "listing_row")[0]


def cleaning_report(spark: SparkSession, folder: str) -> DataFrame:
    return clean(table(spark, folder, "raw_listings"), table(spark, folder, "phone_catalog"), Settings(), "listing_row")[1]


def listing_ages(spark: SparkSession, folder: str) -> DataFrame:
    """Day of capture in UTC and age of the model on that day; unreadable times count as the reference day."""
    rows = with_model(table(spark, folder, "raw_listings", "listing_row", "model", "scraped_at"), table(spark, folder, "phone_catalog"))
    day = S.iso_date(F.col("scraped_at"), F.lit("2026-09-01").cast("date"))
    return rows.select("listing_row", day.cast("string").alias("day"), S.whole_months(F.col("release_date"), day).alias("phone_age_months"))


def attributes_plain(spark: SparkSession, folder: str) -> DataFrame:
    """The attributes whose reading SQL can state, out of the pipeline's own pass."""
    return read_attributes(table(spark, folder, "raw_listings"), "listing_row").select(F.col("row").alias("listing_row"), "item_id", "price", "region", "scraped_at")


def clean_balance(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that went in; rows neither kept nor counted under a rule, repeated numbers among the kept ones, and kept ones that break a bound."""
    kept, report = clean(table(spark, folder, "raw_listings"), table(spark, folder, "phone_catalog"), Settings(), "listing_row")
    sums = report.agg(F.sum("rows").alias("rows"), F.sum(F.when(F.col("rule") == "kept", F.col("rows"))).alias("kept"))
    sound = F.col("price").between(5_000, 400_000) & F.col("battery_health").between(40, 100) & F.col("condition").isin(*CONDITION_CODE) & F.col("release_year").isNotNull() & F.col("storage_gb").isNotNull()
    named = F.nullif(F.col("item_id"), F.lit(""))
    found = kept.agg(F.count("*").alias("n"), (F.count(named) - F.count_distinct(named)).alias("repeated"), F.count_if(~F.coalesce(sound, F.lit(False))).alias("out_of_bounds"))
    return sums.crossJoin(found).select("rows", (F.col("n") - F.coalesce("kept", F.lit(0))).alias("unaccounted"), "repeated", "out_of_bounds")  # one row each


def model_check(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the archive; rows without a positive prediction, and rows that more battery or storage makes cheaper."""
    rows = _features(spark, folder)
    model = LogLinear().fit(rows.where("price > 0"))
    better = rows.withColumns({"battery_health": F.least(F.col("battery_health") + 5, F.lit(100.0)), "storage_gb": F.col("storage_gb") * 2})
    both = model.predict(rows).select("item_id", "y_hat").join(model.predict(better, "more").select("item_id", "more"), "item_id")
    return both.agg(F.count("*").alias("rows"), F.count_if(~F.coalesce(F.col("y_hat") > 0, F.lit(False))).alias("unpredicted"), F.count_if(F.col("more") < F.col("y_hat") * (1 - 1e-9)).alias("falling"))


def values_formatted(spark: SparkSession, folder: str) -> DataFrame:
    """Prices of orders as text, rounded, and as the inner range of a tenth around them; the address of a search."""
    orders = table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority").join(table(spark, folder, "customer", "c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    price = F.col("o_totalprice")
    low, high = S.inner_range(price * 0.9, price * 1.1)
    return orders.select("o_orderkey", S.money(price).alias("money"), S.half_even(price, 500).alias("near"), low.cast("bigint").alias("low"), high.cast("bigint").alias("high"), S.search_url("https://board.example/", F.lower("c_mktsegment"), F.col("o_orderpriority")).alias("url"))


def params_read(spark: SparkSession, folder: str) -> DataFrame:
    """The attributes of a listing as lines of text; broken JSON has none."""
    return table(spark, folder, "raw_listings", "listing_row", "params").select("listing_row", S.params_text(S.params_map(F.col("params"))).alias("lines"))


def usable_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the archive that are complete in all features and have a price."""
    return E.training_rows(table(spark, folder, "clean_listings")).groupBy("condition").agg(F.count("*").alias("n"), F.sum("price").alias("price"))


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Raw listings written as CSV and read again: rows, and rows that differ but for the texts that stand for nothing."""
    rows = table(spark, folder, "raw_listings", *files.RAW_COLUMNS).select(*[F.col(c).cast(f.dataType) for c, f in zip(files.RAW_COLUMNS, files.RAW_SCHEMA, strict=True)])
    path = work_path(spark, "csv")
    files.write_csv(rows, path)
    back = files.read_csv(spark, path, files.RAW_SCHEMA)
    count = lambda df, name: df.groupBy(F.xxhash64(*[F.coalesce(c, F.lit("\u0000")) for c in files.RAW_COLUMNS]).alias("row")).agg(F.count("*").alias(name))
    both = count(files.null_tokens(rows), "before").join(count(back, "after"), "row", "full")
    return both.agg(F.sum("before").alias("rows"), F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("changed"))


def streamed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Events of each kind and day, counted as a stream with a watermark."""
    schema = table(spark, folder, "events").schema
    counts = stream_latest_counts(spark, folder, schema, "ts", "event_type", only="events.parquet")
    name = unused_view(spark, "streamed_counts")
    counts.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", work_path(spark, "stream")).trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), F.col("group").alias("event_type"), "rows")


def streamed_append(spark: SparkSession, folder: str) -> DataFrame:
    """Listings that arrive as a stream, appended once for each number; the stream is run twice, and the second run adds nothing."""
    schema, sink = table(spark, folder, "raw_listings").schema, work_path(spark, "sink")
    for run in ("first", "second"):
        stream_append(spark, folder, schema, sink, work_path(spark, run), only="raw_listings.parquet").awaitTermination()
    stored = spark.read.parquet(sink).where("item_id is not null and item_id != ''")
    return stored.groupBy("item_id").agg(F.count("*").alias("n"))


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return cut_lineage(price_features(table(spark, folder, "clean_listings"), table(spark, folder, "phone_catalog"), "item_id"))


def _predicted(spark: SparkSession, folder: str, model: LogLinear | BoostedTrees) -> DataFrame:
    """A model fitted on all rows with a price, applied to all rows."""
    rows = _features(spark, folder)
    return model.fit(rows.where("price > 0")).predict(rows).select("item_id", "price", "y_hat")


def monotone_price_model(spark: SparkSession, folder: str) -> DataFrame:
    return _predicted(spark, folder, LogLinear())


def gbt_price_model(spark: SparkSession, folder: str) -> DataFrame:
    return _predicted(spark, folder, BoostedTrees())


def cross_validated_model(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of the monotone model by fold."""
    return cross_validate(LogLinear, _features(spark, folder).where("price > 0"), "item_id")[0]


def _asked(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "raw_listings", "listing_row", "model", "storage_gb", "condition", "battery_health", "location", "price")
    return rows.select("listing_row", "model", "storage_gb", "condition", "battery_health", F.col("location").alias("region"), X.price(F.col("price")).alias("asking_price"))


def _observed_statistics(spark: SparkSession, folder: str) -> dict:
    seen = with_model(table(spark, folder, "clean_listings"), table(spark, folder, "phone_catalog")).withColumn("release_year", F.year("release_date"))
    return training_statistics(seen.where("battery_health between 40 and 100"))


def valuations(spark: SparkSession, folder: str) -> DataFrame:
    """Asked prices of raw listings against the median price of their model; rows with an error keep null results."""
    medians = table(spark, folder, "clean_listings", "model", "price").where("model is not null and price > 0").groupBy("model", "price").agg(F.count("*").alias("n")).groupBy(lookup_key(F.col("model")).alias("_m")).agg(F.percentile("price", 0.5, F.col("n")).alias("y_hat"))
    predict = lambda rows: rows.join(small_side(medians), lookup_key(F.col("model")) == F.col("_m"), "left").drop("_m")
    found = evaluate(_asked(spark, folder), table(spark, folder, "phone_catalog"), predict, _observed_statistics(spark, folder))
    return found.select("listing_row", "error", "region_used", "battery_assumed", "fair_price", "verdict", *[F.round(c, 4).alias(c) for c in ("fair_low", "fair_high", "delta_pct")])


def model_valuations(spark: SparkSession, folder: str) -> DataFrame:
    """Asked prices of raw listings against the monotone model."""
    model = LogLinear().fit(_features(spark, folder).where("price > 0"))
    found = evaluate(_asked(spark, folder), table(spark, folder, "phone_catalog"), model.predict, _observed_statistics(spark, folder), dt.date(2026, 9, 1))
    return found.select("listing_row", *RESULTS)


def isolation_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Lonely listings by the five features of the cleaning pipeline; rows without price, storage or known model, which its rules drop, are left out."""
    rows = with_model(table(spark, folder, "clean_listings", "item_id", "model", "price", "storage_gb", "condition", "battery_health"), table(spark, folder, "phone_catalog"))
    rows = rows.where("price > 0 and storage_gb > 0 and release_date is not null")
    battery = S.within(F.col("battery_health"), 40, 100)
    rows = rows.select("item_id", lookup_key(F.col("model")).alias("model"), "price", "storage_gb", "condition", battery.alias("battery_health"), F.log("price").alias("log_price"), F.year("release_date").alias("year"))
    is_new = F.col("condition") == "new"
    rows = fill_group_median(rows, "battery_health", "year", ~is_new, 90.0, F.when(is_new, 100))
    around = group_statistics(rows, F.col("log_price"), [("model", "storage_gb"), ("model",)], 1)
    code = F.create_map(*[F.lit(x) for kv in CONDITION_CODE.items() for x in kv])[F.col("condition")]
    around = around.withColumns({"off": F.col("log_price") - F.col("stat_median"), "code": code, "log_storage": F.log2("storage_gb")})
    return isolation_outliers(around, ["off", "battery_health", "code", "log_storage", "year"], "item_id").where("is_outlier").select("item_id", "anomaly_score")


def synthetic(spark: SparkSession, folder: str) -> DataFrame:
    return synthetic_listings(spark, 3000, 42)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        hier_iqr_outliers, group_levels, cheap_vs_group_median, rule_cascade_report, impute_group_median, dedup_cascade, content_fingerprint_dedup, normalize_text, json_params_lookup, url_canonical, html_item_pages, html_search_pages, months_elapsed,
        catalog_lookup, option_membership, catalog_storages, builtin_catalog, resume_append, first_capture, frequent_categories, default_category, value_counts, regression_metrics, fold_metrics, model_selection, delta_classes, prices_read, regions_read,
        numbers_read, features_of_listings, listing_ages, valuations, model_valuations, attributes_plain, clean_balance, model_check, values_formatted, params_read, usable_rows, csv_round_trip, streamed_counts, streamed_append, negated_keyword_flags, junk_reasons, attributes_read, clean_listings_e2e, cleaning_report, monotone_price_model, gbt_price_model, cross_validated_model, isolation_forest,
    )
    return {f.__name__: f for f in own} | {
        "synthetic_listings": synthetic,
        "p4_found": fill_queries.p4_found,
        "p4_filled_clean": fill_queries.filled_clean,
        "p4_filled_raw": fill_queries.filled_raw,
        "p4_held_out": fill_queries.held_out,
        "p4_fill_counts": fill_queries.fill_counts,
    }
