"""Rules, repeats, statistics, fills, features, metrics, forest and models on small frames."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from bazaarlens.operators import features as E
from bazaarlens.operators.forest import isolation_outliers
from bazaarlens.operators.models import BoostedTrees, LogLinear, _constrained, load_bundle, make_model, metrics_document, save_bundle, scores_table, select_and_refit, training_statistics
from bazaarlens.operators.propagate import Hub, Target, fill, to_fill
from bazaarlens.operators.rules import apply_rules, drop_repeats, drop_report, not_seen, report_text
from bazaarlens.operators.stats import far_below_median, fill_group_median, group_statistics, outside_fence
from bazaarlens.operators.valuation import as_json, as_lines, evaluate
from bazaarlens.sources.catalog import catalog
from pyspark.sql import functions as F


def test_rules_count_under_the_first(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 50), (4, 500)], "i int, p int")
    out = apply_rules(df, [("missing", F.col("p").isNull()), ("low", F.col("p") < 10), ("odd", F.col("i") % 2 == 1)])
    assert {r["i"]: r["drop_reason"] for r in out.collect()} == {1: "missing", 2: "low", 3: "odd", 4: None}
    report = drop_report(out, ["missing", "low", "odd"])
    assert [(r["rule"], r["rows"]) for r in report.orderBy("position").collect()] == [("missing", 1), ("low", 1), ("odd", 1), ("kept", 1)]
    assert report_text(report).splitlines() == ["input rows: 4", "  -1      missing", "  -1      low", "  -1      odd", "output rows: 1"]


def test_repeats_among_survivors(spark):
    rows = [(1, "a", "u1"), (2, "a", "u2"), (3, "", "u2"), (4, "", "u1"), (5, None, None), (6, "b", "u2")]
    df = spark.createDataFrame(rows, "row long, item string, url string").withColumn("drop_reason", F.lit(None).cast("string"))
    out = drop_repeats(df, "row", [("id", [F.col("item")], F.col("item") != ""), ("url", [F.col("url")], F.col("url") != "")])
    assert {r["row"]: r["drop_reason"] for r in out.collect()} == {1: None, 2: "id", 3: None, 4: "url", 5: None, 6: "url"}


def test_not_seen(spark):
    new = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("", 4), (None, 5)], "k string, v int")
    known = spark.createDataFrame([("b",)], "k string")
    assert sorted((r["k"] or "", r["v"]) for r in not_seen(new, known, "k").collect() if r["k"] != "a") == [("", 4), ("", 5)]


def test_statistics_fall_back_and_match_numpy(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("ab"), rng.choice("xyz"), rng.lognormvariate(3, 1)) for i in range(200)] + [(900, "c", "x", 1.0), (901, None, "x", 2.0)]
    df = spark.createDataFrame(rows, "i int, g string, h string, v double")
    out = {r["i"]: r for r in group_statistics(df, F.col("v"), [("g", "h"), ("g",)], 35).collect()}
    for i, g, h, _ in rows:
        fine, coarse = [r[3] for r in rows if r[1:3] == (g, h)], [r[3] for r in rows if r[1] == g]
        group, level = (fine, 0) if len(fine) >= 35 else (coarse, 1) if len(coarse) >= 35 else (None, None)
        assert out[i]["stat_level"] == level and out[i]["stat_n"] == (len(group) if group else None)
        if group:
            assert np.allclose([out[i]["stat_q1"], out[i]["stat_median"], out[i]["stat_q3"]], np.percentile(group, [25, 50, 75]))


def test_fence_and_cheap_keep_rows_without_statistics(spark):
    rows = [(i, "a", math.log(100 + i)) for i in range(15)] + [(99, "a", math.log(900)), (100, "b", 1.0)]
    df = spark.createDataFrame(rows, "i int, g string, v double")
    out = group_statistics(df, F.col("v"), [("g",)], 10)
    assert [r["i"] for r in out.where(outside_fence(F.col("v"))).collect()] == [99]
    assert out.where(far_below_median(F.col("v"), 0.3)).count() == 0


def test_median_fill(spark):
    df = spark.createDataFrame([(1, "g", 80), (2, "g", 90), (3, "g", None), (4, "h", None), (5, "g", 85)], "i int, g string, b int")
    out = {r["i"]: (r["b"], r["b_known"]) for r in fill_group_median(df, "b", "g", F.col("i") != 5, 90.0).collect()}
    assert out == {1: (80, 1), 2: (90, 1), 3: (85, 0), 4: (85, 0), 5: (85, 1)}
    none = spark.createDataFrame([(1, "g", None)], "i int, g string, b int")
    assert fill_group_median(none, "b", "g", F.lit(True), 90.0).first()["b"] == 90


@pytest.fixture
def filled(spark):
    rows = [(i, "m", "used", 80 + i % 3, 1) for i in range(12)] + [(20, "m", "used", None, None), (21, None, None, None, 0), (22, "lonely", "new", None, None), (23, "m", "used", 999, 5), (23, "m", "used", 999, 5)]
    df = spark.createDataFrame(rows, "id int, model string, condition string, battery int, known int").withColumn("_key_model", F.lit("clash")).withColumn("_cell", F.lit(1))
    targets = [Target("battery", F.coalesce(F.col("battery").between(40, 100), F.lit(False)), low=40, high=100), Target("known", F.coalesce(F.col("known").isin(0, 1), F.lit(False)), categorical=True)]
    keys = {"model": F.col("model"), "condition": F.col("condition")}
    hubs = [Hub(("model", "condition"), 4.0), Hub(("model",), 2.0), Hub((), 0.1)]
    return df, fill(df, targets, keys, hubs)


def test_propagation_fills_and_marks(filled):
    df, out = filled
    rows = out.collect()
    assert len(rows) == df.count() and out.columns[: len(df.columns)] == df.columns
    by = {r["id"]: r for r in rows}
    assert by[0]["battery"] == 80 and by[0]["battery_status"] == "observed"
    assert by[20]["battery"] == 81 and by[20]["battery_status"] == "filled" and by[20]["known"] == 1
    assert by[21]["battery_status"] == "filled" and by[21]["known_status"] == "observed"
    assert by[22]["battery_status"] == "filled" and 40 <= by[22]["battery"] <= 100
    assert by[23]["battery"] == 81 and by[23]["_key_model"] == "clash"
    found = {(r["row_key"], r["field_name"]) for r in to_fill(out, ["battery", "known"], "id").collect()}
    assert found == {("20", "battery"), ("20", "known"), ("21", "battery"), ("22", "battery"), ("22", "known"), ("23", "battery"), ("23", "known")}


def test_propagation_without_evidence(spark):
    df = spark.createDataFrame([(1, "a", None)], "id int, model string, battery int")
    t = [Target("battery", F.coalesce(F.col("battery").between(40, 100), F.lit(False)))]
    row = fill(df, t, {"model": F.col("model")}, [Hub(("model",), 1.0)]).first()
    assert row["battery"] is None and row["battery_status"] == "unfilled"
    assert fill(df.limit(0), t, {"model": F.col("model")}, [Hub(("model",), 1.0)]).count() == 0


def test_propagation_reaches_over_shared_members(spark):
    # nothing is observed in group p, but its members share q with observed ones
    df = spark.createDataFrame([(1, "p", "q", None), (2, "p", None, None), (3, "r", "q", 60)], "id int, a string, b string, v int")
    t = [Target("v", F.col("v").isNotNull())]
    out = {r["id"]: r["v"] for r in fill(df, t, {"a": F.col("a"), "b": F.col("b")}, [Hub(("a",), 1.0), Hub(("b",), 1.0)]).collect()}
    assert out == {1: 60, 2: 60, 3: 60}


def test_metrics_and_folds(spark):
    df = spark.createDataFrame([(100.0, 110.0), (200.0, 180.0)], "y double, h double")
    row = df.agg(*E.regression_metrics(F.col("y"), F.col("h"))).first()
    assert row["rmse"] == pytest.approx(math.sqrt(250)) and row["mae"] == 15 and row["mape"] == pytest.approx(10)
    folds = spark.range(3000).select(E.fold_of(F.col("id"), 3).alias("f")).groupBy("f").count().collect()
    assert len(folds) == 3 and all(abs(r["count"] - 1000) < 150 for r in folds)


def test_rare_categories(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [(None,)] + [("__other__",)], "c string")
    out = E.fold_rare(df, "c", E.frequent_values(df, "c", 3))
    assert {r["c"]: r["count"] for r in out.groupBy("c").count().collect()} == {"a": 5, "__other__": 4} and df.where("c = 'b'").count() == 2
    assert E.most_frequent(spark.createDataFrame([("b",), ("a",), ("Неизвестно",), ("Неизвестно",)], "r string"), "r") == "a"


def test_feature_columns(spark):
    from bazaarlens.sources.catalog import catalog

    df = spark.createDataFrame([("iphone  13 PRO", 1024, "used", None, 88, 1, 12, 1, 0), ("Other", 64, "new", "x", 100, 1, 1, 0, 0)], "model string, storage_gb int, condition string, region string, battery_health int, battery_known int, phone_age_months int, has_box int, has_receipt int")
    got = E.feature_frame(df, catalog(spark)).collect()
    assert [(r["model_tier"], r["storage"], r["region"]) for r in got] == [("pro", "1TB", "Неизвестно"), ("__other__", "64GB", "x")]
    with pytest.raises(ValueError):
        E.feature_frame(df.drop("region"), catalog(spark))
    with pytest.raises(ValueError):
        E.training_rows(df.withColumn("price", F.lit(1)))


def test_forest(spark):
    rng = random.Random(3)
    rows = [(i, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(99)] + [(999, 15.0, 15.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    found = [r["id"] for r in isolation_outliers(df, ["a", "b"], "id", 0.05, trees=60).where("is_outlier").collect()]
    assert 999 in found and 3 <= len(found) <= 7
    assert isolation_outliers(df.limit(20), ["a", "b"], "id").where("is_outlier").count() == 0


def test_constrained_least_squares():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 4))
    y = x @ np.array([1.0, -2.0, 0.5, 3.0])
    w = _constrained(x.T @ x, x.T @ y, np.array([0, 1, 1, -1]))
    assert w[1] >= 0 and w[2] >= 0 and w[3] <= 0
    free = _constrained(x.T @ x, x.T @ y, np.zeros(4))
    assert np.allclose(free, [1, -2, 0.5, 3])


@pytest.fixture(scope="module")
def training(spark):
    from bazaarlens.sources.catalog import catalog

    rng = random.Random(5)
    rows = []
    for i in range(600):
        model, base = rng.choice([("iPhone 11", 18000), ("iPhone 13", 34000), ("iPhone 13 Pro", 44000)])
        storage, battery, age, box = rng.choice([128, 256]), rng.randint(75, 100), rng.randint(5, 60), rng.randint(0, 1)
        price = base * (1.12 if storage == 256 else 1) * (1 + 0.007 * (battery - 88)) * (1 - 0.002 * age) * (1.03 if box else 1) * math.exp(rng.gauss(0, 0.05))
        rows.append((i, model, storage, "used", "Москва", battery, 1, age, box, 0, int(price)))
    df = spark.createDataFrame(rows, "id int, model string, storage_gb int, condition string, region string, battery_health int, battery_known int, phone_age_months int, has_box int, has_receipt int, price int")
    return E.feature_frame(df, catalog(spark), ["id", "price"]).cache()


def test_monotone_model(training, spark, tmp_path):
    model = LogLinear().fit(training)
    error = model.predict(training).agg(F.avg(F.abs(F.col("price") - F.col("y_hat")) / F.col("price"))).first()[0]
    assert error < 0.08
    probe = training.limit(1).drop("battery_health").crossJoin(training.sparkSession.range(40, 101).select(F.col("id").cast("double").alias("battery_health")))
    series = [r["y_hat"] for r in model.predict(probe).orderBy("battery_health").collect()]
    assert all(b - a >= -1e-6 for a, b in zip(series, series[1:], strict=False))
    path = str(tmp_path / "linear")
    save_bundle(spark, model, path, typical_error=5.0)
    again, statistics = load_bundle(spark, path)
    assert again.weights == model.weights and statistics == {"typical_error": 5.0}
    assert abs(sum(model.importances().values()) - 1) < 1e-9
    with pytest.raises(FileNotFoundError):
        load_bundle(spark, str(tmp_path / "none"))
    for text in ("[]", "{", '{"kind": "boosted_trees", "version": 0}'):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(str(tmp_path / "bad" / "bundle"))
        with pytest.raises(ValueError):
            load_bundle(spark, str(tmp_path / "bad"))


def test_trees_are_kept(training, spark, tmp_path):
    trees = make_model("boosted_trees", iterations=2, depth=2).fit(training)
    save_bundle(spark, trees, str(tmp_path / "t"), typical_error=1.0)
    again, statistics = load_bundle(spark, str(tmp_path / "t"))
    both = trees.predict(training, "a").select("id", "a").join(again.predict(training, "b").select("id", "b"), "id")
    assert both.where("abs(a - b) > 1e-9").count() == 0 and statistics == {"typical_error": 1.0}
    with pytest.raises(ValueError):
        make_model("other")


def test_selection(training):
    found = select_and_refit({"linear": LogLinear, "trees": lambda: BoostedTrees(iterations=3, depth=3)}, training, "id", 2)
    assert found["best"] in ("linear", "trees") and found["results"]["linear"]["summary"]["mape_mean"] < 10 and found["typical_error"] < 15
    document = metrics_document(found, {"n_train": 7}, trained_at="now")
    assert document["best_model"] == found["best"] and set(document["cross_validation"]) == {"linear", "trees"} and document["n_train_samples"] == 7
    assert list(document["feature_importances"].values()) == sorted(document["feature_importances"].values(), reverse=True)
    assert [line.endswith(" best") for line in scores_table(found).splitlines()].count(True) == 1
    with pytest.raises(ValueError):
        select_and_refit({}, training, "id")


def test_queries_of_models_run_the_whole_job(spark, small, monkeypatch):
    from bazaarlens.plans import core_queries

    assert sorted(r["fold"] for r in core_queries.cross_validated_model(spark, small).collect()) == [0, 1, 2, 3, 4]
    seen = []

    def fit(self, rows):
        seen.append((self.iterations, self.depth, self.rate))
        raise InterruptedError

    monkeypatch.setattr(BoostedTrees, "fit", fit)
    with pytest.raises(InterruptedError):
        core_queries.gbt_price_model(spark, small)
    assert seen == [(20, 5, 0.2)]


def test_lonely_listings_by_battery(spark, tmp_path):
    from bazaarlens.plans import core_queries
    from bazaarlens.sources.catalog import catalog

    rng = random.Random(4)
    rows = [(f"a{i}", "iPhone 13", 30_000.0 * math.exp(rng.gauss(0, 0.02)), 128.0, "used", float(rng.randint(85, 90)), 20.0) for i in range(120)]
    rows += [("worn", "iPhone 13", 30_000.0, 128.0, "used", 41.0, 20.0), ("no_price", "iPhone 13", None, 128.0, "used", 88.0, 20.0), ("no_model", None, 30_000.0, 128.0, "used", 88.0, 20.0)]
    spark.createDataFrame(rows, "item_id string, model string, price double, storage_gb double, condition string, battery_health double, phone_age_months double").write.parquet(f"{tmp_path}/clean_listings.parquet")
    catalog(spark).write.parquet(f"{tmp_path}/phone_catalog.parquet")
    found = {r["item_id"] for r in core_queries.isolation_forest(spark, str(tmp_path)).collect()}
    assert "worn" in found and not found & {"no_price", "no_model"}


def test_fills_beat_the_plain_mean(spark, small):
    from bazaarlens.plans.fill_queries import held_out

    rows = {r["field"]: r for r in held_out(spark, small).collect()}
    assert rows["release_year"]["error"] < 0.1 and rows["battery_health"]["error"] < rows["battery_health"]["plain_error"]


def test_rare_values_beyond_the_bound_are_an_error(training):
    with pytest.raises(ValueError):
        LogLinear(most_values=1).fit(training)


def test_statistics_of_training(spark):
    rows = [(2020, 80, 1, "used", "Омск")] * 3 + [(2020, 90, 1, "used", "Уфа"), (2021, 91, 1, "used", "Уфа"), (2021, 40, 1, "new", "Неизвестно"), (2021, 50, 0, "used", "Омск"), (None, 99, 1, "used", None)]
    found = training_statistics(spark.createDataFrame(rows, "release_year int, battery_health int, battery_known int, condition string, region string"), least=2)
    assert found == {"battery_by_year": {"2020": 80.0, "2021": 91.0}, "battery_median": 85.0, "default_region": "Омск", "known_regions": ["Омск", "Уфа"], "n_train": 8}
    empty = training_statistics(spark.createDataFrame([], "release_year int, battery_health int, battery_known int, condition string, region string"))
    assert empty["battery_median"] == 90.0 and empty["battery_by_year"] == {} and empty["default_region"] == "Неизвестно"


def test_valuation(spark):
    models = catalog(spark)
    rows = [
        (1, "iPhone 13 Pro", 256, "used", 65_000, 78, "питер", True, None), (2, " iphone 13  pro", 256, "new", 49_500, None, None, None, True), (3, "iPhone 12", 128, "used", 40_000, None, " ", None, None), (4, "Nokia", 1, "used", 1, None, None, None, None),
        (5, "iPhone 13", 64, "used", 1, 0, None, None, None), (6, "iPhone 13", 128, "for_parts", 1, 0, None, None, None), (7, "iPhone 13", 128, "used", 0, 0, None, None, None), (8, "iPhone 13", 128, "used", 0, None, None, None, None), (9, None, None, None, None, None, None, None, None),
        (10, "iPhone 13", 128, "used", 60_500, 100, "Омск", False, False),
    ]
    queries = spark.createDataFrame(rows, "fair_price int, model string, storage_gb int, condition string, asking_price long, battery_health int, region string, has_box boolean, has_receipt boolean")
    queries = queries.withColumnRenamed("fair_price", "id")
    statistics = {"battery_by_year": {"2020": 84.5}, "battery_median": 88.5, "default_region": "Москва"}
    seen = {r["id"]: r for r in evaluate(queries, models, lambda f: f.withColumn("y_hat", F.lit(55_000.0)), statistics, dt.date(2026, 9, 1)).collect()}
    assert [seen[i]["error"] for i in range(1, 11)] == [None, None, None, "unknown_model", "storage_not_offered", "unsupported_condition", "battery_out_of_range", "price_not_positive", "unknown_model", None]
    assert (round(seen[1]["delta_pct"], 2), seen[1]["verdict"], seen[1]["fair_low"], round(seen[1]["fair_high"], 6), seen[1]["region_used"], seen[1]["battery_assumed"]) == (18.18, "overpriced", 49_500.0, 60_500.0, "Санкт-Петербург", None)
    assert (seen[2]["verdict"], seen[2]["battery_assumed"], seen[2]["region_used"]) == ("fair", 100.0, "Москва") and (seen[3]["verdict"], seen[3]["battery_assumed"], seen[3]["region_used"]) == ("great_deal", 84.0, "Москва")
    assert seen[10]["verdict"] == "fair" and seen[4]["verdict"] is None and seen[4]["fair_price"] is None
    valued = evaluate(queries.where("id in (1, 4)"), models, lambda f: f.withColumn("y_hat", F.lit(55_000.0)), statistics)
    texts = sorted(r[0] for r in as_lines(valued).collect())
    assert texts == ["Nokia | 1GB | used | asked 1 | error: unknown_model", "iPhone 13 Pro | 256GB | used | Санкт-Петербург | asked 65,000 | fair ~55,000 (49,500 - 60,500), +18.2%, overpriced"]
    assert '"fair_range":[49500,60500],"delta_pct":18.18' in "".join(r[0] for r in as_json(valued, 5.0).collect())
    assert evaluate(queries.limit(0), models, lambda f: f.withColumn("y_hat", F.lit(1.0)), statistics).count() == 0
    with pytest.raises(ValueError):
        evaluate(queries, models, lambda f: f, statistics, threshold=0)
    with pytest.raises(ValueError):
        evaluate(queries.drop("model"), models, lambda f: f, statistics)


def test_completed_listings_have_no_gap(spark):
    from bazaarlens.plans.training import complete_listings

    rows = [("a", "iPhone 13", 128, "used", 80, 1, 9, "2026-01-01", 1, 0, "x"), ("b", None, None, None, None, None, None, "20260101T000000Z", None, None, "iPhone 13 на 256"), ("c", None, None, "new", 7, 1, None, None, 9, None, "стол"), ("d", "iPhone 13", None, "used", 90, 0, None, "?", 0, 1, None)]
    df = spark.createDataFrame(rows, "item_id string, model string, storage_gb long, condition string, battery_health long, battery_known long, phone_age_months int, scraped_at string, has_box long, has_receipt long, title string").withColumn("region", F.lit("мск"))
    got = {r["item_id"]: r for r in complete_listings(df, catalog(spark)).collect()}
    seen = [tuple(got[i][c] for c in ("model", "storage_gb", "condition", "battery_health", "battery_known", "phone_age_months", "has_box", "has_receipt")) for i in "abcd"]
    assert seen == [("iPhone 13", 128, "used", 80, 1, 9, 1, 0), ("iPhone 13", 256, "used", 80, 0, 51, 0, 0), ("__other__", 128, "new", 100, 0, 30, 0, 0), ("iPhone 13", 128, "used", 80, 0, 30, 0, 1)]


def test_hot_keys_are_spread(spark, monkeypatch):
    from bazaarlens.operators import rules

    monkeypatch.setattr(rules, "HOT_ROWS", 5)
    rows = [(i, "hot" if i % 3 else f"k{i}", f"u{i // 2}") for i in range(300)]
    df = spark.createDataFrame(rows, "row long, item string, _reason string").withColumns({"drop_reason": F.lit(None).cast("string"), "_order": F.lit("clash")})
    out = drop_repeats(df, "row", [("id", [F.col("item")], F.col("item") != ""), ("url", [F.col("_reason")], F.lit(True))])
    assert out.columns == df.columns
    got, first, seen = {r["row"]: r["drop_reason"] for r in out.collect()}, {}, {}
    for i, item, url in rows:
        want = "id" if item in first else "url" if url in seen else None
        first.setdefault(item, i)
        if want != "id":
            seen.setdefault(url, i)
        assert got[i] == want


def test_crowded_hubs_are_broadcast_with_the_same_result(spark, monkeypatch):
    from bazaarlens.operators import propagate

    rows = [(i, f"g{i % 7}", f"s{i % 3}", None if i % 4 == 0 else 40 + i % 50, None if i % 5 == 0 else f"k{i % 3}") for i in range(200)]
    df = spark.createDataFrame(rows, "i int, g string, s string, v int, k string")
    run = lambda: {r["i"]: (r["v"], r["k"], r["v_status"]) for r in fill(df, [Target("v", F.col("v").isNotNull()), Target("k", F.col("k").isNotNull(), categorical=True)], {"g": F.col("g"), "s": F.col("s")}, [Hub(("g", "s"), 4.0), Hub(("g",), 1.0), Hub((), 0.01)]).collect()}
    plain = run()
    monkeypatch.setattr(propagate, "CROWDED", 2)
    assert run() == plain and {v[2] for v in plain.values()} == {"observed", "filled"} and all(v[1] for v in plain.values())
    with pytest.raises(ArithmeticError):
        fill(df, [Target("v", F.col("v").isNotNull())], {"g": F.col("g")}, [Hub(("g",), 1.0), Hub((), 1.0)], max_rounds=1)
