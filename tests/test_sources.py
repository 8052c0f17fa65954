"""Sources, sinks, streams, the cleaning pipeline and the driver contract."""

import duckdb
import pytest
from bazaarlens.plans.clean import RULES, Settings, clean, read_attributes
from bazaarlens.sources import files, html
from bazaarlens.sources.catalog import catalog, require_models
from bazaarlens.sources.synthetic import synthetic_listings
from bazaarlens.streaming.resume import append_new, stream_append, stream_latest_counts
from pyspark.sql import functions as F

SOUND = {
    "item_id": "77001122", "listing_url": "https://board.example/omsk/phones/77001122", "title": "Айфон 14 про на 512", "model": "iPhone 14 Pro", "storage_gb": "512", "condition": "refurbished", "battery_health": "93", "price": "71 500 р.",
    "description": "Ёмкость 93 процента, полный комплект, чек сохранился.", "location": "Омск", "params": '{"Цвет": "синий"}', "scraped_at": "20260714T101500Z",
}


def test_csv_round_trip(spark, tmp_path):
    df = files.from_records(spark, [{**SOUND, "description": 'две\nстроки, "кавычки"', "params": {"Модель": "ё"}}, {"item_id": "2", "title": "NA", "price": None}])
    files.write_csv(df, str(tmp_path / "csv"))
    back = {r["item_id"]: r for r in files.read_csv(spark, str(tmp_path / "csv"), files.RAW_SCHEMA).collect()}
    assert back["77001122"]["description"] == 'две\nстроки, "кавычки"' and back["77001122"]["params"] == '{"Модель": "ё"}'
    assert back["2"]["title"] is None and back["2"]["location"] is None
    odd = [{"item_id": "3", "title": "  blanks \t", "description": "a\r\nb\n", "location": '"', "params": "a,b;c\\"}]
    files.write_csv(files.from_records(spark, odd), str(tmp_path / "odd"))
    assert {k: v for k, v in files.read_csv(spark, str(tmp_path / "odd"), files.RAW_SCHEMA).first().asDict().items() if v is not None} == odd[0]
    (tmp_path / "few.csv").write_text("title,item_id\nx,7\n")
    assert files.read_csv(spark, str(tmp_path / "few.csv"), files.RAW_SCHEMA).first()["item_id"] == "7"
    assert [r[0] for r in files.known_ids(spark, str(tmp_path / "csv")).orderBy("item_id").collect()] == ["2", "77001122"]
    assert files.known_ids(spark, str(tmp_path / "missing")).count() == 0
    (tmp_path / "lines.txt").write_text("# c\n a \n\nb\n")
    assert [r[0] for r in files.read_lines(spark, str(tmp_path / "lines.txt")).collect()] == ["a", "b"]


SEARCH = """<body><div data-marker="item" data-item-id="1"><a data-marker="item-title" href="/a_1234567?x=1" title="T1">t</a><p data-marker="item-price"><meta itemprop="price" content="54990">x</p><div class="geo-root-1"><span>Москва</span></div></div>
<div data-marker="item" data-item-id="1"><a itemprop="url" href="/b_1234568">again</a></div><div data-marker="item"><p>no link</p></div>
<div data-marker="item"><a itemprop="url" href="https://h/c_7654321#f">c</a><p data-marker="item-price">12 500 ₽</p></div>{}</body>"""
ITEM = """<html><head><title>x</title><script type="application/ld+json">{bad</script><script type="application/ld+json">[{"@type":"Product","name":"N","description":"D","offers":{"price":"100"}}]</script></head><body>
<ul class="params-paramsList-9"><li>A: 1</li><li>A: 2</li><li>none</li></ul></body></html>"""


def test_search_page():
    cards, more = html.search_page(SEARCH.format(""), "https://board.example")
    assert [(c["item_id"], c["url"], c["title"], c["price"], c["location"]) for c in cards] == [("1", "https://board.example/a_1234567", "T1", 54990, "Москва"), ("7654321", "https://h/c_7654321", "c", 12500, "")]
    assert more
    assert not html.search_page(SEARCH.format('<nav data-marker="pagination-button"></nav>'), "")[1]
    assert html.search_page(SEARCH.format('<a rel="next" href="x"></a>'), "")[1]
    assert not html.search_page(SEARCH.format('<a rel="next" aria-disabled="true"></a>'), "")[1]
    assert html.search_page(None, "") == ([], True)


def test_item_page():
    found = html.item_page(ITEM)
    assert found == {"title": "N", "price": 100, "description": "D", "location": "", "params": {"A": "1"}}
    assert html.is_block_page("<h1>Доступ ограничен: проблема с IP</h1>") and html.is_block_page('<div class="x firewall-title">a</div>') and not html.is_block_page(ITEM) and not html.is_block_page(None)


def test_merge_of_card_and_item(spark):
    cards = spark.createDataFrame([("u1", "card", 5, "L", "s"), ("u2", "card2", 6, "M", "t")], "url string, title string, price long, location string, snippet string")
    items = spark.createDataFrame([("u1", "", 7, "desc", "", {"a": "b"})], "url string, title string, price long, description string, location string, params map<string,string>")
    got = {r["url"]: r for r in html.merge_card_and_item(cards, items).collect()}
    assert (got["u1"]["title"], got["u1"]["price"], got["u1"]["description"], got["u1"]["location"], got["u1"]["params"]) == ("card", 7, "desc", "L", {"a": "b"})
    assert (got["u2"]["price"], got["u2"]["description"], got["u2"]["params"]) == (6, "t", {})


@pytest.mark.parametrize("override, expected", [
    ({}, {"model": "iPhone 14 Pro", "storage_gb": 512, "battery_health": 93, "price": 71500, "region": "Омск", "has_box": 1, "has_receipt": 1, "condition": "refurbished"}),
    ({"model": None, "storage_gb": None, "battery_health": None, "params": "{", "condition": None}, {"model": "iPhone 14 Pro", "storage_gb": 512, "battery_health": 93, "condition": "used"}),
])
def test_attributes(spark, override, expected):
    row = read_attributes(files.from_records(spark, [{**SOUND, **override}])).first()
    assert {k: row[k] for k in expected} == expected


def test_cleaning_rules_one_by_one(spark):
    changes = [
        ({"price": "договорная"}, "missing_price"), ({"model": None, "title": "Samsung", "params": "{}"}, "unknown_model"), ({"storage_gb": None, "title": "iPhone 13 Pro", "params": "{}", "description": "ok"}, "missing_storage"), ({"model": "iPhone 13", "storage_gb": "64"}, "storage_not_offered"),
        ({"description": "Заблокирован на iCloud"}, "junk_locked"), ({"description": "На запчасти"}, "junk_for_parts"), ({"description": "Экран разбит"}, "junk_broken_screen"), ({"description": "Утопленник"}, "junk_water_damage"), ({"description": "Реплика"}, "junk_fake"),
        ({"title": "Чехол для iPhone 13 Pro 256"}, "junk_accessory"), ({"title": "Куплю iPhone 13 Pro 256"}, "junk_not_for_sale"), ({"condition": "for_parts"}, "condition_for_parts"), ({"price": "4999"}, "price_below_minimum"), ({"price": "999999"}, "price_above_maximum"),
    ]
    rows = [{**SOUND, "item_id": str(i), "listing_url": f"https://b/x_{i}", **c} for i, (c, _) in enumerate(changes)]
    kept, report = clean(files.from_records(spark, rows), catalog(spark))
    assert kept.count() == 0 and {r["rule"]: r["rows"] for r in report.collect()} == {rule: 1 for _, rule in changes}


def test_cleaning_of_synthetic_listings(spark):
    raw = synthetic_listings(spark, 600, 7).cache()
    assert raw.count() == 600 and raw.exceptAll(synthetic_listings(spark, 600, 7)).count() == 0
    kept, report = clean(raw, catalog(spark), Settings(method="none"))
    counts = {r["rule"]: r["rows"] for r in report.collect()}
    assert sum(counts.values()) == 600 and counts["kept"] == kept.count() and set(counts) <= {*RULES, "kept"}
    assert kept.columns == files.CLEAN_COLUMNS and kept.where("battery_health not between 40 and 100 or phone_age_months < 0").count() == 0
    assert kept.where(F.col("description").rlike("Утопленник|разбит|iCloud|запчасти|Реплика")).count() == 0
    assert kept.select("item_id").distinct().count() == kept.count()


def test_required_models(spark):
    df = spark.createDataFrame([("iPhone 13",), ("nothing",)], "model string")
    with pytest.raises(KeyError):
        require_models(df, catalog(spark))
    assert require_models(df.limit(1), catalog(spark)).count() == 1
    assert catalog(spark).count() == 36


def test_streams(spark, tmp_path):
    src, sink = str(tmp_path / "src"), str(tmp_path / "sink")
    spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "item_id string, v int").write.parquet(src)
    schema = spark.read.parquet(src).schema
    for _ in range(2):
        stream_append(spark, src, schema, sink, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(sink).select("item_id").collect()) == ["a", "b"]
    assert append_new(spark.createDataFrame([("b", 9), ("c", 9)], "item_id string, v int"), sink) == 1
    ev = str(tmp_path / "ev")
    spark.createDataFrame([("2026-01-01 01:00:00", "x"), ("2026-01-01 02:00:00", "x"), ("2026-01-02 01:00:00", "y")], "t string, g string").write.parquet(ev)
    counts = stream_latest_counts(spark, ev, spark.read.parquet(ev).schema, "t", "g")
    q = counts.writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r["group"], r["rows"]) for r in spark.sql("select * from counts").collect()) == [("x", 2), ("y", 1)]


FAST = ["group_levels", "dedup_cascade", "content_fingerprint_dedup", "normalize_text", "json_params_lookup", "url_canonical", "prices_read", "regions_read", "numbers_read", "catalog_lookup", "option_membership", "html_item_pages", "html_search_pages", "p4_found", "rule_cascade_report", "impute_group_median"]


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, small, name):
    import glob
    import os

    import __spark_entry__ as entry

    con = duckdb.connect()
    con.execute("SET timezone='UTC'")
    for f in glob.glob(f"{small}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = entry.queries()[name](spark, small)
    columns = sorted(df.columns)
    mine = sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
    sql = con.execute(entry.oracle_sql()[name])
    order = [d[0] for d in sql.description]
    assert sorted(order) == columns
    theirs = sorted((tuple(r[order.index(c)] for c in columns) for r in sql.fetchall()), key=str)
    assert len(mine) == len(theirs)
    for a, b in zip(mine, theirs, strict=True):
        assert [pytest.approx(x, rel=1e-9) if isinstance(x, float) else x for x in b] == list(a)


def test_entry(spark, small):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() >= 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_commands(spark, tmp_path, capsys):
    from bazaarlens.cli import main

    at = lambda name: str(tmp_path / name)
    assert main(["synthesize", at("raw"), "--rows", "500", "--seed", "7"], spark) == 0
    assert main(["clean", at("raw"), at("clean"), "--outliers", "none"], spark) == 0
    assert "input rows: 500" in capsys.readouterr().out
    assert main(["train", at("clean"), at("bundle"), "--folds", "2", "--metrics", at("scores.json")], spark) == 0
    assert "monotone_log_linear" in capsys.readouterr().out and "typical_error_pct" in (tmp_path / "scores.json").read_text()
    assert main(["evaluate", at("bundle"), "--phone", "13 про", "--storage", "256", "--condition", "б/у", "--price", "65,5к", "--battery", "78%"], spark) == 0
    line = capsys.readouterr().out
    assert line.startswith("iPhone 13 Pro | 256GB | used |") and "asked 65,500" in line
    assert main(["evaluate", at("bundle"), "--phone", "iPhone 13", "--storage", "64", "--condition", "new", "--price", "70 тыс", "--json"], spark) == 2
    assert '"error":"storage_not_offered"' in capsys.readouterr().out
    assert main(["evaluate", at("nothing")], spark) == 1


def test_entry_without_what_the_subpackage_needs(monkeypatch):
    import sys

    import __spark_entry__ as entry

    monkeypatch.setitem(sys.modules, "bazaarlens.llm.queries", None)  # as where a library that it imports is absent
    found, sql = entry.queries(), entry.oracle_sql()
    assert "p4_found" in found and "p1_price_percentiles" not in found and set(sql) <= set(found)
