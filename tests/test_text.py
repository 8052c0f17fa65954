"""Text functions against stated behaviour."""

from bazaarlens.functions import scalars as S
from bazaarlens.functions import text as X
from bazaarlens.sources.catalog import names
from pyspark.sql import functions as F


def check(apply, expression, cases):
    got = apply(expression, [c[0] for c in cases])
    assert dict(zip([c[0] for c in cases], got, strict=True)) == dict(cases)


def test_normalize(apply):
    check(apply, X.normalize, [(None, ""), ("", ""), (" ЁЛКА \tдва ", "елка два"), ("a \n\n  b", "a\nb"), ("\n x \n", "x")])


def test_fingerprint_cuts_before_it_trims(apply):
    text = "слово " * 60
    got = apply(X.fingerprint, [text, "a--b!!c", None])
    assert got[0] == (" ".join(["слово"] * 60))[:200].strip() and got[1:] == ["a b c", ""]


def test_model(apply):
    known = names()
    check(apply, lambda c: X.model_name(c, known), [
        ("Айфон 13 про макс", "iPhone 13 Pro Max"), ("iPhone 13 Pro, 256 ГБ", "iPhone 13 Pro"), ("iphone хр 64", "iPhone XR"), ("iPhone SE 2022 64", "iPhone SE 2022"), ("iPhone SE (3-го поколения)", "iPhone SE 2022"), ("iPhone SE", None), ("iPhone 16e 128", "iPhone 16e"),
        ("iPhone 14+ 128", "iPhone 14 Plus"), ("iPhone 12 max", "iPhone 12 Pro Max"), ("iPhone 17 Air", "iPhone Air"), ("Samsung S21", None), ("чехол и iPhone SE, а также iPhone 11", "iPhone 11"), ("iPhone 10", "iPhone X"), (None, None), ("13 pro", None),
    ])
    check(apply, lambda c: X.model_name(c, known, False), [("14 pro max", "iPhone 14 Pro Max"), ("XR", "iPhone XR"), ("8", "iPhone 8"), ("x", "iPhone X")])


def test_storage(apply):
    check(apply, X.storage_gb, [("256 ГБ", 256), ("1TB", 1024), ("2 терабайта", 2048), ("3.64 гб", None), ("память 512gb и 128 гб", 512), ("100 гб", None), ("iPhone 256", None), (None, None)])
    check(apply, lambda c: X.storage_gb(c, True), [("iPhone 13 Pro 256", 256), ("iPhone 128 тыс", None), ("iPhone 128 500", None), ("64%", None)])


def test_battery(apply):
    check(apply, X.battery_percent, [("АКБ 87%", 87), ("87% акб", 87), ("100% оригинал", None), ("аккумулятор: 91", 91), ("аккумулятор 500 циклов", None), ("батарея 30%", None), ("Battery health 88 %", 88), ("емкость 79 процентов", 79), ("", None)])


def test_negation(apply):
    cases = [("не битый", False), ("битый", True), ("экран не разбит, но корпус битый", True), ("без трещины", False), ("трещина есть", True), ("без коробки, есть трещина", True), ("разбит экран. не включается", True), ("битый: нет", False), ("никогда не был битый", False)]
    check(apply, lambda c: X.unnegated(X.normalize(c), X.BROKEN_SCREEN), cases)
    check(apply, lambda c: X.unnegated(X.normalize(c), X.BOX), [("Коробка есть, чека нет", True), ("коробки нет", False), ("без чека и коробки", False), ("Полный комплект", True), ("коробка и чек отсутствуют", False), ("🙂 коробка", True), ("", False), (None, False)])


def test_junk_and_condition(apply, spark):
    rows = spark.createDataFrame([
        (0, "Чехол для iPhone 13", "новый"), (1, "Куплю iPhone", ""), (2, "iPhone 13", "Заблокирован на iCloud"), (3, "iPhone 13", "На запчасти"), (4, "iPhone 13", "Экран разбит"), (5, "iPhone 13", "Утопленник"), (6, "iPhone 13", "Реплика"), (7, "iPhone 13", "Не битый, не утопленник, копия чека"), (8, None, None),
    ], "i int, t string, d string")
    got = [r[0] for r in rows.orderBy("i").select(X.junk_reason(F.col("t"), F.col("d"))).collect()]
    assert got == ["accessory", "not_for_sale", "locked", "for_parts", "broken_screen", "water_damage", "fake", None, None]
    rows = spark.createDataFrame([(0, "Новое", ""), (1, "Новое", "пользовался месяц"), (2, "Хорошее", "не включается"), (3, None, "запечатан"), (4, "Восстановленное", ""), (5, None, ""), (6, "требует ремонта", "")], "i int, p string, t string")
    assert [r[0] for r in rows.orderBy("i").select(X.condition(F.col("p"), F.col("t"))).collect()] == ["new", "used", "for_parts", "new", "refurbished", None, "for_parts"]


def test_price_and_region(apply):
    check(apply, X.price, [("21 500 ₽", 21500), ("54990.0", 54990), ("договорная", None), ("54,990", 54), ("0", None), ("-5", None), (None, None), ("1e4", 10000), ("10.5", 10), ("11.5", 12), ("NaN", None)])
    check(apply, X.region, [("г. Москва, ул. Тверская", "Москва"), ("мск", "Москва"), ("ул. Ленина 5", "Неизвестно"), ("Дом 5", "Неизвестно"), ("казань", "Казань"), (None, "Неизвестно"), ("", "Неизвестно"), ("город  Орёл;x", "Орёл")])


def test_scalars(apply):
    check(apply, S.as_whole, [("256.0", 256), ("1.5", None), ("abc", None), (None, None), ("1e3", 1000), (" 7 ", 7), ("1d", None)])
    check(apply, S.url_tail_number, [("https://a.b/x_1234567", "1234567"), ("https://a.b/x_1234567/?q=1", "1234567"), ("https://a.b/x_123", None), (None, None)])
    check(apply, lambda c: S.page_url(c, F.lit(2)), [("https://a/b?q=1&p=5&z=", "https://a/b?q=1&z=&p=2"), ("https://a/b", "https://a/b?p=2")])
    check(apply, lambda c: S.page_url(c, F.lit(1)), [("https://a/b?p=5", "https://a/b"), ("https://a/b?q=", "https://a/b?q=")])
    check(apply, lambda c: S.canonical_url(c, "https://a"), [("/x?y#z", "https://a/x"), ("https://b/x#z", "https://b/x")])
    check(apply, lambda c: S.url_origin(c, "d"), [("https://a.b/c", "https://a.b"), ("nothing", "d"), (None, "d")])


def test_months(apply, spark):
    rows = spark.createDataFrame([("2021-09-24",), ("2021-10-23",), ("2021-10-24",), ("2026-09-01",), ("2020-01-01",), ("2021-02-28",)], "d string")
    got = [r[0] for r in rows.select(S.whole_months(F.lit("2021-09-24").cast("date"), F.col("d").cast("date"))).collect()]
    assert got == [0, 0, 1, 59, 0, 0]
    assert spark.range(1).select(S.whole_months(F.lit("2021-01-31").cast("date"), F.lit("2021-02-28").cast("date"))).first()[0] == 0


def test_find_param(spark):
    rows = spark.createDataFrame([('{"Модель:": "a", "модель": "b"}',), ('{"Объем встроенной памяти": "64"}',), ("[1]",), (None,), ('{"x": 1',)], "p string")
    found = rows.select(S.find_param(S.params_map(F.col("p")), ["модель"], X.normalize), S.find_param(S.params_map(F.col("p")), ["встроен"], X.normalize)).collect()
    assert [r[0] for r in found] == ["b", None, None, None, None] and found[1][1] == "64"


def test_rounding_and_classes(spark):
    row = spark.range(1).select(S.half_even(F.lit(1250.0), 500), S.half_even(F.lit(1750.0), 500), S.classify_delta(F.lit(10.0), 10), S.classify_delta(F.lit(10.01), 10), S.classify_delta(F.lit(-10.5), 10), S.money(F.lit(54990)), S.storage_label(F.lit(2048)), S.storage_label(F.lit(128))).first()
    assert list(row) == [1000.0, 2000.0, "fair", "overpriced", "great_deal", "54,990", "2TB", "128GB"]


def test_first_wins_map(spark):
    row = spark.range(1).select(S.first_wins_map(F.array(F.struct(F.lit("a").alias("key"), F.lit("1").alias("value")), F.struct(F.lit("a").alias("key"), F.lit("2").alias("value")), F.struct(F.lit("b").alias("key"), F.lit("3").alias("value"))))).first()
    assert row[0] == {"a": "1", "b": "3"}


def test_hints_stand_in_every_match(small):
    import re

    import pyarrow.parquet as pq

    rows = pq.read_table(f"{small}/raw_listings.parquet", columns=["title", "description"]).to_pylist()
    texts = [f"{r['title'] or ''}\n{r['description'] or ''}".lower().replace("ё", "е") for r in rows]
    texts += [
        "activation lock", "блокировка активации", "залочен на оператора", "привязан к чужому аккаунту", "айклауд заблокирован", "на айклоуд", "забыл пароль", "не помню код", "не знаю apple id", "режим пропажи", "lost mode", "mdm", "bypass", "обход активации", "r-sim", "рсим", "турбо сим", "sim lock",
        "на запчасти", "на з/ч", "под разбор", "донор", "требует ремонта", "не включается", "не загружается", "не заряжается", "не работает", "не ловит сеть", "нет сети", "face id отвалился", "без face id", "без фейс айди", "сломан", "неисправен", "broken", "битый", "треснут", "в трещинах", "полосы на экране", "пятно на дисплее",
        "утопленник", "тонул", "после влаги", "упал в воду", "уронил в унитаз", "был в море", "искупался", "купался", "залит", "water damage", "попал в бассейн", "падал в лужу", "реплика", "муляж", "подделка", "копия", "не оригинальный айфон", "реф", "cpo", "не распакован", "brand new", "б/у", "бу", "использовался", "пользовался", "в использовании",
        "полный комплект", "родная упаковка", "full set", "чек", "документы", "гарантийный талон", "первый взнос", "первоначальный платеж", "/мес", "в месяц", "предоплата", "trade-in", "трейдин", "аренда",
    ]
    for pattern, hints in X.HINTS.items():
        compiled = re.compile(pattern)
        hit = [t for t in texts if compiled.search(t)]
        assert hit and all(any(h in t for h in hints) for t in hit), pattern[:30]


def test_both_forms_of_negation_agree(spark, small):
    from bazaarlens.functions.signs import signs

    rows = spark.read.parquet(f"{small}/raw_listings.parquet").select("title", "description").limit(300)
    extra = spark.createDataFrame([("x", t) for t in ("не битый", "экран разбит, но корпус целый", "без коробки, есть чек", "коробки и чека нет", "🙂 утопленник", "не включается", "рассрочки нет")] + [(None, None)], "title string, description string")
    rows = rows.unionByName(extra).withColumn("s", signs(F.col("title"), F.col("description")))
    text = S.strip(F.concat(X.normalize(F.col("title")), F.lit("\n"), X.normalize(F.col("description"))))
    native = {"box": X.BOX, "receipt": X.RECEIPT, "installment": X.INSTALLMENT, "broken_screen": X.BROKEN_SCREEN, "water_damage": X.WATER, "used": X.USED_TEXT}
    differ = rows.where((X.junk_reason(F.col("title"), F.col("description")).eqNullSafe(F.col("s.junk")) == F.lit(False)) | F.exists(F.array(*[X.unnegated(text, p) != F.col(f"s.{n}") for n, p in native.items()]), lambda b: b))
    assert differ.count() == 0


def test_typed_values(apply):
    assert apply(X.typed_price, ["65k", "65,5к", "70 тыс", "70 тыс.", "12 500 ₽", "даром", None]) == [65000, 65500, 70000, 70000, 12500, None, None]
    assert apply(X.typed_percent, ["87%", " 100 ", "0", "101", "почти 90", None]) == [87, 100, None, None, None, None]
    assert apply(lambda c: X.typed_storage(c, (64, 1024)), ["1TB", "128", "64", "1024", "100", None]) == [1024, 128, 64, 1024, None, None]
    assert apply(X.typed_condition, ["New", "б/у", "восстановленный", "на запчасти", "?", None]) == ["new", "used", "refurbished", "for_parts", None, None]


def test_times_of_any_form(apply, spark):
    cases = ["20260601T075054Z", "2026-06-01T07:50:54", "2026-06-01 12:50:54+05:00", "20260601T105054+0300", "2026-06-01T07:50:54,000Z", "20260601T0750Z", "2026-06-01T07:50", "2026-06-01", "20260601", "x", "2026-13-01T00:00:00Z", "", None]
    got = apply(S.utc_micros, cases)
    minute, day = 1780300200_000000, 1780272000_000000
    assert got == [minute + 54_000000] * 5 + [minute] * 2 + [day] * 2 + [None] * 4
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        days = [str(d) for d in apply(lambda c: S.iso_date(c, F.lit("1999-01-01").cast("date")), ["2026-06-01T23:59:59Z", "20260601T000000Z", "2026-06-02T01:00:00+03:00", None])]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert days == ["2026-06-01", "2026-06-01", "2026-06-01", "1999-01-01"]
