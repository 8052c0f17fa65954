"""Truth discovery, list mapping, residue, personal data and product grouping on small frames and by brute force."""

import itertools
import json
import random

import numpy as np
import pytest
from bazaarlens.llm import gazetteer, offers, pii, products, residue, truth
from pyspark.sql import functions as F


# ---- problem 2


@pytest.fixture(scope="module")
def captures(spark):
    rows = [
        (1, "1", "https://a.x/p_1", "2026-01-01T00:00:00Z", 90, "red"), (2, "№ 1", None, "20260103T000000Z", 999, "red"), (3, "1.0", "https://b.x/p_1", "2026-01-02T03:00:00+03:00", 80, "blue"), (4, None, "https://a.x/p_1?x=2", "yesterday", 70, None),
        (5, "2", "https://a.x/p_2", None, None, "red"), (6, "2", "https://b.x/p_2", "2026-01-01 00:00:00", None, "  "), (7, "2", "https://b.x/p_2", "2026-01-01T00:00:00", None, "red"),
        (8, "3", "https://a.x/p_3", "2026-01-01T00:00:00Z", 55, "x"), (9, "", "", None, 60, "x"), (10, None, None, None, 60, "x"),
        (11, "4", "https://a.x/p_4", "2026-01-01T00:00:00Z", 61, "x"), (12, "4", "https://a.x/p_4", "2026-01-01T00:00:00Z", 62, "x"), (12, "4", "https://a.x/p_4", "2026-01-01T00:00:00Z", 62, "x"),
    ]
    return spark.createDataFrame(rows, "row long, item string, url string, at string, battery int, colour string").withColumn("value", F.lit("clash")).withColumn("group_key", F.lit("clash"))


def discovered(df):
    rules = {"battery": truth.Rule(latest=True, low=40, high=100), "colour": truth.Rule()}
    return truth.discover(df, truth.item_number(F.col("item"), F.col("url")), "row", truth.capture_time(F.col("at")), truth.host(F.col("url")), rules)


def test_truth_discovery(captures):
    found = {(r["group_key"], r["field"]): r for r in discovered(captures).collect()}
    assert {k: r["row_id"] for k, r in found.items() if k[1] == "battery"} == {("1", "battery"): 3, ("2", "battery"): 6, ("4", "battery"): 11}
    assert found[("1", "colour")]["value"] == "red" and found[("2", "colour")]["value"] == "red"
    wide = {r["group_key"]: r for r in truth.survivors(discovered(captures), ["battery", "colour"]).collect()}
    assert wide["1"]["battery"] == "80" and wide["1"]["colour"] == "red" and wide["4"]["battery_row"] == 11
    assert discovered(captures.limit(0)).count() == 0


def test_unreliable_sources_are_outvoted(spark):
    rows = [(i * 3 + s, str(i), f"https://{'abc'[s]}.x/p", "2026-01-01T00:00:00Z", None, "bad" if s == 2 else "good") for i in range(40) for s in range(3)]
    rows += [(1000, "9001", "https://c.x/p", "2026-01-01T00:00:00Z", None, "bad"), (1001, "9001", "https://a.x/p", "2026-01-01T00:00:00Z", None, "good")]
    df = spark.createDataFrame(rows, "row long, item string, url string, at string, battery int, colour string")
    found = {r["group_key"]: r["value"] for r in discovered(df).where("field = 'colour'").collect()}
    assert set(found.values()) == {"good"}


def test_a_late_unreliable_source_loses(spark):
    day = lambda d: f"2026-01-{d:02d}T00:00:00Z"
    rows, n = [], 0
    for i in range(40):  # c.x, never the last one, is corrected by all others
        for host, at, battery in (("c", 1, 50), ("a", 2, 90), ("b", 3, 90)):
            rows.append((n, str(i), f"https://{host}.x/p", day(at), battery, None))
            n += 1
    rows += [(1000, "9001", "https://a.x/p", day(1), 90, None), (1001, "9001", "https://b.x/p", day(2), 90, None), (1002, "9001", "https://c.x/p", day(3), 50, None)]
    rows += [(2000, "9002", "https://b.x/p", day(1), 70, None), (2001, "9002", "https://b.x/p", day(2), 70, None), (2002, "9002", "https://a.x/p", day(3), 80, None)]
    df = spark.createDataFrame(rows, "row long, item string, url string, at string, battery int, colour string")
    found = {r["group_key"]: (r["value"], r["row_id"]) for r in discovered(df).where("field = 'battery'").collect()}
    assert found["9001"] == ("90", 1001) and found["9002"] == ("80", 2002) and {v for k, (v, _) in found.items() if int(k) < 40} == {"90"}


def test_many_disputed_groups_are_joined_after_aggregation(captures, monkeypatch):
    few = {(r["group_key"], r["field"]): r.asDict() for r in discovered(captures).collect()}
    monkeypatch.setattr(truth, "BROADCAST_LIMIT", -1)
    assert {(r["group_key"], r["field"]): r.asDict() for r in discovered(captures).collect()} == few


def test_times(apply):
    cases = ["2026-01-01T03:00:00+03:00", "20260101T000000Z", "2026-01-01 00:00:00", "2026-01-01T00:00:00.000000+00:00", "0000-00-00T00:00:00", "вчера", None, "20260101T030000+0300"]
    got = apply(truth.capture_time, cases)
    assert got[0] == got[1] == got[2] == got[3] == got[7] == 1767225600_000000 and got[4:7] == [None, None, None]


# ---- problem 3

LIST = [(1, "Москва", ["МСК"]), (2, "Санкт-Петербург", ["СПб"]), (3, "Московская область", []), (4, "Омск", []), (5, "Томск", []), (6, "Нижний Новгород", []), (7, "Набережные Челны", []), (8, "Тверь", []), (9, "Краснодар", []), (10, "Красноярск", [])]


@pytest.mark.parametrize("typed, key", [
    ("москва", 1), ("Mocквa", 1), ("vjcrdf", 1), ("Moskva", 1), ("Moscow", 1), ("Мсоква", 1), ("г. Моска", 1), ("живу в Москве", 1), ("Москва (м. Заставная)", 1), ("РФ/Москва", 1), ("ул. Тихая, д. 5, Москва", 1), ("Москва спросить Олега", 1), ("Москва +79001234567", 1), ("СПб", 2), ("питер", 2),
    ("в Санкт-Петербурге", 2), ("Санкт-Пмтербург", 2), ("Моск. обл.", 3), ("Подмосковье", 3), ("московсая област", 3), ("омск", 4), ("njvcr", 5), ("Томск", 5), ("НН", 6), ("в Нижнем Новгороде", 6), ("Yf,tht;yst Xtkys", 7), ("в Набережных Челнах", 7), ("Тверь; торг", 8), ("Краснодар-сити", 9), ("Красноярск-24", 10),
    ("Озерянск", 0), ("Тверьгино", 0), ("Краснолучинск", 0), ("ул. Ленина", 0), ("центр", 0), ("онлайн", 0), ("?", 0), ("по всей России", 0), ("Крас", 0), ("   ", None), (None, None), ("я" * 20_000, 0),
])
def test_mapping(typed, key):
    assert gazetteer.Matcher(LIST).match(typed) == key


def test_mapping_equals_search_without_an_index():
    rng, m = random.Random(1), gazetteer.Matcher(LIST)
    full = gazetteer.Matcher(LIST)
    everything = [(i, 0.0) for i in range(len(full.surfaces))]
    score = full.score

    def exhaustive(text):
        best = score(text)
        for i, _ in everything:  # edit distance to every surface, found by the index or not
            form, key = full.surfaces[i]
            most = 1 if len(form) < 7 else 2 if len(form) < 12 else 3
            if len(form) >= 4 and (d := gazetteer.distance(text, form, most)) <= most:
                best[key] = max(best.get(key, 0), (1 - d / (1.6 + 0.62 * len(form))) * (1 if form in full.own else 0.93))
        return best

    full.score = exhaustive
    same = 0
    for _ in range(300):
        name = rng.choice(LIST)[1]
        i = rng.randrange(len(name))
        typed = rng.choice([name[:i] + name[i + 1 :], name[:i] + rng.choice("абвно") + name[i:], name[:i] + name[i : i + 2][::-1] + name[i + 2 :]])
        same += m.match(typed) == full.match(typed)
    assert same == 300


def test_mapping_of_a_table(spark):
    df = spark.createDataFrame([(1, "Мсоква"), (2, "Озерянск"), (3, None), (4, "Озерянск")], "i int, v string")
    out = df.withColumn("key", gazetteer.map_to_list(F.col("v"), LIST))
    assert {r["i"]: r["key"] for r in out.collect()} == {1: 1, 2: 0, 3: None, 4: 0}
    assert [(r["v"], r["rows"]) for r in gazetteer.unmatched_report(out, "v", "key").collect()] == [("Озерянск", 2)]
    assert {r[0] for r in df.select(gazetteer.map_to_list(F.col("v"), [])).collect()} == {0, None}


# ---- problem 5


@pytest.mark.parametrize("text, kinds", [
    ("Продам {{ price }}", {"placeholder"}), ("iPhone $модель", {"placeholder"}), ("[[CITY]], :ЦЕНА: ГБ", {"placeholder"}), ("<%= title %>", {"placeholder"}), ("{0:item.name}", {"placeholder"}), ("[вставьте: цена]", {"placeholder"}), ("__имя__", {"placeholder"}), ("%MODEL%", {"placeholder"}),
    ("{СРОЧНО} {ТОРГ}", set()), ("[реально торг]", set()), ("<<< смотрите фото >>>", set()), ("#iphone #продам #торг", set()), ("$ не принимаю, только рубли", set()), ("АКБ: 88 % Полный набор.", set()),
    ("Извините, Bad Gateway. Мы уже чиним", {"message"}), ("Ошибка 404: страница не найдена", {"message"}), ("СЕРВЕР НЕ ОТВЕЧАЕТ", {"message"}), ("Вы человек?", {"message"}), ("Загрузка...", {"message"}), ("Traceback (most recent call last): KeyError '1'", {"message"}),
    ("Сервисный центр не отвечает, но телефон исправен.", set()), ("Загрузка системы пять секунд.", set()), ("Код ошибки 404 видел только в браузере :)", set()), ("При прошивке вылетает ошибка 4013, остальное ок.", set()),
    ("Please turn on JavaScript, чтобы продолжить", {"script_notice"}), ("сценарии отключены в вашем браузере", {"script_notice"}), ("Скрипты банка работают, JS не трогал.", set()), ("Браузер раз просил включить JavaScript, обновил и забыл.", set()),
    ("iPhone None ГБ, батарея None%", {"printed_empty"}), ("NaN", {"printed_empty"}), ("Память nil, цвет nil", {"printed_empty"}), ("null царапин :)", set()), ("lorem ipsum", {"filler"}), ("тест бла-бла-бла 12", {"filler"}), ("фывап фывапр", {"filler"}), ("Тест камеры и звука прошёл.", set()),
    ("Почта x@pochta.test Полный набор.", set()), ("д. 123, кв. 5", set()), ("обычный текст " * 5000, set()),
])
def test_residue(text, kinds):
    assert residue.detect(text) == kinds


@pytest.mark.parametrize("value", ["null", "none", "nan", "nil", "undefined", "#n/a", "#н/д", "#ссылка!", "#ref!", "#знач!", "#value!", "[object object]"])
def test_printed_empty_values_pass_the_prefilter(value):
    assert "printed_empty" in residue.detect(value.upper()) and "printed_empty" in residue.detect(f"Память: {value.upper()}")


def test_residue_of_a_table(spark):
    rows = [(i, "Совсем другое", "ок", f"https://a.x/iphone_{i}") for i in range(4)] + [(10, "iPhone 13", None, "https://a.x/iphone_10"), (11, None, "  ", None), (12, "Раз такое", "{{ x }}", "https://a.x/iphone_12"), (12, "Раз такое", "{{ x }}", "https://a.x/iphone_12")]
    df = spark.createDataFrame(rows, "id long, title string, body string, url string").withColumn("kind", F.lit("clash"))
    found = residue.flag_fields(df, "id", "title", "body", "url").distinct().collect()
    assert {(r["id"], r["field_name"], r["kind"], r["evidence"]) for r in found} == {(i, "title", "mismatch", "comparison") for i in range(4)} | {(12, "description", "placeholder", "detector")}
    assert sorted(r["id"] for r in residue.exclude(df, "id", "title", "body", "url").collect()) == [10, 11]
    assert residue.flag_fields(df.limit(0), "id", "title", "body", "url").count() == 0


def test_wordings_that_no_list_knows(spark):
    """Responses in the titles of a host teach the terms by which responses in bodies are known; stock phrases of sellers repeat as often."""
    unknown = ["This content has gone away", "Oops! Nothing lives at this place"]
    stock = ["Обычное б/у, смотрите фото", "Есть коробка", "Пишите в чат", "Чехол дам"]
    rows = [(i, f"iPhone {11 + i % 5}", ". ".join(stock[i % 4 : i % 4 + 2]), f"https://a.x/omsk/iphone_{i}") for i in range(300)]
    rows += [(1000 + i, unknown[i % 2], stock[0], f"https://a.x/omsk/iphone_{1000 + i}") for i in range(12)]
    rows += [(2000 + i, "iPhone 12", f"{stock[1]}. {unknown[i % 2]}.", f"https://a.x/omsk/iphone_{2000 + i}") for i in range(10)]
    rows += [(3000, "iPhone 12", unknown[0], "https://other.x/iphone_3000")]  # elsewhere, once
    assert not any(residue.detect(u) for u in unknown)
    df = spark.createDataFrame(rows, "id long, title string, body string, url string")
    found = {(r["id"], r["field_name"]) for r in residue.flag_fields(df, "id", "title", "body", "url").collect()}
    assert found == {(1000 + i, "title") for i in range(12)} | {(2000 + i, "description") for i in range(10)}


@pytest.mark.parametrize("text", ["{{ user.name | default: 'здесь стоит очень длинное значение по умолчанию, а то и два' }}", "<%= render partial: 'listing/description', locals: { item: current_item } %>", "[вставьте: описание товара не короче пятидесяти знаков, пожалуйста]"])
def test_long_placeholders(text):
    assert residue.detect(text) == {"placeholder"}


# ---- problem 6


@pytest.mark.parametrize("text, masked", [
    ("Почта g.tarpan @ mail.example, жду", "Почта [EMAIL], жду"), ("x.y(собака)post(dot)invalid!", "[EMAIL]!"), ("a1 собака inbox точка example", "[EMAIL]"), ("Мой ник @ в профиле.", "Мой ник @ в профиле."),
    ("Звоните 8 944*409*47*96.", "Звоните [PHONE]."), ("8975З92О877 в любое время", "[PHONE] в любое время"), ("973.982.50.00", "[PHONE]"), ("+7–948–771–5068", "[PHONE]"), ("восемь девять четыре ноль четыре семь четыре семь восемь девять ноль, жду", "[PHONE], жду"),
    ("Номер заказа 89603067190.", "Номер заказа 89603067190."), ("IMEI 892288418683308, трек 7627 7429 7961", "IMEI 892288418683308, трек 7627 7429 7961"), ("паспорт: 1234 № 567890", "[ID_NUMBER]"), ("СНИЛС 123-456-789 01.", "[ID_NUMBER]."), ("Для договора: инн физлица 001970 427089", "Для договора: [ID_NUMBER]"),
    ("Паспорт не прошу, договор не нужен.", "Паспорт не прошу, договор не нужен."), ("Забрать: ул. Липовая, д. 48, кв. 5.", "Забрать: [ADDRESS]."), ("дом 91а по ул. Рассветная", "[ADDRESS]"), ("тихая 124 корп. 1 кв 163", "[ADDRESS]"), ("Кузнечный б-р 137", "[ADDRESS]"), ("Pick up at 99 Heron Ave.", "Pick up at [ADDRESS]"),
    ("Рядом улица Полевая, парковка есть.", "Рядом улица Полевая, парковка есть."), ("007397, Липецк", "007397, Липецк"), ("С уважением, Зоя Мшенцова", "С уважением, [NAME]"), ("Спросить Т.Т. Тарпанова.", "Спросить [NAME]."), ("Пустовеев Е. М.", "[NAME]"), ("роман ожеговкин", "[NAME]"), ("Гречихвин Аристарх Игнатьевич", "[NAME]"),
    ("паспорт 45О6 123456", "[ID_NUMBER]"), ("ИНН 77I234567890", "[ID_NUMBER]"), ("Паспорт четыре пять ноль шесть один два три четыре пять шесть, жду", "[ID_NUMBER], жду"), ("ИНН№ 770123456789", "[ID_NUMBER]"), ("IDcard AB1234567", "[ID_NUMBER]"),
    ("ivan{at}mail.test", "[EMAIL]"), ("a.b [dog] mail (dot) test", "[EMAIL]"), ("Почта a@b.invalid 89467528436", "Почта [EMAIL] [PHONE]"), ("Звоните 897ЗЗЗОО6О4.", "Звоните [PHONE]."), ("восемь девятьсот двадцать один пятьсот тридцать сорок пять шестьдесят семь", "[PHONE]"),
    ("дом 39, восемь девять четыре четыре три пять три ноль один девять один", "дом 39, [PHONE]"), ("Сорок два года, тридцать пять лет.", "Сорок два года, тридцать пять лет."), ("б-р Лесной, 80к2-181, Омск", "[ADDRESS], Омск"), ("Липовая ул., 72. 89418213787", "[ADDRESS]. [PHONE]"), ("пер Садовый 5", "[ADDRESS]"),
    ("бул Мира 5", "[ADDRESS]"), ("Меня зовут Эльвира Сафина, жду", "Меня зовут [NAME], жду"), ("Продавец: Нурлан Бекетов.", "Продавец: [NAME]."), ("Ask for John Smith please", "Ask for [NAME] please"), ("Нурлан Бекетович", "[NAME]"), ("Эльвира Сафина.", "[NAME]."),
    ("Россия Саратов", "Россия Саратов"), ("Продавец: Нижний Новгород", "Продавец: Нижний Новгород"), ("Осмотр Ткацкий б-р 58 после 18:00", "Осмотр [ADDRESS] после 18:00"), ("Спросить Верескунова Т. Е.", "Спросить [NAME]"),
    ("Tikhon Mshentsov", "[NAME]"), ("Спросить Сергея.", "Спросить Сергея."), ("Для Марии отложил.", "Для Марии отложил."), ("Спасибо Ольге за упаковку.", "Спасибо Ольге за упаковку."), ("", ""), (None, None), ("слово " * 20_000, "слово " * 20_000),
])
def test_masking(text, masked):
    assert pii.mask(text, pii.find(text)) == masked


def test_masking_keeps_everything_else():
    rng = random.Random(2)
    pieces = ["Отдаю с кабелем.", "8 944 409 47 96", "a.b@c.test", "ул. Липовая, д. 4", "Зоя Мшенцова", "АКБ 88%", "🙂", "İ ß"]
    for _ in range(300):
        text = " ; ".join(rng.choice(pieces) for _ in range(6))
        spans = pii.find(text)
        rest, at = [], 0
        for start, end, _ in spans:
            assert at <= start < end <= len(text)
            rest.append(text[at:start])
            at = end
        rest.append(text[at:])
        out = pii.mask(text, spans)
        for kept in rest:
            assert kept in out


def test_masking_of_a_table(spark):
    df = spark.createDataFrame([(1, "a@b.test и 8 944 409 47 96", None), (2, None, "ул. Тихая, 5"), (2, None, "ул. Тихая, 5"), (3, "", "x")], "id long, d string, l string").withColumn("pii_kind", F.lit("clash"))
    assert {(r["id"], r["field_name"], r["pii_kind"]) for r in pii.find_kinds(df, "id", ["d", "l"]).collect()} == {(1, "d", "email"), (1, "d", "phone"), (2, "l", "address")}
    out = pii.mask_fields(df, ["d", "l"]).orderBy("id").collect()
    assert [(r["d"], r["l"], r["pii_kind"]) for r in out] == [("[EMAIL] и [PHONE]", None, "clash"), (None, "[ADDRESS]", "clash"), (None, "[ADDRESS]", "clash"), ("", "x", "clash")]
    assert pii.find_kinds(df.limit(0), "id", ["d"]).count() == 0


# ---- problem 7


def test_offers_are_read_alike():
    a = offers.read("Power bank Kivara pink 30 000 мАч", "В наличии", json.dumps({"Линейка": "«Вомекебо»"}, ensure_ascii=False))
    b = offers.read("ПЗУ / роз. / Vomekebo", "Kivara; 30Ah. Возврат 14 дней.", "")
    assert a == b and a.complete and a.name == ("kivara", "vomekebo")
    c = offers.read("Кабель / лайтнинг / 1,2 метра / красн.", None, '{"Серия": "Гуватуге"')
    assert dict(zip(offers.ATTRIBUTES, c.attributes, strict=True)) | {"kind": "cable"} == dict.fromkeys(offers.ATTRIBUTES) | {"kind": "cable", "length": "1200", "connector": "lightning", "colour": "red"}
    assert offers.read("iPhone16 Pro Max, 1 ТБ, Grade A, синй", None, None).attributes[:5] == ("phone", "16 pro max", "1024", "blue", "a")
    assert offers.read(None, None, None).name == ()


@pytest.fixture(scope="module")
def catalogue(spark):
    rng, rows, truth_of = random.Random(8), [], {}
    lines = ["".join(rng.choice("bdgklmnprstvz") + rng.choice("aeiou") for _ in range(4)) for _ in range(60)]
    colours = {"red": ("красный", "red", "красн."), "white": ("белый", "white", "бел.")}
    for i in range(400):
        line, colour, size = rng.choice(lines), rng.choice(list(colours)), rng.choice([5000, 10000])
        name = line
        if rng.random() < 0.15:
            k = rng.randrange(1, 6)
            name = line[:k] + line[k + 1] + line[k] + line[k + 2 :]
        words = [rng.choice(["Power bank", "Повербанк", "ПЗУ"]), "Kivara", name.title(), rng.choice(colours[colour]), rng.choice([f"{size} мАч", f"{size // 1000}Ah"])]
        rng.shuffle(words)
        rows.append((i, " / ".join(words[:3]), ", ".join(words[3:]), None))
        truth_of[i] = (line, colour, size)
    rows.append((400, None, None, None))
    return spark.createDataFrame(rows, "offer_id long, title string, description string, params string").withColumn("product", F.lit("clash")), truth_of


def test_grouping_against_the_planted_products(catalogue):
    df, truth_of = catalogue
    found = {(r["offer_a"], r["offer_b"]) for r in products.pairs_of_groups(products.group_offers(df, "offer_id"), block=3).collect()}
    true = {(a, b) for a, b in itertools.combinations(range(400), 2) if truth_of[a] == truth_of[b]}
    assert len(found & true) / len(found) > 0.97 and len(found & true) / len(true) > 0.97
    assert products.group_offers(df.limit(0), "offer_id").count() == 0


def test_index_recall(catalogue):
    report = products.recall_report(catalogue[0].withColumn("offer_id", F.col("offer_id") * 25), "offer_id").first()
    assert report["exact_links"] == 0 or report["found_links"] / report["exact_links"] >= 0.9


def test_probes_rise_until_the_links_are_found(spark, monkeypatch):
    # an encoder of little use: one gram outweighs the others, so that a slip often leads to a far cell
    def poor(names, common, rare):
        rng = np.random.default_rng(3)
        return products.Encoder((rng.normal(size=(products.SLOTS, products.WIDTH)) * 10 ** (6 * rng.random((products.SLOTS, 1)))).astype(np.float32), {}, 1.0)

    monkeypatch.setattr(products, "train", poor)
    rng, rows = random.Random(5), []
    for i in range(1800):
        w = "".join(rng.choice("abdegiklmnoprstuvz") for _ in range(6))
        rows += [(2 * i, f"v{i % 18}", w), (2 * i + 1, f"v{i % 18}", w[0] + w[2] + w[1] + w[3:])]
    reps = spark.createDataFrame(rows, "rep long, variant string, name string")
    index = products.build_index(reps)
    assert len(index.centres) == 60
    found = {(r["a"], r["b"]) for r in products.edges(reps, index).collect()}
    planted = {(2 * i, 2 * i + 1) for i in range(1800)}
    assert len(found & planted) >= 0.99 * len(planted)


def test_names_written_apart():
    encoder = products.Encoder(np.zeros((1, 1)), {"kivara": 2.0}, 9.0)
    assert encoder.likeness("kivara vomekebo", "kebo kivara vome") == 1.0 and encoder.likeness("kivara vomekebo", "kivara vome") < 0.55
    assert encoder.likeness("kivara vomekebo", "kivara vomkeebo") == 1.0 and encoder.likeness("kivara vomekebo", "kivara sutizolo") < 0.55
    assert offers.read("Power bank Kivara сини вола", "красный, 5000 мАч", None).name == ("kivara", "sini", "vola")


def test_crowded_keys_and_hubs(catalogue, spark, monkeypatch):
    df, _ = catalogue
    plain = {(r["offer"], r["product"]) for r in products.group_offers(df, "offer_id").collect()}
    monkeypatch.setattr(products, "BLOCK", 3)
    monkeypatch.setattr(products, "HUB", 2)
    assert {(r["offer"], r["product"]) for r in products.group_offers(df, "offer_id").collect()} == plain
    links = spark.createDataFrame([(0, i) for i in range(1, 40)] + [(50, 51)], "a long, b long")
    got = {r["rep"]: r["product"] for r in products.components(spark.range(60).withColumnRenamed("id", "rep"), links).collect()}
    assert all(got[i] == 0 for i in range(40)) and got[51] == 50 and got[45] == 45


def test_components(spark):
    nodes = spark.range(30).withColumnRenamed("id", "rep")
    links = spark.createDataFrame([(i, i + 1) for i in range(12)] + [(20, 25), (21, 25)], "a long, b long")
    got = {r["rep"]: r["product"] for r in products.components(nodes, links).collect()}
    assert all(got[i] == 0 for i in range(13)) and got[20] == got[21] == got[25] == 20 and got[29] == 29
