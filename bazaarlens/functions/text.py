"""Text functions on listings as column expressions: normalisation, negation-aware search, attribute readers.

All patterns are Unicode-aware; a negation-aware search first tests the plain pattern, so the
window logic runs only on rows that hold the wording at all.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarlens.functions.scalars import let, strip

U = "(?U)"

# ---- Fixed values: wording of negations.
CLAUSE_BREAK = r"[.!?;\n]|\s(?:но|однако|but)\s"
NEAR_NEGATION = r"(?:^|[\s,(])(?:не|ни|not|never)\s+(?:\S+\s+)?$"
FAR_NEGATION = r"(?:^|[\s,(])(?:без|нет|no|without)\s+((?:\S+\s+){0,4})$"
AFFIRMATION = r"\b(?:есть|имеется|имеются|присутству\w*|but)\b"
POST_NEGATION = r"^(?:\s*(?:,|\bи\b|\bили\b)\s*[^\s,]+)*\s*[,:\-–—]?\s*(?:нет|отсутству\w*|no|none)(?!\w)"
WINDOW = 60

# ---- Fixed values: vocabularies of conditions and damage.
LOCKED = (
    r"activation\s*lock|icloud\s*lock|блок\w*\s+активац\w*|(?:заблокирован\w*|залочен\w*)\s+(?:на\s+|к\s+|по\s+|под\s+)?(?:чуж\w+\s+)?(?:icloud|айклауд\w*|айклоуд\w*|apple\s*id|аккаунт\w*|учетн\w+\s+запис\w*|оператор\w*)|"
    r"привязан\w*\s+(?:к\s+)?(?:чуж\w+\s+(?:icloud|айклауд\w*|айклоуд\w*|apple\s*id|аккаунт\w*|учетн\w+\s+запис\w*)|оператор\w*)|(?:icloud|айклауд\w*|айклоуд\w*|apple\s*id)\s+(?:заблокирован\w*|залочен\w*)|"
    r"\bна\s+(?:icloud|айклауд\w*|айклоуд\w*)\b|(?:забыл\w*|не\s+помн\w*|не\s+зна\w*)\s+(?:пароль|код|apple\s*id|айди|учетк\w*)|режим\w*\s+пропаж\w*|lost\s*mode|\bmdm\b|\bbypass\b|\bобход\w*\s+(?:icloud|активац\w*)|"
    r"\br-?sim\b|\bрсим\w*|турбо\s*сим\w*|sim[\s-]?lock|\bзалочен\w*"
)
FOR_PARTS = (
    r"(?:на|по|под)\s+(?:запчаст\w*|з/ч|зч|детал(?:и|ей|ям)\b|разбор\w*)|\bдонор\w*|for\s+parts|требует\s+ремонта|нуждается\s+в\s+ремонте|под\s+ремонт\b|не\s+включа(?:ется|ются)\b|не\s+загружа(?:ется|ются)\b|не\s+заряжа(?:ется|ются)\b|"
    r"не\s+работа(?:ет|ют)\b|не\s+(?:ловит|видит)\s+(?:сеть|сим\w*)|нет\s+сети|(?:face\s*id|фейс\s*айди)\s+(?:не\s+работа\w*|отвал\w*)|без\s+(?:face\s*id|фейс\s*айди)|\bсломан\w*|неисправ\w*|\bbroken\b"
)
BROKEN_SCREEN = r"разбит\w*|\bбит(?:ый|ое|ая|ые)\b|треснут\w*|трещин[аыу]\b|в\s+трещинах|\bcracked\b|(?:полос\w*|пятн\w*|битые\s+пиксели)\s+на\s+(?:экран\w*|диспле\w*)"
WATER = (
    r"\bутоп\w*|\bтонул\w*|после\s+(?:воды|утоплен\w*|влаги)|(?:был\w*|побывал\w*|попадал\w*|попал\w*|падал\w*|упал\w*|уронил\w*|искупал\w*)\s+(?:в\s+)?(?:(?:воде|воду|вода|водой)\b|ванн\w*|унитаз\w*|море\b|бассейн\w*|лужу)|"
    r"\bзалит(?:ый|ая|о|а)?\b|water\s*damage|\bкупался\b"
)
FAKE = r"реплик\w*|\breplica\b|муляж\w*|подделк\w*|\bfake\b|\bкопи[яи]\b(?!\s+(?:чек\w*|документ\w*|коробк\w*|гарант\w*))|(?:не\s*оригинал\w*|неоригинал\w*)\s+(?:iphone|айфон\w*|телефон\w*|смартфон\w*)"
ACCESSORY_TITLE = (
    r"^\W*(?:чехол|чехлы|стекло|стекла|пленк\w*|кабель|провод\w*|зарядк\w*|зарядное|блок\s+питания|адаптер\w*|коробк\w*|муляж\w*|корпус\w*|дисплей|дисплеи|экран\w*|аккумулятор\w*|батаре\w*|акб|шлейф\w*|камер\w*|плат\w*|наушник\w*|airpods|"
    r"держател\w*|подставк\w*|кейс\w*|лоток|сим-?лоток|запчаст\w*|задн\w+\s+крышк\w*|крышк\w*)\b|\b(?:для|под)\s+(?:apple\s+)?(?:iphone|айфон\w*)|\b(?:ipad|macbook|imac|apple\s+watch|airpods|magsafe)\b"
)
NOT_FOR_SALE_TITLE = r"^\W*(?:куплю|скупка|скупаю|выкуп|срочный\s+выкуп|ремонт|замена|аренда|прокат|обмен\w*|меняю|обменяю|ищу)\b|\bв\s+аренду\b|\bпод\s+заказ\b|\bпредзаказ\w*"
REFURBISHED_TEXT = r"восстановлен\w*|refurb\w*|\bреф\b|\bcpo\b"
NEW_TEXT = r"запечатан\w*|\bsealed\b|нераспакован\w*|не\s+распакован\w*|не\s+активирован\w*|brand\s+new"
USED_TEXT = r"б\s*/\s*у(?![а-я])|\bбу\b|пользовал\w*|использовал\w*|в\s+использовании"
PARAM_CONDITIONS = (
    ("for_parts", r"for[\s_]parts|требует\s+ремонта|на\s+запчаст|не\s*рабоч|неисправ|сломан|broken"),
    ("refurbished", r"восстановлен|refurb"),
    ("used", r"б\s*/\s*у|\bбу\b|\bused\b|отличн|хорош|удовлетвор|как\s+нов|идеальн"),
    ("new", r"\bнов|\bnew\b"),
)
BOX = r"коробк\w*|полн\w*\s+комплект\w*|комплект\w*\s+полн\w*|родн\w*\s+упаковк\w*|\bbox\b|full\s+set"
RECEIPT = r"\bчек(?:а|ом|и|ов|у)?\b|документ\w*|квитанци\w*|\breceipt\b|гарантийн\w*\s+талон\w*"
INSTALLMENT = (
    r"рассрочк\w*|кредит\w*|перв\w*\s+взнос\w*|первоначальн\w*\s+(?:взнос\w*|плат\w*)|ежемесячн\w*|/\s*мес(?:яц)?\b|в\s+месяц|аренд\w*|предоплат\w*|trade[\s-]?in|трейд[\s-]?ин|трейдин"
)
#: Of each vocabulary, letters of which some stand in every match; most texts hold none, and the pattern is not tried on them.
HINTS = {
    LOCKED: ("lock", "блок", "активац", "залочен", "привязан", "icloud", "айкла", "айкло", "apple", "забыл", "помн", "зна", "пропаж", "lost", "mdm", "bypass", "обход", "sim", "сим"),
    FOR_PARTS: ("запчаст", "з/ч", "зч", "детал", "разбор", "донор", "parts", "ремонт", "включа", "загружа", "заряжа", "работа", "ловит", "видит", "сети", "отвал", "без", "сломан", "исправ", "broken"),
    BROKEN_SCREEN: ("бит", "треснут", "трещин", "cracked", "полос", "пятн"),
    WATER: ("утоп", "тонул", "вод", "влаг", "ванн", "унитаз", "море", "бассейн", "лужу", "залит", "water", "купал"),
    FAKE: ("реплик", "replica", "муляж", "подделк", "fake", "копи", "оригинал"),
    REFURBISHED_TEXT: ("восстановлен", "refurb", "реф", "cpo"),
    NEW_TEXT: ("запечатан", "sealed", "распакован", "активирован", "brand"),
    USED_TEXT: ("б", "пользовал", "использов"),
    BOX: ("коробк", "комплект", "упаковк", "box", "full"),
    RECEIPT: ("чек", "документ", "квитанци", "receipt", "талон"),
    INSTALLMENT: ("рассрочк", "кредит", "взнос", "плат", "ежемесячн", "мес", "аренд", "trade", "трейд"),
}
# ---- Fixed values: measures in titles and descriptions.
STORAGE = r"(?<![\d.,])(64|128|256|512|1024|1|2)\s*(гб|gb|гиг\w*|gig\w*|тб|tb|терабайт\w*|terabyte\w*|g|г)(?![a-zа-я])"
BARE_STORAGE = r"(?<![\d.,])(64|128|256|512)(?![\d.,%])(?!\s+\d)(?!\s*(?:₽|руб|р\b|т\.?\s*р|тыс|k\b|к\b|мес|шт))"
_BATTERY = r"(?:акб|аккумулятор\w*|батаре\w*|емкост\w*|battery(?:\s+health)?|batt\b|здоровье(?:\s+(?:акб|аккумулятора|батареи))?|max(?:imum)?\s+capacity)"
_OTHER_UNIT = r"(?:цикл\w*|cycle\w*|раз\w*|мес\w*|month\w*|дн\w*|day\w*|час\w*|hour\w*|ч\b|мин\w*|mah|мач|ма\b|шт\w*|руб\w*|₽|р\b|т\.?\s*р|тыс\w*|к\b|k\b|gb|гб|г\b|лет|год\w*)"
BATTERY = (
    rf"{_BATTERY}[^\d\n.!?;]{{0,30}}?(?<!\d)(\d{{2,3}})\s*(?:%|процент\w*)",
    rf"(?<!\d)(\d{{2,3}})\s*(?:%|процент\w*)[^\d\n.!?;]{{0,15}}?{_BATTERY}",
    rf"{_BATTERY}\s*[:\-–—=]?\s*(?<!\d)(\d{{2,3}})(?![\d%.,])(?!\s*{_OTHER_UNIT})",
)
# ---- Fixed values: model names in Cyrillic and mixed spelling, and the grammar of models.
MODEL_SPELLINGS = (
    (r"\bа[йи]фон\w*", "iphone"), (r"\bпро\s*-?\s*макс\b|\bпромакс\b", "pro max"), (r"\bпро\b", "pro"), (r"\bмакс\b|\bмах\b", "max"), (r"\bмини\b", "mini"), (r"\bплюс\b", "plus"), (r"\bэ[йи]р\b", "air"),
    (r"\bс[еe]\b", "se"), (r"\b[хx][рr]\b", "xr"), (r"\b[хx][сsc]\b", "xs"), (r"\bх\b", "x"), (r"(?<=\d)е\b", "e"), (r"\bр(?=ro\b|lus\b)", "p"),
)
_GENERATION = r"(1[0-7](?!\d)|8(?!\d)|xs|xr|x(?![a-z])|se|air)"
_VARIANT = r"(?:(e)(?![a-z-])|\s*-?\s*(pro\s*-?\s*max|promax|pro|plus|mini|max|air)(?![a-z])|\s*(\+))?"
_SE = r"(?:\s*\(?\s*(20(?:20|22)|[23](?!\d)(?:\s*-?\s*(?:nd|rd|го|gen\w*|поколени\w*))?)\s*\)?)?"
PREFIXED_MODEL = rf"(?:\bi\s*-?\s*phone|\bapple)\s*-?\s*{_GENERATION}{_VARIANT}{_SE}"
BARE_MODEL = rf"(?<![a-z0-9]){_GENERATION}{_VARIANT}{_SE}"
# ---- Fixed values: regions.
REGION_ALIASES = {"мск": "Москва", "москва": "Москва", "спб": "Санкт-Петербург", "питер": "Санкт-Петербург", "санкт-петербург": "Санкт-Петербург", "екб": "Екатеринбург", "нск": "Новосибирск"}
NOT_A_TOWN = r"^(?:м\.|метро|р-н|район|ул\.|улица|пр-т|проспект|пр\.|пер\.|ш\.|шоссе|мкр|д\.)|\d"
UNKNOWN_REGION = "Неизвестно"


def normalize(c: Column) -> Column:
    """Lower case, ё as е, white space collapsed but for line breaks; null gives the empty text."""
    t = F.lower(F.translate(F.coalesce(c, F.lit("")), "ёЁ", "еЕ"))
    t = F.regexp_replace(F.regexp_replace(t, rf"{U}[^\S\n]+", " "), rf"{U}\s*\n\s*", "\n")
    return strip(t)


def fingerprint(c: Column, chars: int = 200) -> Column:
    """Normalised text, runs of other than letters, digits and underscores as one blank, cut, then trimmed."""
    return F.trim(F.substring(F.regexp_replace(normalize(c), r"[^\p{L}\p{N}_]+", " "), 1, chars))


def match_spans(text: Column, pattern: str) -> Column:
    """Array of (start, length) of all matches, from the pieces between them; the pattern must not match nothing."""

    def spans(both: Column) -> Column:
        pieces, found = both["pieces"], both["found"]
        before = lambda i: F.length(F.array_join(F.slice(pieces, 1, i), "")) + F.coalesce(F.length(F.array_join(F.slice(found, 1, i - 1), "")), F.lit(0))
        at = F.when(F.size(found) > 0, F.sequence(F.lit(1), F.size(found))).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.struct(before(i).alias("start"), F.length(F.element_at(found, i)).alias("length")))

    return let(F.struct(F.split(text, pattern, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")), spans)


def unnegated(text: Column, pattern: str) -> Column:
    """True if a match of ``pattern`` in a normalised text is not negated within its clause."""
    hints, pattern = HINTS.get(pattern, ()), U + pattern

    def search(text: Column) -> Column:
        def stands(span: Column) -> Column:
            start, length = span["start"], span["length"]
            left = F.substring(text, F.greatest(start - WINDOW + 1, F.lit(1)), F.least(start, F.lit(WINDOW)))
            left = F.element_at(F.split(left, U + CLAUSE_BREAK, -1), -1)
            right = F.element_at(F.split(F.substring(text, start + length + 1, F.lit(WINDOW)), U + CLAUSE_BREAK, 2), 1)

            def plain(left: Column) -> Column:
                far = left.rlike(U + FAR_NEGATION) & ~F.regexp_extract(left, U + FAR_NEGATION, 1).rlike(U + AFFIRMATION)
                return ~(left.rlike(U + NEAR_NEGATION) | far | right.rlike(U + POST_NEGATION))

            return let(left, plain)

        likely = reduce(or_, (text.contains(h) for h in hints)) if hints else F.lit(True)
        return F.when(likely & text.rlike(pattern), F.exists(match_spans(text, pattern), stands)).otherwise(F.lit(False))

    return let(text, search)


def junk_reason(title: Column, description: Column) -> Column:
    """First sign of junk: accessory or no offer by the title, then damage and fakes by the whole text."""

    def by_text(text: Column) -> Column:
        out = None
        for reason, pattern in (("locked", LOCKED), ("water_damage", WATER), ("broken_screen", BROKEN_SCREEN), ("for_parts", FOR_PARTS), ("fake", FAKE)):
            out = F.when(unnegated(text, pattern), reason) if out is None else out.when(unnegated(text, pattern), reason)
        return out

    def by_title(head: Column) -> Column:
        return F.when(head.rlike(U + ACCESSORY_TITLE), "accessory").when(head.rlike(U + NOT_FOR_SALE_TITLE), "not_for_sale").otherwise(let(strip(F.concat(head, F.lit("\n"), normalize(description))), by_text))

    return let(normalize(title), by_title)


def damaged(text: Column) -> Column:
    """A sign of lock, parts, broken screen or water in a normalised text."""
    return unnegated(text, LOCKED) | unnegated(text, FOR_PARTS) | unnegated(text, BROKEN_SCREEN) | unnegated(text, WATER)


def condition(param: Column, text: Column) -> Column:
    """Condition of a device from its attribute and its free text; signs of damage overrule the attribute."""
    def by_attribute(said: Column) -> Column:
        out = F.lit(None).cast("string")
        for value, pattern in reversed(PARAM_CONDITIONS):
            out = F.when(said.rlike(U + pattern), value).otherwise(out)
        return out

    def both(x: Column) -> Column:
        return _condition(x["p"], x["t"])

    return let(F.struct(let(normalize(param), by_attribute).alias("p"), normalize(text).alias("t")), both)


def _condition(by_param: Column, body: Column) -> Column:
    return resolve_condition(by_param, damaged(body), unnegated(body, REFURBISHED_TEXT), unnegated(body, NEW_TEXT), unnegated(body, USED_TEXT))


def resolve_condition(by_param: Column, hurt: Column, refurbished: Column, new: Column, used: Column) -> Column:
    """The order in which an attribute and the signs of a text decide."""
    return (
        F.when((by_param == "for_parts") | hurt, "for_parts")
        .when((by_param == "refurbished") | refurbished, "refurbished")
        .when((by_param == "new") & used, "used")
        .when(by_param.isNotNull(), by_param)
        .when(new, "new")
        .when(used, "used")
    )


def storage_gb(text: Column, bare: bool = False) -> Column:
    """Capacity in GB: the first valid number with a unit; with ``bare`` also a number without one."""
    return let(normalize(text), lambda t: _storage(t, bare))


def _storage(t: Column, bare: bool) -> Column:
    pairs = F.arrays_zip(F.regexp_extract_all(t, F.lit(U + STORAGE), F.lit(1)).alias("n"), F.regexp_extract_all(t, F.lit(U + STORAGE), F.lit(2)).alias("u"))
    tera = lambda p: p["u"].rlike("^[tт]")
    valid = F.filter(pairs, lambda p: F.when(tera(p), p["n"].isin("1", "2")).otherwise(p["n"].isin("64", "128", "256", "512", "1024")))
    found = F.get(F.transform(valid, lambda p: p["n"].cast("int") * F.when(tera(p), 1024).otherwise(1)), F.lit(0))
    if not bare:
        return found
    return F.coalesce(found, F.regexp_extract(t, U + BARE_STORAGE, 1).try_cast("int"))


def battery_percent(text: Column, low: int = 40, high: int = 100) -> Column:
    """Battery health next to a battery word; the first value in bounds, by pattern in order."""
    def first(t: Column, p: str) -> Column:
        values = F.transform(F.regexp_extract_all(t, F.lit(U + p), F.lit(1)), lambda x: x.cast("int"))
        return F.get(F.filter(values, lambda v: v.between(low, high)), F.lit(0))

    return let(normalize(text), lambda t: F.coalesce(*[first(t, p) for p in BATTERY]))


def model_name(text: Column, known: list[str], prefix: bool = True) -> Column:
    """Canonical name of the first model in the text that stands in ``known``."""
    t = normalize(text)
    for pattern, latin in MODEL_SPELLINGS:
        t = F.regexp_replace(t, U + pattern, latin)
    return let(t, lambda t: _model(t, known, prefix))


def _model(t: Column, known: list[str], prefix: bool) -> Column:
    grammar = F.lit(U + (PREFIXED_MODEL if prefix else BARE_MODEL))
    gen, e, variant, plus, se = (F.regexp_extract_all(t, grammar, F.lit(i)) for i in range(1, 6))
    parts = F.arrays_zip(gen.alias("g"), e.alias("e"), variant.alias("v"), plus.alias("p"), se.alias("s"))

    def name(m: Column) -> Column:
        v = F.when(m["p"] != "", "plus").otherwise(F.regexp_replace(F.regexp_replace(F.regexp_replace(m["v"], r"\s+", " "), r" - |-", " "), "^promax$", "pro max"))
        suffix = F.when(v == "", "").when(v == "pro max", " Pro Max").when(v == "pro", " Pro").when(v == "plus", " Plus").when(v == "mini", " mini").when(v == "air", " Air").otherwise(" ?")
        x_name = F.when(m["g"] == "10", "X").otherwise(F.upper(m["g"]))
        return (
            F.when(m["g"] == "se", F.when(m["s"] == "", None).when(m["s"].rlike("^(2022|3)"), "iPhone SE 2022").otherwise("iPhone SE 2020"))
            .when((m["g"] == "air") | ((m["g"] == "17") & (v == "air")), "iPhone Air")
            .when(m["g"].isin("10", "x", "xr", "xs"), F.concat(F.lit("iPhone "), x_name, F.when(v == "max", " Max").otherwise(suffix)))
            .when(m["e"] != "", F.concat(F.lit("iPhone "), m["g"], F.lit("e")))
            .otherwise(F.concat(F.lit("iPhone "), m["g"], F.when(v == "max", " Pro Max").otherwise(suffix)))
        )

    names = F.transform(parts, name)
    return F.get(F.filter(names, lambda n: n.isin(known)), F.lit(0))


def price(c: Column) -> Column:
    """Price in whole units: a plain number rounded half-even, else the first run of digits with its blanks removed."""
    text = strip(c.cast("string"))
    number = F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))
    run = F.regexp_extract(F.regexp_replace(text, rf"{U}[^\S\n]+", " "), r"\d[\d ]*", 0)
    digits = F.regexp_replace(run, " ", "").try_cast("bigint")
    return F.when(number.isNotNull(), F.when((number > 0) & (number < 9.0e18), F.bround(number, 0).cast("bigint"))).when(digits > 0, digits)


def region(location: Column) -> Column:
    """Town or region at the head of an address, or the name for an unknown one."""
    head = F.element_at(F.split(strip(F.coalesce(location, F.lit(""))), r"[,;\n]", 2), 1)
    head = F.trim(F.regexp_replace(F.regexp_replace(strip(head), r"(?iU)^(?:г\.|город\s)\s*", ""), rf"{U}\s+", " "))
    key = F.translate(F.lower(head), "ё", "е")
    alias = F.create_map(*[F.lit(x) for pair in REGION_ALIASES.items() for x in pair])
    plain = F.concat(F.upper(F.substring(head, 1, 1)), F.substr(head, F.lit(2)))
    return F.when((head == "") | F.lower(head).rlike(U + NOT_A_TOWN), UNKNOWN_REGION).otherwise(F.coalesce(alias[key], plain))


# ---- what people type when asked for one thing


def typed_price(c: Column) -> Column:
    """A price as typed, also in thousands ("65k", "70 тыс"); null if there is none."""
    thousands = F.regexp_extract(strip(c), r"(?iu)^(\d+(?:[.,]\d+)?)\s*(?:k|к|тыс\.?)$", 1)
    return F.when(thousands != "", F.bround(F.regexp_replace(thousands, ",", ".").try_cast("double") * 1000, 0).cast("bigint")).otherwise(price(c))


def typed_percent(c: Column) -> Column:
    """A whole percentage of 1 to 100 as typed, with or without its sign; null if there is none."""
    number = F.regexp_extract(strip(c), r"^(\d{1,3})\s*%?$", 1).try_cast("int")
    return F.when(number.between(1, 100), number)


def typed_storage(c: Column, sizes: tuple[int, ...]) -> Column:
    """A capacity in GB as typed: with a unit, or a bare number among ``sizes``."""
    bare = strip(c).try_cast("int")
    return F.coalesce(storage_gb(c, True), F.when(bare.isin(*sizes), bare))


def typed_condition(c: Column) -> Column:
    """A condition as typed: its own name, or a wording of it."""
    plain = normalize(c)
    return F.when(plain.isin("new", "used", "refurbished", "for_parts"), plain).otherwise(condition(c, c))
