"""Reading of catalogue offers: kind, model and measured attributes in canonical form, and what is left as the name.

A word that stands in no vocabulary and is no measure belongs to the name (brand and product line).
Names are spelled in one Latin form, so that Cyrillic and Latin spellings meet. Vocabulary words of
five letters or more are also recognised with one misspelling.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import lru_cache

from bazaarlens.llm.gazetteer import distance, letters

# ---- Fixed values: kinds of article by their names.
KINDS = {
    "phone": ("смартфон восстановленный", "смартфон", "телефон", "восстановленный смартфон", "smartphone"),
    "case": ("чехол-накладка", "чехол накладка", "чехол", "кейс", "case", "бампер"),
    "glass": ("защитное стекло", "бронестекло", "стекло", "screen glass", "tempered glass"),
    "power_bank": ("внешний аккумулятор", "power bank", "powerbank", "повербанк", "пауэрбанк", "пзу"),
    "battery": ("аккумулятор", "батарея", "акб", "battery"),
    "charger": ("зарядное устройство", "адаптер питания", "зарядка", "сзу", "charger", "power adapter"),
    "cable": ("шнур зарядный", "кабель", "cable", "провод", "шнур"),
}
# ---- Fixed values: colours, materials, connectors and grades by their names.
COLOURS = {
    "black": "чёрный черный чёрн черн black", "white": "белый бел white", "red": "красный красн red", "blue": "синий син blue", "green": "зелёный зеленый зел green", "pink": "розовый роз pink", "clear": "прозрачный прозр clear transparent",
    "gold": "золотой золот gold", "grey": "серый сер grey gray графит graphite", "purple": "фиолетовый фиол purple", "yellow": "жёлтый желтый yellow", "silver": "серебристый серебро silver",
}
MATERIALS = {"leather": "leather кожа кожаный", "plastic": "plastic пластик пластиковый", "silicone": "silicone силикон силиконовый", "fabric": "ткань тканевый fabric", "metal": "металл металлический metal"}
CONNECTORS = {"lightning": ("lightning", "лайтнинг", "8-pin", "8 pin", "8pin"), "usb_c": ("usb type c", "usb type-c", "usb-c", "usb c", "type-c", "type c", "тайп си", "тайп-си"), "micro": ("micro usb", "micro-usb", "микро юсб")}
# ---- Fixed values: advertising phrases and words that name no attribute.
NOISE = (
    "успей купить", "быстрая доставка", "лучшая цена", "топ продаж", "100% качество", "опт и розница", "оригинальная упаковка", "гарантия магазина", "скидка сегодня", "в наличии", "подарок", "premium", "хит", "new", "акция",
    "есть ещё расцветки и размеры, уточняйте", "отправим в день заказа", "самовывоз или доставка", "возврат 14 дней", "товар на складе, проверяем перед отгрузкой", "собственный импорт, чек выдаём", "работаем без выходных", "характеристики:", "в объявлении:",
)
STOP = frozenset("для от и с на в к по the for from of by with refurb сборка ко".split())
# ---- Fixed values: words of phone models.
MODEL_WORDS = {"про": "pro", "макс": "max", "мини": "mini", "плюс": "plus", "pro": "pro", "max": "max", "mini": "mini", "plus": "plus"}

#: Attributes that every offer of a kind must name before it counts as complete.
REQUIRED = {
    "phone": ("model", "storage", "colour", "grade"), "case": ("model", "colour", "material"), "glass": ("model", "thickness"), "power_bank": ("capacity", "colour"), "battery": ("model", "capacity"), "charger": ("power", "colour"), "cable": ("length", "connector", "colour"),
}
ATTRIBUTES = ("kind", "model", "storage", "colour", "grade", "material", "power", "capacity", "length", "thickness", "connector")
BRAND_KEYS, LINE_KEYS = ("бренд", "производитель"), ("серия", "линейка")

# all patterns are for text in lower case
_NOISE = re.compile("|".join(re.escape(w.lower()) for w in sorted(NOISE, key=len, reverse=True)))
_MODEL = re.compile(r"(?:\bapple\s+)?(?:\bi\s?phone|\bайфон|\bip(?=\s?(?:\d|x|s)))\s*[- ]?\s*(se\s*20\d\d|se|xs\s*max|x[rs]?|\d{1,2}(?:\s?e(?!\w))?)(?!\w)((?:\s+(?:pro|max|mini|plus|про|макс|мини|плюс)\b)*)")
_NUM = r"(\d+(?:[  ]\d{3})*(?:[.,]\d+)?)"
_STORAGE = re.compile(rf"(?<![\d.,]){_NUM}\s*(тб|tb|терабайт\w*|гб|gb|гигабайт\w*|мб|mb|мегабайт\w*)\b")
_CAPACITY = re.compile(rf"(?<![\d.,]){_NUM}\s*(мач|mah|ma/h|mа/h|ач|ah|а/ч)(?!\w)")
_POWER = re.compile(rf"(?<![\d.,]){_NUM}\s*(вт|ватт|watt|w)\b")
_THICK = re.compile(rf"(?<![\d.,]){_NUM}\s*(мм|mm|мкм|um)\b")
_LENGTH = re.compile(rf"(?<![\d.,]){_NUM}\s*(метров|метра|метр|м|m|см|cm|мм|mm)\b")
_GRADE = re.compile(r"\b(?:grade|грейд|класс|кл)\.?\s*([abcавс])\b")
_WORD = re.compile(r"[A-Za-zА-Яа-яЁё]+(?:[-'][A-Za-zА-Яа-яЁё]+)*")
_LATIN = dict(zip("абвгдеёжзийклмнопрстуфхцчшщъыьэюя", "a b v g d e e j z i i k l m n o p r s t u f h ts ch sh sch _ i _ e u a".split(), strict=True))


def _phrases(table: dict[str, tuple[str, ...]]) -> tuple[re.Pattern[str], dict[str, str]]:
    meaning = {w: name for name, words in table.items() for w in words}
    return re.compile(r"(?<![\w-])(?:" + "|".join(map(re.escape, sorted(meaning, key=len, reverse=True))) + r")(?![\w-])\.?"), meaning


_KINDS, _CONNECTORS = _phrases(KINDS), _phrases(CONNECTORS)
_COLOUR = {w: c for c, words in COLOURS.items() for w in words.split()}
_MATERIAL = {w: c for c, words in MATERIALS.items() for w in words.split()}
_KIND_WORD = {w: k for k, words in KINDS.items() for w in words if " " not in w}
_LONG = {w: ("colour", c) for w, c in _COLOUR.items() if len(w) >= 5} | {w: ("material", c) for w, c in _MATERIAL.items() if len(w) >= 5} | {w: ("kind", k) for w, k in _KIND_WORD.items() if len(w) >= 5}


@lru_cache(200_000)
def spelled(word: str) -> str:
    """One Latin spelling of a name word in either script."""
    w = "".join(_LATIN.get(c, c) for c in word.lower()).replace("_", "").replace("-", "").replace("'", "")
    for a, b in (("qu", "kv"), ("x", "ks"), ("w", "v"), ("ck", "k"), ("c", "k"), ("q", "k"), ("zh", "j"), ("kh", "h"), ("ya", "a"), ("yu", "u"), ("yo", "e"), ("ye", "e"), ("y", "i"), ("ph", "f"), ("dj", "g")):
        w = w.replace(a, b)
    return re.sub(r"(.)\1+", r"\1", w)


def _number(text: str) -> float:
    return float(text.replace(" ", "").replace(" ", "").replace(",", "."))


def _short(x: float) -> str:
    return f"{x:.4f}".rstrip("0").rstrip(".")


@dataclass(frozen=True)
class Offer:
    """Canonical attributes (None if not named) and the words of the name in order of the alphabet."""

    attributes: tuple[str | None, ...]
    name: tuple[str, ...]

    @property
    def complete(self) -> bool:
        a = dict(zip(ATTRIBUTES, self.attributes, strict=True))
        return a["kind"] is not None and all(a[r] is not None for r in REQUIRED[a["kind"]])


def _params(params: str | None) -> str:
    if not params or not params.strip():
        return ""
    try:
        found = json.loads(params)
        if isinstance(found, dict):
            return " \n ".join(str(v) for v in found.values() if v is not None)
    except ValueError:
        pass
    return " ".join(re.findall(r':\s*"([^"]*)', params))


def read(title: str | None, description: str | None, params: str | None) -> Offer:
    """The offer that a title, a description and JSON parameters describe together."""
    text = " \n ".join(t for t in (title, description, _params(params)) if t)
    text = _NOISE.sub(" ", text.lower())
    found: dict[str, str | None] = dict.fromkeys(ATTRIBUTES)

    def take(pattern: re.Pattern[str], text: str, use) -> str:  # noqa: ANN001
        def one(m: re.Match[str]) -> str:
            return " ; " if use(m) else m.group()

        return pattern.sub(one, text)

    def put(name: str, value: str) -> bool:
        if found[name] is None:
            found[name] = value
        return True

    def model(m: re.Match[str]) -> bool:
        base = re.sub(r"\s+", " ", m.group(1).lower().strip())
        base = re.sub(r"^(\d+) e$", r"\1e", base)
        return put("model", " ".join([base, *(MODEL_WORDS[w] for w in m.group(2).lower().split())]))

    text = take(_MODEL, text, model)
    text = take(_STORAGE, text, lambda m: put("storage", _short(_number(m.group(1)) * (1024 if m.group(2)[0] in "тt" else 1 / 1024 if m.group(2)[0] in "мm" else 1))))
    text = take(_CAPACITY, text, lambda m: put("capacity", _short(_number(m.group(1)) * (1 if m.group(2)[0] in "мm" else 1000))))
    text = take(_POWER, text, lambda m: put("power", _short(_number(m.group(1)))))
    text = take(_GRADE, text, lambda m: put("grade", {"а": "a", "в": "b", "с": "c"}.get(m.group(1), m.group(1))))
    for (pattern, meaning), name in ((_CONNECTORS, "connector"), (_KINDS, "kind")):
        text = take(pattern, text, lambda m, name=name, meaning=meaning: put(name, meaning[m.group().rstrip(".")]))
    measure = "thickness" if found["kind"] == "glass" else "length"
    scale = {"мкм": 0.001, "um": 0.001, "мм": 1.0, "mm": 1.0, "см": 10.0, "cm": 10.0}
    text = take(_THICK if measure == "thickness" else _LENGTH, text, lambda m: put(measure, _short(_number(m.group(1)) * scale.get(m.group(2), 1000.0))))
    name: list[str] = []
    apple = False
    unclear: list[str] = []  # words that may be slips of a vocabulary
    for word in _WORD.findall(text):
        if word in STOP:
            continue
        if word == "apple":
            apple = True
        elif word in _COLOUR:
            put("colour", _COLOUR[word])
        elif word in _MATERIAL:
            put("material", _MATERIAL[word])
        elif len(word) >= 4 and _misspelt(word):
            unclear.append(word)
        elif len(word) > 1:
            name.append(spelled(word))
    for word in unclear:  # only for what is named nowhere else; other slips are words of the name
        attribute, value = _misspelt(word)
        if found[attribute] in (None, value):
            found[attribute] = value
        else:
            name.append(spelled(word))
    if found["kind"] is None and (apple or found["storage"] or found["grade"]):
        found["kind"] = "phone"
    wanted = {"kind", *REQUIRED.get(found["kind"] or "", ATTRIBUTES)}
    return Offer(tuple(found[a] if a in wanted else None for a in ATTRIBUTES), tuple(sorted({w for w in name if w})))


@lru_cache(100_000)
def _misspelt(word: str) -> tuple[str, str] | None:
    """The vocabulary entry that ``word`` misspells by one letter, if there is one."""
    for known, meaning in _LONG.items():
        if abs(len(known) - len(word)) <= 1 and (letters(word) ^ letters(known)).bit_count() <= 2 and distance(word, known, 1) <= 1:
            return meaning
    return None
