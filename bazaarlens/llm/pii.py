"""Problem 6: personal data in free text, found under its disguises and replaced by typed placeholders.

A text is rewritten by small transducers that remember where every character came from: look-alike
letters inside words and numbers, numbers written as words (digits, tens and hundreds), and disguised
"at" and "dot" become plain. E-mails, phones, numbers of documents and addresses are looked for in
the plain form, and the spans found are mapped back to the source, so the placeholder replaces exactly
the disguised characters and the rest of the text stays as it was. A transducer or a detector runs
only where one of its trigger words stands. Names are known by given names, and where those are
unknown by their shape (patronymics, surnames) and by words that announce a person.

Kinds: email, phone, id_number (numbers of personal documents and accounts with the state),
address (street or the like with a house number) and name (two of given name, patronymic and
surname, or initials with a surname). Numbers of devices, orders and parcels are left alone.

Defined results: null stays null and empty stays empty, both without kinds; overlapping finds keep
the earliest and longest; texts of any length are read whole; repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "phone", "id_number", "address", "name")

# ---- Fixed values: given names, lower case, nominative.
MALE = (
    "александр алексей анатолий андрей антон аркадий аристарх арсений артём артур борис вадим валентин валерий василий виктор виталий владимир владислав всеволод вячеслав геннадий георгий герман глеб григорий даниил данила денис дмитрий "
    "евгений егор ефим захар иван игнат игнатий игорь илья кирилл константин лев леонид макар максим марк матвей михаил никита николай олег павел пётр платон прохор роман руслан савелий святослав семён сергей станислав степан тарас "
    "тимофей тимур тихон фёдор филипп юрий яков ярослав"
).split()
FEMALE = (
    "александра алина алиса алла алевтина альбина анастасия ангелина анна антонина варвара валентина валерия вера вероника виктория галина дарина дарья диана ева евгения екатерина елена елизавета жанна зинаида зоя инна ирина карина кира "
    "клавдия кристина ксения лариса лидия любовь людмила маргарита марина мария марьяна милана надежда наталья наталия нина оксана олеся ольга полина раиса регина светлана софия софья таисия тамара татьяна ульяна юлия яна"
).split()
# ---- Fixed values: digits as words.
DIGIT_WORDS = {
    "ноль": "0", "нуль": "0", "один": "1", "два": "2", "три": "3", "четыре": "4", "пять": "5", "шесть": "6", "семь": "7", "восемь": "8", "девять": "9",
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
}
# ---- Fixed values: numbers from ten on as words.
TEENS = dict(zip("десять одиннадцать двенадцать тринадцать четырнадцать пятнадцать шестнадцать семнадцать восемнадцать девятнадцать".split(), range(10, 20), strict=True)) | dict(zip("ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split(), range(10, 20), strict=True))
TENS = dict(zip("двадцать тридцать сорок пятьдесят шестьдесят семьдесят восемьдесят девяносто".split(), range(20, 100, 10), strict=True)) | dict(zip("twenty thirty forty fifty sixty seventy eighty ninety".split(), range(20, 100, 10), strict=True))
HUNDREDS = dict(zip("сто двести триста четыреста пятьсот шестьсот семьсот восемьсот девятьсот".split(), range(100, 1000, 100), strict=True))
# ---- Fixed values: letters that stand for digits inside numbers, and Latin letters that stand for Cyrillic ones inside words.
DIGIT_LOOKALIKES = {"З": "3", "з": "3", "О": "0", "о": "0", "O": "0", "o": "0", "Q": "0", "l": "1", "I": "1", "|": "1"}
LETTER_LOOKALIKES = str.maketrans("aceopxyABCEHKMOPTX", "асеорхуАВСЕНКМОРТХ")
# ---- Fixed values: transliteration of Cyrillic letters.
LATIN = dict(zip("абвгдеёжзийклмнопрстуфхцчшщъыьэюя", "a b v g d e e zh z i y k l m n o p r s t u f kh ts ch sh shch _ y _ e yu ya".split(), strict=True))


def _given_forms() -> set[str]:
    """Case forms of the given names, and their Latin spelling in the nominative."""
    forms: set[str] = set()
    for name in (*MALE, *FEMALE):
        forms.add(name)
        forms.add("".join(LATIN[c] for c in name).replace("_", ""))
        stem = name[:-1]
        if name.endswith("ия"):
            forms.update(stem + e for e in ("и", "ю", "ей"))
        elif name.endswith("я"):
            forms.update(stem + e for e in ("и", "е", "ю", "ей"))
        elif name.endswith("а"):
            forms.update(stem + e for e in ("ы", "и", "е", "у", "ой"))
        elif name.endswith(("й", "ь")):
            forms.update(stem + e for e in ("я", "ю", "ем", "е", "и"))
        elif name == "павел":
            forms.update("павл" + e for e in ("а", "у", "ом", "е"))
        elif name == "пётр":
            forms.update("петр" + e for e in ("", "а", "у", "ом", "е"))
        elif name == "лев":
            forms.update("льв" + e for e in ("а", "у", "ом", "е"))
        else:
            forms.update(name + e for e in ("а", "у", "ом", "е"))
    return forms | {f.replace("ё", "е") for f in forms}


GIVEN = frozenset(_given_forms())
_SURNAME = r"[а-яё-]{2,}(?:(?:ов|ев|ёв|ин|ын)(?:а|у|ым|е|ой)?|(?:ск|цк)(?:ий|ая|ого|ому|ой|ую|им)|(?:ых|их|ко|юк|ук|чук|ян|дзе|швили))|[a-z-]{2,}(?:ov|ev|in|yn|un|ova|eva|ina|yna|una|sky|skiy|skaya|tsev|tseva)"
_PATRONYMIC = r"[а-яё]{2,}(?:ович|евич|ьич|ич)(?:а|у|ем|ом|е)?|[а-яё]{2,}(?:овн|евн|ичн|иничн)(?:а|ы|е|у|ой)|[a-z]{2,}(?:ovich|evich|ovna|evna)"
_SURNAME_RE, _PATRONYMIC_RE = re.compile(_SURNAME), re.compile(_PATRONYMIC)
_INITIALS = (
    re.compile(r"(?<![\w.])[А-ЯЁA-Z]\.\s?[А-ЯЁA-Z]\.\s?([A-ZА-ЯЁ][A-Za-zА-Яа-яЁё-]{3,})"),
    re.compile(r"(?<![\w.])([A-ZА-ЯЁ][A-Za-zА-Яа-яЁё-]{3,})\s+[А-ЯЁA-Z]\.\s?[А-ЯЁA-Z]\."),
)
_TWO_INITIALS = re.compile(r"[А-ЯЁA-Z]\.\s?[А-ЯЁA-Z]\.")
_WORD = re.compile(r"[A-Za-zА-Яа-яЁё]+(?:-[A-Za-zА-Яа-яЁё]+)*")
#: Ordinary words with the ending of a surname.
NOT_SURNAMES = frozenset("один магазин готов здоров новый новая вчера очень причин машин корзин витрин половина цена часов месяцев рублей телефонов основа снова слева справа зимой готова здорова кроме лишнее мобильников bitcoin begin again login admin main plain mini even seven eleven".split())

_CUES = r"зовут|продав(?:ец|ца|цу)|прода[её]т|спросить|спрашива\w+|уважением|контакт\w*|получател\w*|владел\w*|отправител\w*|обращаться\s+к|на\s+имя|фио|name\s+is|regards|seller|ask\s+for|contact|owner"
_ANNOUNCED = re.compile(rf"(?<!\w)(?i:{_CUES})[\s:,—–-]+((?:[А-ЯЁ][а-яё]+(?:-[А-ЯЁ][а-яё]+)?)(?:[ ][А-ЯЁ][а-яё]+(?:-[А-ЯЁ][а-яё]+)?){{1,2}}|[A-Z][a-z]+(?:[ ][A-Z][a-z]+){{1,2}})(?![\w-])")
_WITH_PATRONYMIC = re.compile(r"(?<![\w-])(?:[А-ЯЁ][а-яё]{2,}(?:-[А-ЯЁ][а-яё]+)?[ ])?[А-ЯЁ][а-яё]{2,}[ ][А-ЯЁ][а-яё]*(?:[оеё]вич|ьич|[оеё]вн|ичн)(?:а|у|ем|ы|е|ой)?(?![\w-])")
_SHAPED = re.compile(r"(?<![\w-])([А-ЯЁ][а-яё]{2,})[ ]([А-ЯЁ][а-яё]{2,}(?:[оеё]в|[иы]н)(?:а|у|ым|ой)?|[А-ЯЁ][а-яё]{2,}(?:енко|швили|дзе))(?![\w-])")
# ---- Fixed values: words before the name of a place, and towns that look like surnames.
PLACE_WORDS = frozenset("россия рф город городе область области район районе республика край улица улице проспект площадь метро станция посёлок поселок село деревня шоссе переулок набережная бульвар мост".split())
TOWN_SHAPES = frozenset("ростов саратов псков тамбов азов серов киров львов харьков чехов пушкин калинин гагарин камышин королёв королев дмитров серпухов могилёв челны магнитогорск".split())

_EMAIL = re.compile(r"(?<![\w.+-])[a-z0-9][\w.+-]*@[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}(?![\w@-])", re.I)
_AT = re.compile(r"\s*[(\[{<]\s*(?:at|собака|эт|dog)\s*[)\]}>]\s*|\s+(?:at|собака|dog)\s+|\s+@\s*|(?<=[\w])@\s+", re.I)
_DOT = re.compile(r"\s*[(\[{<]\s*(?:dot|точка|тчк)\s*[)\]}>]\s*|\s+(?:dot|точка|тчк)\s+", re.I)
_NUMBER = {w: int(d) for w, d in DIGIT_WORDS.items()} | TEENS | TENS | HUNDREDS
_NUMBER_WORD = rf"(?:{'|'.join(sorted(_NUMBER, key=len, reverse=True))})"
#: Words of numbers, with short figures only between them.
_NUMBER_RUN = re.compile(rf"(?<!\w)(?:\+?[78][\s-]+)?{_NUMBER_WORD}(?:(?:[\s-]+\d{{1,3}})*[\s,.-]+{_NUMBER_WORD}(?!\w))+", re.I)
_RUN_PART = re.compile(rf"{_NUMBER_WORD}|\d+", re.I)
_GAP = r"[\s()\-–—.*]{0,3}"
_PHONE = re.compile(rf"(?<![\w+])(?:\+?7|8){_GAP}\(?[3489]\d{_GAP}\d{_GAP}(?:\d{_GAP}){{6}}\d(?!\d)|(?<![\w+])8(?:[\s.-]?\d){{10}}(?!\d)|(?<![\w+\d])(?:\(?9\d\d\)?[\s.-]\d{{3}}[\s.-]\d\d[\s.-]\d\d)(?![\d-])|\+[1-9]\d{{0,2}}(?:[\s().-]{{0,2}}\d){{8,11}}(?!\d)")
_BARE_PHONE = re.compile(r"(?:тел\w*|звон\w*|номер|call|phone|связь|писать\D{0,8}|вотсап|whatsapp|набрать)[\s.:№—-]{0,4}(9\d{9})(?!\d)", re.I)
_NOT_PHONE = re.compile(r"(?:заказ\w*|накладн\w*|трек\w*|посылк\w*|отправлени\w*|imei|серийн\w*|артикул|инн|снилс|паспорт|загран|физлица|запрос\w*|request id|order|invoice|tracking|serial|s/n|код\w*|договор\w* №|\bid)[\s:№#.]*(?:номер|number|no\.?|№)?[\s:№#.\d]{0,8}$", re.I)
_MANY_DIGITS = re.compile(r"(?:[\dЗзОоOoQlI|][\s()\-–—.*+]{0,3}){10}")
_DIGIT = re.compile(r"\d")
#: Tokens of figures and look-alike letters with a figure first and two figures at least, or with figures on both sides.
_FIGURES = re.compile(r"(?<![^\W\d_])(?=[^\W_]*\d[ЗзОоOoQlI|]*\d)[\dЗОOQI|][\dЗзОоOoQlI|]+(?![^\W\d_])")
_BARE_ID = re.compile(r"\d{3}-\d{3}-\d{3}")

_ID = re.compile(
    r"паспорт\w*[\s:.№]*(?:серии\s*)?\d{2}\s?\d{2}\s*(?:№|номер|no\.?)?\s*\d{6}(?!\d)|серия[\s:]*\d{2}\s?\d{2}[\s,]*(?:№|номер)[\s:]*\d{6}(?!\d)|загран\w*(?:\s*паспорт\w*)?[\s:№]*\d{2}\s*№?\s*\d{7}(?!\d)"
    r"|\bинн(?:\s+(?:физ\.?\s?лица|фл))?[\s:№]*(?:\d{6}\s?\d{6}|\d{4}\s?\d{6}\s?\d{2}|\d{10})(?!\d)|снилс[\s:№]*\d{3}[\s-]?\d{3}[\s-]?\d{3}[\s-]?\d{2}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{3}[\s-]\d{2}(?!\d)"
    r"|(?:вод(?:ительск\w*)?\.?\s*)?удостоверени\w*[\s:№]*\d{2}\s?[\dа-яa-z]{2}\s?\d{6}(?!\d)|(?:вод\w*\.?\s*)?права[\s:№]+\d{2}\s?\d{2}\s?\d{6}(?!\d)|\bid\s*card[\s:]*(?:no\.?|number|№|#)?[\s:]*[a-z]{0,2}\d{6,12}(?!\d)"
    r"|\bpassport[\s:]*(?:no\.?|number|№|#)?[\s:]*[a-z]{0,2}\d{6,9}(?!\d)|\b(?:driver'?s?|driving)\s+licen[cs]e[\s:]*(?:no\.?|number)?[\s:]*[a-z]{0,3}\d{6,12}(?!\d)|\bполис\w*[\s:№]*(?:омс)?[\s:№]*\d{16}(?!\d)|\bssn[\s:#]*\d{3}-\d{2}-\d{4}(?!\d)",
    re.I,
)
_NUM = r"\d{1,4}\s?[а-яa-z]?(?:\s?[/кk-]\s?\d{1,4}[а-я]?)?(?![\wЗО]|[\s*.(–-]\(?\d{3}[\s*.)–-]{1,2}\d|(?<=[78])[\s(-]{1,2}9\d{9}|[\s*.(–-]{1,2}\d[\s*.(–-]\d[\s*.(–-]\d)(?:,?\s*(?:корп|стр|к|с)\.?\s*\d+[а-я]?)?"
_FLAT = r"(?:-\d{1,4}(?!\d))?(?:,?\s*(?:кв|квартира|под|подъезд|этаж|оф|офис)\.?\s*\d+)*"
_TYPE = r"(?:ул(?:ица|ице|ицы|\.)?|пр-т|просп(?:ект\w*|\.)?|б-р|бул(?:ьвар\w*|\.|(?=\s))|пер(?:еулок|еулке|\.)?|ш(?:оссе|\.)|проезд\w*|пр-д|мкр(?:\.|-н)?|микрорайон\w*|наб(?:ережная|ережной|\.)|пл(?:ощадь|ощади|\.)|тракт\w*|аллея)"
_HOUSE = r"(?:д\.?|дом|домом|стр\.?|корп\.?)"
_STREET = r"[а-яё0-9][а-яё-]{2,}(?:\s[а-яё-]{3,})?"
_ADDRESS = re.compile(
    rf"(?<!\w){_TYPE}\s*{_STREET}[\s,]*(?:{_HOUSE}\s*)?{_NUM}{_FLAT}"
    rf"|(?<!\w)[а-яё-]{{3,}}\s+{_TYPE}[\s,]*(?:{_HOUSE}\s*)?{_NUM}{_FLAT}"
    rf"|(?<!\w)дом\s*{_NUM}\s*по\s+{_TYPE}\s*{_STREET}"
    rf"|(?<!\w)[а-яё-]{{2,}}(?:ая|яя|ий|ый|ой|ое|ее|ого|его|ина|ова|ева)\s+\d{{1,4}}\s?[а-я]?(?:\s?[/к-]\s?\d{{1,3}})?(?:,?\s*(?:корп|стр|к)\.?\s*\d+)?,?\s*(?:кв|квартира)\.?\s*\d+"
    r"|(?<!\w)\d{1,5}\s?[a-zа-я]?(?:[/кk]\d+)?(?:\s(?:стр|корп|bld)\.?\s\d+)?\s+(?:[a-z][a-z'-]+\s){1,3}(?:st|street|ave|avenue|road|rd|lane|ln|blvd|boulevard|drive|court|terrace|square)\b\.?(?:,?\s*(?:apt|flat|unit|suite)\.?\s*\d+\w?)?",
    re.I,
)

EMAIL_T, SPELLED_T, ID_T, ADDRESS_T, NAME_T = 1, 2, 4, 8, 16
_TRIGGERS: dict[str, int] = (
    dict.fromkeys(("@", "собака", " at ", " dog ", *(f"{o}{w}" for o in "([{<" for w in ("at", "эт", "dog", " at", " эт", " dog"))), EMAIL_T)
    | dict.fromkeys(_NUMBER, SPELLED_T)
    | dict.fromkeys(("паспорт", "серия", "загран", "инн ", "инн:", "инн№", "снилс", "удостоверен", "id card", "idcard", "passport", "licen", "полис", "права", "ssn"), ID_T)
    | dict.fromkeys(("ул.", "ул ", "улиц", "пр-т", "просп", "б-р", "бул.", "бул ", "бульвар", "пер.", "пер ", "переул", "ш.", "шоссе", "проезд", "пр-д", "мкр", "микрорайон", "наб.", "наб ", "набереж", "пл.", "площад", "тракт", "аллея", "дом", "кв ", "кв.", "кварт"), ADDRESS_T)
    | dict.fromkeys((" st", " ave", " road", " rd", " lane", " ln", " blvd", " boul", " drive", " court", " terr", " square"), ADDRESS_T)
)


def _automaton() -> ahocorasick.Automaton:
    words = dict(_TRIGGERS)
    for form in GIVEN:
        words[form] = words.get(form, 0) | NAME_T
    found = ahocorasick.Automaton()
    for word, mark in words.items():
        found.add_word(word, (mark, len(word)))
    found.make_automaton()
    return found


_AUTOMATON = _automaton()
_MIXED = re.compile(r"[а-яёА-ЯЁ][a-zA-Z]|[a-zA-Z][а-яёА-ЯЁ]")
_MIXED_WORD = re.compile(r"[A-Za-zА-Яа-яЁё]*(?:[а-яё][a-z]|[a-z][а-яё])[A-Za-zА-Яа-яЁё]*", re.I)

Span = tuple[int, int, str]


def _rewrite(text: str, edits: list[tuple[int, int, str]]) -> tuple[str, list[int]]:
    """``text`` with ``edits`` applied and, for each plain character and the end, its place in the source."""
    out, origin, at = [], [], 0
    for start, end, plain in edits:
        if start < at:
            continue
        out.append(text[at:start])
        origin.extend(range(at, start))
        out.append(plain)
        origin.extend([start] * len(plain))
        at = end
    out.append(text[at:])
    origin.extend(range(at, len(text) + 1))
    return "".join(out), origin


def _emails(text: str) -> Iterator[Span]:
    for m in _EMAIL.finditer(text):
        yield m.start(), m.end(), "email"
    edits = [(m.start(), m.end(), "@") for m in _AT.finditer(text)] + [(m.start(), m.end(), ".") for m in _DOT.finditer(text)]
    if edits:
        plain, origin = _rewrite(text, sorted(edits))
        for m in _EMAIL.finditer(plain):
            yield origin[m.start()], origin[m.end() - 1] + 1, "email"


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """Edits that write runs of numbers in words as digits; a run needs six digits, as in "девятьсот двадцать один, ноль 5 ноль"."""
    edits = []
    for run in _NUMBER_RUN.finditer(text):
        parts = list(_RUN_PART.finditer(run.group()))
        groups: list[list] = []  # start, end, value, the power of ten that the next word must stay under
        for m in parts:
            word = m.group().lower()
            if word.isdigit():
                groups.append([m.start(), m.end(), word, 1])
                continue
            value = _NUMBER[word]
            if groups and groups[-1][3] > 1 and 0 < value < groups[-1][3] and not isinstance(groups[-1][2], str):
                groups[-1][1], groups[-1][2] = m.end(), groups[-1][2] + value
            else:
                groups.append([m.start(), m.end(), value, 1])
            groups[-1][3] = 100 if value >= 100 else 10 if value >= 20 else 1
        digits = "".join(str(g[2]) for g in groups)
        if len(digits) >= 6:
            at = run.start()
            ends = [g[0] for g in groups[1:]] + [groups[-1][1]]
            edits += [(at + g[0], at + end, str(g[2])) for g, end in zip(groups, ends, strict=True)]
    return edits


def _figures(text: str) -> str:
    """Look-alike letters inside tokens of figures become figures, one for one."""

    def plain(m: re.Match[str]) -> str:
        return "".join(DIGIT_LOOKALIKES.get(c, c) for c in m.group())

    return _FIGURES.sub(plain, text)


def _phones(text: str, plain: str, back: Callable[[int, int], tuple[int, int]]) -> Iterator[Span]:
    """Phones of the plain form, as spans of the source."""
    if not _MANY_DIGITS.search(plain):
        return
    for start, end in [(m.start(), m.end()) for m in _PHONE.finditer(plain)] + [m.span(1) for m in _BARE_PHONE.finditer(plain)]:
        if _NOT_PHONE.search(plain[max(0, start - 40) : start]):
            continue
        first, last = back(start, start + len(plain[start:end].rstrip(" ,.-\n")))
        yield first, first + len(text[first:last].rstrip(" ,.-\n")), "phone"


def _names(text: str, low: str, ends: list[tuple[int, int]]) -> Iterator[Span]:
    if _TWO_INITIALS.search(text):
        for pattern in _INITIALS:
            for m in pattern.finditer(text):
                surname = m.group(1).lower()
                if _SURNAME_RE.fullmatch(surname) and surname not in NOT_SURNAMES:
                    yield m.start(), m.end(), "name"
    for end, length in ends:
        start = end - length
        if (start and (low[start - 1].isalpha() or low[start - 1] in "@._")) or (end < len(low) and (low[end].isalpha() or low[end] in "@_")):
            continue
        left = right = None
        m = _WORD.match(text, end + 1) if text[end : end + 1].isspace() else None
        if m:
            right = m
        before = text[max(0, start - 40) : start]
        if before[-1:].isspace() and (words := list(_WORD.finditer(before))) and words[-1].end() == len(before) - 1:
            left = words[-1]
        upper = text[start].isupper()

        def fits(word: str, pattern: re.Pattern[str], upper: bool = upper) -> bool:
            w = word.lower()
            return word[0].isupper() == upper and w not in NOT_SURNAMES and w not in GIVEN and bool(pattern.fullmatch(w))

        if right and fits(right.group(), _PATRONYMIC_RE):
            begin = start - (len(before) - left.start()) if left and fits(left.group(), _SURNAME_RE) else start
            after = _WORD.match(text, right.end() + 1)
            yield begin, after.end() if begin == start and after and text[right.end()].isspace() and fits(after.group(), _SURNAME_RE) else right.end(), "name"
        elif right and fits(right.group(), _SURNAME_RE):
            yield start, right.end(), "name"
        elif left and fits(left.group(), _SURNAME_RE):
            yield start - (len(before) - left.start()), end, "name"


_ADJECTIVE = ("ий", "ый", "ой", "ая", "яя", "ое", "ые", "ие")


def _shaped_names(text: str) -> Iterator[Span]:
    """Names without a known given name: announced ones, those with a patronymic, and a word with a surname after it."""
    for m in _ANNOUNCED.finditer(text):
        first, second = m.group(1).lower().split()[:2]
        named = first in GIVEN or not first.endswith(_ADJECTIVE) or _SURNAME_RE.fullmatch(second)
        if named and not PLACE_WORDS & {first, second}:
            yield m.start(1), m.end(1), "name"
    for m in _WITH_PATRONYMIC.finditer(text):
        yield m.start(), m.end(), "name"
    for m in _SHAPED.finditer(text):
        first, second = m.group(1).lower(), m.group(2).lower()
        if first not in PLACE_WORDS and not first.endswith((*_ADJECTIVE, "ть", "те")) and second not in TOWN_SHAPES and second not in NOT_SURNAMES:
            yield m.start(), m.end(), "name"


def find(text: str | None) -> list[Span]:
    """Spans (start, end, kind) of personal data in the source text, in order and without overlap."""
    if not text:
        return []
    if not text.isascii() and _MIXED.search(text):
        # one letter for one letter, so places stay; numbers are not touched
        text = _MIXED_WORD.sub(lambda m: m.group().translate(LETTER_LOOKALIKES) if sum(c in "абвгдеёжзийклмнопрстуфхцчшщъыьэюяАБВГДЕЁЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ" for c in m.group()) * 2 >= len(m.group()) else m.group(), text)
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    marks, names = 0, []
    for end, (mark, length) in _AUTOMATON.iter(low):
        marks |= mark
        if mark & NAME_T:
            names.append((end + 1, length))
    spans: list[Span] = []
    if marks & EMAIL_T:
        spans.extend(_emails(text))
    edits = _spelled(text) if marks & SPELLED_T else []
    plain, origin = _rewrite(text, edits) if edits else (text, None)
    plain = _figures(plain)
    digits = len(_DIGIT.findall(plain))

    def back(start: int, end: int) -> tuple[int, int]:
        return (start, end) if origin is None else (origin[start], origin[end])

    if digits:
        if marks & ID_T or _BARE_ID.search(plain):
            spans.extend((*back(m.start(), m.end()), "id_number") for m in _ID.finditer(plain))
        if marks & ADDRESS_T:
            spans.extend((*back(m.start(), m.end()), "address") for m in _ADDRESS.finditer(plain))
        if digits >= 6:
            spans.extend(_phones(text, plain, back))
    if names or _TWO_INITIALS.search(text):
        spans.extend(_names(text, low, names))
    known = [span for span in spans if span[2] == "name"]
    spans.extend(span for span in _shaped_names(text) if not any(span[0] < end and start < span[1] for start, end, _ in known))
    if len(spans) < 2:
        return spans
    order = {kind: i for i, kind in enumerate(("email", "id_number", "address", "phone", "name"))}
    kept: list[Span] = []
    for start, end, kind in sorted(spans, key=lambda s: (s[0], order[s[2]], -s[1])):
        if kept and start < kept[-1][1]:
            if end - start > kept[-1][1] - kept[-1][0] and order[kind] <= order[kept[-1][2]]:
                kept[-1] = (start, end, kind)
            continue
        kept.append((start, end, kind))
    return kept


def mask(text: str | None, spans: list[Span]) -> str | None:
    """``text`` with each span replaced by its kind in brackets."""
    if not spans or text is None:
        return text
    out, at = [], 0
    for start, end, kind in spans:
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def find_kinds(rows: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """Columns id, field_name, pii_kind: one row for each kind that a field of a row holds."""
    schema = T.StructType([T.StructField(id_col, rows.schema[id_col].dataType), T.StructField("field_name", T.StringType()), T.StructField("pii_kind", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            out, keys = [], batch.iloc[:, 0].tolist()
            for i, field in enumerate(fields):
                for key, text in zip(keys, batch.iloc[:, i + 1], strict=True):
                    if not text:
                        continue
                    kinds = seen.get(text)
                    if kinds is None:
                        kinds = tuple(dict.fromkeys(s[2] for s in find(text)))
                        if len(text) < 200:
                            if len(seen) > 50_000:
                                seen.clear()
                            seen[text] = kinds
                    out.extend((key, field, kind) for kind in kinds)
            yield pd.DataFrame(out, columns=[id_col, "field_name", "pii_kind"])

    return rows.select(id_col, *fields).mapInPandas(run, schema)


def mask_fields(rows: DataFrame, fields: list[str]) -> DataFrame:
    """``rows`` with the personal data in ``fields`` replaced; all other columns and texts unchanged."""
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields])

    def masked(texts: pd.Series) -> pd.Series:
        return pd.Series([mask(t, find(t)) if isinstance(t, str) else None for t in texts], dtype=object)

    masking = F.pandas_udf(masked, T.StringType())
    return rows.withColumns({f: masking(F.col(f)) for f in fields}).select(*[f.name for f in schema.fields])
