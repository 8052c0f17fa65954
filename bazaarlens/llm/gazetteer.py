"""Problem 3: freely typed values mapped to the entries of a reference list.

Each entry gets surface forms: its name, case forms, transliterations, shortened and known names.
Character n-grams of the surfaces, weighted by how rare they are, form an inverted index. A typed
value is split at commas, freed of frames such as "г.", "живу в", "(метро ...)" or "; торг",
normalised (case, look-alike letters, keyboard layout, Latin spelling), looked up in the index, and
scored by weighted cosine and by edit distance to the candidates; the best entry is taken if its
score passes the threshold and its lead over the next entry passes the margin, else the value is
reported as unmatched (entry 0). Equal values are matched once in each batch, and short ones are remembered.

Every form that the index retrieves is scored; the edit distance is skipped only where the pairs of
letters in common prove that it exceeds what is accepted. A longer list than ``MAX_ENTRIES``, which
is sent to the executors, is an error. The values are never shuffled, so one value held by a third of
all rows is no hot spot.

Defined results: null and blank values give null (there is nothing to map); a value that names no
entry, or two entries equally well, gives 0; an empty list gives 0 for every value.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable
from functools import lru_cache
from itertools import islice, takewhile

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most entries of a list that is sent to the executors.
MAX_ENTRIES = 200_000

# ---- Fixed values: keyboard positions (Latin layout to Cyrillic layout), look-alike letters, transliteration.
LAYOUT = str.maketrans("qwertyuiop[]asdfghjkl;'zxcvbnm,.`", "йцукенгшщзхъфывапролджэячсмитьбюё")
LOOKALIKE = str.maketrans("aceopxykmtbhABCEHKMOPTXY", "асеорхукмтвнАВСЕНКМОРТХУ")
LATIN = dict(zip("абвгдежзийклмнопрстуфхцчшщъыьэюя", "a b v g d e zh z i y k l m n o p r s t u f kh ts ch sh shch _ y _ e yu ya".split(), strict=True))
TO_CYRILLIC = (
    ("shch", "щ"), ("sch", "щ"), ("zh", "ж"), ("kh", "х"), ("ts", "ц"), ("ch", "ч"), ("sh", "ш"), ("yu", "ю"), ("ya", "я"), ("yo", "е"), ("ye", "е"), ("iy", "ий"), ("x", "кс"), ("w", "в"), ("q", "к"), ("j", "й"), ("c", "к"), ("h", "х"),
    ("'", "ь"), ("’", "ь"), *((lat, cyr) for cyr, lat in LATIN.items() if len(lat) == 1 and lat != "_" and cyr != "э" and cyr != "й"),
)
# ---- Fixed values: names that people use for towns and regions of the list, by official name.
NICKNAMES = {
    "Москва": "мск moscow msk москвабад", "Санкт-Петербург": "спб питер петербург spb с-пб с.-пб санкт-петер st-petersburg peter", "Московская область": "мо подмосковье мособласть мособл моск-обл", "Ленинградская область": "ло ленобласть ленобл лен-обл",
    "Екатеринбург": "екб екат ебург екатер yekaterinburg ekb свердловск", "Новосибирск": "нск новосиб сибирск nsk новосибирь", "Казань": "кзн kzn", "Краснодар": "крд кдр екатеринодар", "Нижний Новгород": "нн нино нижний н-новгород ннов nnov горький", "Ростов-на-Дону": "рнд ростов ростов-н-д ростов-на-д rostov-on-don rostov",
    "Самара": "смр куйбышев", "Челябинск": "члб чел челяба челябик chel", "Омск": "омскград", "Уфа": "ufa", "Красноярск": "крск кр-ярск", "Воронеж": "врн vrn", "Пермь": "прм", "Волгоград": "влг волга волгогр сталинград vlg", "Саратов": "срт сарат", "Тюмень": "тмн",
    "Тольятти": "тлт тольят togliatti tlt", "Ижевск": "ижик иж ижв", "Барнаул": "брн барнео", "Иркутск": "ирк", "Хабаровск": "хаб хабара хбр khv", "Ярославль": "ярик яр ярс yar", "Владивосток": "влад владик вдк vlad vvo", "Махачкала": "мах махач мхч", "Томск": "тмск",
    "Оренбург": "орен оренбуржье", "Кемерово": "кем кмр", "Рязань": "рзн", "Астрахань": "астра астр", "Набережные Челны": "челны наб-челны нч", "Пенза": "пнз", "Липецк": "лпк лип", "Калининград": "клд кениг кенигсберг кенинг клгд калинград", "Тула": "тульск", "Курск": "крск-обл", "Ставрополь": "ставр ставрик ств",
    "Сочи": "sochi", "Улан-Удэ": "уу улан-уде", "Тверь": "твр", "Магнитогорск": "магнитка магн мгн", "Иваново": "ив-во ивн", "Белгород": "белг бел", "Сургут": "сург сгт", "Чебоксары": "чебы чебок чбк", "Калуга": "клг", "Королёв": "korolyov", "Орёл": "orel oryol", "Череповец": "череп чрп", "Петрозаводск": "птз петрик",
    "Йошкар-Ола": "йошка й-ола ёшка",
}
# ---- Fixed values: words that frame a place.
BEFORE = r"(?:г\.?|гор\.?|город|городе|обл\.?|россия|рф|россии|russia|в|во|из|живу|нахожусь|отдам|забирать|забрать|самовывоз|доставка|продаю|центр|район|место|локация|адрес)"
AFTER = r"(?:сити|сіти|city|центр|город|24|36|и рядом|и область|рядом|торг|самовывоз|доставка|рф|россия|спросить.*|и окрестности|\d{1,3})"

_SPACE = re.compile(r"[\s\-–—_/\\.,;:()\"«»+|]+")
_PARENS = re.compile(r"\([^)]*\)|\[[^\]]*\]")
_TAIL = re.compile(r"\s*(?:;|/|\||\s[-–—]\s|\s+спросить\b).*$", re.I)
_FRAME_START = re.compile(rf"^(?:{BEFORE}(?:[\s/.,–—-]+|$))+", re.I)
_FRAME_END = re.compile(rf"(?:[\s/–—-]+{AFTER})+$", re.I)
_STREET = re.compile(r"(?<!\w)(?:ул|улица|пр-т|проспект|б-р|бульвар|пер|переулок|ш|шоссе|проезд|мкр|микрорайон|наб|пл|р-н|район|тц|метро|м|дом|д|кв|корп|станция|пгт|пос|село|дер|деревня)(?=[\s.]|$)", re.I)
_LATIN_WORD = re.compile(r"[a-z]", re.I)
_CYRILLIC = re.compile(r"[а-яё]", re.I)


def plain(text: str) -> str:
    """Lower case, one space between words, ё as е, composed letters."""
    return _SPACE.sub(" ", unicodedata.normalize("NFKC", text).lower().replace("ё", "е")).strip()


def latin(text: str) -> str:
    return "".join(LATIN.get(c, c) for c in text).replace("_", "")


def cyrillic(text: str) -> str:
    for lat, cyr in TO_CYRILLIC:
        text = text.replace(lat, cyr)
    return text


def case_forms(name: str) -> set[str]:
    """Locative, genitive and accusative of a plain name, word by word."""
    forms: list[list[str]] = [[], [], []]
    words = name.split()
    for i, w in enumerate(words):
        if w in ("на", "ола", "удэ") and len(words) > 1 and w == "на":
            loc = gen = acc = w
        elif w.endswith("ая"):
            loc, gen, acc = w[:-2] + "ой", w[:-2] + "ой", w[:-2] + "ую"
        elif w.endswith(("ий", "ый")):
            loc, gen, acc = w[:-2] + ("ем" if w.endswith("ий") else "ом"), w[:-2] + ("его" if w.endswith("ий") else "ого"), w
        elif w.endswith("ые"):
            loc = gen = w[:-2] + "ых"
            acc = w
        elif w.endswith("ы"):
            loc, gen, acc = w[:-1] + "ах", w[:-1], w
        elif w.endswith("а"):
            loc, gen, acc = w[:-1] + "е", w[:-1] + "ы", w[:-1] + "у"
        elif w.endswith("ия") or w in ("область",) or (w.endswith("ь") and not w.endswith(("авль", "ополь"))):
            loc, gen, acc = w[:-1] + "и", w[:-1] + "и", w
        elif w.endswith("ь"):
            loc, gen, acc = w[:-1] + "е", w[:-1] + "я", w
        elif w == "орел":
            loc, gen, acc = "орле", "орла", w
        elif w.endswith("ец"):
            loc, gen, acc = w[:-2] + "це", w[:-2] + "ца", w
        elif w.endswith(("и", "у", "э", "дону")) or (i < len(words) - 1 and len(words) > 1 and w in ("санкт", "улан", "йошкар")):
            loc = gen = acc = w
        elif w.endswith("о"):
            loc, gen, acc = w[:-1] + "е", w[:-1] + "а", w
        else:
            loc, gen, acc = w + "е", w + "а", w
        for form, value in zip(forms, (loc, gen, acc), strict=True):
            form.append(value)
    return {" ".join(f) for f in forms} - {name}


def distance(a: str, b: str, most: int) -> int:
    """Edit distance with transpositions, or ``most`` + 1 if it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            cost = min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y))
            if older and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, older[j - 2] + 1)
            row.append(cost)
        if min(row) > most:
            return most + 1
    return row[-1]


@lru_cache(1_000_000)
def letters(word: str) -> int:
    """The letters of a word as bits."""
    bits = 0
    for c in word:
        bits |= 1 << (ord(c) & 31)
    return bits


def grams(text: str) -> Counter:
    """Pairs and triples of characters, with the ends marked."""
    t = f"^{text}$"
    return Counter(t[i : i + n] for n in (2, 3) for i in range(len(t) - n + 1))


class Matcher:
    """Inverted index over the surface forms of a list and the decision of one value."""

    def __init__(self, entries: Iterable[tuple[int, str, list[str]]], threshold: float = 0.62, margin: float = 0.04) -> None:
        self.threshold, self.margin = threshold, margin
        self.exact: dict[str, int] = {}
        self.names: dict[int, str] = {}
        surfaces: dict[str, set[int]] = defaultdict(set)
        for key, name, aliases in entries:
            base = plain(name)
            self.names[key] = base
            known = [*aliases, *NICKNAMES.get(name, "").split()]
            if base.endswith(" область"):
                stem = base.rsplit(" ", 1)[0]
                known += [f"{stem} обл", f"{stem[:4]} обл", f"{latin(stem)} oblast", f"{latin(stem)} obl", f"{latin(stem)} region"]
            strong = {base, *case_forms(base), latin(base), latin(base).replace("iy", "y"), latin(base).replace("yy", "y"), latin(base).replace("iy", "iy")}
            for form in strong:
                surfaces[form].add(key)
            for form in (*strong, *map(plain, known)):
                self.exact.setdefault(form, key)
                self.exact.setdefault(form.replace(" ", ""), key)
        for form in [f for f, keys in surfaces.items() if len(keys) > 1]:
            del surfaces[form]
        self.surfaces = sorted((form, next(iter(keys))) for form, keys in surfaces.items())
        self.own = set(self.names.values())
        self.sorted_names = sorted((n, k) for k, n in self.names.items())
        self.by_letter: dict[str, list[tuple[int, str]]] = defaultdict(list)
        for n, k in self.sorted_names:
            self.by_letter[n[:1]].append((k, n))
        df = Counter(g for form, _ in self.surfaces for g in grams(form))
        self.idf = {g: math.log(1 + len(self.surfaces) / n) for g, n in df.items()}
        self.unknown = math.log(1 + len(self.surfaces)) if self.surfaces else 1.0
        self.postings: dict[str, list[tuple[int, float, int]]] = defaultdict(list)
        for i, (form, _) in enumerate(self.surfaces):
            counts = grams(form)
            norm = math.sqrt(sum((n * self.idf[g]) ** 2 for g, n in counts.items()))
            for g, n in counts.items():
                self.postings[g].append((i, n * self.idf[g] / norm, n if len(g) == 2 else 0))
        #: Most words of a name, and most letters that the wrong keyboard layout writes as commas, so that no longer piece can be one.
        self.most_words = max((len(form.split()) for form in (*self.exact, *(f for f, _ in self.surfaces))), default=1)
        self.most_commas = max((sum(c in "бю" for c in form) for form in (*self.exact, *(f for f, _ in self.surfaces))), default=0)
        self.seen: dict[str, int] = {}

    def variants(self, text: str) -> list[str]:
        """Readings of a plain text: as it is, look-alike letters, keyboard layout, Latin spelling."""
        if not _LATIN_WORD.search(text):
            return [text]
        if _CYRILLIC.search(text):
            return [text.translate(LOOKALIKE), text]
        return [text, cyrillic(text)]

    def score(self, text: str) -> dict[int, float]:
        """Best score of each entry for one reading."""
        counts = grams(text)
        weights = {g: n * self.idf.get(g, self.unknown) for g, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in weights.values())) or 1.0
        cosine: dict[int, float] = defaultdict(float)
        shared: dict[int, int] = defaultdict(int)
        for g, w in weights.items():
            n = counts[g]
            for i, v, m in self.postings.get(g, ()):
                cosine[i] += w * v / norm
                shared[i] += min(n, m)
        best: dict[int, float] = {}
        for i, c in cosine.items():
            form, key = self.surfaces[i]
            most = 1 if len(form) < 7 else 2 if len(form) < 12 else 3
            # a slip changes three pairs of letters at most, so forms that share fewer are farther away
            if len(form) >= 4 and abs(len(text) - len(form)) <= most and shared[i] > max(len(text), len(form)) - 3 * most and (d := distance(text, form, most)) <= most:
                c = max(c, 1 - d / (1.6 + 0.62 * len(form)))
            if form not in self.own:
                c *= 0.93  # a misspelt name is likelier than a misspelt case form
            best[key] = max(best.get(key, 0.0), c)
        return best

    def part(self, text: str) -> int:
        """Entry of one plain stretch of text, or 0."""
        if not text:
            return 0
        readings = self.variants(text)
        for reading in readings:
            if reading in self.exact:
                return self.exact[reading]
            if reading.replace(" ", "") in self.exact:
                return self.exact[reading.replace(" ", "")]
        if len(text) < 3:
            return 0
        best: dict[int, float] = {}
        for reading in readings:
            for key, c in self.score(reading).items():
                best[key] = max(best.get(key, 0.0), c)
        ranked = sorted(best.items(), key=lambda x: -x[1])
        if ranked and ranked[0][1] >= self.threshold and (len(ranked) < 2 or ranked[0][1] - ranked[1][1] >= self.margin):
            return ranked[0][0]
        return self.shortened(readings[0])

    def shortened(self, text: str) -> int:
        """Entry that a cut or contracted spelling ("сарат", "мах ла", "н новгород") fits alone, or 0."""
        if " " in text:
            head, tail = text.split(" ", 1)
            fits = {k for k, n in self.by_letter[head[:1]] if n.startswith(head) and n.endswith(tail) and len(head) + len(tail) >= 3 and len(n) > len(head) + len(tail) and " область" not in n}
        elif len(text) >= 4:
            first = bisect_left(self.sorted_names, (text,))  # names that begin with the text follow each other
            fits = {k for n, k in takewhile(lambda x: x[0].startswith(text), islice(self.sorted_names, first, None)) if len(n) > len(text)}
        else:
            fits = set()
        return fits.pop() if len(fits) == 1 else 0

    def typed(self, value: str) -> int:
        """Entry of a value as typed, or 0."""
        parts = value.split(",")
        layout = self._layout(value)
        if layout:
            return layout
        for part in parts:
            if found := self._framed(part):
                return found
        return 0

    def _layout(self, value: str) -> int:
        """Entry of a value typed with the wrong keyboard layout; its letters may be commas and semicolons."""
        if not _LATIN_WORD.search(value):
            return 0
        pieces = value.strip().lower().split(",")
        for start in range(len(pieces)):
            for end in range(start + 1, min(len(pieces), start + 1 + self.most_commas) + 1):
                piece = ",".join(pieces[start:end]).strip()
                if not piece or _CYRILLIC.search(piece) or plain(piece) in self.exact:
                    continue
                meant = plain(piece.translate(LAYOUT))
                if len(meant) >= 3 and (meant in self.exact or (len(meant) >= 6 and self._near(meant))):
                    return self.exact.get(meant) or self._near(meant)
        return 0

    def _near(self, text: str) -> int:
        best = self.score(text)
        ranked = sorted(best.items(), key=lambda x: -x[1])
        return ranked[0][0] if ranked and ranked[0][1] >= max(0.78, self.threshold) and (len(ranked) < 2 or ranked[0][1] - ranked[1][1] >= self.margin) else 0

    def _framed(self, part: str) -> int:
        core = _PARENS.sub(" ", part).strip()
        if _LATIN_WORD.search(core) and _CYRILLIC.search(core):
            core = core.translate(LOOKALIKE)
        if found := self.part(plain(core)):
            return found
        cut = _TAIL.sub("", core).strip() if not re.match(r"\s*(?:россия|рф|russia)\b", core, re.I) else core
        while True:
            shorter = _FRAME_END.sub("", _FRAME_START.sub("", cut)).strip()
            if shorter == cut:
                break
            cut = shorter
        if not cut or _STREET.search(cut):
            return 0
        if cut != core and (found := self.part(plain(cut))):
            return found
        # the name may be followed by anything: a telephone, an address, a person
        words = plain(cut).split()
        for n in range(min(self.most_words, len(words) - 1), 0, -1):
            for reading in self.variants(" ".join(words[:n])):
                if found := self.exact.get(reading) or (len(reading) > 3 and self._near(reading)):
                    return found
        return 0

    def match(self, value: object) -> int | None:
        if not isinstance(value, str) or not value.strip():
            return None
        # house numbers and the like vary without end; only short values are remembered
        found = self.seen.get(value)
        if found is None:
            found = self.typed(value)
            if len(value) <= 40:
                if len(self.seen) >= 100_000:
                    self.seen.clear()
                self.seen[value] = found
        return found


def load_entries(entries: DataFrame, key: str, name: str, aliases: str) -> list[tuple[int, str, list[str]]]:
    """The list on the driver; raises if it has more than ``MAX_ENTRIES`` rows."""
    rows = entries.where(F.col(key).isNotNull() & F.col(name).isNotNull()).select(key, name, aliases).orderBy(key).limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"the reference list has more than {MAX_ENTRIES} entries")
    return [(r[0], r[1], list(r[2] or [])) for r in rows]


def map_to_list(value: Column, entries: list[tuple[int, str, list[str]]], threshold: float = 0.62, margin: float = 0.04) -> Column:
    """Key of the list entry that ``value`` means: null for blank values, 0 for unmatched ones."""
    held: list[Matcher] = []

    def run(values: pd.Series) -> pd.Series:
        if not held:
            held.append(Matcher(entries, threshold, margin))
        codes, distinct = pd.factorize(values, use_na_sentinel=False)
        return pd.Series([held[0].match(v) for v in distinct], dtype="Int32").take(codes).reset_index(drop=True)

    return F.pandas_udf(run, T.IntegerType())(value)


def unmatched_report(mapped: DataFrame, value: str, key: str) -> DataFrame:
    """Values that mean no entry, with the number of their rows, most frequent first."""
    return mapped.where(F.col(key) == 0).groupBy(value).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), value)
