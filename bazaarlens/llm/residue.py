"""Problem 5: template residue, filler and error pages in place of a seller's words.

Two kinds of evidence are put together. Detectors know unfilled placeholders, filler, printed empty
values, error and blocking messages and script notices; they are row-local. The comparison knows no
wording at all: it compares the terms of address slug, title and body.

1. A title without any product term under a slug that has one is a mismatch. Mismatched titles of one
   wording that stand on several advertisements of a host are low-information responses.
2. Their terms, against those of the sentences under titles that do name their product, give each term a
   log-odds weight: how much likelier it is in a response of the site than in a seller's words.
3. Sentences of bodies that stand on several advertisements of a host and whose terms weigh
   ``least_weight`` on the average are responses too wherever they share no term with title and slug.
   Sellers' stock phrases repeat as often, but their terms weigh little.

All counts are over all rows, by partial aggregates; no wording and no host is gathered in one task.

Defined results: null and blank fields are never flagged; a missing address gives no comparison for
its row; one row for each flagged field, kind and evidence; repeated input rows give repeated
results of the detectors; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.session import cut_lineage, small_side

# ---- Fixed values: names of listing fields that a template may leave unfilled.
SLOTS = (
    "model storage price city color colour title name item user phone description condition battery seller location region address date "
    "id memory brand category currency link url image photo value text "
    "модель память цена город цвет имя состояние описание название заголовок батарея телефон продавец адрес район дата бренд марка категория ссылка фото"
).split()
# ---- Fixed values: filler, as whole sentences or comma-separated parts.
FILLER = (
    "placeholder", "sample text", "sample", "test description", "test", "todo", "tbd", "fixme", "lorem ipsum", "lorem ipsum dolor sit amet", "dummy text", "untitled", "no title", "your text here", "description here",
    "образец заполнения", "образец", "тест", "тестовое объявление", "тестовое описание", "дописать", "заполнить позже", "заполнить", "текст объявления", "текст", "опишите товар подробно", "опишите товар", "здесь будет описание",
    "здесь будет текст", "рыба-текст", "рыба текст", "бла-бла-бла", "бла бла бла", "заголовок объявления", "описание товара", "описание объявления", "без названия", "без заголовка", "без описания", "новое объявление",
    "новое объявление (копия)", "введите текст", "введите описание", "введите заголовок", "добавить описание", "черновик",
)
# ---- Fixed values: messages of sites, servers and programs.
STATUS = (
    "not found", "forbidden", "bad gateway", "gateway timeout", "gateway time-out", "service unavailable", "internal server error", "too many requests", "bad request", "unauthorized", "access denied", "request timed out",
    "страница не найдена", "доступ ограничен", "доступ запрещ[её]н", "сервер не отвечает", "внутренняя ошибка сервера", "слишком много запросов", "технические работы на сайте", "сервис временно недоступен", "сайт временно недоступен",
)
MESSAGES = (
    "connection reset by peer", "connection refused", "connection timed out", r"traceback \(most recent call last", "nullpointerexception", r"\b\w+exception\b[^.]{0,40}\bat line \d", "stack trace", "объявление снято с публикации",
    "объявление не найдено", "товар не найден или удал", "сессия истекла", "session (?:has )?expired", "не удалось загрузить", "failed to load", "что-то пошло не так", "something went wrong",
    "доступ с вашего адреса", "обновите страницу через", "проверка браузера", "checking your browser", r"подтвердите,? что вы (?:не робот|человек)", "verify (?:that )?you are (?:a )?human", r"вы (?:человек|не робот|робот)\?", "just a moment",
    "attention required", "request id:", "код запроса", r"\bhttp (?:error )?[45]\d\d\b", r"^(?:ошибка|error)\s*[:№#]?\s*[1-5]\d\d\b", r"(?:^|[.!\n]\s*)error \d{3}\b",
)
SCRIPT = r"(?:java ?script|\bjs\b|скрипт\w*|сценари\w*|scripts?\b|cookies?\b)"
SCRIPT_NOTICES = (
    rf"{SCRIPT} (?:is |are )?(?:required|disabled|turned off|blocked)",
    rf"{SCRIPT}[^.!?\n]{{0,20}} (?:отключен\w*|выключен\w*|заблокирован\w*)(?! не)",
    rf"(?:please )?(?:turn on|enable|allow|activate) (?:the )?(?:java ?script|js\b|скрипт|сценари|cookies?\b|scripts?\b)",
    rf"(?:\bвключите|необходимо включить|нужно включить|требуется включить|\bразрешите) (?:java ?script|js\b|скрипт|сценари|cookies?\b|scripts?\b)",
    rf"(?:сайт|страница) не работает без {SCRIPT}",
    rf"(?:page|site|website|app) (?:needs|requires) {SCRIPT}",
    rf"browser does(?: not|n't) support {SCRIPT}",
    rf"браузер не поддерживает {SCRIPT}",
    r"turn off your (?:ad ?)?blocker", r"разрешите и обновите страницу",
)
EMPTY = r"(?:null|none|nan|nil|undefined|#n/a|#н/д|#ссылка!|#ref!|#знач!|#value!|\[object object\])"
LABELS = r"(?:iphone|apple|память|цвет|состояние|батарея|цена|город|модель|описание|название|продавец|телефон|storage|colou?r|condition|battery|price|city|model|title)"

_SLOT = "|".join(sorted(map(re.escape, SLOTS), key=len, reverse=True))
_PATH = rf"(?:(?:{_SLOT})(?:[._](?:{_SLOT}))*|[a-z]+(?:[._][a-z]+)+)"
_ANY = r"[\w.:|' -]+?"
_PLACEHOLDER = re.compile(
    rf"\{{\{{[^{{}}\n]*\w[^{{}}\n]*\}}\}}|\{{%[^%\n]*\w[^%\n]*%\}}|<%[^%\n]*\w[^%\n]*%>|\$\{{[^{{}}\n]*\w[^{{}}\n]*\}}|@@{_ANY}@@|(?<!\w)__[^\W_]{_ANY}__(?!\w)|\[\[[^\[\]\n]*\w[^\[\]\n]*\]\]|<<\s*{_PATH}\s*>>"
    rf"|\{{\d+:[^{{}}\n]+\}}|\[(?:вставьте|insert|укажите|введите)[: ][^\]\n]+\]"
    rf"|\{{\s*{_PATH}\s*\}}|\[\s*{_PATH}\s*\]|<\s*{_PATH}\s*>|#{_PATH}#|%{_PATH}%|(?<!\w):{_PATH}:(?!\w)|\$(?:{_PATH})\b",
    re.I,
)
_PLACEHOLDER_START = re.compile(r"[{\[<@%$#_]|:\w+[\w.]*:")
_MESSAGE = re.compile("|".join(rf"\b(?:{s})" for s in STATUS) + "|" + "|".join(MESSAGES), re.I)
_SCRIPT = re.compile("|".join(SCRIPT_NOTICES), re.I | re.M)
_LOADING = re.compile(r"(?:^|[.!?\n]\s*)(?:loading|загрузка|please wait|подождите)\s*(?:…|\.{2,})\s*$", re.I)
_EMPTY_WHOLE = re.compile(rf"^\W*(?:(?:{LABELS}|гб|gb)\W+)*{EMPTY}(?:\W+(?:{EMPTY}|{LABELS}|гб|gb)|%)*\W*$", re.I)
_EMPTY_LABEL = re.compile(rf"\b{LABELS}\s*[:—=-]?\s*{EMPTY}(?![\w'])|#n/a|#ссылка!|#ref!|#value!|#знач!|\[object object\]|\bundefined\s*(?:гб|gb|%)|\b(?:null|none|nan|nil)\s*(?:гб|gb|%)", re.I)
_FILLER = re.compile("|".join(map(re.escape, sorted(FILLER, key=len, reverse=True))) + r"|qwe\w*|asd\w*|zxc\w*|фыв\w*|йцу\w*|ячс\w*|1q2\w*|xxx+|ааа+")
_FILLER_PART = re.compile(rf"^(?:(?:{_FILLER.pattern})(?!\w)[\W_]*)+\d*$")
_PART = re.compile(r"[.!?;,…]+(?:\s+|$)|\n+")
# ---- Fixed values: terms of the products that are sold here.
PRODUCT = r"(?iU)[ij1l]?\s*-?phone|айфон|ифон|apple|смартфон|телефон|\b(?:xr|xs|se)\b|\b\d{1,2}\s*(?:pro|про|plus|плюс|mini|мини)\b"

#: One of these stands in every text that a message, script, filler or empty-value detector can match.
TRIGGERS = (
    "not found forbidden gateway unavailable|server error|too many|bad request|unauthorized|denied|timed out|не найден|ограничен|запрещ|не отвечает|ошибка|error|много запросов|работы на сайте|недоступен|connection|traceback|exception|stack trace|"
    "снято с|не найдено|сессия|session|не удалось|failed to|пошло не так|went wrong|вашего адреса|обновите страницу|проверка браузера|your browser|подтвердите|verify|вы человек|вы не робот|вы робот|moment|attention|request id|код запроса|http |"
    "script|скрипт|сценари|js|cookie|blocker|null|none|nan|nil|undefined|#n/a|#н/д|#ссылка|#ref|#value|#знач|object|loading|загрузка|please wait|подождите"
).replace("not found forbidden gateway unavailable", "not found|forbidden|gateway|unavailable").split("|")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word in TRIGGERS:
        found.add_word(word, 1)
    for word in (*FILLER, *"qwe asd zxc фыв йцу ячс 1q2 xxx ааа".split()):
        found.add_word(word, 2)
    found.make_automaton()
    return found


_AUTOMATON = _automaton()


def detect(text: str) -> set[str]:
    """Kinds of residue that the detectors find in one text."""
    kinds: set[str] = set()
    if _PLACEHOLDER_START.search(text) and _PLACEHOLDER.search(text):
        kinds.add("placeholder")
    low = text.lower()
    hits = {value for _, value in _AUTOMATON.iter(low)}
    if 1 in hits:
        if _MESSAGE.search(low) or _LOADING.search(low):
            kinds.add("message")
        if _SCRIPT.search(low):
            kinds.add("script_notice")
        if _EMPTY_WHOLE.search(low) or _EMPTY_LABEL.search(low):
            kinds.add("printed_empty")
    if 2 in hits:
        for part in _PART.split(low):
            if _FILLER_PART.match(part.strip(" .!?…")):
                kinds.add("filler")
                break
    return kinds


def _plain(text: Column) -> Column:
    """Lower case, figures as 0, one blank between the words of a line."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"\d+", "0"), r"(?U)[^\S\n]+", " ")


def _trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(" .!?;…\n\r\t"))


def _terms(text: Column) -> Column:
    """Distinct words of two letters or more."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}{2,}"), F.lit(0)))


def _detected(rows: DataFrame) -> DataFrame:
    """What the detectors find: id, field_name, kind."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, title, body in zip(batch["id"], batch["title"], batch["body"], strict=True):
                for field_name, text in (("title", title), ("description", body)):
                    if text and not text.isspace():
                        out.extend((key, field_name, kind) for kind in detect(text))
            yield pd.DataFrame(out, columns=["id", "field_name", "kind"])

    return rows.select("id", "title", "body").mapInPandas(run, f"id {rows.schema['id'].dataType.simpleString()}, field_name string, kind string")


def _compared(rows: DataFrame, least_copies: int, least_weight: float) -> DataFrame:
    """What the comparison of slug, title and body finds: id, field_name, kind."""
    url = F.coalesce(F.trim("url"), F.lit(""))
    base = rows.select(
        "id", "title", "body", F.lower(F.regexp_extract(url, r"^[A-Za-z]+://([^/?#]+)", 1)).alias("host"), F.lower(F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]+/?([^?#]*)", 1)).alias("slug"), F.coalesce(F.col("title").rlike(PRODUCT), F.lit(False)).alias("named"),
    )
    counts = [F.count("*").alias("n"), F.min("slug").alias("first"), F.max("slug").alias("last")]
    repeated = (F.col("n") >= least_copies) & (F.col("first") != F.col("last"))
    titles = cut_lineage(base.where(~F.col("named") & F.col("title").rlike(r"(?U)\S") & F.col("slug").rlike(PRODUCT)).select("id", "host", "slug", _trimmed(_plain(F.col("title"))).alias("wording")))  # the few mismatched ones
    responses = cut_lineage(titles.groupBy("host", "wording").agg(*counts).where(repeated))
    by_title = titles.join(small_side(responses), ["host", "wording"], "left_semi").select("id", F.lit("title").alias("field_name"), F.lit("mismatch").alias("kind"))
    total = responses.agg(F.sum("n")).first()[0]
    if not total:
        return by_title

    spoken = base.where(F.col("body").isNotNull()).select("id", "host", "slug", "title", "named", F.explode(F.split(_plain(F.col("body")), r"[.!?;…]+\s+|\n+")).alias("wording")).withColumn("wording", _trimmed(F.col("wording"))).where(F.length("wording") > 1)
    # the distinct sentences of each host: everything below but the last step is taken from them
    sentences = cut_lineage(spoken.groupBy("host", "wording").agg(*counts, F.count_if("named").alias("by_sellers")))
    terms = F.explode(_terms(F.col("wording"))).alias("term")
    said = responses.select("n", terms).groupBy("term").agg(F.sum("n").alias("p"))
    usual = sentences.where("by_sellers > 0").select("by_sellers", terms).groupBy("term").agg(F.sum("by_sellers").alias("q"))
    sellers = base.agg(F.count_if(F.col("named") & F.col("body").isNotNull())).first()[0]
    even = 1.0 / (total + 1)  # what a term that never occurs counts for
    weight = F.log((F.coalesce("p", F.lit(0)) * even + even) / (F.coalesce("q", F.lit(0)) / float(sellers + 1) + even))
    open_ones = sentences.where(repeated & (F.col("host") != "")).select("host", "wording", terms)
    weighed = open_ones.join(small_side(said), "term", "left").join(usual, "term", "left").groupBy("host", "wording").agg(F.avg(weight).alias("weight"))
    found = cut_lineage(weighed.where(F.col("weight") >= least_weight).select("host", "wording", "weight"))
    strange = ~F.arrays_overlap(F.array_union(_terms(F.coalesce("title", F.lit(""))), _terms(F.col("slug"))), _terms(F.col("wording")))
    # bound to a column of the found sentences, so that it is not tried on all others before the join
    by_body = spoken.join(small_side(found), ["host", "wording"]).where(F.when(F.col("weight").isNotNull(), strange)).select("id", F.lit("description").alias("field_name"), F.lit("response_terms").alias("kind")).distinct()
    return by_title.unionByName(by_body)


def flag_fields(rows: DataFrame, id_col: str, title_col: str, body_col: str, url_col: str, least_copies: int = 3, least_weight: float = 1.25) -> DataFrame:
    """Columns id, field_name, kind, evidence ('detector' or 'comparison')."""
    plain = rows.select(F.col(id_col).alias("id"), F.col(title_col).alias("title"), F.col(body_col).alias("body"), F.col(url_col).alias("url"))
    sure = _detected(plain).withColumn("evidence", F.lit("detector"))
    compared = _compared(plain, least_copies, least_weight).withColumn("evidence", F.lit("comparison"))
    return sure.unionByName(compared).select(F.col("id").alias(id_col), "field_name", "kind", "evidence")


def exclude(rows: DataFrame, id_col: str, title_col: str, body_col: str, url_col: str, least_copies: int = 3) -> DataFrame:
    """``rows`` without those that have residue in a field."""
    flagged = flag_fields(rows, id_col, title_col, body_col, url_col, least_copies).select(id_col).distinct()
    return rows.join(flagged, id_col, "left_anti")
