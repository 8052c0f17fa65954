"""Number, date, address, JSON, array and map functions as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(c: Column) -> Column:
    """Trim white space of any kind, as opposed to blanks alone."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def as_text(c: Column) -> Column:
    """Trimmed text, null as the empty text."""
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def as_whole(c: Column) -> Column:
    """A whole number from a number or its text; anything else is null."""
    text = strip(c.cast("string"))
    number = F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))
    return F.when((F.abs(number) < 9.0e18) & (number == F.floor(number)), number.cast("bigint"))


def within(c: Column, low: float, high: float) -> Column:
    return F.when(c.between(low, high), c)


def one_of(c: Column, values: Sequence) -> Column:
    return F.when(c.isin(list(values)), c)


def half_even(c: Column, step: float = 1.0) -> Column:
    """Nearest multiple of ``step``, halves to the even one."""
    return F.bround(c / step, 0) * step


def percent_delta(asked: Column, fair: Column) -> Column:
    """Deviation in percent; null where the fair value is not positive."""
    return F.when(fair > 0, (asked - fair) / fair * 100)


def classify_delta(delta: Column, threshold: float, below: str = "great_deal", above: str = "overpriced", between: str = "fair") -> Column:
    """Boundaries count as in between."""
    return F.when(delta < -threshold, below).when(delta > threshold, above).when(delta.isNotNull(), between)


def inner_range(low: Column, high: Column, step: int = 100) -> tuple[Column, Column]:
    """The widest range of multiples of ``step`` inside low..high, after rounding to two places."""
    return F.ceil(F.bround(low, 2) / step) * step, F.floor(F.bround(high, 2) / step) * step


def whole_months(start: Column, end: Column) -> Column:
    """Whole months from start to end, never negative; the day of the month must be reached."""

    def months(d: Column) -> Column:
        a, b = d.getField("a"), d.getField("b")
        return F.greatest((F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a) - F.when(F.dayofmonth(b) < F.dayofmonth(a), 1).otherwise(0), F.lit(0))

    return F.when(start.isNotNull() & end.isNotNull(), let(F.struct(start.cast("date").alias("a"), end.cast("date").alias("b")), months))


def utc_micros(text: Column) -> Column:
    """Microseconds since 1970 of an ISO-8601 time in basic or extended form; no offset means UTC; unreadable is null."""
    t = strip(text)
    t = F.regexp_replace(t, r"^(\d{4})(\d{2})(\d{2})(?=$|[T ])", "$1-$2-$3")
    t = F.regexp_replace(t, r"^(\d{4}-\d{2}-\d{2})[T ](\d{2})(\d{2})(\d{2})?(?=$|[^\d:])", "$1T$2:$3:$4")
    t = F.regexp_replace(t, r"^(.{16}):?(?=$|[^\d:])", "$1:00")
    t = F.regexp_replace(t, r"(\d{2}:\d{2}\S*[+-]\d{2})(\d{2})$", "$1:$2")
    t = F.regexp_replace(t, r"(\d),(\d)", "$1.$2")
    t = F.regexp_replace(t, r"^(\d{4}-\d{2}-\d{2})$", "$1T00:00:00Z")
    t = F.regexp_replace(t, r"^(.{11}\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?)$", "$1Z")
    return let(t, lambda t: F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"), F.unix_micros(t.try_cast("timestamp"))))


def iso_date(text: Column, reference: Column) -> Column:
    """UTC date of an ISO-8601 text, whatever the zone of the session; unreadable ones give the reference date."""
    days = F.floor(utc_micros(text) / 86_400_000_000).cast("int")
    return F.coalesce(F.date_add(F.lit("1970-01-01").cast("date"), days), reference)


def storage_label(gb: Column) -> Column:
    """Marketing label of a capacity."""
    return F.when((gb >= 1024) & (gb % 1024 == 0), F.concat((gb / 1024).cast("bigint").cast("string"), F.lit("TB"))).otherwise(F.concat(gb.cast("string"), F.lit("GB")))


def money(c: Column) -> Column:
    """Thousands separators, no decimals, halves to even."""
    return F.format_number(c, 0)


# ---- addresses


def canonical_url(url: Column, base: str = "") -> Column:
    """Absolute address without query and fragment."""
    cut = F.regexp_replace(url, r"[#?].*$", "")
    return F.when(cut.startswith("/"), F.concat(F.lit(base), cut)).otherwise(cut)


def url_tail_number(url: Column) -> Column:
    """The number of six digits or more that ends the path after an underscore."""
    return F.nullif(F.regexp_extract(F.regexp_replace(url, r"[#?].*$", ""), r"_(\d{6,})/?$", 1), F.lit(""))


def url_origin(url: Column, default: str) -> Column:
    """Scheme and host, or a default."""
    found = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(default))


def search_url(base: str, region: Column, query: Column) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), region, F.lit("?q="), F.url_encode(query))


def page_url(url: Column, page: Column) -> Column:
    """``url`` with its page parameter replaced; page 1 has none; the other parameters stay in order."""
    base = F.regexp_replace(url, r"[?#].*$", "")
    query = F.regexp_replace(F.regexp_extract(url, r"\?([^#]*)", 1), r"#.*$", "")
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^p(=|$)"))
    parts = F.when(page > 1, F.array_append(kept, F.concat(F.lit("p="), page.cast("string")))).otherwise(kept)
    return F.when(F.size(parts) > 0, F.concat(base, F.lit("?"), F.array_join(parts, "&"))).otherwise(base)


# ---- JSON and maps


def params_map(json: Column) -> Column:
    """JSON object as a map of texts; anything else gives the empty map."""
    return F.coalesce(F.from_json(json, "map<string,string>"), F.create_map().cast("map<string,string>"))


def params_text(params: Column) -> Column:
    """Lines of 'key: value'."""
    return F.array_join(F.transform(F.map_entries(params), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("")))), "\n")


def find_param(params: Column, candidates: Sequence[str], normal) -> Column:  # noqa: ANN001
    """Value whose normalised key equals a candidate, else the first key that contains one, in candidate order."""
    entries = F.transform(F.map_entries(params), lambda e: F.struct(F.regexp_replace(normal(e["key"]), ":+$", "").alias("k"), e["value"].alias("v")))
    def equal(name: str) -> Column:
        found = F.filter(entries, lambda e: e["k"] == name)
        return F.get(found, F.size(found) - 1)["v"]

    def part(name: str) -> Column:
        return F.get(F.filter(entries, lambda e: e["k"].contains(name)), F.lit(0))["v"]

    return F.coalesce(*map(equal, candidates), *map(part, candidates))


def first_wins_map(entries: Column) -> Column:
    """Map of an array of (key, value) structs in which the first value of a key stays."""
    empty = F.array().cast("array<struct<key:string,value:string>>")
    kept = F.aggregate(entries, empty, lambda acc, e: F.when(F.exists(acc, lambda a: a["key"] == e["key"]), acc).otherwise(F.array_append(acc, e)))
    return F.map_from_entries(kept)
