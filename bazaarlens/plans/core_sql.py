"""SQL equivalents of the core queries, for the independent check."""

from __future__ import annotations

from bazaarlens.plans.fill_queries import P4_SQL

#: White space of any script, which the regular expressions of the checking engine do not know as such.
_S = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_SH = r"[\t\r\f\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000} ]"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_S}+|{_S}+$', '', 'g')"


def _normal(c: str) -> str:
    low = f"lower(translate(coalesce({c}, ''), 'ёЁ', 'еЕ'))"
    return _strip(f"regexp_replace(regexp_replace({low}, '{_SH}+', ' ', 'g'), '{_S}*\\n{_S}*', chr(10), 'g')")


def _levels(table: str, value: str, levels: list[tuple[str, ...]], least: int) -> str:
    """CTE with the statistics of the first level that has enough rows."""
    parts = []
    for i, keys in enumerate(levels):
        over = f"OVER (PARTITION BY {', '.join(keys)})"
        parts += [f"count(*) {over} AS n{i}", f"quantile_cont({value}, 0.25) {over} AS a{i}", f"quantile_cont({value}, 0.5) {over} AS m{i}", f"quantile_cont({value}, 0.75) {over} AS z{i}"]
    pick = lambda c: "CASE " + " ".join(f"WHEN n{i} >= {least} THEN {c if c.isdigit() else c + str(i)}" for i in range(len(levels))) + " END"
    level = "CASE " + " ".join(f"WHEN n{i} >= {least} THEN {i}" for i in range(len(levels))) + " END"
    return f"leveled AS (SELECT *, {', '.join(parts)} FROM {table}), stats AS (SELECT *, {level} AS stat_level, {pick('n')} AS stat_n, {pick('a')} AS q1, {pick('m')} AS med, {pick('z')} AS q3 FROM leveled)"


_SCORED = """
scored AS (
  SELECT (('0x' || substr(md5(l_orderkey::VARCHAR || ':42'), 1, 8))::BIGINT % 5)::INT AS fold, l_extendedprice AS y, p_retailprice * l_quantity AS a, l_quantity * 1500 AS b
  FROM lineitem JOIN part ON l_partkey = p_partkey)
"""
_KEY = f"lower(regexp_replace({_strip('model')}, '{_S}+', ' ', 'g'))"
_MONTHS = "greatest((year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate) - CASE WHEN day(l_shipdate) < day(o_orderdate) THEN 1 ELSE 0 END, 0)"

#: Time of capture in UTC, basic form made extended, no offset read as UTC.
_UTC = r"""
regexp_replace(trim(scraped_at), '^([0-9]{4})([0-9]{2})([0-9]{2})T([0-9]{2})([0-9]{2})([0-9]{2})', '\1-\2-\3T\4:\5:\6') AS t
"""
_DAY = "coalesce(((try_cast(CASE WHEN regexp_matches(t, '(Z|[+-][0-9]{2}:?[0-9]{2})$') AND regexp_matches(t, '[0-9]:[0-9]{2}') THEN t ELSE t || 'Z' END AS TIMESTAMPTZ)) AT TIME ZONE 'UTC')::DATE, DATE '2026-09-01')"

SQL: dict[str, str] = {
    **P4_SQL,
    "listing_ages": f"""
WITH t AS (SELECT listing_row, model, {_UTC} FROM raw_listings), d AS (SELECT listing_row, model, {_DAY} AS day FROM t)
SELECT listing_row, day::VARCHAR AS day, CASE WHEN release_date IS NOT NULL THEN greatest((year(day) - year(release_date)) * 12 + month(day) - month(release_date) - CASE WHEN day(day) < day(release_date) THEN 1 ELSE 0 END, 0)::INT END AS phone_age_months
FROM d LEFT JOIN phone_catalog ON {_KEY} = lower(name)
""",
    "hier_iqr_outliers": f"""
WITH rows_ AS (SELECT *, ln(l_extendedprice) AS v FROM lineitem), {_levels("rows_", "v", [("l_partkey", "l_returnflag", "l_linestatus"), ("l_partkey", "l_returnflag"), ("l_partkey",)], 10)}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, stat_level, stat_n, round(med, 6) AS stat_median FROM stats
WHERE v < q1 - greatest(q3 - q1, 0.05) OR v > q3 + greatest(q3 - q1, 0.05)
""",
    "group_levels": f"""
WITH rows_ AS (SELECT model, storage_gb, condition, ln(price) AS v FROM clean_listings WHERE price > 0), {_levels("rows_", "v", [("model", "storage_gb", "condition"), ("model", "condition"), ("model",)], 10)}
SELECT coalesce(stat_level, -1) AS stat_level, count(*) AS n, round(avg(med), 6) AS mean_median, sum(stat_n)::BIGINT AS sum_n FROM stats GROUP BY 1
""",
    "cheap_vs_group_median": f"""
WITH rows_ AS (SELECT o_orderkey, o_totalprice, c_mktsegment, o_orderpriority, ln(o_totalprice) AS v FROM orders JOIN customer ON o_custkey = c_custkey), {_levels("rows_", "v", [("c_mktsegment", "o_orderpriority"), ("c_mktsegment",)], 10)}
SELECT o_orderkey, o_totalprice, c_mktsegment, o_orderpriority, round(exp(med), 2) AS usual FROM stats WHERE exp(v - med) < 0.3
""",
    "rule_cascade_report": """
WITH r AS (SELECT CASE WHEN o_orderstatus <> 'F' THEN 1 WHEN o_totalprice < 20000 THEN 2 WHEN o_totalprice > 400000 THEN 3 WHEN o_orderpriority LIKE '1%' THEN 4 WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 5 ELSE 6 END AS position FROM orders)
SELECT position::BIGINT AS position, ['not_final', 'low_price', 'high_price', 'urgent', 'late', 'kept'][position] AS rule, count(*) AS rows FROM r GROUP BY position
""",
    "impute_group_median": """
WITH r AS (SELECT event_id, event_type, CASE WHEN event_id % 7 <> 0 THEN trunc(value)::BIGINT END AS v FROM events),
m AS (SELECT event_type, quantile_cont(v::DOUBLE, 0.5) AS med FROM r GROUP BY event_type)
SELECT event_id, event_type, coalesce(v, round_even(med, 0)::BIGINT) AS value, (v IS NOT NULL)::BIGINT AS value_known FROM r JOIN m USING (event_type)
""",
    "dedup_cascade": """
WITH a AS (SELECT *, CASE WHEN trim(item_id, ' ') <> '' AND row_number() OVER (PARTITION BY trim(item_id, ' ') ORDER BY listing_row) > 1 THEN 'item_id' END AS r1 FROM raw_listings),
b AS (SELECT *, CASE WHEN r1 IS NULL AND trim(listing_url, ' ') <> '' AND row_number() OVER (PARTITION BY r1 IS NULL, trim(listing_url, ' ') ORDER BY listing_row) > 1 THEN 'listing_url' END AS r2 FROM a),
c AS (SELECT *, CASE WHEN r1 IS NULL AND r2 IS NULL AND length(title) >= 10 AND row_number() OVER (PARTITION BY r1 IS NULL AND r2 IS NULL, title, price ORDER BY listing_row) > 1 THEN 'content' END AS r3 FROM b)
SELECT listing_row, coalesce(r1, r2, r3) AS drop_reason FROM c
""",
    "content_fingerprint_dedup": f"""
WITH p AS (SELECT listing_row, trim(substr(regexp_replace({_normal("description")}, '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'), 1, 200), ' ') AS print FROM raw_listings)
SELECT print, min(listing_row) AS listing_row, count(*) AS copies FROM p WHERE length(print) >= 30 GROUP BY print
""",
    "normalize_text": f"SELECT listing_row, {_normal('title')} AS title, md5({_normal('description')}) AS description_md5 FROM raw_listings",
    "json_params_lookup": """
WITH j AS (SELECT listing_row, CASE WHEN json_valid(params) AND json_type(params::JSON) = 'OBJECT' THEN params::JSON END AS p FROM raw_listings)
SELECT listing_row, json_extract_string(p, '$."Модель"') AS model,
  coalesce(json_extract_string(p, '$."Память"'), json_extract_string(p, '$."Встроенная память"')) AS memory, coalesce(len(json_keys(p)), 0)::INT AS keys FROM j
""",
    "url_canonical": """
SELECT listing_row, regexp_replace(listing_url, '[#?].*$', '') AS url, nullif(regexp_extract(regexp_replace(listing_url, '[#?].*$', ''), '_([0-9]{6,})/?$', 1), '') AS tail,
  coalesce(nullif(regexp_extract(listing_url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1), ''), 'https://board.example') AS origin,
  regexp_replace(listing_url, '[#?].*$', '') || '?' || array_to_string(list_append(list_filter(string_split(regexp_extract(listing_url, '\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^p(=|$)')), 'p=3'), '&') AS page_3
FROM raw_listings WHERE listing_url IS NOT NULL
""",
    "html_item_pages": "SELECT c_custkey AS page_id, c_name AS title, trunc(abs(c_acctbal))::BIGINT AS price, 'a' || chr(10) || c_mktsegment AS description, c_mktsegment AS key, FALSE AS is_block FROM customer",
    "html_search_pages": "SELECT s_nationkey AS page_id, TRUE AS has_next, (s_suppkey + 1000000)::VARCHAR AS item_id, 'https://board.example/x_' || (s_suppkey + 1000000) AS url, s_name AS title, 1000::BIGINT AS price FROM supplier",
    "months_elapsed": f"SELECT {_MONTHS}::INT AS months, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1",
    "catalog_lookup": f"SELECT coalesce(tier, '__other__') AS tier, year(release_date)::INT AS year, count(*) AS n FROM clean_listings LEFT JOIN phone_catalog ON {_KEY} = lower(name) GROUP BY 1, 2",
    "option_membership": f"""
SELECT model, list_contains(storage_options, storage_gb::INT) AS offered, list_position(storage_options, storage_gb::INT)::BIGINT - 1 AS step, count(*) AS n FROM clean_listings JOIN phone_catalog ON {_KEY} = lower(name) WHERE storage_gb IS NOT NULL GROUP BY 1, 2, 3
""",
    "catalog_storages": "SELECT DISTINCT s AS storage_gb, CASE WHEN s >= 1024 AND s % 1024 = 0 THEN (s // 1024)::VARCHAR || 'TB' ELSE s::VARCHAR || 'GB' END AS label FROM (SELECT unnest(storage_options) AS s FROM phone_catalog)",
    "builtin_catalog": "SELECT name FROM phone_catalog",
    "resume_append": """
SELECT user_id::VARCHAR AS user, min(event_id) AS event_id FROM events WHERE event_id % 2 = 0 AND user_id NOT IN (SELECT user_id FROM events WHERE event_id % 97 = 1 AND user_id IS NOT NULL) GROUP BY 1
""",
    "first_capture": "SELECT arg_min(listing_row, listing_row) AS listing_row, listing_url, arg_min(struct_pack(t := title), listing_row).t AS title FROM raw_listings WHERE listing_url IS NOT NULL GROUP BY listing_url",
    "frequent_categories": """
WITH r AS (SELECT c_custkey, n_name, count(*) OVER (PARTITION BY n_name) AS k, count(*) OVER () AS all_ FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT CASE WHEN k >= all_ // 25 THEN n_name ELSE '__other__' END AS n_name, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM r GROUP BY 1
""",
    "default_category": "SELECT region FROM clean_listings WHERE region IS NOT NULL AND region <> 'Неизвестно' GROUP BY region ORDER BY count(*) DESC, region LIMIT 1",
    "value_counts": "SELECT region AS value, count(*) AS rows FROM clean_listings WHERE region IS NOT NULL GROUP BY region HAVING count(*) >= 10",
    "regression_metrics": f"WITH {_SCORED} SELECT round(sqrt(avg((y - a) * (y - a))), 4) AS rmse, round(avg(abs(y - a)), 4) AS mae, round(avg(abs(y - a) / y) * 100, 4) AS mape FROM scored",
    "fold_metrics": f"WITH {_SCORED} SELECT fold, count(*) AS n, round(sqrt(avg((y - a) * (y - a))), 4) AS rmse, round(avg(abs(y - a)), 4) AS mae, round(avg(abs(y - a) / y) * 100, 4) AS mape FROM scored GROUP BY fold",
    "model_selection": f"""
WITH {_SCORED}, m AS (SELECT fold, 0 AS ordinal, avg(abs(y - a) / y) * 100 AS mape FROM scored GROUP BY fold UNION ALL SELECT fold, 1, avg(abs(y - b) / y) * 100 FROM scored GROUP BY fold)
SELECT ordinal, round(avg(mape), 3) AS mape_mean FROM m GROUP BY ordinal ORDER BY avg(mape), ordinal LIMIT 1
""",
    "delta_classes": f"""
WITH {_SCORED}, d AS (SELECT *, (y - a) / a * 100 AS d FROM scored)
SELECT CASE WHEN d < -10 THEN 'great_deal' WHEN d > 10 THEN 'overpriced' ELSE 'fair' END AS verdict, count(*) AS n, round(avg(round_even(y / 500, 0) * 500), 3) AS mean_rounded FROM d GROUP BY 1
""",
    "prices_read": f"""
WITH t AS (SELECT listing_row, {_strip("price")} AS p FROM raw_listings), n AS (SELECT *, CASE WHEN regexp_full_match(p, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN try_cast(p AS DOUBLE) END AS x,
  try_cast(replace(regexp_extract(regexp_replace(p, '{_SH}+', ' ', 'g'), '[0-9][0-9 ]*'), ' ', '') AS BIGINT) AS d FROM t)
SELECT listing_row, CASE WHEN x IS NOT NULL THEN CASE WHEN x > 0 THEN round_even(x, 0)::BIGINT END WHEN d > 0 THEN d END AS price FROM n
""",
    "regions_read": f"""
WITH h AS (SELECT listing_row, {_strip("string_split_regex(" + _strip("coalesce(location, '')") + ", '[,;\\n]')[1]")} AS h FROM raw_listings),
t AS (SELECT listing_row, trim(regexp_replace(regexp_replace(h, '^(?i:г\\.|город{_S}){_S}*', ''), '{_S}+', ' ', 'g'), ' ') AS h FROM h)
SELECT listing_row, CASE WHEN h = '' OR regexp_matches(lower(h), '^(?:м\\.|метро|р-н|район|ул\\.|улица|пр-т|проспект|пр\\.|пер\\.|ш\\.|шоссе|мкр|д\\.)|[0-9]') THEN 'Неизвестно'
  ELSE coalesce(map {{'мск': 'Москва', 'москва': 'Москва', 'спб': 'Санкт-Петербург', 'питер': 'Санкт-Петербург', 'санкт-петербург': 'Санкт-Петербург', 'екб': 'Екатеринбург', 'нск': 'Новосибирск'}}[replace(lower(h), 'ё', 'е')], upper(h[1:1]) || h[2:]) END AS region FROM t
""",
    "numbers_read": f"""
WITH t AS (SELECT listing_row, battery_health, {_strip("item_id")} AS i FROM raw_listings), n AS (SELECT *, CASE WHEN regexp_full_match(i, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN try_cast(i AS DOUBLE) END AS x FROM t)
SELECT listing_row, CASE WHEN battery_health BETWEEN 40 AND 100 THEN battery_health::BIGINT END AS battery, CASE WHEN abs(x) < 9e18 AND x = floor(x) THEN x::BIGINT END AS number FROM n
""",
    "features_of_listings": f"""
SELECT item_id, model, coalesce(tier, '__other__') AS model_tier, CASE WHEN storage_gb >= 1024 AND storage_gb % 1024 = 0 THEN (storage_gb // 1024)::VARCHAR || 'TB' ELSE storage_gb::VARCHAR || 'GB' END AS storage, condition, coalesce(region, 'Неизвестно') AS region,
  storage_gb::DOUBLE AS storage_gb, battery_health::DOUBLE AS battery_health, battery_known::DOUBLE AS battery_known, phone_age_months::DOUBLE AS phone_age_months, has_box::DOUBLE AS has_box, has_receipt::DOUBLE AS has_receipt
FROM clean_listings LEFT JOIN phone_catalog ON {_KEY} = lower(name)
""",
}

SQL["valuations"] = f"""
WITH prices AS ({SQL["prices_read"]}), regions AS ({SQL["regions_read"]}),
seen AS (SELECT c.*, year(release_date) AS y FROM clean_listings c LEFT JOIN phone_catalog ON {_KEY} = lower(name) WHERE battery_health BETWEEN 40 AND 100),
used AS (SELECT * FROM seen WHERE battery_known = 1 AND condition <> 'new'),
years AS (SELECT y, quantile_cont(battery_health::DOUBLE, 0.5) AS med FROM used WHERE y IS NOT NULL GROUP BY y),
usual AS (SELECT coalesce((SELECT quantile_cont(battery_health::DOUBLE, 0.5) FROM used), 90.0) AS med, (SELECT region FROM seen WHERE region IS NOT NULL AND region <> 'Неизвестно' GROUP BY region ORDER BY count(*) DESC, region LIMIT 1) AS region),
fair AS (SELECT {_KEY} AS k, quantile_cont(price::DOUBLE, 0.5) AS fair FROM clean_listings WHERE model IS NOT NULL AND price > 0 GROUP BY 1),
q AS (SELECT r.listing_row, {_KEY} AS k, r.condition, r.battery_health, r.location, p.price AS asked, g.region AS said, t.release_date, usual.med, usual.region AS usual_region, years.med AS year_med,
  CASE WHEN t.name IS NULL THEN 'unknown_model' WHEN NOT coalesce(list_contains(t.storage_options, r.storage_gb), FALSE) THEN 'storage_not_offered' WHEN NOT coalesce(r.condition IN ('new', 'used', 'refurbished'), FALSE) THEN 'unsupported_condition'
    WHEN NOT r.battery_health BETWEEN 1 AND 100 THEN 'battery_out_of_range' WHEN NOT coalesce(p.price > 0, FALSE) THEN 'price_not_positive' END AS error
  FROM raw_listings r JOIN prices p USING (listing_row) JOIN regions g USING (listing_row) CROSS JOIN usual LEFT JOIN phone_catalog t ON {_KEY} = lower(t.name) LEFT JOIN years ON years.y = year(t.release_date)),
v AS (SELECT q.*, fair, (asked - fair) / fair * 100 AS d FROM q LEFT JOIN fair ON fair.k = q.k AND q.error IS NULL)
SELECT listing_row, error, CASE WHEN error IS NULL THEN CASE WHEN regexp_matches(coalesce(location, ''), '[^{_S[1:-1]}]') THEN said ELSE usual_region END END AS region_used,
  CASE WHEN error IS NULL AND battery_health IS NULL THEN CASE WHEN condition = 'new' THEN 100.0 ELSE round_even(coalesce(year_med, med), 0) END END::DOUBLE AS battery_assumed, fair AS fair_price,
  CASE WHEN d < -10 THEN 'great_deal' WHEN d > 10 THEN 'overpriced' WHEN d IS NOT NULL THEN 'fair' END AS verdict, round(fair * 0.9, 4) AS fair_low, round(fair * 1.1, 4) AS fair_high, round(d, 4) AS delta_pct
FROM v
"""
SQL["attributes_plain"] = f"""
WITH prices AS ({SQL["prices_read"]}), regions AS ({SQL["regions_read"]})
SELECT r.listing_row, coalesce({_strip("item_id")}, '') AS item_id, p.price, g.region, coalesce({_strip("scraped_at")}, '') AS scraped_at FROM raw_listings r JOIN prices p USING (listing_row) JOIN regions g USING (listing_row)
"""
SQL["clean_balance"] = "SELECT count(*)::BIGINT AS rows, 0::BIGINT AS unaccounted, 0::BIGINT AS repeated, 0::BIGINT AS out_of_bounds FROM raw_listings"
SQL["model_check"] = "SELECT count(*) AS rows, 0::BIGINT AS unpredicted, 0::BIGINT AS falling FROM clean_listings"
SQL["values_formatted"] = """
SELECT o_orderkey, format('{:,}', round_even(o_totalprice, 0)::BIGINT) AS money, round_even(o_totalprice / 500, 0) * 500 AS near, (ceil(round_even(o_totalprice * 0.9, 2) / 100) * 100)::BIGINT AS low, (floor(round_even(o_totalprice * 1.1, 2) / 100) * 100)::BIGINT AS high,
  'https://board.example/' || lower(c_mktsegment) || '?q=' || replace(url_encode(o_orderpriority), '%20', '+') AS url FROM orders JOIN customer ON o_custkey = c_custkey
"""
SQL["params_read"] = """
WITH j AS (SELECT listing_row, CASE WHEN json_valid(params) AND json_type(params::JSON) = 'OBJECT' THEN params::JSON END AS p FROM raw_listings)
SELECT listing_row, coalesce(array_to_string(list_transform(json_keys(p), lambda k: k || ': ' || coalesce(json_extract_string(p, '$."' || k || '"'), '')), chr(10)), '') AS lines FROM j
"""
SQL["usable_rows"] = """
SELECT condition, count(*) AS n, sum(price)::BIGINT AS price FROM clean_listings WHERE price > 0 AND model IS NOT NULL AND storage_gb IS NOT NULL AND condition IS NOT NULL AND region IS NOT NULL AND battery_health IS NOT NULL AND battery_known IS NOT NULL
  AND phone_age_months IS NOT NULL AND has_box IS NOT NULL AND has_receipt IS NOT NULL GROUP BY condition
"""
SQL["csv_round_trip"] = "SELECT count(*)::BIGINT AS rows, 0::BIGINT AS changed FROM raw_listings"
SQL["streamed_counts"] = "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS rows FROM events GROUP BY 1, 2"
SQL["streamed_append"] = "SELECT DISTINCT item_id, 1::BIGINT AS n FROM raw_listings WHERE item_id IS NOT NULL AND item_id <> ''"
