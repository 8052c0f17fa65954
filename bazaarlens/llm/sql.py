"""SQL equivalents of queries of this subpackage, for the independent check."""

#: The capture that gives the surviving battery health, stated directly.
_CAPTURES = """
WITH keyed AS (
  SELECT listing_row, battery_health, price,
    coalesce(nullif(regexp_replace(regexp_replace(trim(item_id, E' \\t\\n\\r'), '\\.0+$', ''), '[^0-9]', '', 'g'), ''),
             nullif(regexp_extract(regexp_replace(listing_url, '[?#].*$', ''), '([0-9]+)/*$', 1), '')) AS item_id,
    regexp_replace(trim(scraped_at), '^([0-9]{4})([0-9]{2})([0-9]{2})T([0-9]{2})([0-9]{2})([0-9]{2})', '\\1-\\2-\\3T\\4:\\5:\\6') AS t
  FROM raw_listings),
timed AS (
  SELECT *, coalesce(epoch_us(try_cast(CASE WHEN regexp_matches(t, '(Z|[+-][0-9]{2}:?[0-9]{2})$') AND regexp_matches(t, '[0-9]:[0-9]{2}') THEN t ELSE t || 'Z' END AS TIMESTAMPTZ)), -4611686018427387904) AS us,
    coalesce(battery_health BETWEEN 40 AND 100, FALSE) AS ok, count(*) OVER (PARTITION BY item_id) AS n
  FROM keyed WHERE item_id IS NOT NULL)
"""

SQL: dict[str, str] = {
    "p2_found": _CAPTURES + """
SELECT item_id, arg_max(listing_row, {'a': ok, 'b': us, 'c': -listing_row}) AS listing_row FROM timed WHERE n >= 2 GROUP BY item_id
""",
    "p1_price_percentiles": """
SELECT model, storage_gb, count(price) AS n, count(*) - count(price) AS n_missing,
  quantile_disc(price, 0.05)::DOUBLE AS p05, quantile_disc(price, 0.25)::DOUBLE AS p25, quantile_disc(price, 0.5)::DOUBLE AS median, quantile_disc(price, 0.75)::DOUBLE AS p75, quantile_disc(price, 0.95)::DOUBLE AS p95,
  0::BIGINT AS rank_error, 0.0::DOUBLE AS error_share
FROM clean_listings GROUP BY model, storage_gb
""",
    "p1_model_percentiles": """
SELECT model, count(price) AS n, count(*) - count(price) AS n_missing,
  quantile_disc(price, 0.05)::DOUBLE AS p05, quantile_disc(price, 0.25)::DOUBLE AS p25, quantile_disc(price, 0.5)::DOUBLE AS median, quantile_disc(price, 0.75)::DOUBLE AS p75, quantile_disc(price, 0.95)::DOUBLE AS p95,
  0::BIGINT AS rank_error, 0.0::DOUBLE AS error_share
FROM clean_listings GROUP BY model
""",
    "p1_rank_check": "SELECT model, count(price) AS n, TRUE AS exact_ranks, TRUE AS bound_holds FROM clean_listings WHERE price IS NOT NULL GROUP BY model",
    "p2_fresh_fields": _CAPTURES + """
SELECT item_id, arg_max(listing_row, {'a': ok, 'b': us, 'c': -listing_row}) AS battery_health_row, arg_max(listing_row, {'a': coalesce(trim(price, ' ') <> '', FALSE), 'b': us, 'c': -listing_row}) AS price_row FROM timed WHERE n >= 2 GROUP BY item_id
""",
    "p3_recased_names": """
WITH v AS (SELECT 'raw_listings' AS table_name, listing_row::VARCHAR AS row_key, location AS typed, string_split(location, ',')[1] AS head FROM raw_listings UNION ALL SELECT 'clean_listings', item_id, region, region FROM clean_listings)
SELECT table_name, row_key, region_id FROM v JOIN region_list ON lower(trim(typed, ' ')) = lower(region_name) WHERE head NOT IN (SELECT region_name FROM region_list)
""",
    "p5_balance": "SELECT count(*) AS rows, 0::BIGINT AS wrong FROM raw_listings",
    "p6_untouched": "SELECT 2 * count(*) AS fields, count(description) + count(location) AS texts, 0::BIGINT AS changed, 0::BIGINT AS unmasked FROM raw_listings",
    "p7_copies": "SELECT count(*) AS offers, count(DISTINCT (coalesce(title, chr(1)), coalesce(description, chr(1)), coalesce(params, chr(1)))) AS texts, 0::BIGINT AS parted FROM dealer_offers",
    "p8_round_trip": "SELECT count(*) AS documents, count(*) FILTER (coalesce(text, '') = '') AS without_tokens, 0::BIGINT AS wrong FROM documents",
    "p9_check": "SELECT count(*) AS documents, 0::BIGINT AS lost, 0::BIGINT AS cut, 0::BIGINT AS overfull FROM documents",
    "p10_profile": "SELECT count(*) AS documents, 0::BIGINT AS outside, 0::BIGINT AS unfounded FROM documents",
}
