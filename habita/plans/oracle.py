"""DuckDB SQL oracle for every registered query.

Each statement rebuilds its input from the driver tables with the same rules
as ``habita.sources.adapters`` and then computes the answer with plain SQL,
emulating Spark's semantics where they differ (permissive JSON typing, legacy
int casts, ``trim`` of spaces only, array display text).
"""

from __future__ import annotations

from ..functions.patterns import LEGACY_INT, LEGACY_INT_FRACTION_ONLY
from ..sources.adapters import (BEDROOM_TOKENS, CITIES, LEGAL_TOKENS, OFFER_TYPES,
                                PROPERTY_TYPES, SURFACE_TOKENS, TITLE_KINDS, WC_TOKENS)


def lit(v) -> str:
    if v is None:
        return "NULL"
    return "'" + str(v).replace("'", "''") + "'"


def pick(values, idx: str) -> str:
    return f"([{', '.join(lit(v) for v in values)}])[({idx}) + 1]"


def s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def jstr(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'null' ELSE '\"' || {x} || '\"' END"


def _wire_sql() -> str:
    k, c = "o_orderkey", "o_custkey"
    url = f"'https://src' || {s(f'{c} % 4')} || '.example/annonce/' || {s(c)} || '-' || {s(f'{k} % 3')}"
    listing_id = f"CASE WHEN {k} % 50 = 7 THEN 'null' ELSE '\"' || md5({url}) || '\"' END"
    title = f"'  ' || {pick(TITLE_KINDS, f'{k} // 2 % 6')} || ' ' || o_orderpriority || ' '"
    p = s(f"CAST(floor(o_totalprice) AS BIGINT)")
    price = (f"CASE WHEN {k} % 11 = 0 THEN 'null' WHEN {k} % 13 = 0 THEN '0' "
             f"WHEN {k} % 17 = 0 THEN '\"' || {p} || '\"' WHEN {k} % 19 = 0 THEN {p} || '.0' "
             f"WHEN {k} % 23 = 0 THEN '-' || {p} ELSE {p} END")
    city = f"CASE WHEN {k} % 10 = 0 THEN NULL WHEN {k} % 10 = 1 THEN '' ELSE {pick(CITIES, f'{c} % 3')} END"
    img_a = f"'\"https://img.example/' || {s(k)} || '/1.jpg\"'"
    img_b = f"'\"https://img.example/' || {s(k)} || '/2.jpg\"'"
    iv = f"({k} // 11 % 4)"
    images = (f"CASE WHEN {iv} = 0 THEN ',\"image_urls\":[' || {img_a} || ',null,' || {img_b} || ',' || {img_a} || ']' "
              f"WHEN {iv} = 1 THEN ',\"image_urls\":[]' WHEN {iv} = 2 THEN '' "
              f"ELSE ',\"image_urls\":\"str\"' END")
    dv = f"({k} // 5 % 6)"
    descr = (f"CASE WHEN {dv} = 0 THEN 'Belle villa de ' || {s(f'50 + {k} % 400')} || ' m² avec titre foncier, ' || {s(f'1 + {k} % 6')} || ' chambres' "
             f"WHEN {dv} = 1 THEN 'Permis de construire disponible, ' || {s(f'1 + {k} % 3')} || ' wc, surface : ' || {s(f'100 + {k} % 900')} "
             f"WHEN {dv} = 2 THEN 'Acte de vente et TITRE FONCIER, ' || {s(f'1 + {k} % 5')} || ' pièces, ' || {s(f'20 + {k} % 300')} || ' m2' "
             f"WHEN {dv} = 3 THEN '' WHEN {dv} = 4 THEN NULL "
             f"ELSE 'Maison ' || {s(f'1 + {k} % 4')} || ' toilettes, ' || {s(f'1 + {k} % 8')} || ' pièce' END")
    two = lambda x: f"lpad({s(x)}, 2, '0')"
    scraped = (f"strftime(o_orderdate, '%Y-%m-%d') || 'T' || {two(f'{k} // 3600 % 24')} || ':' || "
               f"{two(f'{k} // 60 % 60')} || ':' || {two(f'{k} % 60')}")

    def field(name, token):
        return f"'\"{name}\":' || {token}"

    body = " || ',' || ".join([
        field("listing_id", listing_id),
        field("title", jstr(title)),
        field("property_type", jstr(pick(PROPERTY_TYPES, f"{k} % 6"))),
        field("offer_type", jstr(pick(OFFER_TYPES, f"{k} // 3 % 7"))),
        field("description", jstr(descr)),
        field("bedrooms", pick(BEDROOM_TOKENS, f"{k} % 7")),
        field("square_footage", pick(SURFACE_TOKENS, f"{k} // 2 % 8")),
        field("wc_interne", pick(WC_TOKENS, f"{k} // 7 % 8")),
        field("legal_doc", pick(LEGAL_TOKENS, f"{k} % 4")),
        field("price", price),
        field("address", jstr(f"'Quartier ' || {s(f'{c} % 7')} || ', Lomé, Togo'")),
        field("city", jstr(city)),
        field("neighborhood", jstr(f"'Q' || {s(f'{c} % 7')}")),
        field("listing_url", jstr(url)) + f" || {images}",
        field("source", jstr(f"'src' || {s(f'{c} % 4')}")),
        field("scraped_at", jstr(scraped)),
    ])
    return (f"SELECT {k} AS msg_id, CASE WHEN {k} % 97 = 5 THEN body "
            f"WHEN {k} % 89 = 3 THEN '[' || body || '}}]' ELSE body || '}}' END AS value "
            f"FROM (SELECT {k}, '{{' || {body} AS body FROM orders) o")


STRING_FIELDS = ["listing_id", "title", "property_type", "offer_type", "description", "bedrooms",
                 "square_footage", "wc_interne", "legal_doc", "address", "city", "neighborhood",
                 "listing_url", "source", "scraped_at"]


def _parsed_sql(lenient: bool = False) -> str:
    cols = [f"json_extract_string(j, '$.{f}') AS {f}" for f in STRING_FIELDS]
    if lenient:
        price = ("CASE WHEN json_type(j, '$.price') IN ('BIGINT', 'UBIGINT') THEN CAST(json_extract(j, '$.price') AS BIGINT) "
                 "WHEN json_type(j, '$.price') = 'VARCHAR' AND regexp_matches(trim(json_extract_string(j, '$.price'), ' '), '^[+-]?[0-9]{1,18}$') "
                 "THEN TRY_CAST(trim(json_extract_string(j, '$.price'), ' ') AS BIGINT) END AS price")
    else:
        price = ("CASE WHEN json_type(j, '$.price') IN ('BIGINT', 'UBIGINT') "
                 "THEN CAST(json_extract(j, '$.price') AS BIGINT) END AS price")
    imgs = ("CASE WHEN json_type(j, '$.image_urls') = 'ARRAY' "
            "THEN from_json(json_extract(j, '$.image_urls'), '[\"VARCHAR\"]') END AS image_urls")
    return (f"SELECT msg_id, value, (j IS NOT NULL) AS valid_json, {', '.join(cols)}, {price}, {imgs} "
            f"FROM (SELECT msg_id, value, CASE WHEN json_valid(value) AND json_type(value) = 'OBJECT' "
            f"THEN CAST(value AS JSON) END AS j FROM wire) p")


def legacy_int(x: str) -> str:
    return (f"TRY_CAST(COALESCE(NULLIF(regexp_extract({x}, {lit(LEGACY_INT)}, 1), ''), "
            f"CASE WHEN regexp_matches({x}, {lit(LEGACY_INT_FRACTION_ONLY)}) THEN '0' END) AS INTEGER)")


def prop_type(x: str) -> str:
    return (f"CASE WHEN regexp_matches({x}, '(?i)villa') THEN 'Villa' "
            f"WHEN regexp_matches({x}, '(?i)maison') THEN 'Maison' "
            f"WHEN regexp_matches({x}, '(?i)terrain') THEN 'Terrain' "
            f"WHEN regexp_matches({x}, '(?i)appartement') THEN 'Appartement' ELSE 'Autre' END")


def offer_type(x: str, lenient: bool = False) -> str:
    lou = "(?i)lou|location" if lenient else "(?i)lou"
    return (f"CASE WHEN regexp_matches({x}, '{lou}') THEN 'Location' "
            f"WHEN regexp_matches({x}, '(?i)ven') THEN 'Vente' ELSE 'Inconnu' END")


def array_text(x: str) -> str:
    """Spark's display text of array<string>: '[a, null, b]'."""
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE '[' || "
            f"array_to_string(list_transform({x}, lambda e: coalesce(e, 'null')), ', ') || ']' END")


PY_WS_SQL = None  # set below (import-time, avoids a cycle)


def _clean_sql(lenient: bool = False) -> str:
    from ..functions.patterns import PY_STRIP
    title = f"regexp_replace(title, {lit(PY_STRIP)}, '', 'g')" if lenient else "trim(title, ' ')"
    return (f"SELECT msg_id, listing_id, {title} AS title, {prop_type('property_type')} AS property_type, "
            f"{offer_type('offer_type', lenient)} AS offer_type, description, "
            f"{legacy_int('bedrooms')} AS bedrooms, TRY_CAST(square_footage AS FLOAT) AS square_footage, "
            f"{legacy_int('wc_interne')} AS wc_interne, legal_doc, price, address, city, neighborhood, "
            f"listing_url, image_urls, source, scraped_at "
            f"FROM {'parsed_l' if lenient else 'parsed'} "
            f"WHERE listing_id IS NOT NULL AND price IS NOT NULL AND price > 0 AND city IS NOT NULL")


LATEST_SQL = ("SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
              "(PARTITION BY listing_url ORDER BY scraped_at DESC) AS rn FROM clean) WHERE rn = 1")


def with_listings(select: str, lenient: bool = False) -> str:
    ctes = [f"wire AS ({_wire_sql()})", f"parsed AS ({_parsed_sql()})",
            f"clean AS ({_clean_sql()})", f"latest AS ({LATEST_SQL})"]
    if lenient:
        ctes += [f"parsed_l AS ({_parsed_sql(True)})", f"clean_l AS ({_clean_sql(True)})"]
    return "WITH " + ",\n".join(ctes) + "\n" + select


def listing_oracles() -> dict[str, str]:
    q = {}
    q["flagship_market_summary"] = with_listings(
        "SELECT source, property_type, offer_type, count(*) AS n_listings, "
        "CAST(sum(price) AS BIGINT) AS sum_price, min(price) AS min_price, max(price) AS max_price, "
        "CAST(sum(bedrooms) AS BIGINT) AS sum_bedrooms, "
        "round(sum(CAST(square_footage AS DOUBLE)), 2) AS sum_surface "
        "FROM latest GROUP BY source, property_type, offer_type")
    q["wire_parse_permissive"] = with_listings(
        "SELECT msg_id, " + ", ".join(STRING_FIELDS) + ", price, "
        + array_text("image_urls") + " AS image_urls FROM parsed")
    q["events_props_parse"] = (
        "SELECT event_id, event_type, CASE WHEN json_type(j, '$.k') IN ('BIGINT', 'UBIGINT') "
        "THEN CAST(json_extract(j, '$.k') AS BIGINT) END AS k FROM (SELECT event_id, event_type, "
        "CASE WHEN json_valid(props) AND json_type(props) = 'OBJECT' THEN CAST(props AS JSON) END AS j "
        "FROM events) e")
    q["property_type_normalise"] = with_listings(
        f"SELECT property_type AS raw_property_type, {prop_type('property_type')} AS property_type, "
        "count(*) AS n_rows FROM parsed WHERE listing_id IS NOT NULL GROUP BY 1, 2")
    q["offer_type_normalise"] = with_listings(
        f"SELECT offer_type AS raw_offer_type, {offer_type('offer_type')} AS offer_type, "
        f"{offer_type('offer_type', True)} AS offer_type_lenient, count(*) AS n_rows "
        "FROM parsed WHERE listing_id IS NOT NULL GROUP BY 1, 2, 3")
    q["typed_casts_legacy"] = with_listings(
        f"SELECT msg_id, bedrooms, square_footage, wc_interne, {legacy_int('bedrooms')} AS bedrooms_int, "
        "CAST(TRY_CAST(square_footage AS FLOAT) AS DOUBLE) AS surface_float, "
        f"{legacy_int('wc_interne')} AS wc_int, price AS price_long FROM parsed")
    q["price_lenient"] = with_listings("SELECT msg_id, price, offer_type, title FROM clean_l", lenient=True)
    q["clean_listings"] = with_listings(
        "SELECT msg_id, listing_id, title, property_type, offer_type, description, bedrooms, "
        "CAST(square_footage AS DOUBLE) AS square_footage, wc_interne, legal_doc, price, address, city, "
        f"neighborhood, listing_url, {array_text('image_urls')} AS image_urls, source, scraped_at FROM clean")
    q["reject_reasons"] = with_listings(
        "SELECT CASE WHEN NOT valid_json THEN 'unparseable' WHEN listing_id IS NULL THEN 'missing_listing_id' "
        "WHEN price IS NULL THEN 'missing_price' WHEN price <= 0 THEN 'price_not_positive' "
        "WHEN city IS NULL THEN 'missing_city' ELSE 'kept' END AS reason, source, count(*) AS n_rows "
        "FROM parsed GROUP BY 1, 2")
    dig = lambda x: f"NULLIF(regexp_replace({x}, '[^0-9]', '', 'g'), '')"
    q["digits_only_cleanup"] = with_listings(
        "SELECT listing_url, bedrooms, square_footage, wc_interne, "
        f"TRY_CAST({dig('bedrooms')} AS INTEGER) AS bedrooms_digits, "
        f"CAST(TRY_CAST({dig('square_footage')} AS FLOAT) AS DOUBLE) AS surface_digits, "
        f"TRY_CAST({dig('wc_interne')} AS INTEGER) AS wc_digits, count(*) AS n_rows "
        "FROM parsed WHERE listing_id IS NOT NULL GROUP BY ALL")
    q["bedroom_outliers"] = with_listings(
        "SELECT msg_id, bedrooms AS bedrooms_raw, CASE WHEN bedrooms IS NULL OR bedrooms > 15 THEN NULL "
        "ELSE bedrooms END AS bedrooms FROM clean")
    q["dedup_latest_per_url"] = with_listings(
        "SELECT listing_url, listing_id, scraped_at, price, title, offer_type FROM latest")
    q["count_listings"] = with_listings("SELECT count(*) AS n_rows FROM latest")
    q["distinct_sources"] = with_listings("SELECT DISTINCT source FROM latest")
    q["image_urls_text"] = with_listings(
        f"SELECT msg_id, {array_text('image_urls')} AS image_urls_text, "
        "CAST(CASE WHEN image_urls IS NULL THEN -1 ELSE len(image_urls) END AS INTEGER) AS n_images FROM clean")
    q["curated_marts"] = with_listings(
        "SELECT city, neighborhood, property_type, offer_type, count(*) AS n_listings, "
        "min(price) AS min_price, max(price) AS max_price, round(avg(price), 2) AS avg_price "
        "FROM latest GROUP BY ALL")
    q["price_per_m2"] = with_listings(
        "SELECT city, property_type, count(*) AS n_listings, "
        "round(avg(price / CAST(square_footage AS DOUBLE)), 2) AS avg_price_m2 "
        "FROM latest WHERE square_footage > 0 GROUP BY ALL")
    q["upsert_insert_if_absent"] = with_listings(
        "SELECT listing_url, listing_id, scraped_at, price, source FROM ("
        "SELECT *, row_number() OVER (PARTITION BY listing_url ORDER BY scraped_at DESC) AS rn "
        "FROM clean WHERE scraped_at >= '1998-01-01') b WHERE rn = 1 AND NOT EXISTS ("
        "SELECT 1 FROM clean s WHERE s.scraped_at < '1998-01-01' AND s.listing_url = b.listing_url)")
    stream_cols = ("listing_id, title, property_type, offer_type, description, bedrooms, "
                   "CAST(square_footage AS DOUBLE) AS square_footage, wc_interne, legal_doc, price, address, "
                   f"city, neighborhood, listing_url, {array_text('image_urls')} AS image_urls, source, scraped_at")
    q["stream_to_lake"] = with_listings(f"SELECT {stream_cols} FROM clean")
    distinct_urls = ("SELECT listing_url, source, CAST(1 AS BIGINT) AS n_rows FROM "
                     "(SELECT DISTINCT listing_url, source FROM clean) d")
    q["stream_batch_dedup"] = with_listings(distinct_urls)
    q["stream_watermark_dedup"] = with_listings(distinct_urls)
    q["curated_zone_refresh"] = q["dedup_latest_per_url"]
    q["lake_compact"] = q["stream_to_lake"]
    q["wire_roundtrip"] = with_listings(
        "SELECT " + ", ".join(STRING_FIELDS) + ", price, " + array_text("image_urls") + " AS image_urls FROM parsed")
    q["csv_feed_roundtrip"] = with_listings(
        "SELECT " + ", ".join(f"NULLIF({c}, '') AS {c}" for c in STRING_FIELDS) + ", CAST(price AS VARCHAR) AS price, "
        "NULLIF(array_to_string(list_filter(image_urls, lambda x: x IS NOT NULL), ','), '') AS image_urls FROM parsed")
    q["serving_view_sql"] = with_listings(
        "SELECT source, count(*) AS n_rows, min(scraped_at) AS first_seen, max(price) AS max_price FROM latest "
        "WHERE listing_url IS NOT NULL GROUP BY source")
    q["fanout_both_sinks"] = with_listings(
        "SELECT source, count(*) AS n_rows, 'lake' AS sink FROM clean GROUP BY source UNION ALL "
        "SELECT source, count(DISTINCT listing_url) AS n_rows, 'store' AS sink FROM clean WHERE listing_url IS NOT NULL GROUP BY source")
    q["load_metrics"] = with_listings(
        "SELECT count(*) AS n_read, count(*) - count(listing_url) AS n_no_key, count(DISTINCT listing_url) AS n_written FROM clean")
    first, last = "scraped_at < '1994-07-01'", "scraped_at >= '1994-07-01' AND scraped_at < '1996-07-01'"
    stored = f"(SELECT count(DISTINCT listing_url) FROM clean WHERE {first})"
    added = f"(SELECT count(DISTINCT listing_url) FROM clean WHERE {last} AND listing_url NOT IN (SELECT listing_url FROM clean WHERE {first} AND listing_url IS NOT NULL))"
    q["load_skips_failing_batch"] = with_listings(
        f"SELECT CAST(b AS INTEGER) AS batch_id, n_read, n_written, b = 2 AS failed FROM (SELECT 0 AS b, (SELECT count(*) FROM clean WHERE {first}) AS n_read, {stored} AS n_written "
        "UNION ALL SELECT 1, 0, 0 UNION ALL SELECT 2, (SELECT count(*) FROM clean WHERE scraped_at >= '1996-07-01'), 0 "
        f"UNION ALL SELECT 3, (SELECT count(*) FROM clean WHERE {last}), {added} UNION ALL SELECT -1, {stored} + {added}, 0) x")
    q["processed_at_injected"] = with_listings("SELECT msg_id, '2024-05-01 10:00:00' AS processed_at FROM clean")
    at = lambda k: f"min(CASE WHEN rn >= ({k} * n + 3) // 4 THEN price END)"        # noqa: E731
    q["price_quartiles_exact"] = with_listings(
        f"SELECT city, property_type, max(n) AS n_listings, {at(1)} AS q25, {at(2)} AS q50, {at(3)} AS q75 FROM ("
        "SELECT city, property_type, price, row_number() OVER (PARTITION BY city, property_type ORDER BY price) AS rn, "
        "count(*) OVER (PARTITION BY city, property_type) AS n FROM latest) x GROUP BY city, property_type")
    return q
