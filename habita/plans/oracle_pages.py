"""DuckDB oracle statements for the page, text and API queries."""

from __future__ import annotations

from ..functions.patterns import (PY_DIGIT, PY_NON_DIGIT, PY_STRIP, PY_WS, PY_WS_CHARS,
                                  URL_AUTHORITY, URL_HOST, URL_PATH, URL_SCHEME)
from ..functions.text import ROOM_PATTERNS, SURFACE_PATTERNS, WC_PATTERN
from ..sources.api import API_PAGE_SIZE, API_SOURCE, API_URL_PREFIX
from .oracle import lit, pick, s, with_listings

# The named references that the driver's pages use.
NAMED_ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&nbsp;", "\u00a0"), ("&copy;", "©"), ("&middot;", "·"),
    ("&eacute;", "é"), ("&egrave;", "è"), ("&agrave;", "à"),
    ("&ccedil;", "ç"), ("&euro;", "€"), ("&sup2;", "²"),
]


def strip(x):
    return f"regexp_replace({x}, {lit(PY_STRIP)}, '', 'g')"


def decode(x):
    out = x
    for ent, ch in NAMED_ENTITIES:
        out = f"replace({out}, {lit(ent)}, {lit(ch)})"
    return f"replace({out}, '&amp;', '&')"


def first_attr(x, tag, attr):
    return f"NULLIF(regexp_extract({x}, {lit(rf'(?s)<(?i:{tag})\b[^>]*\b(?i:{attr})=\"([^\"]*)\"')}, 1), '')"


def first_tag_text(x, tag):
    return f"regexp_extract({x}, {lit(rf'(?s)<(?i:{tag})\b[^>]*>([^<]*)')}, 1)"


def first_int(x):
    return f"NULLIF(regexp_extract({x}, {lit(f'({PY_DIGIT}+)')}, 1), '')"


def all_text(x):
    return (f"{strip(f'array_to_string(list_filter(regexp_extract_all({x}, {lit(chr(62) + '([^<]+)')}, 1), '
                     f'lambda t: length(t) > 0), {lit(chr(32))})')}")


def resolve(base, href):
    """urljoin without dot-segment handling: equal to the Spark expression on
    references without '.'/'..' or empty path segments (the test pages have none)."""
    path = f"regexp_extract({base}, {lit(URL_PATH)}, 1)"
    auth = f"regexp_extract({base}, {lit(URL_AUTHORITY)}, 1)"
    return (f"CASE WHEN {href} IS NULL THEN NULL "
            f"WHEN regexp_matches({href}, {lit(URL_SCHEME)}) THEN {href} "
            f"WHEN starts_with({href}, '//') THEN regexp_extract({base}, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1) || ':' || {href} "
            f"WHEN starts_with({href}, '/') THEN {auth} || {href} "
            f"WHEN starts_with({href}, '?') THEN regexp_extract({base}, '^([^?#]*)', 1) || {href} "
            f"WHEN starts_with({href}, '#') THEN regexp_extract({base}, '^([^#]*)', 1) || {href} "
            f"WHEN {href} = '' THEN {base} "
            f"ELSE {auth} || CASE WHEN contains({path}, '/') THEN regexp_extract({path}, '^(.*/)', 1) ELSE '/' END || {href} END")


def host(url):
    return f"NULLIF(regexp_extract({url}, {lit(URL_HOST)}, 1), '')"


def class_block(x, tag, cls):
    return f"regexp_extract({x}, {lit(rf'(?s)<(?i:{tag})\b[^>]*\b(?i:class)=\"[^\"]*{cls}[^\"]*\"[^>]*>(.*?)</(?i:{tag})>')}, 1)"


def link_cards_sql(src: str) -> str:
    """cards of every <li>: (page_id, url, pos, listing_url, title, listing_id)."""
    split = f"string_split(regexp_replace(html, '(<li\\b)', chr(1) || '\\1', 'g'), chr(1))"
    href = first_attr("card", "a", "href")
    title_text = strip(decode(first_tag_text("card", "a")))
    title = f"COALESCE(NULLIF({title_text}, ''), {first_attr('card', 'a', 'title')})"
    return (f"SELECT page_id, url, pos, listing_url, title, md5(listing_url) AS listing_id FROM ("
            f"SELECT page_id, url, pos, {resolve('url', href)} AS listing_url, {title} AS title FROM ("
            f"SELECT page_id, url, unnest(cards) AS card, CAST(generate_subscripts(cards, 1) - 1 AS INTEGER) AS pos FROM ("
            f"SELECT page_id, url, ({split})[2:] AS cards FROM {src}) a) b) c "
            f"WHERE listing_url IS NOT NULL AND listing_url <> ''")


def price_texts_sql() -> str:
    c = "c_custkey"
    v = f"(CAST(floor(abs(c_acctbal)) AS BIGINT) * 1000 + {c} % 1000)"
    sep = pick([" ", " ", " ", "."], f"{c} % 4")
    groups = (f"{s(f'{v} // 1000000')} || {sep} || lpad({s(f'{v} // 1000 % 1000')}, 3, '0') || {sep} || "
              f"lpad({s(f'{v} % 1000')}, 3, '0')")
    text = (f"CASE WHEN {c} % 5 = 0 THEN {groups} || ' F CFA' WHEN {c} % 5 = 1 THEN 'Prix : ' || {groups} "
            f"WHEN {c} % 5 = 2 THEN {lit(chr(10) + ' ')} || {groups} || ' FCFA' WHEN {c} % 5 = 3 THEN 'CFA' "
            f"ELSE {groups} END")
    return f"SELECT {c}, {text} AS price_text FROM customer"


def location_texts_sql() -> str:
    c = "c_custkey"
    text = (f"CASE WHEN {c} % 4 = 0 THEN n_name || ', ' || r_name || ', Togo' "
            f"WHEN {c} % 4 = 1 THEN 'Quartier ' || {s(f'{c} % 9')} || ', ' || n_name "
            f"WHEN {c} % 4 = 2 THEN n_name ELSE ' Bè , ' || n_name || ' , ' || r_name || ' Togo ' END")
    return (f"SELECT {c}, {text} AS location_text FROM customer JOIN nation ON c_nationkey = n_nationkey "
            f"JOIN region ON n_regionkey = r_regionkey")


def contains_chain(t, rules, default):
    body = " ".join(f"WHEN contains({t}, {lit(k)}) THEN {lit(v)}" for k, v in rules)
    return f"CASE {body} ELSE {lit(default)} END"


def api_rows_sql() -> str:
    p = "p_partkey"
    piece = f"CASE WHEN {p} % 6 = 5 THEN {s('p_size % 6')} ELSE {pick([None, '0', '', '3', 'abc'], f'{p} % 6')} END"
    rooms = (f"CASE WHEN piece IS NULL OR piece = '' THEN 0 "
             f"WHEN regexp_matches(piece, '^\\s*[+-]?[0-9]+\\s*$') THEN TRY_CAST(trim(piece) AS INTEGER) END")
    img = (f"CASE WHEN {p} % 4 = 0 THEN '[https://img.example/p/' || {s(p)} || '.jpg]' "
           f"WHEN {p} % 4 = 3 THEN '[https://img.example/p/' || {s(p)} || '-b.jpg]' END")
    inner = (f"SELECT 'P' || {s(p)} AS listing_id, p_name AS title, concat_ws(' ', p_type, p_brand) AS description, "
             f"CAST(floor(p_retailprice * 100) AS BIGINT) AS price, {piece} AS piece, "
             f"{s('p_size * 10')} AS square_footage, {s('p_size % 3')} AS wc_interne, "
             f"{pick(['Titre foncier', None], f'{p} % 2')} AS legal_doc, "
             f"{pick(['Villa', 'Appartement', 'Terrain'], f'{p} % 3')} AS property_type, "
             f"{pick(['Location', 'Vente'], f'{p} % 2')} AS offer_type, "
             f"CASE WHEN {p} % 9 <> 0 THEN 'Rue ' || {s(p)} END AS address, "
             f"CASE WHEN {p} % 5 <> 0 THEN 'Lomé' END AS city, 'Q' || {s(f'{p} % 11')} AS neighborhood, "
             f"{lit(API_URL_PREFIX)} || 'P' || {s(p)} AS listing_url, {img} AS image_urls, "
             f"{lit(API_SOURCE)} AS source, "
             f"row_number() OVER (PARTITION BY {p} // {API_PAGE_SIZE} ORDER BY {p}) AS rk, "
             f"{p} // {API_PAGE_SIZE} AS doc_id FROM part")
    return (f"SELECT * EXCLUDE (piece, rk, doc_id), {rooms} AS bedrooms FROM ({inner}) a "
            f"WHERE doc_id % 16 <> 5")


def page_oracles() -> dict[str, str]:
    from ..functions.normalise import (LEGAL_DEFAULT, LEGAL_KEYWORDS, TITLE_TYPES_A, TITLE_TYPES_B,
                                       TITLE_TYPES_C, TYPE_DEFAULT)
    from .page_queries import ALLOWED_DOMAINS

    q = {}
    q["page_cards"] = f"SELECT page_id, pos, listing_url, listing_id, title FROM ({link_cards_sql('pages')}) x"
    primary = f"NULLIF(regexp_extract(html, {lit(r'(?s)<(?i:h4)\b[^>]*>\s*<(?i:a)\b[^>]*\b(?i:href)=\"([^\"]*)\"')}, 1), '')"
    href = f"COALESCE({primary}, {first_attr('html', 'a', 'href')})"
    q["page_listing_keys"] = (f"SELECT page_id, listing_url, md5(listing_url) AS listing_id FROM ("
                              f"SELECT page_id, {resolve('url', href)} AS listing_url FROM pages) x "
                              f"WHERE listing_url IS NOT NULL")
    h = f"lower({host('url')})"
    conds = " OR ".join(f"{h} = {lit(d)} OR ends_with({h}, {lit('.' + d)})" for d in ALLOWED_DOMAINS)
    q["page_host_allowlist"] = f"SELECT page_id, url, {h} AS host FROM pages WHERE {conds}"
    h1 = strip(decode(first_tag_text("html", "h1")))
    tt = strip(decode(first_tag_text("html", "title")))
    q["page_title"] = f"SELECT page_id, COALESCE(NULLIF({h1}, ''), {tt}) AS title FROM pages"
    block = class_block("html", "div", "ad")
    q["page_ad_text"] = f"SELECT page_id, {decode(all_text(chr(39) + '>' + chr(39) + ' || ' + block + ' || ' + chr(39) + '<' + chr(39)))} AS ad_text FROM pages"
    art = f"regexp_extract(html, {lit(r'(?s)<(?i:article)\b[^>]*>(.*)</(?i:article)>')}, 1)"
    paras = (f"array_to_string(list_filter(list_transform(regexp_extract_all({art}, {lit(r'(?s)<(?i:p)\b[^>]*>([^<]*)')}, 1), "
             f"lambda t: {strip('t')}), lambda t: length(t) > 0), ' ')")
    canon = "regexp_extract(url, '^([^#]*)', 1)"
    q["page_detail_join"] = (
        f"WITH cards AS (SELECT page_id, {canon} AS listing_url, {strip(decode(first_tag_text('html', 'h1')))} AS title, "
        f"{first_int(decode(block))} AS square_footage FROM pages), "
        f"details AS (SELECT page_id, {canon} AS listing_url, {decode(paras)} AS description, "
        f"{first_int(decode(all_text(chr(39) + '>' + chr(39) + ' || ' + art + ' || ' + chr(39) + '<' + chr(39))))} AS detail_surface FROM pages), "
        f"c1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY listing_url ORDER BY page_id) rn FROM cards) WHERE rn = 1), "
        f"d1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY listing_url ORDER BY page_id) rn FROM details) WHERE rn = 1) "
        f"SELECT c1.listing_url, c1.title, d1.description, COALESCE(NULLIF(c1.square_footage, ''), d1.detail_surface) AS square_footage "
        f"FROM c1 JOIN d1 ON c1.listing_url = d1.listing_url")
    t = "COALESCE(price_text, '0')"
    e4 = (f"CASE WHEN regexp_matches({t}, {lit(f'[{PY_DIGIT}{PY_WS_CHARS}]')}) THEN "
          f"regexp_replace(regexp_extract({t}, {lit(f'[{PY_DIGIT}{PY_WS_CHARS}]+')}, 0), {lit(PY_WS)}, '', 'g') ELSE '0' END")
    q["price_digits"] = f"SELECT c_custkey, price_text, {e4} AS price_digits FROM ({price_texts_sql()}) x"
    t5 = "COALESCE(price_text, '')"
    run = f"regexp_extract({t5}, {lit(f'[{PY_DIGIT}{PY_WS_CHARS}.]+')}, 0)"
    e5 = f"COALESCE(NULLIF(replace(replace({run}, '.', ''), ' ', ''), ''), '0')"
    q["price_digits_dotted"] = f"SELECT c_custkey, price_text, {e5} AS price_digits FROM ({price_texts_sql()}) x"
    loc = strip("location_text")
    parts = f"list_transform(string_split({loc}, ','), lambda p: {strip('p')})"
    q["location_split"] = (
        f"SELECT c_custkey, location_text, CASE WHEN contains(loc, ',') THEN parts[1] ELSE '' END AS neighborhood, "
        f"CASE WHEN contains(loc, ',') THEN CASE WHEN contains(parts[-1], 'Togo') THEN parts[-2] ELSE parts[-1] END "
        f"ELSE loc END AS city FROM (SELECT c_custkey, location_text, {loc} AS loc, {parts} AS parts "
        f"FROM ({location_texts_sql()}) a) b")
    st = strip("title")
    low_t = f"lower(COALESCE({st}, ''))"
    texts = "parsed WHERE listing_id IS NOT NULL"
    q["type_from_title_a"] = with_listings(f"SELECT msg_id, {st} AS title, {contains_chain(low_t, TITLE_TYPES_A, TYPE_DEFAULT)} AS property_type FROM {texts}")
    q["type_from_title_b"] = with_listings(f"SELECT msg_id, {st} AS title, {contains_chain(low_t, TITLE_TYPES_B, TYPE_DEFAULT)} AS property_type FROM {texts}")
    low_c = f"lower(COALESCE({st}, '') || ' ' || COALESCE(description, ''))"
    q["type_from_title_c"] = with_listings(f"SELECT msg_id, {st} AS title, {contains_chain(low_c, TITLE_TYPES_C, TYPE_DEFAULT)} AS property_type FROM {texts}")
    badge = "COALESCE(offer_type, '')"
    q["offer_from_text_a"] = with_listings(
        f"SELECT msg_id, offer_type AS badge, {contains_chain(badge, [('Location', 'Location'), ('Vente', 'Vente')], 'Inconnu')} AS offer_type FROM {texts}")
    q["offer_from_text_b"] = with_listings(
        f"SELECT msg_id, {st} AS title, CASE WHEN contains({low_t}, 'location') OR contains({low_t}, 'louer') THEN 'Location' "
        f"WHEN contains({low_t}, 'vente') OR contains({low_t}, 'vendre') THEN 'Vente' ELSE 'Inconnu' END AS offer_type FROM {texts}")
    q["offer_from_text_c"] = with_listings(
        f"SELECT msg_id, offer_type AS badge, {contains_chain(f'lower({badge})', [('louer', 'Location'), ('vente', 'Vente')], 'Inconnu')} AS offer_type FROM {texts}")
    q["first_integer"] = with_listings(
        f"SELECT msg_id, {first_int('description')} AS first_int, regexp_replace(bedrooms, {lit(PY_NON_DIGIT)}, '', 'g') AS bedrooms_digits FROM {texts}")
    low = "lower(description)"
    first_of = lambda pats: "COALESCE(" + ", ".join(f"NULLIF(regexp_extract({low}, {lit(p)}, 1), '')" for p in pats) + ")"
    q["pattern_priority"] = with_listings(
        f"SELECT msg_id, {first_of(SURFACE_PATTERNS)} AS surface, {first_of(ROOM_PATTERNS)} AS rooms FROM {texts}")
    q["wc_count"] = with_listings(f"SELECT msg_id, NULLIF(regexp_extract({low}, {lit(WC_PATTERN)}, 1), '') AS wc FROM {texts}")
    ld = "lower(COALESCE(description, ''))"
    q["legal_doc_first"] = with_listings(f"SELECT msg_id, {contains_chain(ld, LEGAL_KEYWORDS, LEGAL_DEFAULT)} AS legal_doc FROM {texts}")
    found = ", ".join(f"CASE WHEN contains({ld}, {lit(k)}) THEN {lit(v)} END" for k, v in LEGAL_KEYWORDS)
    q["legal_docs_all"] = with_listings(
        f"SELECT msg_id, COALESCE(NULLIF(concat_ws(', ', {found}), ''), {lit(LEGAL_DEFAULT)}) AS legal_doc FROM {texts}")
    card = "[regexp_replace(listing_url, '/annonce/', '/img/') || '.jpg']"
    tok = "list_transform(card || image_urls, lambda x: COALESCE(x, 'null'))"
    union_txt = f"'[' || array_to_string(list_filter(toks, lambda x, i: list_position(toks, x) = i), ', ') || ']'"
    gal_txt = "'[' || array_to_string(list_transform(image_urls, lambda x: COALESCE(x, 'null')), ', ') || ']'"
    q["image_union"] = with_listings(
        f"SELECT msg_id, CASE WHEN len(image_urls) > 0 THEN {union_txt} ELSE '[' || card[1] || ']' END AS image_urls "
        f"FROM (SELECT msg_id, image_urls, {card} AS card, {tok.replace('card', card)} AS toks FROM {texts}) x")
    q["api_flatten"] = (f"SELECT listing_id, title, description, price, bedrooms, square_footage, wc_interne, legal_doc, "
                        f"property_type, offer_type, address, city, neighborhood, listing_url, image_urls, source "
                        f"FROM ({api_rows_sql()}) a")
    nav = f"regexp_extract(html, {lit(r'(?s)(<(?i:ul)\b.*?</(?i:ul)>)')}, 1)"
    q["ajax_cards"] = (f"SELECT page_id, pos, listing_url, listing_id, title FROM ({link_cards_sql(f'(SELECT page_id, url, {nav} AS html FROM pages WHERE page_id % 50 NOT IN (3, 4)) e WHERE html <> ' + chr(39) + chr(39))}) x")
    q["source_union"] = with_listings(
        f"SELECT source, count(*) AS n_rows, CAST(sum(price) AS BIGINT) AS sum_price FROM ("
        f"SELECT source, price FROM clean UNION ALL SELECT source, price FROM ({api_rows_sql()}) a "
        f"WHERE listing_id IS NOT NULL AND price > 0 AND city IS NOT NULL) u GROUP BY source")
    q["first_per_crawl"] = (
        f"SELECT crawl, listing_url, page_id, pos, title FROM (SELECT *, row_number() OVER (PARTITION BY crawl, listing_url "
        f"ORDER BY page_id, pos) AS rn FROM (SELECT lower({host('url')}) AS crawl, * FROM ({link_cards_sql('pages')}) c) d) e WHERE rn = 1")
    return q


def site_oracles() -> dict[str, str]:
    from ..functions.normalise import TITLE_TYPES_A
    from ..sources.site_pages import (BADGES, DETAIL_TYPES, SITE_CITIES, SITE_TITLES,
                                      intendance_price_text)
    k, c = "o_orderkey", "o_custkey"
    title = f"{pick(SITE_TITLES, f'{k} // 2 % 6')} || ' ' || {s(c)}"
    price_text = intendance_price_text().replace(" div ", " // ").replace("AS STRING", "AS VARCHAR")
    e4 = (f"CASE WHEN regexp_matches(pt, {lit(f'[{PY_DIGIT}{PY_WS_CHARS}]')}) THEN "
          f"regexp_replace(regexp_extract(pt, {lit(f'[{PY_DIGIT}{PY_WS_CHARS}]+')}, 0), {lit(PY_WS)}, '', 'g') ELSE '0' END")
    hood = f"'Q' || {s(f'{c} % 7')}"
    city = pick(SITE_CITIES, f"{c} % 3")
    type_a = contains_chain("lower(title)", TITLE_TYPES_A, "Autre")
    img = f"'https://img.example/' || {s(k)}"
    q = {}
    q["site_intendance_extract"] = (
        f"SELECT listing_url, md5(listing_url) AS listing_id, title, {e4} AS price, address, neighborhood, city, "
        f"CASE WHEN {type_a} = 'Autre' THEN {pick(DETAIL_TYPES, f'{k} % 3')} ELSE {type_a} END AS property_type, "
        f"offer_type, bedrooms, wc_interne, square_footage, description, legal_doc, image_urls, source FROM ("
        f"SELECT {k}, 'https://intendance.tg/annonce/' || {s(k)} || '-' || {s(c)} AS listing_url, {title} AS title, "
        f"{price_text} AS pt, "
        f"'Quartier ' || {s(f'{c} % 7')} || CASE WHEN {k} % 3 = 2 THEN '' ELSE '   ' || {hood} || ' ,  ' || {city} END AS address, "
        f"CASE WHEN {k} % 3 = 2 THEN '' ELSE {hood} END AS neighborhood, "
        f"CASE WHEN {k} % 3 = 2 THEN 'Lomé' ELSE {city} END AS city, "
        f"{contains_chain(pick(BADGES, f'{k} % 4'), [('Location', 'Location'), ('Vente', 'Vente')], 'Inconnu')} AS offer_type, "
        f"{s(f'CASE WHEN {k} % 4 <> 3 THEN {k} % 6 + 1 ELSE {k} % 5 + 1 END')} AS bedrooms, "
        f"{s(f'CASE WHEN {k} % 5 <> 2 THEN {k} % 3 + 1 ELSE {k} % 2 + 1 END')} AS wc_interne, "
        f"{s(f'CASE WHEN {k} % 7 <> 6 THEN 50 + {k} % 400 ELSE 100 + {k} % 500 END')} AS square_footage, "
        f"CASE {k} % 3 WHEN 0 THEN 'Villa ' || {s(k)} || ' avec titre foncier. Jardin' "
        f"WHEN 1 THEN 'Bien de ' || {s(f'60 + {k} % 90')} || ' m2 et permis de construire' "
        f"ELSE 'Desc ' || {s(k)} || ' & co' END AS description, "
        f"CASE {k} % 3 WHEN 0 THEN 'Titre foncier' WHEN 1 THEN 'Permis de construire' ELSE 'Non spécifié' END AS legal_doc, "
        f"CASE WHEN {k} % 4 IN (0, 1) THEN '[' || {img} || '/c.jpg, ' || {img} || '/g.jpg]' "
        f"WHEN {k} % 2 = 0 THEN '[' || {img} || '/c.jpg]' ELSE '[]' END AS image_urls, "
        f"'intendance.tg' AS source FROM orders WHERE {k} % 9 <> 4 AND {k} % 101 <> 100) x")
    q["site_intendance_ajax"] = q["site_intendance_extract"]
    q.update(_coin_igoe_oracles(e4))
    return q


def _duck(expr: str) -> str:
    return expr.replace(" div ", " // ").replace("AS STRING", "AS VARCHAR")


def _coin_igoe_oracles(e4: str) -> dict[str, str]:
    from ..functions.normalise import TITLE_TYPES_B, TITLE_TYPES_C
    from ..sources.site_pages import (COIN_TITLES, IGOE_EXCERPTS, IGOE_STICKERS, IGOE_TITLES, NBSP,
                                      _groups, intendance_price_text)
    k, c = "o_orderkey", "o_custkey"
    q = {}
    title = f"{pick(COIN_TITLES, f'{k} // 2 % 6')} || ' ' || {s(c)}"
    hood = f"'Q' || {s(f'{c} % 7')}"
    low = "lower(title)"
    offer_b = (f"CASE WHEN contains({low}, 'location') OR contains({low}, 'louer') THEN 'Location' "
               f"WHEN contains({low}, 'vente') OR contains({low}, 'vendre') THEN 'Vente' ELSE 'Inconnu' END")
    img = f"'https://img.example/' || {s(k)}"
    q["site_coinafrique_extract"] = (
        f"SELECT listing_url, md5(listing_url) AS listing_id, title, {e4} AS price, address, neighborhood, city, "
        f"{contains_chain(low, TITLE_TYPES_B, 'Autre')} AS property_type, {offer_b} AS offer_type, "
        f"bedrooms, wc_interne, square_footage, description, legal_doc, image_urls, source FROM ("
        f"SELECT {k}, 'https://tg.coinafrique.com/annonce/immobilier/' || {s(k)} || '-' || {s(c)} AS listing_url, "
        f"{title} AS title, {_duck(intendance_price_text())} AS pt, "
        f"CASE {k} % 4 WHEN 0 THEN {hood} || ', Lomé, Togo' WHEN 1 THEN {hood} || ', Kara' WHEN 2 THEN 'Sokodé' "
        f"ELSE 'Bè , Lomé , Maritime Togo' END AS address, "
        f"CASE {k} % 4 WHEN 0 THEN {hood} WHEN 1 THEN {hood} WHEN 2 THEN '' ELSE 'Bè' END AS neighborhood, "
        f"CASE {k} % 4 WHEN 0 THEN 'Lomé' WHEN 1 THEN 'Kara' WHEN 2 THEN 'Sokodé' ELSE 'Lomé' END AS city, "
        f"{s(f'CASE WHEN {k} % 4 = 1 THEN {k} % 7 + 2 WHEN {k} % 4 = 0 THEN {k} % 5 + 1 END')} AS bedrooms, "
        f"{s(f'CASE WHEN {k} % 4 = 0 THEN 50 + {k} % 300 WHEN {k} % 3 = 0 THEN 100 + {k} % 900 END')} AS square_footage, "
        f"{s(f'CASE WHEN {k} % 4 = 0 THEN {k} % 3 + 1 WHEN {k} % 3 = 1 THEN {k} % 4 + 1 END')} AS wc_interne, "
        f"CASE {k} % 4 WHEN 0 THEN 'Maison de ' || {s(f'{k} % 5 + 1')} || ' chambres, ' || {s(f'50 + {k} % 300')} || "
        f"' m², ' || {s(f'{k} % 3 + 1')} || ' wc. Titre foncier et permis de construire' "
        f"WHEN 1 THEN 'Bel espace de ' || {s(f'{k} % 7 + 2')} || ' pièces' WHEN 2 THEN 'Acte de vente disponible' ELSE '' END AS description, "
        f"CASE {k} % 4 WHEN 0 THEN 'Titre foncier, Permis de construire' WHEN 2 THEN 'Acte de vente' ELSE 'Non spécifié' END AS legal_doc, "
        f"CASE WHEN {k} % 2 = 0 AND {k} % 5 <> 1 THEN '[' || {img} || '/a.jpg]' ELSE '[]' END AS image_urls, "
        f"'coinafrique' AS source FROM orders WHERE {k} % 9 <> 4 AND {k} % 101 <> 100) x")

    t5 = "pt"
    run = f"regexp_extract({t5}, {lit(f'[{PY_DIGIT}{PY_WS_CHARS}.]+')}, 0)"
    e5 = f"COALESCE(NULLIF(replace(replace({run}, '.', ''), ' ', ''), ''), '0')"
    ititle = f"{pick(IGOE_TITLES, f'{k} // 2 % 6')} || ' ' || {s(c)}"
    price_text = (f"CASE {k} % 3 WHEN 0 THEN {_duck(_groups('.'))} || ' FCFA' "
                  f"WHEN 1 THEN {_duck(_groups(NBSP))} || ' CFA' ELSE 'Vendu' END")
    full = (f"CASE {k} % 3 WHEN 0 THEN 'Villa de standing. Acte de vente disponible' "
            f"WHEN 1 THEN 'Titre foncier en cours' END")
    from ..functions.normalise import LEGAL_KEYWORDS
    q["site_igoe_extract"] = (
        f"SELECT listing_url, md5(listing_url) AS listing_id, title, {e5} AS price, "
        f"CASE WHEN neighborhood <> '' THEN neighborhood || ', Lomé' ELSE 'Lomé' END AS address, neighborhood, 'Lomé' AS city, "
        f"{contains_chain(f'lower(title || {lit(chr(32))} || excerpt)', TITLE_TYPES_C, 'Autre')} AS property_type, "
        f"{contains_chain('lower(sticker)', [('louer', 'Location'), ('vente', 'Vente')], 'Inconnu')} AS offer_type, "
        f"bedrooms, wc_interne, square_footage, description, "
        f"CASE WHEN description <> '' THEN {contains_chain('lower(description)', LEGAL_KEYWORDS, 'Non spécifié')} ELSE '' END AS legal_doc, "
        f"image_urls, source FROM (SELECT *, CASE WHEN full_text IS NULL THEN excerpt WHEN excerpt <> '' THEN excerpt || ' ' || full_text "
        f"ELSE full_text END AS description FROM ("
        f"SELECT {k}, 'https://www.igoeimmobilier.com/property/' || {s(k)} || '-' || {s(c)} || '/' AS listing_url, "
        f"{ititle} AS title, {price_text} AS pt, "
        f"CASE WHEN {k} % 4 = 3 THEN '' ELSE {hood} END AS neighborhood, "
        f"{pick(IGOE_STICKERS, f'{k} % 3')} AS sticker, {pick(IGOE_EXCERPTS, f'{k} % 4')} AS excerpt, {full} AS full_text, "
        f"CASE WHEN {k} % 4 <> 2 THEN {s(f'{k} % 5 + 1')} END AS bedrooms, "
        f"CASE WHEN {k} % 6 <> 5 THEN {s(f'{k} % 2 + 1')} END AS wc_interne, "
        f"{s(f'CASE WHEN {k} % 2 = 0 THEN 100 + {k} % 500 ELSE 30 + {k} % 70 END')} AS square_footage, "
        f"CASE WHEN {k} % 4 IN (0, 1) THEN '[' || {img} || '/i.jpg, ' || {img} || '/j.jpg]' "
        f"WHEN {k} % 2 = 0 THEN '[' || {img} || '/i.jpg]' ELSE '[]' END AS image_urls, "
        f"'igoeimmobilier' AS source FROM orders WHERE {k} % 9 <> 4 AND {k} % 101 <> 100) a) b")
    q["site_items_to_lake"] = (
        "SELECT listing_url, '1970-01-01T00:00:00' AS scraped_at, source, TRY_CAST(price AS BIGINT) AS price "
        f"FROM ({q['site_igoe_extract']}) i WHERE TRY_CAST(price AS BIGINT) > 0 AND city IS NOT NULL")
    return q
