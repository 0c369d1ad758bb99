"""Adapter: site-shaped list and detail pages rendered from ``orders``.

Each order becomes one listing card on a list page (20 cards per page, grouped
by key range, so a page never grows with the table) and one detail page. Card
and page variants cycle through the cases the extraction rules must handle:
missing links, fallback selectors, absent icons, missing detail pages, cards
repeated in the slider; links that climb a directory, character references,
all three ways of quoting attributes, galleries and contents with nested
elements, labels whose value is not the next row, and a page footer that looks
like fields of a card. The oracle derives the expected items from the same
order columns without reading any HTML.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

CARDS_PER_PAGE = 20


def _case(idx: str, values) -> str:
    body = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {idx} {body} END"


# Fixed values of the rendered pages.
SITE_TITLES = ["VILLA duplex à vendre", "maison basse en location", "Terrain 600m2",
               "bel appartement à louer", "Studio meublé", "Immeuble R+3 vente"]
BADGES = ["Ventes", "Location", "Locations", "Réservé"]
DETAIL_TYPES = ["Bureau", "Immeuble", "Entrepôt"]
SITE_CITIES = ["Lomé", "Kara", "Sokodé"]
NBSP, NNBSP = "\u00a0", "\u202f"
# a footer after the last card, with elements that the card rules look for
FOOTER = ('<footer><h4><a href="/mentions">Mentions</a></h4><a rel="tag" href="/f">Pied</a><span class="inforoom">99</span>'
          '<img class="wp-post-image ad__card-img" src="/logo.png"><p class="ad__card-price">1</p></footer>')


def _referenced(text: str) -> str:
    """Accents of a text as character references, named and numeric."""
    return f"replace(replace(replace({text}, 'é', '&eacute;'), 'à', '&#224;'), 'm²', 'm&sup2;')"


def _groups(sep: str) -> str:
    v = "CAST(floor(o_totalprice) AS BIGINT)"
    return (f"CAST({v} div 1000000 AS STRING) || '{sep}' || lpad(CAST(({v} div 1000) % 1000 AS STRING), 3, '0')"
            f" || '{sep}' || lpad(CAST({v} % 1000 AS STRING), 3, '0')")


def intendance_price_text() -> str:
    return (f"CASE o_orderkey % 4 WHEN 0 THEN {_groups(' ')} || ' F CFA' "
            f"WHEN 1 THEN 'Prix : ' || {_groups(NBSP)} WHEN 2 THEN {_groups(NNBSP)} || ' FCFA' "
            f"ELSE 'Sur demande' END")


def intendance_pages(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """-> (list_pages, detail_pages), both (page_id, url, html)."""
    k = "o_orderkey"
    title = f"{_case(f'({k} div 2) % 6', SITE_TITLES)} || ' ' || CAST(o_custkey AS STRING)"
    path = f"'/annonce/' || CAST({k} AS STRING) || '-' || CAST(o_custkey AS STRING)"
    link = (f"CASE WHEN {k} % 9 = 4 THEN '' "
            f"WHEN {k} % 5 = 1 THEN '<a class=\"property_listing\" data-link=\"' || {path} || '\" data-modal-title=\"' || {title} || '\"></a>' "
            f"WHEN {k} % 4 = 0 THEN '<h4><a href=\"..' || {path} || '\"><i class=\"icon\"></i>  ' || {_referenced(title)} || ' </a></h4>' "
            f"ELSE '<h4><a href=' || chr(39) || {path} || chr(39) || '>  ' || {title} || ' </a></h4>' END")
    loc = (f"'<div class=\"property_location_image\"><span>Quartier ' || CAST(o_custkey % 7 AS STRING) || '</span>' || "
           f"CASE WHEN {k} % 3 = 2 THEN '' ELSE ' <a rel=\"tag\" href=\"/q\">Q' || CAST(o_custkey % 7 AS STRING) || "
           f"'</a>, <a rel=\"tag\" href=\"/c\">' || {_case('o_custkey % 3', SITE_CITIES)} || '</a>' END || '</div>'")
    card = (f"'<div class=\"listing_wrapper col-md-4\">' || {link} || "
            f"'<div class=\"listing_unit_price_wrapper\">' || {intendance_price_text()} || '<span class=\"price_label\"></span></div>' || "
            f"{loc} || '<div class=\"action_tag_wrapper\">' || {_case(f'{k} % 4', BADGES)} || '</div>' || "
            f"CASE WHEN {k} % 4 <> 3 THEN '<span class=\"inforoom\">' || CAST({k} % 6 + 1 AS STRING) || ' ch</span>' ELSE '' END || "
            f"CASE WHEN {k} % 5 <> 2 THEN '<span class=\"infobath\">' || CAST({k} % 3 + 1 AS STRING) || '</span>' ELSE '' END || "
            f"CASE WHEN {k} % 7 <> 6 THEN '<span class=\"infosize\"><b>' || CAST(50 + {k} % 400 AS STRING) || ' m²</b></span>' ELSE '' END || "
            f"'<div class=\"listing_details\">Desc ' || CAST({k} AS STRING) || ' &amp; co</div>' || "
            f"CASE WHEN {k} % 2 = 0 THEN '<img class=\"attachment wp-post-image\" src=\"https://img.example/' || CAST({k} AS STRING) || '/c.jpg\">' ELSE '' END || "
            f"'</div>'")
    cards = orders.selectExpr(f"{k} div {CARDS_PER_PAGE} AS page_id", f"{k} AS k",
                              f"CASE WHEN {k} % {CARDS_PER_PAGE} = 0 THEN ({card}) || ({card}) ELSE {card} END AS card")
    list_pages = (cards.groupBy("page_id")
                  .agg(F.array_sort(F.collect_list(F.struct("k", "card"))).alias("cs"))
                  .select("page_id",
                          F.concat(F.lit("https://intendance.tg/page/"), F.col("page_id")).alias("url"),
                          F.concat(F.lit('<html><body><div class="slider_prop_wrapper"></div>'),
                                   F.array_join(F.transform("cs", lambda s: s["card"]), ""),
                                   F.lit(FOOTER + "</body></html>")).alias("html")))
    detail = (f"CASE {k} % 3 WHEN 0 THEN '<div id=\"description\"><div class=text><p>Villa ' || CAST({k} AS STRING) || ' avec titre foncier.</p><p>  </p></div><p>Jardin</p></div>' "
              f"WHEN 1 THEN '<div class=\"property_description\"><span>Bien</span> de ' || CAST(60 + {k} % 90 AS STRING) || ' m2 et permis de construire</div>' ELSE '' END || "
              f"'<ul class=\"property_details_list\"><li>Surface</li><li><i></i></li><li>' || CAST(100 + {k} % 500 AS STRING) || ' m²</li><li>Chambres</li><li>' || "
              f"CAST({k} % 5 + 1 AS STRING) || '</li><li>Salle de bain</li><li>' || CAST({k} % 2 + 1 AS STRING) || '</li><li>Type</li><li> ' || "
              f"{_case(f'{k} % 3', DETAIL_TYPES)} || ' </li></ul>' || "
              f"CASE WHEN {k} % 4 IN (0, 1) THEN '<div class=\"owl-carousel\"><div class=item><img src=\"https://img.example/' || CAST({k} AS STRING) || "
              f"'/c.jpg\"></div><div class=item><img src=https://img.example/' || CAST({k} AS STRING) || '/g.jpg></div></div>' ELSE '' END")
    detail_pages = orders.where(f"{k} % 101 <> 100").selectExpr(
        f"{k} AS page_id", f"'https://intendance.tg' || {path} AS url", f"'<html><body>' || {detail} || '</body></html>' AS html")
    return list_pages, detail_pages


# Fixed values of the classifieds and agency pages.
COIN_TITLES = ["Terrain à vendre", "Appartement meublé à louer", "Villa en location",
               "Maison vente rapide", "Studio", "Immeuble commercial"]
COIN_LOCATIONS = ["'Q' || CAST(o_custkey % 7 AS STRING) || ', Lomé, Togo'",
                  "'Q' || CAST(o_custkey % 7 AS STRING) || ', Kara'",
                  "'Sokodé'", "' Bè , Lomé , Maritime Togo '"]
IGOE_TITLES = ["Villa meublée", "Appartement F4", "Maison basse", "Studio", "Terrain urbain", "Bureau"]
IGOE_EXCERPTS = ["Belle villa avec jardin", "Appartement lumineux", "", "Terrain et studio"]
IGOE_STICKERS = ["A Louer", "Vente", "Vendu"]


def _list_pages(cards: DataFrame, url_prefix: str, head: str = "") -> DataFrame:
    return (cards.groupBy("page_id")
            .agg(F.array_sort(F.collect_list(F.struct("k", "card"))).alias("cs"))
            .select("page_id", F.concat(F.lit(url_prefix), F.col("page_id")).alias("url"),
                    F.concat(F.lit("<html><body>" + head), F.array_join(F.transform("cs", lambda s: s["card"]), ""),
                             F.lit(FOOTER + "</body></html>")).alias("html")))


def coinafrique_pages(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    k = "o_orderkey"
    title = f"{_case(f'({k} div 2) % 6', COIN_TITLES)} || ' ' || CAST(o_custkey AS STRING)"
    path = f"'/annonce/immobilier/' || CAST({k} AS STRING) || '-' || CAST(o_custkey AS STRING)"
    img = f"CASE WHEN {k} % 2 = 0 THEN '<img class=\"ad__card-img\" src=\"https://img.example/' || CAST({k} AS STRING) || '/a.jpg\">' ELSE '' END"
    link = (f"CASE WHEN {k} % 9 = 4 THEN '' WHEN {k} % 5 = 1 THEN '<a class=\"card-image\" href=\"' || {path} || '\"></a>' "
            f"ELSE '<a class=\"card-image ad__card-image waves-block\" href=\"' || {path} || '\">' || {img} || '</a>' END")
    heading = (f"CASE WHEN {k} % 5 = 1 THEN '<p class=\"title\"><a href=\"' || {path} || '\"> ' || {title} || ' </a></p>' "
               f"ELSE '<p class=\"ad__card-description\"><a href=\"' || {path} || '\">' || {title} || '</a></p>' END")
    loc = "CASE o_orderkey % 4 " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(COIN_LOCATIONS)) + " END"
    card = (f"'<div class=\"col s6\"><div class=\"card ad__card round\">' || {link} || {heading} || "
            f"'<p class=\"ad__card-price\">' || {intendance_price_text()} || '</p>' || "
            f"'<p class=\"ad__card-location\"><span>' || {loc} || '</span></p></div></div>'")
    cards = orders.selectExpr(f"{k} div {CARDS_PER_PAGE} AS page_id", f"{k} AS k", f"{card} AS card")
    desc = (f"CASE {k} % 4 WHEN 0 THEN 'Maison de ' || CAST({k} % 5 + 1 AS STRING) || ' chambres, ' || CAST(50 + {k} % 300 AS STRING) || "
            f"' m², ' || CAST({k} % 3 + 1 AS STRING) || ' wc. Titre foncier et permis de construire' "
            f"WHEN 1 THEN 'Bel espace de ' || CAST({k} % 7 + 2 AS STRING) || ' pièces' "
            f"WHEN 2 THEN 'Acte de vente disponible' ELSE '' END")
    details = (f"CASE {k} % 3 WHEN 0 THEN 'Surface : ' || CAST(100 + {k} % 900 AS STRING) "
               f"WHEN 1 THEN CAST({k} % 4 + 1 AS STRING) || ' toilettes' ELSE '' END")
    detail_pages = orders.where(f"{k} % 101 <> 100").selectExpr(
        f"{k} AS page_id", f"'https://tg.coinafrique.com' || {path} AS url",
        f"'<html><body><div class=\"ad-description\"><p>' || {desc} || '</p></div><div class=\"details\"><span>' || "
        f"{details} || '</span></div></body></html>' AS html")
    return _list_pages(cards, "https://tg.coinafrique.com/categorie/immobilier?page="), detail_pages


def igoe_pages(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    k = "o_orderkey"
    title = f"{_case(f'({k} div 2) % 6', IGOE_TITLES)} || ' ' || CAST(o_custkey AS STRING)"
    url = f"'https://www.igoeimmobilier.com/property/' || CAST({k} AS STRING) || '-' || CAST(o_custkey AS STRING) || '/'"
    head = (f"CASE WHEN {k} % 9 = 4 THEN '<h3 class=\"entry-title\">' || {title} || '</h3>' "
            f"WHEN {k} % 5 = 1 THEN '<h3 class=\"entry-title\"> ' || {title} || ' </h3><a class=\"epl-more-link\" href=\"' || {url} || '\">Voir</a>' "
            f"ELSE '<h3 class=\"entry-title\"><a href=\"' || {url} || '\">' || {title} || '</a></h3>' END")
    price = (f"CASE {k} % 3 WHEN 0 THEN '<div class=\"price\"><span>' || {_groups('.')} || ' FCFA</span></div>' "
             f"WHEN 1 THEN '<span class=\"page-price\">' || {_groups(NBSP)} || ' CFA</span>' "
             f"ELSE '<span class=\"page-price sold-status\">Vendu</span>' END")
    card = (f"'<div class=\"epl-listing-post epl-property-blog\">' || {head} || {price} || "
            f"'<span class=\"item-suburb\">' || CASE WHEN {k} % 4 = 3 THEN '' ELSE 'Q' || CAST(o_custkey % 7 AS STRING) END || '</span>' || "
            f"'<span class=\"status-sticker st\">' || {_case(f'{k} % 3', IGOE_STICKERS)} || '</span>' || "
            f"CASE WHEN {k} % 4 <> 2 THEN '<div class=\"epl-icon-container-bed\"><div class=\"icon-value\"> ' || CAST({k} % 5 + 1 AS STRING) || ' </div></div>' ELSE '' END || "
            f"CASE WHEN {k} % 6 <> 5 THEN '<div class=\"epl-icon-container-bath\"><div class=\"icon-value\">' || CAST({k} % 2 + 1 AS STRING) || '</div></div>' ELSE '' END || "
            f"'<div class=\"epl-excerpt-content\"><p>' || {_case(f'{k} % 4', IGOE_EXCERPTS)} || '</p></div>' || "
            f"CASE WHEN {k} % 2 = 0 THEN '<img class=\"wp-post-image\" src=\"https://img.example/' || CAST({k} AS STRING) || '/i.jpg\">' ELSE '' END || "
            f"'</div>'")
    cards = orders.selectExpr(f"{k} div {CARDS_PER_PAGE} AS page_id", f"{k} AS k", f"{card} AS card")
    detail = (f"CASE {k} % 3 WHEN 0 THEN '<div class=\"entry-content\"><div><p>Villa de standing.</p></div><p>Acte de vente disponible</p></div>' "
              f"WHEN 1 THEN '<div class=\"property-description\"><span>Titre foncier</span> en cours</div>' ELSE '' END || "
              f"CASE WHEN {k} % 2 = 0 THEN '<ul><li>Surface : ' || CAST(100 + {k} % 500 AS STRING) || ' m²</li></ul>' "
              f"ELSE '<div class=\"epl-icon-container-size\"><div class=\"icon-value\">' || CAST(30 + {k} % 70 AS STRING) || '</div></div>' END || "
              f"CASE WHEN {k} % 4 IN (0, 1) THEN '<div class=\"property-gallery\"><div><img src=\"https://img.example/' || CAST({k} AS STRING) || "
              f"'/i.jpg\"></div><div><img src=' || chr(39) || 'https://img.example/' || CAST({k} AS STRING) || '/j.jpg' || chr(39) || '></div></div>' ELSE '' END")
    detail_pages = orders.where(f"{k} % 101 <> 100").selectExpr(
        f"{k} AS page_id", f"{url} AS url", f"'<html><body>' || {detail} || '</body></html>' AS html")
    return _list_pages(cards, "https://www.igoeimmobilier.com/les-annonces/page/"), detail_pages
