"""Per-site extraction (cards + detail pages + J1) on golden HTML fixtures."""

from pyspark.sql import functions as F

from habita.operators.sites import extract_site

TS_TEXT = "2024-05-01T10:00:00"

INTENDANCE_LIST = """<html><body>
<div class="slider_prop_wrapper">
 <div class="listing_wrapper col-md-4">
  <a class="property_listing_link property_listing" data-link="/annonce/villa-1" data-modal-title="Villa modal"></a>
  <h4><a href="/annonce/villa-1">  Belle Villa à Bè  </a></h4>
  <div class="listing_unit_price_wrapper">15 000 000 F CFA<span class="price_label"></span></div>
  <div class="property_location_image"><span>Bè</span> <a rel="tag" href="/q/be">Bè</a>, <a rel="tag" href="/c/lome">Lomé</a></div>
  <div class="action_tag_wrapper">Ventes</div>
  <span class="inforoom">4 ch</span><span class="infobath">2</span><span class="infosize"><b>250 m²</b></span>
  <div class="listing_details">Grande villa &amp; piscine</div>
  <img class="attachment wp-post-image" src="https://img.example/1.jpg">
 </div>
</div>
<div class="listing_wrapper">
  <a class="property_listing" data-link="https://intendance.tg/annonce/bureau-2" data-modal-title="Bureau moderne"></a>
  <div class="listing_unit_price_wrapper">Prix : 500 000</div>
  <div class="action_tag_wrapper">Location</div>
</div>
<div class="listing_wrapper"><p>sans lien</p></div>
<div class="listing_wrapper"><h4><a href="/annonce/villa-1">Belle Villa à Bè</a></h4></div>
</body></html>"""

INTENDANCE_DETAILS = {
    "https://intendance.tg/annonce/villa-1": """<div id="description"><p>Villa avec titre foncier.</p><p>  </p><p>Jardin</p></div>
<ul class="property_details_list"><li>Surface</li><li>300 m²</li><li>Chambres</li><li>5</li></ul>
<div class="owl-carousel"><img src="https://img.example/1.jpg"><img src="https://img.example/2.jpg"></div>""",
    "https://intendance.tg/annonce/bureau-2": """<div class="property_description"><span>Bureau</span> de 80 m2</div>
<ul><li>Surface</li><li>80 m2</li><li>Type</li><li> Bureau </li><li>Salle de bain</li><li>1</li></ul>""",
}

COIN_LIST = """<div class="col s6"><div class="card ad__card round">
 <a class="card-image ad__card-image waves-block" href="/annonce/maisons/maison-3"><img class="ad__card-img" src="https://img.example/c3.jpg"></a>
 <p class="ad__card-description"><a href="/annonce/maisons/maison-3">Maison à louer Agoè</a></p>
 <p class="ad__card-price">150 000 CFA</p>
 <p class="ad__card-location"><span>Agoè, Lomé, Togo</span></p>
</div></div>
<div class="card ad__card"><p class="ad__card-description"><a>pas de lien</a></p></div>
<div class="card ad__card"><a class="card-image" href="/annonce/terrains/t-9"></a>
 <p class="title"><a> Terrain 600m2 à vendre </a></p><p class="ad__card-price">CFA</p>
 <p class="ad__card-location"><span>Kara</span></p></div>"""

COIN_DETAILS = {
    "https://tg.coinafrique.com/annonce/maisons/maison-3": """<div class="ad-description"><p>Maison de 3 chambres, 120 m², 2 wc.</p>
<p>Titre foncier et permis de construire</p></div><div class="details"><span>Surface : 150</span></div>""",
}

IGOE_LIST = """<div class="epl-listing-post epl-listing-grid">
 <h3 class="entry-title"><a href="https://www.igoeimmobilier.com/property/villa-7/">Villa meublée</a></h3>
 <div class="price"><span>1.500.000 FCFA</span></div>
 <span class="item-suburb">Adidogomé</span>
 <span class="status-sticker for-rent">A Louer</span>
 <div class="epl-icon-container-bed"><div class="icon-value"> 3 </div></div>
 <div class="epl-icon-container-bath"><div class="icon-value">2</div></div>
 <div class="epl-excerpt-content"><p>Belle villa avec jardin</p></div>
 <img class="wp-post-image" src="https://img.example/i7.jpg">
</div>"""

IGOE_DETAILS = {
    "https://www.igoeimmobilier.com/property/villa-7/": """<div class="entry-content"><p>Villa de standing.</p><p>Acte de vente disponible</p></div>
<ul><li>Surface : 400 m²</li></ul>
<div class="property-gallery"><img src="https://img.example/i7.jpg"><img src="https://img.example/i8.jpg"></div>""",
}


def run(spark, site, list_url, list_html, details):
    lp = spark.createDataFrame([(1, list_url, list_html)], "page_id long, url string, html string")
    dp = spark.createDataFrame([(10 + i, u, h) for i, (u, h) in enumerate(details.items())],
                               "page_id long, url string, html string")
    return {r["listing_url"]: r.asDict() for r in extract_site(site, lp, dp, F.lit(TS_TEXT)).collect()}


def test_intendance(spark):
    out = run(spark, "intendance", "https://intendance.tg/", INTENDANCE_LIST, INTENDANCE_DETAILS)
    assert set(out) == set(INTENDANCE_DETAILS)           # no-URL card dropped, repeat merged (A5)
    v = out["https://intendance.tg/annonce/villa-1"]
    assert v["title"] == "Belle Villa à Bè" and v["price"] == "15000000"
    assert v["address"] == " ".join(["Bè", " ", "Bè", ", ", "Lomé"]).strip()
    assert (v["neighborhood"], v["city"]) == ("Bè", "Lomé")
    assert (v["property_type"], v["offer_type"]) == ("Villa", "Vente")
    assert (v["bedrooms"], v["wc_interne"], v["square_footage"]) == ("4", "2", "250")
    assert v["description"] == "Villa avec titre foncier. Jardin"
    assert v["legal_doc"] == "Titre foncier"
    assert v["image_urls"] == ["https://img.example/1.jpg", "https://img.example/2.jpg"]
    assert v["listing_id"] and v["source"] == "intendance.tg" and v["scraped_at"] == "2024-05-01T10:00:00"
    b = out["https://intendance.tg/annonce/bureau-2"]
    assert b["title"] == "Bureau moderne" and b["price"] == "" and b["offer_type"] == "Location"
    assert b["property_type"] == "Bureau"                # 'Autre' replaced from the detail page
    assert (b["square_footage"], b["wc_interne"], b["bedrooms"]) == ("80", "1", None)
    assert b["description"] == "Bureau de 80 m2" and b["legal_doc"] == "Non spécifié"
    assert b["image_urls"] == [] and b["city"] == "Lomé" and b["neighborhood"] == ""


def test_coinafrique(spark):
    out = run(spark, "coinafrique", "https://tg.coinafrique.com/categorie/immobilier", COIN_LIST, COIN_DETAILS)
    assert set(out) == set(COIN_DETAILS)                 # the terrain card has no detail page (J1 inner)
    m = out["https://tg.coinafrique.com/annonce/maisons/maison-3"]
    assert m["title"] == "Maison à louer Agoè" and m["price"] == "150000"
    assert (m["neighborhood"], m["city"], m["address"]) == ("Agoè", "Lomé", "Agoè, Lomé, Togo")
    assert (m["property_type"], m["offer_type"]) == ("Maison", "Location")
    assert m["description"] == "Maison de 3 chambres, 120 m², 2 wc. Titre foncier et permis de construire"
    assert (m["square_footage"], m["bedrooms"], m["wc_interne"]) == ("120", "3", "2")
    assert m["legal_doc"] == "Titre foncier, Permis de construire"
    assert m["image_urls"] == ["https://img.example/c3.jpg"] and m["source"] == "coinafrique"


def test_coinafrique_left_join_keeps_card_defaults(spark):
    lp = spark.createDataFrame([(1, "https://tg.coinafrique.com/c", COIN_LIST)], "page_id long, url string, html string")
    dp = spark.createDataFrame([], "page_id long, url string, html string")
    out = {r["listing_url"]: r for r in extract_site("coinafrique", lp, dp, F.lit(TS_TEXT), how="left").collect()}
    t = out["https://tg.coinafrique.com/annonce/terrains/t-9"]
    assert t["title"] == "Terrain 600m2 à vendre" and t["price"] == "0"
    assert (t["property_type"], t["offer_type"], t["city"], t["neighborhood"]) == ("Terrain", "Vente", "Kara", "")


def test_igoe(spark):
    out = run(spark, "igoe", "https://www.igoeimmobilier.com/les-annonces/", IGOE_LIST, IGOE_DETAILS)
    v = out["https://www.igoeimmobilier.com/property/villa-7/"]
    assert v["title"] == "Villa meublée" and v["price"] == "1500000"
    assert (v["neighborhood"], v["city"], v["address"]) == ("Adidogomé", "Lomé", "Adidogomé, Lomé")
    assert (v["offer_type"], v["property_type"]) == ("Location", "Villa")
    assert (v["bedrooms"], v["wc_interne"], v["square_footage"]) == ("3", "2", "400")
    assert v["description"] == "Belle villa avec jardin Villa de standing. Acte de vente disponible"
    assert v["legal_doc"] == "Acte de vente"
    assert v["image_urls"] == ["https://img.example/i7.jpg", "https://img.example/i8.jpg"]


def one_item(spark, site, card, detail, list_url, url, wrap="<html><body>%s</body></html>"):
    lists = spark.createDataFrame([(1, list_url, wrap % card)], "page_id int, url string, html string")
    details = spark.createDataFrame([(1, url, wrap % detail)], "page_id int, url string, html string")
    return extract_site(site, lists, details, F.lit(TS_TEXT)).collect()


def test_elements_are_read_to_their_own_end(spark):
    card = ("<div class=listing_wrapper><div><h4><a href='../../a/1?x=1&amp;y=2'><i></i> Villa X</a></h4></div>"
            "<span><a rel=tag href=/q>Kodjo</a></span><span><a rel=tag href=/c>Kara</a></span>"
            "<img class='wp-post-image' src='/i?a=1&amp;b=2'></div><footer><h4><a href=/z>z</a></h4><span class=infobath>9</span></footer>")
    detail = ("<div id=description><div><div><p>Un</p></div></div><p>titre foncier &ecirc;</p></div>"
              "<ul><li>Surface</li><li><b>no</b></li><li>77 m2</li></ul>"
              "<div class='owl-carousel'><div><img src=1.jpg></div><div><img src='2.jpg'></div></div>")
    (r,) = one_item(spark, "intendance", card, detail, "https://intendance.tg/p/q/list", "https://intendance.tg/a/1?x=1&y=2")
    assert r["title"] == "Villa X" and r["city"] == "Lomé" and r["neighborhood"] == "Kodjo"    # the index counts per parent
    assert r["description"] == "Un titre foncier ê" and r["legal_doc"] == "Titre foncier"
    assert r["square_footage"] == "77" and r["wc_interne"] is None
    assert r["image_urls"] == ["/i?a=1&b=2", "1.jpg", "2.jpg"]


def test_empty_city_link_takes_the_default(spark):
    card = '<div class="listing_wrapper"><h4><a href="/a">V</a></h4><a rel="tag">Q</a><a rel="tag"></a></div>'
    (r,) = one_item(spark, "intendance", card, "", "https://intendance.tg/", "https://intendance.tg/a")
    assert (r["neighborhood"], r["city"]) == ("Q", "Lomé")


def test_other_hosts_are_not_followed(spark):
    card = '<div class="listing_wrapper"><h4><a href="https://elsewhere.example/a">V</a></h4></div>'
    assert one_item(spark, "intendance", card, "", "https://intendance.tg/", "https://elsewhere.example/a") == []
    card = '<div class="ad__card"><a class="ad__card-image" href="https://elsewhere.example/a"></a></div>'
    assert len(one_item(spark, "coinafrique", card, "", "https://tg.coinafrique.com/", "https://elsewhere.example/a")) == 1


def test_class_is_matched_as_a_substring(spark):
    card = '<div class="my-ad__card-box"><a class="x card-image" href=/a></a><p class="title"><a>T</a></p></div>'
    (r,) = one_item(spark, "coinafrique", card, "", "https://tg.coinafrique.com/", "https://tg.coinafrique.com/a")
    assert r["title"] == "T"


def test_ajax_cards_use_the_site_rule(spark):
    import json
    env = [(5, "https://intendance.tg/ajax", json.dumps({"html": '<div class="listing_wrapper"><h4><a href="/a">V</a></h4></div>', "loadmore": "more", "next_page": 2})),
           (6, "https://intendance.tg/ajax", '{"html": "<div'), (7, "https://intendance.tg/ajax", json.dumps({"html": "", "loadmore": "no_more"}))]
    ajax = spark.createDataFrame(env, "page_id int, url string, response string")
    none = spark.createDataFrame([], "page_id int, url string, html string")
    details = spark.createDataFrame([(1, "https://intendance.tg/a", "<p>x</p>")], "page_id int, url string, html string")
    (r,) = extract_site("intendance", none, details, F.lit(TS_TEXT), ajax=ajax).collect()
    assert r["title"] == "V" and r["listing_url"] == "https://intendance.tg/a"
