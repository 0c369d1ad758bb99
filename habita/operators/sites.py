"""Per-site extraction rules for the three HTML sources.

Each site has a card rule (list page -> one row per card) and a detail rule
(detail page -> fields that complete the card); ``extract_site`` joins them by
URL. Selectors run on the element tree (``habita.functions.dom``) and return
raw texts; everything that is done with the texts is a Spark expression. Items
keep the wire types: numbers are text, ``image_urls`` an array.
"""

from __future__ import annotations

from urllib.parse import urljoin

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import normalise as N
from ..functions.dom import Element, attr_is, first, has_class, select_rows, texts_within
from ..functions.html import host_allowed, join_stripped
from ..functions.text import (digits_only, first_integer, price_digits, price_digits_dotted,
                              py_strip, rooms_from_text, split_location, surface_from_text,
                              wc_from_text)
from ..sources.pages import ajax_html
from .dedup import pick_per_key
from .extract import image_merge

# Source labels and defaults of the three sites.
# Hosts whose pages a source follows; a source without an entry follows any.
ALLOWED_DOMAINS = {"intendance": ["intendance.tg"], "igoe": ["igoeimmobilier.com"]}
SOURCES = {"intendance": "intendance.tg", "coinafrique": "coinafrique", "igoe": "igoeimmobilier"}
DEFAULT_CITY = "Lomé"
LEGAL_UNSPECIFIED = "Non spécifié"

# The markup each site uses (class names, ids, row labels).
INTENDANCE = {
    "link": "property_listing", "link_url_attr": "data-link", "link_title_attr": "data-modal-title",
    "price": "listing_unit_price_wrapper", "location": "property_location_image",
    "badge": "action_tag_wrapper", "rooms": "inforoom", "baths": "infobath", "size": "infosize",
    "details": "listing_details", "image": "wp-post-image",
    "description_id": "description", "description_alt": "property_description",
    "surface_rows": ["Surface", "Superficie"], "room_rows": ["Chambres", "Pièces"],
    "bath_rows": ["Salle de bain", "Douche"], "type_rows": ["Type"], "gallery": "owl-carousel",
}
COINAFRIQUE = {
    "link": "ad__card-image", "link_alt": "card-image", "title": "ad__card-description",
    "title_alt": "title", "price": "ad__card-price", "location": "ad__card-location",
    "image": "ad__card-img", "description": "description", "description_alt": "ad-description",
    "details": "details",
}
IGOE = {
    "title": "entry-title", "link_alt": "epl-more-link", "price": "price",
    "price_sold": "page-price sold-status", "price_alt": "page-price", "suburb": "item-suburb",
    "badge": "status-sticker", "beds": "epl-icon-container-bed", "baths": "epl-icon-container-bath",
    "icon_value": "icon-value", "excerpt": "epl-excerpt-content", "image": "wp-post-image",
    "content": "entry-content", "description_alt": "property-description",
    "surface_rows": ["Surface", "superficie"], "size": "epl-icon-container-size",
    "gallery": "property-gallery",
}
CARD_CLASS = {"intendance": "listing_wrapper", "coinafrique": "ad__card", "igoe": "epl-listing-post"}


def _null() -> Column:
    return F.lit(None).cast("string")


def _strip_or_empty(c: str) -> Column:
    return F.coalesce(py_strip(c), F.lit(""))


def _address(root: Element, url: str | None) -> str:
    """What a page's links stand against: its address, or its ``base`` element."""
    base = first(e.attrs["href"] for e in root.find("base") if e.attrs.get("href"))
    return urljoin(url or "", base) if base else url or ""


def _first_text(elements) -> str | None:
    """``.../text()`` + ``.get()``: the first own text node of the first element that has one."""
    return first(t for e in elements if (t := e.first_text) is not None)


def _sources(elements) -> list[str]:
    return [e.attrs["src"] for e in elements if "src" in e.attrs]


def _first_image(card: Element, cls: str) -> list[str]:
    src = first(_sources(card.find("img", has_class(cls))))
    return [src] if src else []


def cards(pages: DataFrame, site: str) -> DataFrame:
    """S5 for one site: the fields of every card, (page_id, url, pos, ...). A card is the
    element itself, to its own closing tag; cards without a link are dropped (F5)."""
    rule, fields = CARD_RULES[site]
    is_card = has_class(CARD_CLASS[site])

    def rows(root, url):
        address = _address(root, url)
        for pos, card in enumerate(root.find("div", is_card)):
            got = rule(card)
            if got[0]:
                yield (pos, urljoin(address, got[0]), *got[1:])
    return select_rows(pages, rows, "pos int, listing_url string, " + fields)


# ---------------------------------------------------------------- intendance
INTENDANCE_CARD = ("title_a string, title_b string, price_txt string, tag1 string, tag2 string, room string, bath string, "
                   "size string, badge string, loc array<string>, details string, image_urls array<string>")


def intendance_fields(card: Element):
    m = INTENDANCE
    links = [a for h in card.find("h4") for a in h.children("a")]
    modal = list(card.find("a", has_class(m["link"])))
    href = first(a.attrs["href"] for a in links if "href" in a.attrs)

    tagged = [e.children("a", attr_is("rel", "tag")) for e in card.parents_of("a")]

    def tag(index):
        # the index counts among the links of one parent
        return _first_text(t[index] for t in tagged if len(t) > index)
    return (href or first(a.attrs[m["link_url_attr"]] for a in modal if m["link_url_attr"] in a.attrs),
            _first_text(links), first(a.attrs[m["link_title_attr"]] for a in modal if m["link_title_attr"] in a.attrs),
            _first_text(card.find("div", has_class(m["price"]))), tag(0), tag(1),
            _first_text(card.find("span", has_class(m["rooms"]))), _first_text(card.find("span", has_class(m["baths"]))),
            first(t for e in card.find("span", has_class(m["size"])) for t in e.all_texts()),
            _first_text(card.find("div", has_class(m["badge"]))), texts_within(card, has_class(m["location"])),
            _first_text(card.find("div", has_class(m["details"]))), _first_image(card, m["image"]))


def intendance_card(c: DataFrame, scraped_at: Column) -> DataFrame:
    title = py_strip("title_a")
    t = c.withColumn("title", F.when(title != "", title).otherwise(F.coalesce("title_b", F.lit(""))))
    return t.select(
        "page_id", "pos", "listing_url", "title",
        price_digits(F.coalesce("price_txt", F.lit("0"))).alias("price"),
        py_strip(F.array_join("loc", " ")).alias("address"),
        _strip_or_empty("tag1").alias("neighborhood"),
        F.coalesce(py_strip("tag2"), F.lit(DEFAULT_CITY)).alias("city"),
        N.type_from_title_a(F.col("title")).alias("property_type"),
        N.offer_from_badge_a(F.coalesce("badge", F.lit(""))).alias("offer_type"),
        F.when(F.col("room") != "", digits_only(F.col("room"))).alias("bedrooms"),
        F.when(F.col("bath") != "", digits_only(F.col("bath"))).alias("wc_interne"),
        first_integer(F.col("size")).alias("square_footage"),
        _strip_or_empty("details").alias("description"),
        "image_urls",
        F.lit(SOURCES["intendance"]).alias("source"), scraped_at.alias("scraped_at"),
        F.lit(LEGAL_UNSPECIFIED).alias("legal_doc"),
    )


def _rows(root: Element) -> list[list[str]]:
    """First texts of the ``li`` of each parent, without those that have none."""
    return [[own for li in e.children("li") if (own := li.first_text) is not None] for e in root.parents_of("li")]


def _after_label(rows: list[list[str]], words) -> str | None:
    """First text of an ``li`` that follows, anywhere later among its siblings, an ``li`` whose first text holds a word."""
    for row in rows:
        for label, value in zip(row, row[1:]):
            if any(w in label for w in words):
                return value
    return None


def _text_after(root: Element, tag: str, word: str) -> str | None:
    """First text node after, among its siblings, a ``tag`` whose first text holds the word."""
    for e in root.parents_of(tag):
        seen = False
        for k in e.kids:
            if isinstance(k, str):
                if seen:
                    return k
            elif k.tag == tag and (own := k.first_text) is not None and word in own:
                seen = True
    return None


INTENDANCE_DETAIL = "parts array<string>, surface string, rooms string, baths string, kind string, d_images array<string>"


def intendance_detail_fields(root: Element, url: str | None):
    m, rows = INTENDANCE, _rows(root)
    paras = [t for d in root.find("div", attr_is("id", m["description_id"])) for p in d.find("p") for t in p.texts()]
    yield (paras or texts_within(root, has_class(m["description_alt"])),
           _after_label(rows, m["surface_rows"]) or _text_after(root, "strong", m["surface_rows"][0]),
           _after_label(rows, m["room_rows"]), _after_label(rows, m["bath_rows"]), _after_label(rows, m["type_rows"]),
           _images_within(root, has_class(m["gallery"])))


def _images_within(root: Element, test) -> list[str]:
    """``src`` of every image inside a ``div`` that passes, each element once."""
    seen: dict[int, Element] = {}
    for d in root.find("div", test):
        for e in d.find("img"):
            seen[id(e)] = e
    return _sources(seen.values())


def intendance_detail(d: DataFrame) -> DataFrame:
    return d.select(
        "page_id", F.col("url").alias("listing_url"),
        F.when(F.size("parts") > 0, join_stripped("parts")).alias("d_description"),
        first_integer(F.col("surface")).alias("d_surface"), first_integer(F.col("rooms")).alias("d_rooms"),
        first_integer(F.col("baths")).alias("d_baths"), py_strip("kind").alias("d_type"), "d_images")


def intendance_merge(j: DataFrame) -> DataFrame:
    desc = F.coalesce(F.col("d_description"), F.col("description"))
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    ptype = F.when(((F.col("property_type") == "Autre") | empty("property_type")) & F.col("d_type").isNotNull(),
                   F.col("d_type")).otherwise(F.col("property_type"))
    gallery = F.col("d_images")
    images = F.when(F.size(gallery) > 0, image_merge(F.col("image_urls"), gallery)).otherwise(F.col("image_urls"))
    legal = N.legal_doc_first(desc, default=F.col("legal_doc"))
    return j.select(
        F.md5("listing_url").alias("listing_id"), "title", ptype.alias("property_type"), "offer_type",
        desc.alias("description"),
        F.when(empty("bedrooms"), F.coalesce(F.col("d_rooms"), F.col("bedrooms"))).otherwise(F.col("bedrooms")).alias("bedrooms"),
        F.when(empty("square_footage"), F.coalesce(F.col("d_surface"), F.col("square_footage"))).otherwise(F.col("square_footage")).alias("square_footage"),
        F.when(empty("wc_interne"), F.coalesce(F.col("d_baths"), F.col("wc_interne"))).otherwise(F.col("wc_interne")).alias("wc_interne"),
        legal.alias("legal_doc"), "price", "address", "city", "neighborhood", "listing_url",
        images.alias("image_urls"), "source", "scraped_at")


# --------------------------------------------------------------- coinafrique
COINAFRIQUE_CARD = "t1 string, t2 string, price_txt string, location string, image_urls array<string>"


def coinafrique_fields(card: Element):
    m = COINAFRIQUE
    href = lambda cls: first(a.attrs["href"] for a in card.find("a", has_class(cls)) if "href" in a.attrs)     # noqa: E731
    inner = lambda cls, tag: _first_text(x for p in card.find("p", has_class(cls)) for x in p.children(tag))     # noqa: E731
    return (href(m["link"]) or href(m["link_alt"]), inner(m["title"], "a"), inner(m["title_alt"], "a"),
            _first_text(card.find("p", has_class(m["price"]))), inner(m["location"], "span"), _first_image(card, m["image"]))


def coinafrique_card(c: DataFrame, scraped_at: Column) -> DataFrame:
    t1 = _strip_or_empty("t1")
    t = c.select("*", F.when(t1 != "", t1).otherwise(_strip_or_empty("t2")).alias("title"), _strip_or_empty("location").alias("address"))
    hood, city = split_location(F.col("address"))
    return t.select(
        "page_id", "pos", "listing_url", "title",
        price_digits(F.coalesce("price_txt", F.lit("0"))).alias("price"), "address",
        hood.alias("neighborhood"), city.alias("city"),
        N.type_from_title_b(F.col("title")).alias("property_type"),
        N.offer_from_title_b(F.col("title")).alias("offer_type"),
        "image_urls",
        F.lit(SOURCES["coinafrique"]).alias("source"), scraped_at.alias("scraped_at"),
        _null().alias("description"), _null().alias("bedrooms"), _null().alias("square_footage"),
        _null().alias("wc_interne"), F.lit(LEGAL_UNSPECIFIED).alias("legal_doc"))


COINAFRIQUE_DETAIL = "parts array<string>, about array<string>"


def coinafrique_detail_fields(root: Element, url: str | None):
    m = COINAFRIQUE
    either = lambda e: m["description"] in e.attrs.get("class", "") or m["details"] in e.attrs.get("class", "")     # noqa: E731
    yield (texts_within(root, has_class(m["description"])) or texts_within(root, has_class(m["description_alt"])), texts_within(root, either))


def coinafrique_detail(d: DataFrame) -> DataFrame:
    t = d.select("page_id", "url", "parts", F.lower(F.array_join("about", " ")).alias("main"))
    legal_all = N.legal_docs_all(F.col("main"))
    return t.select(
        "page_id", F.col("url").alias("listing_url"),
        join_stripped("parts").alias("d_description"),
        surface_from_text(F.col("main")).alias("d_surface"), rooms_from_text(F.col("main")).alias("d_rooms"),
        wc_from_text(F.col("main")).alias("d_wc"),
        F.when(legal_all != LEGAL_UNSPECIFIED, legal_all).alias("d_legal"))


def coinafrique_merge(j: DataFrame) -> DataFrame:
    return j.select(
        F.md5("listing_url").alias("listing_id"), "title", "property_type", "offer_type",
        F.col("d_description").alias("description"),
        F.coalesce("d_rooms", "bedrooms").alias("bedrooms"),
        F.coalesce("d_surface", "square_footage").alias("square_footage"),
        F.coalesce("d_wc", "wc_interne").alias("wc_interne"),
        F.coalesce("d_legal", "legal_doc").alias("legal_doc"),
        "price", "address", "city", "neighborhood", "listing_url", "image_urls", "source", "scraped_at")


# ---------------------------------------------------------------------- igoe
IGOE_CARD = ("t1 string, t2 string, price_txt string, suburb string, badge string, beds string, baths string, "
             "excerpt string, image_urls array<string>")


def _icon(root: Element, container: str) -> str | None:
    return _first_text(v for c in root.find("div", has_class(container)) for v in c.find("div", attr_is("class", IGOE["icon_value"])))


def igoe_fields(card: Element):
    m = IGOE
    heads = list(card.find("h3", attr_is("class", m["title"])))
    links = [a for h in heads for a in h.children("a")]
    span = lambda cls: _first_text(card.find("span", attr_is("class", cls)))      # noqa: E731
    return (first(a.attrs["href"] for a in links if "href" in a.attrs)
            or first(a.attrs["href"] for a in card.find("a", attr_is("class", m["link_alt"])) if "href" in a.attrs),
            _first_text(links), _first_text(heads),
            _first_text(s for d in card.find("div", attr_is("class", m["price"])) for s in d.children("span")) or span(m["price_sold"]) or span(m["price_alt"]),
            span(m["suburb"]), _first_text(card.find("span", has_class(m["badge"]))), _icon(card, m["beds"]), _icon(card, m["baths"]),
            _first_text(p for d in card.find("div", attr_is("class", m["excerpt"])) for p in d.children("p")), _first_image(card, m["image"]))


def igoe_card(c: DataFrame, scraped_at: Column) -> DataFrame:
    t1 = _strip_or_empty("t1")
    t = c.select("*", F.when(t1 != "", t1).otherwise(_strip_or_empty("t2")).alias("title"),
                 _strip_or_empty("suburb").alias("neighborhood"), F.coalesce("excerpt", F.lit("")).alias("short"))
    hood = F.col("neighborhood")
    return t.select(
        "page_id", "pos", "listing_url", "title",
        price_digits_dotted(F.coalesce("price_txt", F.lit(""))).alias("price"),
        hood, F.lit(DEFAULT_CITY).alias("city"),
        F.when(hood != "", F.concat(hood, F.lit(", " + DEFAULT_CITY))).otherwise(F.lit(DEFAULT_CITY)).alias("address"),
        N.offer_from_badge_c(F.coalesce("badge", F.lit(""))).alias("offer_type"),
        F.when(F.col("beds") != "", py_strip("beds")).alias("bedrooms"), F.when(F.col("baths") != "", py_strip("baths")).alias("wc_interne"),
        N.type_from_title_c(F.col("title"), F.col("short")).alias("property_type"),
        py_strip("short").alias("description"),
        "image_urls",
        F.lit(SOURCES["igoe"]).alias("source"), scraped_at.alias("scraped_at"),
        F.lit("").alias("square_footage"), F.lit("").alias("legal_doc"))


IGOE_DETAIL = "parts array<string>, surface string, d_images array<string>"


def igoe_detail_fields(root: Element, url: str | None):
    m = IGOE
    inside: dict[int, Element] = {}
    for d in root.find("div", has_class(m["content"])):
        inside.update((id(p), p) for p in d.find("p"))
    paras = [t for p in inside.values() for t in p.texts()]
    rows = (li for li in root.find("li") if any(w in "".join(li.all_texts()) for w in m["surface_rows"]))
    yield (paras or texts_within(root, has_class(m["description_alt"])), _first_text(rows) or _icon(root, m["size"]),
           _images_within(root, has_class(m["gallery"])) or _images_within(root, attr_is("id", m["gallery"])))


def igoe_detail(d: DataFrame) -> DataFrame:
    return d.select("page_id", F.col("url").alias("listing_url"), F.when(F.size("parts") > 0, join_stripped("parts")).alias("d_full"),
                    first_integer(F.col("surface")).alias("d_surface"), "d_images")


def igoe_merge(j: DataFrame) -> DataFrame:
    full = F.col("d_full")
    desc = (F.when(full.isNull(), F.col("description"))
             .when(F.coalesce(F.col("description"), F.lit("")) != "", F.concat_ws(" ", "description", full))
             .otherwise(full))
    legal = F.when(F.coalesce(desc, F.lit("")) != "", N.legal_doc_first(desc)).otherwise(F.col("legal_doc"))
    gallery = F.col("d_images")
    images = F.when(F.size(gallery) > 0, image_merge(F.col("image_urls"), gallery)).otherwise(F.col("image_urls"))
    return j.select(
        F.md5("listing_url").alias("listing_id"), "title", "property_type", "offer_type",
        desc.alias("description"), "bedrooms",
        F.coalesce("d_surface", "square_footage").alias("square_footage"), "wc_interne",
        legal.alias("legal_doc"), "price", "address", "city", "neighborhood", "listing_url",
        images.alias("image_urls"), "source", "scraped_at")


CARD_RULES = {"intendance": (intendance_fields, INTENDANCE_CARD), "coinafrique": (coinafrique_fields, COINAFRIQUE_CARD),
              "igoe": (igoe_fields, IGOE_CARD)}
DETAIL_RULES = {"intendance": (intendance_detail_fields, INTENDANCE_DETAIL), "coinafrique": (coinafrique_detail_fields, COINAFRIQUE_DETAIL),
                "igoe": (igoe_detail_fields, IGOE_DETAIL)}
RULES = {
    "intendance": (intendance_card, intendance_detail, intendance_merge),
    "coinafrique": (coinafrique_card, coinafrique_detail, coinafrique_merge),
    "igoe": (igoe_card, igoe_detail, igoe_merge),
}


def extract_site(site: str, list_pages: DataFrame, detail_pages: DataFrame,
                 scraped_at: Column | None = None, how: str = "inner", ajax: DataFrame | None = None) -> DataFrame:
    """Cards of the list pages joined to their detail pages.

    One card per URL per crawl (A5, first page/position) and one detail page
    per URL, so repeated URLs never multiply. Links to hosts the source does
    not follow are dropped (F6). ``ajax``: 'load more' responses (S7), whose
    cards go through the same card rule, after those of the list pages. The
    result has the wire fields (price and counts as text) and goes to
    ``habita.sources.wire.to_wire``.
    """
    card_rule, detail_rule, merge = RULES[site]
    ts = scraped_at if scraped_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    found = cards(list_pages, site).withColumn("turn", F.lit(0))
    if ajax is not None:
        found = found.unionByName(cards(ajax_html(ajax), site).withColumn("turn", F.lit(1)))
    if site in ALLOWED_DOMAINS:
        found = found.where(host_allowed("listing_url", ALLOWED_DOMAINS[site]))
    order = found.withColumn("pos", F.struct("turn", "pos")).drop("turn")
    c = card_rule(order, ts)
    c1 = pick_per_key(c, "listing_url", ["page_id", "pos"], largest=False).drop("page_id", "pos")
    rule, fields = DETAIL_RULES[site]
    d = detail_rule(select_rows(detail_pages, rule, fields))
    d1 = pick_per_key(d, "listing_url", ["page_id"], largest=False).drop("page_id")
    return merge(c1.join(d1, "listing_url", how))
