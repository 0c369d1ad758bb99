"""Deterministic adapters from the driver tables to listing-shaped inputs.

The driver tables hold no listings, so each adapter derives the upstream
shape (wire JSON, API documents, price texts, location texts) from a table
whose size grows with the scale factor. The same rules are written as SQL in
``habita.plans.oracle`` so that an independent engine can rebuild the input.
All rules are pure column expressions: no shuffle, no driver round-trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the orders -> wire adapter (edge cases of every field).
TITLE_KINDS = ["VILLA duplex à vendre", "maison basse en location", "Terrain 600m2",
               "bel appartement à louer", "Studio meublé", "Immeuble R+3 vente"]
PROPERTY_TYPES = ["VILLA duplex", "maison basse", "Terrain 600m2", "bel appartement",
                  "Studio", None]
OFFER_TYPES = ["À louer", "Vente", "Location", "A VENDRE", None, "Loué", "Événement"]
BEDROOM_TOKENS = ['3', '"3.7"', '""', '"abc"', 'null', '"20"', '" 4 "']
SURFACE_TOKENS = ['"120"', '"45.5"', '"120 m2"', '""', '"1e3"', '"  80 "', '".5"',
                  '"99999999999"']
WC_TOKENS = ['"1"', '2', '"2.5"', '"+4"', '"-2"', '"x"', 'null', '"3."']
LEGAL_TOKENS = ['"Titre foncier"', '"Non spécifié"', '""', 'null']
CITIES = ["Lomé", "Kara", "Sokodé"]


def _pick(values, idx: Column) -> Column:
    """values[idx] for a literal list (NULL entries allowed)."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (idx + 1).cast("int"))


def _jstr(x: Column) -> Column:
    """JSON token of a plain string (values here need no escaping)."""
    return F.when(x.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), x, F.lit('"')))


def _field(name: str, token: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), token)


def listing_url_of(k: Column, c: Column) -> Column:
    return F.concat(F.lit("https://src"), c % 4, F.lit(".example/annonce/"), c, F.lit("-"), k % 3)


def _descr(k: Column) -> Column:
    v = F.expr("o_orderkey div 5") % 6
    return (F.when(v == 0, F.concat(F.lit("Belle villa de "), 50 + k % 400,
                                    F.lit(" m² avec titre foncier, "), 1 + k % 6, F.lit(" chambres")))
             .when(v == 1, F.concat(F.lit("Permis de construire disponible, "), 1 + k % 3,
                                    F.lit(" wc, surface : "), 100 + k % 900))
             .when(v == 2, F.concat(F.lit("Acte de vente et TITRE FONCIER, "), 1 + k % 5,
                                    F.lit(" pièces, "), 20 + k % 300, F.lit(" m2")))
             .when(v == 3, F.lit(""))
             .when(v == 4, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("Maison "), 1 + k % 4, F.lit(" toilettes, "),
                                 1 + k % 8, F.lit(" pièce"))))


def _scraped_at(k: Column) -> Column:
    """Crawl instant: the order date (timestamp without zone) plus a
    key-derived time of day, as a naive ISO text."""
    def two(x):
        return F.lpad(x.cast("string"), 2, "0")
    hh = F.expr("o_orderkey div 3600") % 24
    mi = F.expr("o_orderkey div 60") % 60
    return F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit("T"), two(hh), F.lit(":"),
                    two(mi), F.lit(":"), two(k % 60))


def orders_to_wire(orders: DataFrame, *extra: Column) -> DataFrame:
    """orders -> (msg_id, value): one wire message per order (with ``extra`` columns of ``orders``: those and value).

    listing_url repeats (three URLs per customer) so dedup has work to do;
    every field cycles through its edge values; about 1 % of messages are
    truncated and about 1 % are wrapped in a top-level array.
    """
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    url = listing_url_of(k, c)
    listing_id = F.when(k % 50 == 7, F.lit("null")).otherwise(_jstr(F.md5(url)))
    title = F.concat(F.lit("  "), _pick(TITLE_KINDS, F.expr("o_orderkey div 2") % 6),
                     F.lit(" "), F.col("o_orderpriority"), F.lit(" "))
    p = F.floor(F.col("o_totalprice")).cast("bigint").cast("string")
    price = (F.when(k % 11 == 0, F.lit("null"))
              .when(k % 13 == 0, F.lit("0"))
              .when(k % 17 == 0, F.concat(F.lit('"'), p, F.lit('"')))
              .when(k % 19 == 0, F.concat(p, F.lit(".0")))
              .when(k % 23 == 0, F.concat(F.lit("-"), p))
              .otherwise(p))
    city = (F.when(k % 10 == 0, F.lit(None).cast("string"))
             .when(k % 10 == 1, F.lit(""))
             .otherwise(_pick(CITIES, c % 3)))
    img_variant = F.expr("o_orderkey div 11") % 4
    img_a = F.concat(F.lit('"https://img.example/'), k, F.lit('/1.jpg"'))
    img_b = F.concat(F.lit('"https://img.example/'), k, F.lit('/2.jpg"'))
    images = (F.when(img_variant == 0, F.concat(F.lit(',"image_urls":['), img_a, F.lit(",null,"),
                                                  img_b, F.lit(","), img_a, F.lit("]")))
               .when(img_variant == 1, F.lit(',"image_urls":[]'))
               .when(img_variant == 2, F.lit(""))
               .otherwise(F.lit(',"image_urls":"str"')))
    # plain string fields in one to_json (NULL -> null); fields whose JSON token
    # type matters (numbers, quoted numbers, arrays, wrong types) are spliced in
    strings = F.to_json(F.struct(
        title.alias("title"),
        _pick(PROPERTY_TYPES, k % 6).alias("property_type"),
        _pick(OFFER_TYPES, F.expr("o_orderkey div 3") % 7).alias("offer_type"),
        _descr(k).alias("description"),
        F.concat(F.lit("Quartier "), c % 7, F.lit(", Lomé, Togo")).alias("address"),
        city.alias("city"),
        F.concat(F.lit("Q"), c % 7).alias("neighborhood"),
        url.alias("listing_url"),
        F.concat(F.lit("src"), c % 4).alias("source"),
        _scraped_at(k).alias("scraped_at"),
    ), {"ignoreNullFields": "false"})
    body = F.concat(
        F.lit("{"), _field("listing_id", listing_id), F.lit(","),
        _field("bedrooms", _pick(BEDROOM_TOKENS, k % 7)), F.lit(","),
        _field("square_footage", _pick(SURFACE_TOKENS, F.expr("o_orderkey div 2") % 8)), F.lit(","),
        _field("wc_interne", _pick(WC_TOKENS, F.expr("o_orderkey div 7") % 8)), F.lit(","),
        _field("legal_doc", _pick(LEGAL_TOKENS, k % 4)), F.lit(","),
        _field("price", price), images, F.lit(","),
        F.substring(strings, F.lit(2), F.length(strings) - 2),
    )
    value = (F.when(k % 97 == 5, body)                                   # truncated
              .when(k % 89 == 3, F.concat(F.lit("["), body, F.lit("}]")))  # top-level array
              .otherwise(F.concat(body, F.lit("}"))))
    return orders.select(*(extra or [k.alias("msg_id")]), value.alias("value"))


def customer_price_texts(customer: DataFrame) -> DataFrame:
    """customer -> (c_custkey, price_text): price labels with space, NBSP,
    narrow NBSP or dot thousands separators and assorted prefixes."""
    c = F.col("c_custkey")
    v = F.floor(F.abs(F.col("c_acctbal"))).cast("bigint") * 1000 + c % 1000
    sep = _pick([" ", "\u00a0", "\u202f", "."], c % 4)
    groups = F.concat((v / 1000000).cast("bigint").cast("string"), sep,
                      F.lpad(((v / 1000).cast("bigint") % 1000).cast("string"), 3, "0"), sep,
                      F.lpad((v % 1000).cast("string"), 3, "0"))
    text = (F.when(c % 5 == 0, F.concat(groups, F.lit(" F CFA")))
             .when(c % 5 == 1, F.concat(F.lit("Prix : "), groups))
             .when(c % 5 == 2, F.concat(F.lit("\n "), groups, F.lit(" FCFA")))
             .when(c % 5 == 3, F.lit("CFA"))
             .otherwise(groups))
    return customer.select(c.alias("c_custkey"), text.alias("price_text"))


def customer_location_texts(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """customer ⨝ nation ⨝ region -> (c_custkey, location_text) in the
    'quartier, ville[, pays]' shapes of the classifieds cards."""
    c = F.col("c_custkey")
    j = (customer.select("c_custkey", "c_nationkey")
         .join(nation.select("n_nationkey", "n_name", "n_regionkey"),
               F.col("c_nationkey") == F.col("n_nationkey"))
         .join(region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey")))
    text = (F.when(c % 4 == 0, F.concat(F.col("n_name"), F.lit(", "), F.col("r_name"), F.lit(", Togo")))
             .when(c % 4 == 1, F.concat(F.lit("Quartier "), c % 9, F.lit(", "), F.col("n_name")))
             .when(c % 4 == 2, F.col("n_name"))
             .otherwise(F.concat(F.lit(" Bè , "), F.col("n_name"), F.lit(" , "), F.col("r_name"),
                                 F.lit(" Togo "))))
    return j.select(c.alias("c_custkey"), text.alias("location_text"))
