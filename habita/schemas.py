"""Schemas of the wire message, the cleaned listing, the serving table and the
upstream JSON shapes (API response, AJAX envelope)."""

from pyspark.sql import types as T

S = T.StringType()

# Names and types of the wire message, one JSON object per listing; every field nullable.
LISTING_RAW = T.StructType([
    T.StructField("listing_id", S),
    T.StructField("title", S),
    T.StructField("property_type", S),
    T.StructField("offer_type", S),
    T.StructField("description", S),
    T.StructField("bedrooms", S),
    T.StructField("square_footage", S),
    T.StructField("wc_interne", S),
    T.StructField("legal_doc", S),
    T.StructField("price", T.LongType()),
    T.StructField("address", S),
    T.StructField("city", S),
    T.StructField("neighborhood", S),
    T.StructField("listing_url", S),
    T.StructField("image_urls", T.ArrayType(S)),
    T.StructField("source", S),
    T.StructField("scraped_at", S),
])

RAW_FIELDS = [f.name for f in LISTING_RAW.fields]

# Cleaned listing (lake): typed numerics plus the processing instant.
LISTING_CLEAN = T.StructType([
    T.StructField("listing_id", S),
    T.StructField("title", S),
    T.StructField("property_type", S),
    T.StructField("offer_type", S),
    T.StructField("description", S),
    T.StructField("bedrooms", T.IntegerType()),
    T.StructField("square_footage", T.FloatType()),
    T.StructField("wc_interne", T.IntegerType()),
    T.StructField("legal_doc", S),
    T.StructField("price", T.LongType()),
    T.StructField("address", S),
    T.StructField("city", S),
    T.StructField("neighborhood", S),
    T.StructField("listing_url", S),
    T.StructField("image_urls", T.ArrayType(S)),
    T.StructField("source", S),
    T.StructField("scraped_at", S),
    T.StructField("processed_at", T.TimestampType()),
])

CLEAN_FIELDS = [f.name for f in LISTING_CLEAN.fields]

# Serving table: same 18 columns, image list flattened to text, key listing_url.
LISTING_DW = T.StructType([
    f if f.name != "image_urls" else T.StructField("image_urls", S)
    for f in LISTING_CLEAN.fields
])

# DDL of the serving table (fixed values: column names and SQL types).
LISTING_DW_DDL = """CREATE TABLE IF NOT EXISTS {table} (
    listing_id TEXT,
    title TEXT,
    property_type TEXT,
    offer_type TEXT,
    description TEXT,
    bedrooms INTEGER,
    square_footage FLOAT,
    wc_interne INTEGER,
    legal_doc TEXT,
    price BIGINT,
    address TEXT,
    city TEXT,
    neighborhood TEXT,
    listing_url TEXT PRIMARY KEY,
    image_urls TEXT,
    source TEXT,
    scraped_at TEXT,
    processed_at TIMESTAMP
)"""

DW_KEY = "listing_url"

# The GraphQL API response, data.getAllProperties.data[] of nested objects.
_NAMED = T.StructType([T.StructField("denomination", S)])
API_PROPERTY = T.StructType([
    T.StructField("id", S),
    T.StructField("titre", S),
    T.StructField("descriptif", S),
    T.StructField("piece", T.VariantType()),      # a number or a text
    T.StructField("surface", S),
    T.StructField("cout_mensuel", T.LongType()),
    T.StructField("wc_douche_interne", S),
    T.StructField("papier_propriete", S),
    T.StructField("adresse", T.StructType([T.StructField("libelle", S)])),
    T.StructField("ville", _NAMED),
    T.StructField("quartier", _NAMED),
    T.StructField("offre", _NAMED),
    T.StructField("categorie_propriete", _NAMED),
    T.StructField("visuels", T.ArrayType(T.StructType([T.StructField("url", S)]))),
])
API_RESPONSE = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("getAllProperties", T.StructType([
            T.StructField("data", T.ArrayType(API_PROPERTY)),
        ])),
    ])),
])

# AJAX "load more" envelope: embedded HTML with more cards.
AJAX_ENVELOPE = T.StructType([
    T.StructField("html", S),
    T.StructField("loadmore", S),
    T.StructField("next_page", T.IntegerType()),
])
