"""GraphQL API documents (S4) and their flattening (E10d, E11d, E27-E31, L1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schemas import API_RESPONSE

# Source label and the listing URL rule of the API.
API_SOURCE = "omnisoft_api"
API_URL_PREFIX = "https://devapi.omnisoft.africa/property/"
API_PAGE_SIZE = 2500


def _pick(values, idx):
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (idx + 1).cast("int"))


def api_documents_from_part(part: DataFrame, page_size: int = API_PAGE_SIZE) -> DataFrame:
    """Adapter: part -> (doc_id, response) API documents.

    Rows are grouped into documents by key range (``p_partkey div page_size``),
    so every document holds at most ``page_size`` properties however large
    the table grows. Documents with doc_id % 16 = 5 lack ``getAllProperties``.
    """
    p = F.col("p_partkey")
    named = lambda x: F.struct(x.alias("denomination"))
    prop = F.struct(
        p.alias("pk"),
        F.concat(F.lit("P"), p).alias("id"),
        F.col("p_name").alias("titre"),
        F.concat_ws(" ", "p_type", "p_brand").alias("descriptif"),
        _pick([None, "0", "", "3", "abc"], p % 6).alias("piece_fixed"),
        (F.col("p_size") % 6).cast("string").alias("piece_size"),
        (F.col("p_size") * 10).cast("string").alias("surface"),
        F.floor(F.col("p_retailprice") * 100).cast("bigint").alias("cout_mensuel"),
        (F.col("p_size") % 3).cast("string").alias("wc_douche_interne"),
        _pick(["Titre foncier", None], p % 2).alias("papier_propriete"),
        F.when(p % 9 != 0, F.struct(F.concat(F.lit("Rue "), p).alias("libelle"))).alias("adresse"),
        F.when(p % 5 != 0, named(F.lit("Lomé"))).alias("ville"),
        named(F.concat(F.lit("Q"), p % 11)).alias("quartier"),
        named(_pick(["Location", "Vente"], p % 2)).alias("offre"),
        named(_pick(["Villa", "Appartement", "Terrain"], p % 3)).alias("categorie_propriete"),
        F.when(p % 4 == 0, F.array(F.struct(F.concat(F.lit("https://img.example/p/"), p, F.lit(".jpg")).alias("url")),
                                   F.struct(F.lit("").alias("url"))))
         .when(p % 4 == 1, F.array().cast("array<struct<url:string>>"))
         .when(p % 4 == 3, F.array(F.struct(F.concat(F.lit("https://img.example/p/"), p, F.lit("-b.jpg")).alias("url")),
                                   F.struct(F.lit(None).cast("string").alias("url"))))
         .alias("visuels"),
    )
    # piece: the 6th variant is the part size as text
    prop = prop.withField("piece", F.when(p % 6 == 5, prop["piece_size"]).otherwise(prop["piece_fixed"])) \
               .dropFields("piece_fixed", "piece_size")
    docs = (part.select((p / page_size).cast("bigint").alias("doc_id"), prop.alias("prop"))
            .groupBy("doc_id").agg(F.array_sort(F.collect_list("prop")).alias("props")))
    body = F.when(F.col("doc_id") % 16 == 5, F.to_json(F.struct(F.struct().alias("data")))) \
            .otherwise(F.to_json(F.struct(F.struct(F.struct(F.col("props").alias("data"))
                                                   .alias("getAllProperties")).alias("data"))))
    return docs.select("doc_id", body.alias("response"))


def _rooms(piece):
    """int(piece or 0) of a JSON value. A number is truncated; a text must
    be an integer, any other gives NULL (instead of aborting the response)."""
    text = piece.try_cast("string")
    number = F.try_variant_get(piece, "$", "double")
    return (F.when(piece.isNull() | F.is_variant_null(piece) | (text == ""), F.lit(0))
             .when(F.schema_of_variant(piece) != "STRING", F.floor(F.abs(number)).try_cast("int") * F.signum(number).cast("int"))
             .when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(text).try_cast("int")))


def flatten_api(docs: DataFrame, response_col: str = "response", cap: int | None = None,
                url_prefix: str = API_URL_PREFIX, source: str = API_SOURCE) -> DataFrame:
    """``data.getAllProperties.data[]`` -> one listing per property.

    Missing levels give no rows. Every property of a response is read; the
    number per response is the request's ``first:`` argument (L1), so a bound
    here is only for callers that ask for one.
    """
    parsed = docs.select(F.col("doc_id"), F.from_json(F.col(response_col), API_RESPONSE).alias("r"))
    data = F.col("r.data.getAllProperties.data")
    props = parsed.select("doc_id", F.posexplode(data if cap is None else F.slice(data, 1, cap)).alias("pos", "p"))
    p = lambda f: F.col(f"p.{f}")
    urls = F.filter(F.transform(p("visuels"), lambda v: v["url"]),
                    lambda u: u.isNotNull() & (u != ""))
    return props.select(
        p("id").alias("listing_id"),
        p("titre").alias("title"),
        p("categorie_propriete.denomination").alias("property_type"),
        p("offre.denomination").alias("offer_type"),
        p("descriptif").alias("description"),
        _rooms(p("piece")).alias("bedrooms"),
        p("surface").alias("square_footage"),
        p("wc_douche_interne").alias("wc_interne"),
        p("papier_propriete").alias("legal_doc"),
        p("cout_mensuel").alias("price"),
        p("adresse.libelle").alias("address"),
        p("ville.denomination").alias("city"),
        p("quartier.denomination").alias("neighborhood"),
        F.concat(F.lit(url_prefix), p("id")).alias("listing_url"),
        F.when(F.size(p("visuels")) > 0, urls).alias("image_urls"),
        F.lit(source).alias("source"),
    )
