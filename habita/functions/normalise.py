"""Domain normalisers: property type, offer type, legal documents.

Each follows one source's rule exactly (first match wins, in the stated order).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_match(text: Column, rules, default, *, how: str = "contains") -> Column:
    """``rules`` = [(needle_or_regex, value), ...]; first hit wins, else default.
    how: 'contains' (case-sensitive substring) or 'rlike' (regex)."""
    expr = None
    for needle, value in rules:
        cond = text.contains(needle) if how == "contains" else text.rlike(needle)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(default) if not isinstance(default, Column) else default)


# ---- stream-job normalisers (P3, P4) ---------------------------------------
# Case-insensitive patterns and labels, in priority order.
STREAM_PROPERTY_TYPES = [
    ("(?i)villa", "Villa"),
    ("(?i)maison", "Maison"),
    ("(?i)terrain", "Terrain"),
    ("(?i)appartement", "Appartement"),
]
STREAM_PROPERTY_DEFAULT = "Autre"
STREAM_OFFER_TYPES = [
    ("(?i)lou", "Location"),
    ("(?i)ven", "Vente"),
]
# lenient mode also reads the noun "location" as an offer
LENIENT_OFFER_TYPES = [
    ("(?i)lou|location", "Location"),
    ("(?i)ven", "Vente"),
]
STREAM_OFFER_DEFAULT = "Inconnu"


def stream_property_type(x) -> Column:
    """NULL or no match -> 'Autre'."""
    return first_match(_c(x), STREAM_PROPERTY_TYPES, STREAM_PROPERTY_DEFAULT, how="rlike")


def stream_offer_type(x, lenient: bool = False) -> Column:
    """P4: 'lou' -> Location, 'ven' -> Vente, else 'Inconnu'. In compat mode the
    word 'Location' itself is *not* recognised (it holds no 'lou')."""
    rules = LENIENT_OFFER_TYPES if lenient else STREAM_OFFER_TYPES
    return first_match(_c(x), rules, STREAM_OFFER_DEFAULT, how="rlike")


# ---- spider normalisers over lower-cased titles (E10, E11) ------------------
# Fixed values: (substring, label) in each site's priority order.
TITLE_TYPES_A = [("appartement", "Appartement"), ("villa", "Villa"),
                 ("maison", "Maison"), ("terrain", "Terrain")]
TITLE_TYPES_B = [("terrain", "Terrain"), ("appartement", "Appartement"),
                 ("villa", "Villa"), ("maison", "Maison"), ("studio", "Studio"),
                 ("immeuble", "Immeuble")]
TITLE_TYPES_C = [("villa", "Villa"), ("appartement", "Appartement"),
                 ("terrain", "Terrain"), ("studio", "Studio"), ("maison", "Maison")]
TYPE_DEFAULT = "Autre"


def type_from_title_a(title) -> Column:
    """E10a (card title of the first HTML site)."""
    return first_match(F.lower(F.coalesce(_c(title), F.lit(""))), TITLE_TYPES_A, TYPE_DEFAULT)


def type_from_title_b(title) -> Column:
    """E10b (card title of the classifieds site)."""
    return first_match(F.lower(F.coalesce(_c(title), F.lit(""))), TITLE_TYPES_B, TYPE_DEFAULT)


def type_from_title_c(title, excerpt=None) -> Column:
    """Title + ' ' + excerpt, lower-cased."""
    text = F.lower(F.concat_ws(" ", F.coalesce(_c(title), F.lit("")),
                               F.coalesce(_c(excerpt), F.lit("")) if excerpt is not None else F.lit("")))
    return first_match(text, TITLE_TYPES_C, TYPE_DEFAULT)


OFFER_DEFAULT = "Inconnu"


def offer_from_badge_a(badge) -> Column:
    """Case-sensitive badge text; 'Location' before 'Vente'."""
    b = F.coalesce(_c(badge), F.lit(""))
    return first_match(b, [("Location", "Location"), ("Vente", "Vente")], OFFER_DEFAULT)


def offer_from_title_b(title) -> Column:
    """Lower title; location/louer before vente/vendre."""
    t = F.lower(F.coalesce(_c(title), F.lit("")))
    return (F.when(t.contains("location") | t.contains("louer"), F.lit("Location"))
             .when(t.contains("vente") | t.contains("vendre"), F.lit("Vente"))
             .otherwise(F.lit(OFFER_DEFAULT)))


def offer_from_badge_c(badge) -> Column:
    """Lower badge; 'louer' before 'vente'."""
    b = F.lower(F.coalesce(_c(badge), F.lit("")))
    return first_match(b, [("louer", "Location"), ("vente", "Vente")], OFFER_DEFAULT)


# ---- legal documents (E16, E17) -------------------------------------------
# Keywords in priority order and their sentence-cased labels.
LEGAL_KEYWORDS = [
    ("titre foncier", "Titre foncier"),
    ("permis de construire", "Permis de construire"),
    ("acte de vente", "Acte de vente"),
]
LEGAL_DEFAULT = "Non spécifié"


def legal_doc_first(text, default=LEGAL_DEFAULT) -> Column:
    """First keyword found in the lower-cased text; else ``default``."""
    t = F.lower(F.coalesce(_c(text), F.lit("")))
    return first_match(t, LEGAL_KEYWORDS, default)


def legal_docs_all(text) -> Column:
    """Every keyword found, sentence-cased, ', '-joined; else 'Non spécifié'."""
    t = F.lower(F.coalesce(_c(text), F.lit("")))
    found = F.filter(
        F.array(*[F.when(t.contains(k), F.lit(v)) for k, v in LEGAL_KEYWORDS]),
        lambda e: e.isNotNull())
    return F.when(F.size(found) > 0, F.array_join(found, ", ")).otherwise(F.lit(LEGAL_DEFAULT))


def capitalize(x) -> Column:
    """Python str.capitalize(): first character upper, the rest lower."""
    x = _c(x)
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 30)))
