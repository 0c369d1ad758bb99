"""URLs and text lists of pages as column expressions.

What needs the extent of an element is in ``habita.functions.dom``.
"""

from pyspark.sql import Column, functions as F

from .patterns import URL_AUTHORITY, URL_PATH, URL_SCHEME
from .text import py_strip


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def join_stripped(texts) -> Column:
    """Strip each text, drop blanks, join with one space."""
    stripped = F.transform(_c(texts), lambda t: py_strip(t))
    return F.array_join(F.filter(stripped, lambda t: F.length(t) > 0), " ")


def _resolve_path(base_path: Column, ref_path: Column) -> Column:
    """urljoin's path merge: base directory + reference, empty middle segments
    dropped, '.' skipped, '..' popping (never above the root)."""
    base_segs = F.split(base_path, "/")
    base_dir = F.when(F.try_element_at(base_segs, F.lit(-1)) != "",
                      F.slice(base_segs, 1, F.size(base_segs) - 1)).otherwise(base_segs)
    ref_segs = F.split(ref_path, "/")
    segs = F.when(ref_path.startswith("/"), ref_segs).otherwise(F.concat(base_dir, ref_segs))
    n = F.size(segs)
    middle = F.filter(F.slice(segs, 2, F.greatest(n - 2, F.lit(0))), lambda x: x != "")
    # (Python collapses empty middle segments only for path-relative references)
    segs = F.when((n <= 2) | ref_path.startswith("/"), segs).otherwise(
        F.concat(F.slice(segs, 1, 1), middle, F.slice(segs, -1, 1)))
    stack = F.aggregate(
        segs, F.array().cast("array<string>"),
        lambda acc, x: (F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
                         .when(x == ".", acc)
                         .otherwise(F.concat(acc, F.array(x)))))
    last = F.try_element_at(segs, F.lit(-1))
    stack = F.when(last.isin(".", ".."), F.concat(stack, F.array(F.lit("")))).otherwise(stack)
    joined = F.array_join(stack, "/")
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def resolve_url(base, href) -> Column:
    """``urljoin(base, href)`` -- absolute, '//', '/', '?', '#', '' and
    relative references, with Python's path merge. Plain references (no
    '.'/'..' or empty path segment) take direct string expressions."""
    base, href = _c(base), _c(href)
    authority = F.regexp_extract(base, URL_AUTHORITY, 1)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    path = F.regexp_extract(base, URL_PATH, 1)
    base_no_frag = F.regexp_extract(base, r"^([^#]*)", 1)
    base_no_query = F.regexp_extract(base, r"^([^?#]*)", 1)
    ref_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    ref_rest = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    # plain references (no '.'/'..' segment, no empty segment) skip the
    # segment-stack merge: root-relative ones append to the authority, others
    # to the base directory
    plain = ~ref_path.rlike(r"(^|/)\.\.?(/|$)") & ~ref_path.contains("//") & ~path.contains("//")
    directory = F.concat(authority,
                         F.when(path.contains("/"), F.regexp_extract(path, r"^(.*/)", 1))
                          .otherwise(F.lit("/")))
    simple = F.when(href.startswith("/"), F.concat(authority, href)).otherwise(F.concat(directory, href))
    merged = F.when(plain, simple).otherwise(F.concat(authority, _resolve_path(path, ref_path), ref_rest))
    return (F.when(href.isNull(), F.lit(None).cast("string"))
             .when(href.rlike(URL_SCHEME), href)
             .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
             .when(href.startswith("?"), F.concat(base_no_query, href))
             .when(href.startswith("#"), F.concat(base_no_frag, href))
             .when(href == "", base)
             .otherwise(merged))


def url_host(url) -> Column:
    """Host part of a URL (NULL if it does not parse)."""
    return F.try_parse_url(_c(url), F.lit("HOST"))


def host_allowed(url, domains) -> Column:
    """host equals an allowed domain or is a sub-domain of one."""
    host = F.lower(url_host(url))
    cond = F.lit(False)
    for d in domains:
        d = d.lower()
        cond = cond | (host == d) | host.endswith("." + d)
    return F.coalesce(cond, F.lit(False))
