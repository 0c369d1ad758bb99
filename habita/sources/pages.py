"""HTML pages as a table ``pages(page_id, url, html)``.

Crawling is out of scope: pages arrive as rows. Cards are elements of list
pages (one row per card, in document order); detail pages are matched to cards
by URL (J1, see operators.extract).
"""

from __future__ import annotations

from urllib.parse import urljoin

from pyspark.sql import DataFrame, functions as F

from ..functions.dom import first, select_rows
from ..functions.text import py_strip
from ..schemas import AJAX_ENVELOPE


def _link_cards(root, url):
    """Every list item is a card: its first link, that link's first text and title attribute."""
    for pos, li in enumerate(root.find("li")):
        a = first(li.find("a"))
        if a is not None and "href" in a.attrs:
            yield pos, urljoin(url or "", a.attrs["href"]), first(a.texts()), a.attrs.get("title")


def link_cards(pages: DataFrame, html_col: str = "html", keep=("page_id", "url")) -> DataFrame:
    """Generic list page: every ``<li>`` holding a link is a card.

    listing_url = the link resolved against the page URL (E1), listing_id =
    md5 of it (E2), title = the stripped link text, falling back to the
    link's ``title`` attribute (E3). Cards without a URL are dropped (F5).
    """
    cards = select_rows(pages, _link_cards, "pos int, listing_url string, text string, alt string", keep, html_col)
    title = F.coalesce(F.nullif(py_strip("text"), F.lit("")), F.col("alt"))
    return (cards.select(*keep, "pos", "listing_url", title.alias("title"))
            .where(F.col("listing_url") != "")
            .withColumn("listing_id", F.md5("listing_url")))


def ajax_envelopes_from_pages(pages: DataFrame) -> DataFrame:
    """Adapter: one 'load more' envelope per page, whose ``html`` is the page's
    navigation list. Fixed edge rules: one page in 50 (page_id % 50 = 3) sends
    truncated JSON, page_id % 50 = 4 sends an empty ``html``."""
    pid = F.col("page_id")
    nav = F.regexp_extract("html", r"(?s)(<(?i:ul)\b.*?</(?i:ul)>)", 1)
    html = F.when(pid % 50 == 4, F.lit("")).otherwise(nav)
    env = F.to_json(F.struct(html.alias("html"),
                             F.when(pid % 2 == 0, F.lit("more")).otherwise(F.lit("no_more")).alias("loadmore"),
                             (pid % 5 + 2).cast("int").alias("next_page")))
    body = F.when(pid % 50 == 3, F.expr("substring(__env, 1, length(__env) - 1)")).otherwise(F.col("__env"))
    return (pages.select("page_id", "url", env.alias("__env"))
            .select("page_id", "url", body.alias("response")))


def ajax_html(envelopes: DataFrame, response_col: str = "response") -> DataFrame:
    """(page_id, url, html) of the envelopes that parse and hold any HTML."""
    env = envelopes.select("page_id", "url",
                           F.inline(F.array(F.from_json(F.col(response_col), AJAX_ENVELOPE))))
    return env.where(F.col("html").isNotNull() & (F.col("html") != "")).select("page_id", "url", "html")


def ajax_cards(envelopes: DataFrame, response_col: str = "response") -> DataFrame:
    """S7 with the generic card rule, resolved against the request URL."""
    return link_cards(ajax_html(envelopes, response_col))
