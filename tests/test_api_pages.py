"""S4 API flattening edge cases, S7 AJAX envelopes, J1 card/detail join."""

import json

from pyspark.sql import functions as F

from habita.operators.extract import join_card_detail
from habita.sources.api import flatten_api
from habita.sources.pages import ajax_cards


def test_api_missing_levels_and_fields(spark):
    prop = lambda **kw: dict({"id": "1", "titre": "t", "cout_mensuel": 100}, **kw)
    docs = [
        {"data": {"getAllProperties": {"data": [
            prop(id="a", piece=None, visuels=[{"url": "u1"}, {"url": ""}, {"url": None}]),
            prop(id="b", piece="", visuels=[]),
            prop(id="c", piece="0", ville=None, offre={"denomination": "Vente"}),
            prop(id="d", piece=" 3 ", categorie_propriete={"denomination": "Villa"}, adresse={"libelle": "R"}),
            prop(id="e", piece="abc"),
        ]}}},
        {"data": {}}, {"other": 1}, "not json",
    ]
    df = spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)],
                               "doc_id int, response string")
    out = {r["listing_id"]: r for r in flatten_api(df).collect()}
    assert set(out) == {"a", "b", "c", "d", "e"}
    assert out["a"]["image_urls"] == ["u1"] and out["b"]["image_urls"] is None
    assert [out[k]["bedrooms"] for k in "abcde"] == [0, 0, 0, 3, None]
    assert out["c"]["city"] is None and out["c"]["offer_type"] == "Vente"
    assert out["d"]["property_type"] == "Villa" and out["d"]["address"] == "R"
    assert out["a"]["listing_url"].endswith("/a") and out["a"]["source"] == "omnisoft_api"


def test_api_reads_every_property_of_a_response(spark):
    doc = {"data": {"getAllProperties": {"data": [{"id": str(i)} for i in range(2500)]}}}
    df = spark.createDataFrame([(0, json.dumps(doc))], "doc_id int, response string")
    assert flatten_api(df).count() == 2500 and flatten_api(df, cap=2000).count() == 2000


def test_api_rooms_of_numbers_and_texts(spark):
    rooms = [3.0, 3.9, -2.5, 4, "3.0", " 5 ", 0, None, "", "x", True]
    doc = {"data": {"getAllProperties": {"data": [{"id": str(i), "piece": p} for i, p in enumerate(rooms)]}}}
    df = spark.createDataFrame([(0, json.dumps(doc))], "doc_id int, response string")
    got = {int(r["listing_id"]): r["bedrooms"] for r in flatten_api(df).collect()}
    assert [got[i] for i in range(10)] == [3, 3, -2, 4, None, 5, 0, 0, 0, None]


def test_ajax_envelopes(spark):
    cards = '<li><a href="/p/1">One</a></li><li><a href="/p/2"> Two </a></li>'
    envs = [(1, "https://s.example/list", json.dumps({"html": cards, "loadmore": "more", "next_page": 3})),
            (2, "https://s.example/list", '{"html": "<li><a href="'),              # invalid JSON
            (3, "https://s.example/list", json.dumps({"html": "", "loadmore": "no_more"}))]
    df = spark.createDataFrame(envs, "page_id int, url string, response string")
    got = sorted((r["listing_url"], r["title"]) for r in ajax_cards(df).collect())
    assert got == [("https://s.example/p/1", "One"), ("https://s.example/p/2", "Two")]


def test_card_detail_inner_join_one_row_per_url(spark):
    cards = spark.createDataFrame([(1, 0, "u1", "t", ""), (2, 0, "u1", "t2", "5"), (3, 0, "u2", "x", None)],
                                  "page_id int, pos int, listing_url string, title string, square_footage string")
    details = spark.createDataFrame([(7, "u1", "d", "80"), (8, "u1", "d2", "90")],
                                    "page_id int, listing_url string, description string, detail_surface string")
    out = join_card_detail(cards, details).collect()
    assert len(out) == 1                           # u2 has no detail page: dropped
    r = out[0]
    assert (r["title"], r["description"], r["square_footage"]) == ("t", "d", "80")   # '' filled from detail
