"""D3 marts: approximate quartiles against exact nearest-rank quartiles."""

import math

import pandas as pd

import __spark_entry__ as E
from habita.plans import common
from habita.plans.listing_queries import LOCATION_COLS
from tests.conftest import SF_CHECK


def test_price_quartiles_within_sketch_error(spark):
    approx = {(r["city"], r["property_type"]): (r["n_listings"], r["price_quartiles"])
              for r in E.queries()["price_quantiles_approx"](spark, SF_CHECK).collect()}
    pdf = common.latest(spark, SF_CHECK, LOCATION_COLS).select("city", "property_type", "price").toPandas()
    assert approx
    for (city, ptype), g in pdf.groupby(["city", "property_type"], dropna=False):
        v = sorted(g["price"].tolist())
        n = len(v)
        count, qs = approx[(None if pd.isna(city) else city, ptype)]
        assert count == n
        for p, got in zip((0.25, 0.5, 0.75), qs):
            rank = max(math.ceil(p * n) - 1, 0)
            # accuracy 10000: rank error at most n / 10000 (+1 for rounding)
            tol = int(n / 10000) + 1
            assert v[max(rank - tol, 0)] <= got <= v[min(rank + tol, n - 1)], (city, ptype, p)
