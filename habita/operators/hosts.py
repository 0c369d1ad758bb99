"""Host lists of any size (F6): a host is on a list if it, or a domain above it, is."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.html import url_host


def listed_hosts(hosts: DataFrame, domains: DataFrame) -> DataFrame:
    """Of the column ``host`` the distinct ones that equal a ``domain`` or lie below one (both lower-cased).

    Each distinct host is written once per level (``a.b.c``, ``b.c``, ``c``), which
    makes the test an equi-join: the list may be as long as it likes, and a host
    that a third of all rows share is looked up once.
    """
    one = hosts.select(F.lower("host").alias("host")).where("host is not null").distinct()
    labels = F.split("host", "[.]")
    above = one.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))).alias("domain"))
    wanted = domains.select(F.lower("domain").alias("domain"))
    return above.join(wanted, "domain", "left_semi").select("host").distinct()


def keep_listed(rows: DataFrame, url_col: str, domains: DataFrame) -> DataFrame:
    """Rows whose URL's host is on the list (column ``domain``); a URL without a host is on none."""
    named = rows.withColumn("__host", F.lower(url_host(url_col)))
    listed = listed_hosts(named.select(F.col("__host").alias("host")), domains)
    return named.join(listed.withColumnRenamed("host", "__host"), "__host", "left_semi").drop("__host").select(*rows.columns)
