"""URL filter by host reputation: empirical-Bayes shrinkage with DataFrame operators only.

Outcomes of labelled pages (a page is bad if its label has quality 0 or toxic 1)
are counted per host. A host's bad share gets a beta prior centred on its
registered domain's posterior mean, a domain's on its suffix's, a suffix's on
the overall share. The prior strength of each level is fitted to all groups of
that level by the analysis-of-variance estimate of the beta-binomial
correlation. A host is blocked when the lower bound of its posterior lies above
``MAX_BAD``; explicit rules come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# (host, path prefix, verdict)
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
MAX_BAD = 0.3       # block when the posterior lower bound of the bad share is above this
Z = 1.645           # one-sided 95 % bound
WEAKEST, STRONGEST, UNFITTED = 1.0, 1000.0, 10.0     # limits of a fitted prior strength; where groups cannot tell it
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1, F.length(rest) + 1), "^[^?#]*", 0)
    return F.coalesce(F.translate(raw, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def best_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (host and all its subdomains, path prefix)."""
    name = verdict = None
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return (name, verdict) if rules else (F.lit(None).cast("string"),) * 2


def _strength(groups: DataFrame) -> float:
    """Prior strength 1/rho - 1 of one level from its groups' (n, bad); three sums reach the driver."""
    g = groups.where("n > 0").agg(
        F.count("*").alias("m"), F.sum("n").alias("n"), F.sum("bad").alias("k"), F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("kk")).first()
    m, n = g["m"], g["n"] or 0
    if m < 2 or n <= m:
        return UNFITTED
    p = g["k"] / n
    between = (g["kk"] - n * p * p) / (m - 1)
    within = (g["k"] - g["kk"]) / (n - m)
    n0 = (n - g["nn"] / n) / (m - 1)
    bottom = between + (n0 - 1) * within
    rho = (between - within) / bottom if bottom > 0 else 0.0
    return min(max(1 / rho - 1, WEAKEST), STRONGEST) if rho > 0 else STRONGEST


def host_reputation(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per host of ``pages``: labelled outcomes, posterior mean and lower bound of the bad share.

    A label's ``doc_id`` is the page's ``page_id``; labels with a null quality
    and a null toxic mark count as not bad. Hosts without labelled pages have
    their domain's posterior.
    """
    host, _ = url_parts(F.col("url"))
    seen = labels.groupBy(F.col("doc_id").alias("page_id")).agg(
        F.count("*").alias("n"),
        F.sum(F.when((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1), 1).otherwise(0)).alias("bad"))
    hosts = (pages.select("page_id", host.alias("host")).join(seen, "page_id", "left")
             .groupBy("host").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
             .select("host", F.regexp_extract("host", r"[^.]+\.[^.]+$|[^.]*$", 0).alias("domain"),
                     F.regexp_extract("host", r"[^.]*$", 0).alias("suffix"), "n", "bad"))
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("dn"), F.sum("bad").alias("dbad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("dbad").alias("sbad"))
    total = suffixes.agg(F.sum("sn").alias("n"), F.sum("sbad").alias("bad")).first()
    mean = total["bad"] / total["n"] if total["n"] else 0.0       # nothing labelled: nothing is known against a host
    ks = _strength(suffixes.select(F.col("sn").alias("n"), F.col("sbad").alias("bad")))
    kd = _strength(domains.select(F.col("dn").alias("n"), F.col("dbad").alias("bad")))
    kh = _strength(hosts)
    chain = (hosts.join(domains.join(suffixes, "suffix"), ["suffix", "domain"])
             .withColumn("suffix_mean", (F.lit(ks * mean) + F.col("sbad")) / (F.lit(ks) + F.col("sn")))
             .withColumn("domain_mean", (F.lit(kd) * F.col("suffix_mean") + F.col("dbad")) / (F.lit(kd) + F.col("dn")))
             .withColumn("size", F.lit(kh) + F.col("n"))
             .withColumn("bad_mean", (F.lit(kh) * F.col("domain_mean") + F.col("bad")) / F.col("size")))
    spread = F.sqrt(F.col("bad_mean") * (1 - F.col("bad_mean")) / (F.col("size") + 1))
    return chain.select("host", "n", "bad", "bad_mean", F.greatest(F.col("bad_mean") - F.lit(Z) * spread, F.lit(0.0)).alias("bad_low"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules=RULES, max_bad: float = MAX_BAD) -> DataFrame:
    """Verdict for every page: page_id, host, path, rule, verdict, bad_mean, bad_low.

    A null url or one without ``://`` has an empty host and path, fits no rule
    and is judged as the host ''. Null page ids are kept (and never labelled);
    repeated rows each get a row; extra columns are ignored.
    """
    host, path = url_parts(F.col("url"))
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    judged = host_reputation(pages, labels).select("host", "bad_mean", "bad_low")
    return (pages.select("page_id", host.alias("host"), path.alias("path"))
            .join(judged, "host", "left")
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(verdict, F.when(F.col("bad_low") > max_bad, "block").otherwise("allow")).alias("verdict"),
                    "bad_mean", "bad_low"))
