"""Registered queries of this subpackage and the SQL that some of them must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import read_table
from . import (byte_bpe, embedding_dedup, huffman, minhash, packing, parity_join, periodic, reputation, spelling,
               suffix_dedup, toxicity, wfst, wrapper)


def op6_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (reputation.judge_urls(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))
            .select("page_id", "host", "path", "rule", "verdict"))


def op9_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.link_documents(read_table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprint_edits(read_table(spark, sf_dir, "documents"))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest_without_repeats(read_table(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link_vectors(read_table(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.main_texts(read_table(spark, sf_dir, "pages"))


def op5_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.roundtrip(read_table(spark, sf_dir, "documents"))


def op7_piece_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wfst.encode_documents(read_table(spark, sf_dir, "documents"))


def op8_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest_roundtrip(read_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest_runs(periodic.mark_runs(periodic.tile_tails(read_table(spark, sf_dir, "documents"))))


def queries() -> dict:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_embedding_dedup": op2_embedding_dedup,
        "op3_toxicity": op3_toxicity,
        "op4_main_text": op4_main_text,
        "op5_huffman_ids": op5_huffman_ids,
        "op7_piece_transducer": op7_piece_transducer,
        "op8_pattern_packing": op8_pattern_packing,
        "op6_url_reputation": op6_url_reputation,
        "op9_parity_join": op9_parity_join,
        "op10_fingerprints": op10_fingerprints,
        "op11_byte_bpe": op11_byte_bpe,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_periodic_runs": op13_periodic_runs,
    }


_COMPONENTS = """
  reach(id, other) AS (SELECT a, b FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a)"""

_OP2 = f"""WITH RECURSIVE
  good AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.v, b.v) >= 0.98),{_COMPONENTS}
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
       least(e.vec_id, coalesce((SELECT min(other) FROM reach r WHERE r.id = e.vec_id), e.vec_id)) AS component_id,
       e.vec_id <= coalesce((SELECT min(other) FROM reach r WHERE r.id = e.vec_id), e.vec_id) AS kept
FROM embeddings e"""

_OP9 = f"""WITH RECURSIVE
  words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
  shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
               FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0) x),
  sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
  common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
  links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),{_COMPONENTS}
SELECT d.doc_id, coalesce((SELECT n FROM sizes z WHERE z.doc_id = d.doc_id), 0) AS n_shingles,
       least(d.doc_id, coalesce((SELECT min(other) FROM reach r WHERE r.id = d.doc_id), d.doc_id)) AS component_id
FROM documents d"""


def _strength_sql(groups: str, n: str, k: str) -> str:
    return (f"(SELECT CASE WHEN m < 2 OR n <= m THEN {reputation.UNFITTED} WHEN b + (n0 - 1) * w <= 0 OR b <= w THEN {reputation.STRONGEST} "
            f"ELSE least(greatest((b + (n0 - 1) * w) / (b - w) - 1, {reputation.WEAKEST}), {reputation.STRONGEST}) END FROM ("
            f"SELECT m, n, (kk - k * k / n) / (m - 1) AS b, (k - kk) / (n - m) AS w, (n - nn / n) / (m - 1) AS n0 FROM ("
            f"SELECT count(*)::DOUBLE AS m, sum({n})::DOUBLE AS n, sum({k})::DOUBLE AS k, sum({n} * {n})::DOUBLE AS nn, sum({k}::DOUBLE * {k} / {n}) AS kk "
            f"FROM {groups} WHERE {n} > 0) x) y)")


def _op6() -> str:
    fits = lambda h, p: f"(host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}')"      # noqa: E731
    rules = sorted(reputation.RULES, key=lambda r: -len(r[0] + r[1]))
    rule = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p, _ in rules) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for h, p, v in rules) + f" ELSE CASE WHEN low > {reputation.MAX_BAD} THEN 'block' ELSE 'allow' END END"
    return f"""WITH
  cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
  parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{reputation.UPPER}', '{reputation.LOWER}') AS host,
                   regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*', 0)) + 1), '^[^?#]*', 0) AS path FROM cut),
  seen AS (SELECT doc_id, count(*) AS n, sum(CASE WHEN coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
  hosts AS (SELECT host, regexp_extract(host, '[^.]+[.][^.]+$|[^.]*$', 0) AS domain, regexp_extract(host, '[^.]*$', 0) AS suffix,
                   coalesce(sum(n), 0) AS n, coalesce(sum(bad), 0) AS bad FROM parts LEFT JOIN seen ON page_id = doc_id GROUP BY host),
  domains AS (SELECT suffix, domain, sum(n) AS dn, sum(bad) AS dbad FROM hosts GROUP BY 1, 2),
  suffixes AS (SELECT suffix, sum(dn) AS sn, sum(dbad) AS sbad FROM domains GROUP BY 1),
  fit AS (SELECT (SELECT coalesce(sum(sbad)::DOUBLE / nullif(sum(sn), 0), 0) FROM suffixes) AS mean, {_strength_sql('suffixes', 'sn', 'sbad')} AS ks,
                 {_strength_sql('domains', 'dn', 'dbad')} AS kd, {_strength_sql('hosts', 'n', 'bad')} AS kh),
  means AS (SELECT host, kh + n AS size, (kh * ((kd * ((ks * mean + sbad) / (ks + sn)) + dbad) / (kd + dn)) + bad) / (kh + n) AS m
            FROM hosts JOIN domains USING (suffix, domain) JOIN suffixes USING (suffix), fit),
  lows AS (SELECT host, greatest(m - {reputation.Z} * sqrt(m * (1 - m) / (size + 1)), 0) AS low FROM means)
SELECT page_id, host, path, {rule} AS rule, {verdict} AS verdict FROM parts JOIN lows USING (host)"""


def oracle_sql() -> dict[str, str]:
    return {"op2_embedding_dedup": _OP2, "op6_url_reputation": _op6(), "op9_parity_join": _OP9}
