import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from habita.llm.common import materialize
from habita.llm.tokens import tokenizer_path
from habita.session import read_table

from ..conftest import SF_SMALL
from . import brute


def test_stages_against_brute_force(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    toxic = materialize(corpus_pipeline.reject_toxic(spark, docs, SF_SMALL), "t")
    assert toxic.schema == docs.schema and toxic.count() <= docs.count()
    whole = {tuple(r) for r in docs.collect()}
    texts = {r["doc_id"]: r["text"] for r in toxic.collect()}
    assert {tuple(r) for r in toxic.collect()} <= whole
    near = materialize(corpus_pipeline.one_of_each_group(spark, toxic, SF_SMALL), "n")
    sets = {i: brute.shingles(t) for i, t in texts.items()}
    comp = brute.components(sets, brute.near_links(sets))
    assert near.columns == docs.columns and {r["doc_id"] for r in near.collect()} == set(comp.values())
    left = [(r["doc_id"], r["text"]) for r in near.collect()]
    cut = materialize(corpus_pipeline.cut_repeats(spark, near, SF_SMALL), "c")
    want = {i: kept.decode("utf-8", "ignore") for i, (kept, _) in brute.without_repeats(left).items()}
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == want and all(r["n_chars"] == len(r["text"]) for r in cut.collect())
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = {i: np.array(tokenizer.encode(t, add_special_tokens=False).ids + [0], "<u4") for i, t in want.items()}
    packed = corpus_pipeline.pack(spark, cut, SF_SMALL).collect()
    assert sum(r["length"] for r in packed) == sum(map(len, ids.values()))
    assert all(zlib.crc32(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for r in packed)
    ran = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in ran.collect()) == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed)


def test_stages_keep_odd_rows(spark, odd_docs, no_docs):
    near = corpus_pipeline.one_of_each_group(spark, odd_docs, SF_SMALL)
    assert near.columns == odd_docs.columns
    ids = [r["doc_id"] for r in near.collect()]
    assert ids.count(1) == 1 and 2 not in ids and ids.count(None) == 2 and {4, 5, 6} <= set(ids)
    assert corpus_pipeline.one_of_each_group(spark, no_docs, SF_SMALL).count() == 0
    assert corpus_pipeline.cut_repeats(spark, no_docs, SF_SMALL).count() == 0
    assert corpus_pipeline.reject_toxic(spark, odd_docs, SF_SMALL).columns == odd_docs.columns


def test_columns_of_any_name_pass_through_all_stages(spark, odd_docs):
    """Names that operators use inside come out as they went in, at every stage."""
    names = ["_text", "text_hash", "spans", "copied", "mark_id", "mark_spans", "mark_copied", "mark_name", "uid", "score", "component_id", "h", "tie", "keys", "__row"]
    docs = materialize(odd_docs.select("*", *[F.concat(F.lit(f"{n}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n)
                                              for n in names if n not in odd_docs.columns]), "docs")
    extra = [c for c in docs.columns if c not in ("text", "n_chars")]
    want = {tuple(r) for r in docs.select(extra).collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF_SMALL), name)
        rows = [tuple(r) for r in docs.select(extra).collect()]
        assert docs.columns[:len(odd_docs.columns)] == odd_docs.columns and set(rows) <= want and len(rows) > 10, name
    assert corpus_pipeline.pack(spark, docs, SF_SMALL).count() >= docs.count()
