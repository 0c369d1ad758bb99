"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, documents drawn without looking at
labels the unlabelled part. A linear classifier over words and word beginnings
minimises the class-prior-corrected risk: the prior times the positives' loss
as toxic, plus the unlabelled loss as clean less the positives' share in it;
when that second part turns negative (a sign of overfitting) the step undoes it
instead. One classifier per bag of unlabelled documents is trained in numpy in
its own task; a document's score is the mean of their logits as a probability.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import U64, mix64, text_rows
from .tokens import slices

THRESHOLD = 0.3
BAGS = 4
POSITIVES = 4000        # bound on the sampled toxic documents
UNLABELLED = 20000      # bound on the sampled unlabelled documents, all bags together
BEGINNINGS = (4, 5, 6)  # lengths of the word beginnings that are features
LEAST_SHARE = 0.02      # of the positives, that a feature must occur in
LEAST_COUNT = 5         # positives that a feature must occur in
LEAST_LIFT = 5.0        # times as often in positives as in unlabelled (half of what the prior allows, if that is less)
EPOCHS = 300
TRIM = " .,;:!?*#$%&|()[]{}<>\"'`~^_=+/\\-"


def held_out(doc_id):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _hash(values: pa.Array, kind: int) -> np.ndarray:
    coded = values.dictionary_encode()
    known = pd.util.hash_array(np.array(coded.dictionary.to_pylist(), dtype=object), categorize=False) if len(coded) else np.empty(0, U64)
    known = mix64(known ^ U64((kind + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return known[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else known


def word_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per occurrence of a word: its text and its entry in the table of distinct words' feature hashes (0: none)."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    coded = pc.list_flatten(lists).dictionary_encode()
    words = pc.utf8_trim(pc.utf8_lower(coded.dictionary), TRIM)
    length = pc.utf8_length(words).to_numpy(zero_copy_only=False) if len(words) else np.empty(0, int)
    table = [np.where(length > 0, _hash(words, 0), U64(0))]
    for k in BEGINNINGS:
        table.append(np.where(length >= k, _hash(pc.utf8_slice_codeunits(words, 0, k), k), U64(0)))
    return doc, coded.indices.to_numpy(zero_copy_only=False), np.stack(table, axis=1)


def _sample_rows(batches):
    """Distinct feature hashes of each sampled document, one row per bag that uses it."""
    for batch in batches:
        for part in slices(batch):
            doc, at, table = word_features(part.column("text"))
            positive = part.column("positive").to_numpy(zero_copy_only=False)
            bag = part.column("bag").to_numpy(zero_copy_only=False)
            ends = np.searchsorted(doc, np.arange(part.num_rows + 1))
            rows = []
            for i in range(part.num_rows):
                feats = np.unique(table[np.unique(at[ends[i]:ends[i + 1]])])
                raw = feats[feats > 0].astype("<u8").tobytes()
                rows += [(b, int(positive[i]), raw) for b in (range(BAGS) if positive[i] else [int(bag[i])])]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                              pa.array([r[2] for r in rows], pa.binary())], names=["bag", "positive", "feats"])


def train(pos: list[np.ndarray], unl: list[np.ndarray], prior: float, epochs: int = EPOCHS, rate: float = 0.1, decay: float = 3e-4):
    """Feature hashes, weights and bias of one non-negative PU classifier with the logistic loss."""
    def count(rows):
        return np.unique(np.concatenate(rows) if rows else np.empty(0, U64), return_counts=True)
    names, df_p = count(pos)
    all_u, df_u = count(unl)
    at = np.searchsorted(all_u, names)
    in_u = np.zeros(len(names))
    hit = (at < len(all_u)) & (all_u[np.minimum(at, max(len(all_u) - 1, 0))] == names if len(all_u) else False)
    in_u[hit] = df_u[at[hit]]
    lift = (df_p / max(len(pos), 1)) / ((in_u + 0.5) / (len(unl) + 1))
    names = names[(df_p >= max(LEAST_COUNT, LEAST_SHARE * len(pos))) & (lift >= min(LEAST_LIFT, 0.5 / prior))]

    def indexed(rows):
        doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        flat = np.concatenate(rows) if rows else np.empty(0, U64)
        i = np.searchsorted(names, flat)
        ok = (i < len(names)) & (names[np.minimum(i, max(len(names) - 1, 0))] == flat) if len(names) else np.zeros(len(flat), bool)
        return doc[ok], i[ok]
    (dp, fp), (du, fu) = indexed(pos), indexed(unl)
    bias = float(np.log(prior / (1 - prior)))
    w, b = np.zeros(len(names)), bias
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for t in range(1, epochs + 1):
        gp = b + np.bincount(dp, w[fp], len(pos))
        gu = b + np.bincount(du, w[fu], len(unl))
        sp, su = 1 / (1 + np.exp(-gp)), 1 / (1 + np.exp(-gu))
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        up, uu = prior * sp / max(len(pos), 1), su / max(len(unl), 1)           # slopes of the clean part
        if negative >= 0:
            cp, cu = prior * (sp - 1) / max(len(pos), 1) - up, uu
        else:                                                                   # undo the overfitted part
            cp, cu = up, -uu
        grad = np.append(np.bincount(fp, cp[dp], len(names)) + np.bincount(fu, cu[du], len(names)) + decay * w,
                         cp.sum() + cu.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return names, w, b


def _train_bag(prior: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [np.frombuffer(x, "<u8") for x in pdf["feats"]]
        is_pos = pdf["positive"].to_numpy() == 1
        names, w, b = train([r for r, y in zip(rows, is_pos) if y], [r for r, y in zip(rows, is_pos) if not y], prior)
        return pd.DataFrame([(names.astype("<u8").tobytes(), w.astype("<f8").tobytes(), b)], columns=["names", "weights", "bias"])
    return run


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED):
    """Feature hashes (sorted), weights and bias of the mean classifier.

    Positives: rows labelled toxic that are not held out; unlabelled: rows drawn
    by a hash of ``doc_id`` whatever their label, held-out rows left aside. Both
    samples are bounded by the parameters. Conflicting labels of one ``doc_id``:
    toxic if any is. Without positives every score is the prior.
    """
    spark = docs.sparkSession
    marks = labels.where("doc_id is not null and toxic is not null").where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n_marked, n_toxic = marks.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = min(max(n_toxic / n_marked, 1e-4), 0.5) if n_marked else 1e-4
    if not n_toxic:
        return np.empty(0, U64), np.empty(0), float(np.log(prior / (1 - prior)))
    rows = text_rows(docs).where("doc_id is not null").where(~held_out("doc_id"))
    total = rows.count()
    draw = (F.xxhash64("doc_id", F.lit(17)) / F.lit(2.0 ** 64) + 0.5)
    toxic = (rows.join(marks.where("toxic = 1").where(draw < positives / n_toxic).select("doc_id"), "doc_id", "left_semi")
             .withColumns({"positive": F.lit(True), "bag": F.lit(0)}))
    other = rows.where(draw < unlabelled / max(total, 1)).withColumns({"positive": F.lit(False), "bag": F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(BAGS)).cast("int")})
    models = (toxic.unionByName(other).select("text", "positive", "bag")
              .mapInArrow(_sample_rows, "bag int, positive int, feats binary")
              .groupBy("bag").applyInPandas(_train_bag(prior), "names binary, weights binary, bias double").collect())     # BAGS rows
    names = np.concatenate([np.frombuffer(m["names"], "<u8") for m in models] or [np.empty(0, U64)])
    weights = np.concatenate([np.frombuffer(m["weights"], "<f8") for m in models] or [np.empty(0)])
    names, at = np.unique(names, return_inverse=True)
    return names, np.bincount(at, weights, len(names)) / max(len(models), 1), float(np.mean([m["bias"] for m in models])) if models else float(np.log(prior / (1 - prior)))


def _score(model):
    names, weights, bias = model

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                doc, at, table = word_features(part.column("text"))
                i = np.searchsorted(names, table)
                known = np.where((table > 0) & (names[np.minimum(i, len(names) - 1)] == table), i, -1) if len(names) else np.full(table.shape, -1)
                hit = (known >= 0).any(axis=1)[at] if len(at) else np.empty(0, bool)
                pairs = (doc[hit][:, None] * (len(names) + 1) + known[at[hit]] + 1).ravel()
                pairs = np.unique(pairs[pairs % (len(names) + 1) > 0])
                logit = bias + np.bincount(pairs // (len(names) + 1), weights[pairs % (len(names) + 1) - 1] if len(names) else None, part.num_rows)
                out = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.float64())], names=["doc_id", "score"])
    return run


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every document.

    The score sees the text only. Null text is empty and has the score of a
    text without known words; rows with a null ``doc_id`` are scored and not
    held out; repeated rows each get a row; extra columns are ignored.
    """
    model = fit(docs, labels)
    scored = text_rows(docs).mapInArrow(_score(model), "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is below the threshold, all columns as they were."""
    kinds = docs.schema
    model = fit(docs, labels)
    names, weights, bias = model

    def run(batches):
        for batch in batches:
            text = batch.column("text").cast(pa.large_string()).fill_null("")
            probe = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), text], names=["doc_id", "text"])
            score = np.concatenate([b.column("score").to_numpy() for b in _score(model)([probe])] or [np.empty(0)])
            yield batch.filter(pa.array(score < threshold))
    return docs.mapInArrow(run, kinds)
