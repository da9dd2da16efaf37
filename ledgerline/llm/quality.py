"""Quality classifier: interpolated modified Kneser-Ney perplexity (operator 1).

A trigram model per language is trained on trusted text (labelled good and not
toxic in every label of the document).  A document's perplexity under the model
of its language decides: it is rejected when the perplexity lies above the
``quantile`` of the language's trusted documents that were not trained on.

Tokens are runs of non-space characters, as written, and a closing mark.

Every trusted document counts, whole: the hash of the id deals them into two halves, one trains
the models, the other sets the thresholds, so that no threshold comes from text that a model
has read.  ``train_docs`` (documents a language) and ``train_words`` (words a document) bound the training
for a caller who asks for it; by default nothing is bounded.

Plan.  Models and scores are those of :mod:`ledgerline.llm.kneser_ney`: n-grams lie in buckets, training and scoring go by
parts, and what a part has shuffled or written goes before the next, so that disk stays near the input's size and nothing
has to fit one task or the driver.  Thresholds come from a histogram of log perplexities, not from sorted values.

Defined results: null text counts as empty; a text without words has a null
perplexity and is kept; so is a document whose language has no trusted text
(null is a language of its own); rows repeated with the same id and text get
the same decision; without labels every document is kept; an empty table gives
an empty result; ids with contradicting labels are not trusted.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, packed, unpacked, written
from ledgerline.llm.kneser_ney import score, train

QUANTILE = 0.99  # beyond it, more clean documents are lost than bad ones found (README)
START, END = "\x02", "\x03"  # how a plain statement of the model may write the marks; see ngrams
SPACES = r"[\x20\x09-\x0D]+"
TRAIN_DOCS = TRAIN_WORDS = math.inf  # half of all trusted documents, whole
STEPS = 1000  # histogram cells a unit of log10 perplexity


def words(text) -> F.Column:
    """Words of a text column, an empty array without any."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES, -1), lambda w: w != "")


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.min(F.expr("case when quality = 1 and coalesce(toxic, 0) = 0 then 1 else 0 end")).alias("good")) \
        .where("good = 1").select("doc_id")


def thresholds(scores: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``lang, threshold``: upper edge of the histogram cell that holds the quantile of ``log10_perplexity``."""
    cells = scores.groupBy("lang", F.ceil(F.col("log10_perplexity") * STEPS).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    ordered = cells.selectExpr("lang", "cell", "sum(n) over (partition by lang order by cell) as upto",
                               "sum(n) over (partition by lang) as total")
    return ordered.where(F.col("upto") >= F.col("total") * quantile).groupBy("lang") \
        .agg((F.min("cell") / STEPS).alias("threshold"))


def classify(docs: DataFrame, labels: DataFrame, train_docs: float = TRAIN_DOCS, train_words: float = TRAIN_WORDS,
             quantile: float = QUANTILE) -> DataFrame:
    """``doc_id, k, lang, log10_perplexity, threshold, keep`` of every distinct (id, text); k is the row's key."""
    good = written(trusted_ids(labels), "trusted")
    meta = docs.select("doc_id", "lang").join(good, "doc_id")
    sizes = meta.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("lang", "l1")
    draw = F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1_000_000))
    chosen = meta.join(sizes, F.expr("lang <=> l1")) \
        .where(draw < F.least(F.lit(500_000.0), F.lit(1_000_000.0 * train_docs) / F.col("n"))).select("doc_id").distinct()
    chosen = written(chosen, "train-ids")
    spoken, scratch = words(F.col("text")), Scratch()
    texts = docs.select("doc_id", "lang", "text").where(draw < 500_000).join(chosen, "doc_id").select("lang", "text") \
        .where((F.size(spoken) > 0) & (F.size(spoken) <= F.lit(train_words)))
    texts = scratch.written(texts, "train-texts")
    model = train(texts.select("lang", spoken.alias("words")))
    scratch.drop()
    scores = written(score(docs.select("doc_id", "text", "lang"), model), "perplexity")
    model.scratch.drop()
    judged = scores.join(good, "doc_id", "left_semi").join(chosen, "doc_id", "left_anti")
    limits = thresholds(judged, quantile).withColumnRenamed("lang", "l2")
    x = scores.join(limits, F.expr("lang <=> l2"), "left").drop("l2")
    return x.withColumn("keep", F.expr("coalesce(log10_perplexity <= threshold, true)"))


def keep_good(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps; all columns pass unchanged."""
    bad = written(classify(docs.select("doc_id", "text", "lang"), labels, **params).where("not keep").select(
        F.col("doc_id").alias("id"), "k"), "rejected")
    rows = packed(docs).withColumn("k", F.xxhash64(F.col("doc_id"), F.col("row.text"))).alias("d")
    return rows.join(bad.distinct().alias("b").hint("shuffle_hash"), F.expr("d.doc_id <=> b.id and d.k = b.k"), "left_anti") \
        .select(*unpacked(docs.columns))


def decisions(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """``doc_id, lang, perplexity, threshold, keep`` of every row of ``docs``, joined on the row's key."""
    docs = docs.select("doc_id", "text", "lang")
    found = classify(docs, labels, **params).select(
        F.col("doc_id").alias("id"), F.col("k").alias("key"), F.col("lang").alias("l"), "log10_perplexity", "threshold", "keep")
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("k"), "lang")
    return rows.join(found, F.expr("doc_id <=> id and k = key and lang <=> l"), "left").select(
        "doc_id", "lang", F.pow(F.lit(10.0), "log10_perplexity").alias("perplexity"),
        F.pow(F.lit(10.0), "threshold").alias("threshold"), F.coalesce("keep", F.lit(True)).alias("keep"))


def query(spark, sf_dir: str) -> DataFrame:
    """op1: every document's perplexity, its language's threshold and the decision."""
    return decisions(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
