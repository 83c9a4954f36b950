"""The corpus pipeline: language ID, quality, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet to
the shared folder and reads again as the next stage's ``docs``.  All but the last return the columns of
``documents``.  Empty inputs give empty outputs; a null text leaves at the first stage.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lumeval.llm.common import Workspace, maybe_among, read
from lumeval.llm.language_id import UND, id_bucket, fit, predict
from lumeval.llm.ngram_join import jaccard_components, shingle_profile
from lumeval.llm.packing import pack
from lumeval.llm.quality_kn import classify
from lumeval.llm.suffix_dedup import remove_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Share of labelled texts, rightly predicted, that a language's score limit may reject.
SCORE_QUANTILE = 0.005


def score_limits(scored, langs):
    """Least score of each language: the SCORE_QUANTILE of the scores of all texts that are rightly predicted.

    With fewer than 1 / SCORE_QUANTILE of them the quantile over all languages stands in, and without enough
    of these half the way from the score of mere chance to 1, below which no limit lies.
    """
    scored = scored.filter("lang_pred = lang")
    rows = (scored.rollup("lang_pred").agg(F.percentile_approx("score", SCORE_QUANTILE, 10000).alias("q"),
                                           F.count("*").alias("n")).collect())
    known = {r["lang_pred"]: r["q"] for r in rows if r["n"] * SCORE_QUANTILE >= 1}
    least = 0.5 + 0.5 / len(langs)
    return {k: max(least, known.get(k, known.get(None, least))) for k in langs}


def language(spark, docs, sf_dir):
    """Keeps documents in a recognised language; ``lang`` stays as given.

    Buckets 2 to 4 of the ids train the network; all labelled documents set the
    limits, from the one prediction that is then filtered.  A single learned language is told apart from
    scrambled text only.
    """
    langs, model = fit(docs.filter(id_bucket("doc_id") >= 2), "text", "lang", "doc_id", reject=True)
    out = predict(docs, "text", langs, model, COLUMNS)
    if model is None:
        return out.limit(0).select(*COLUMNS)
    out = Workspace(spark, "language").save(out, "scored")
    limits = score_limits(out, langs)
    limit = F.create_map(*[F.lit(v) for pair in limits.items() for v in pair])[F.col("lang_pred")]
    return out.filter((F.col("lang_pred") != UND) & (F.col("score") >= limit)).select(*COLUMNS)


def quality(spark, docs, sf_dir):
    """Keeps documents whose perplexity is within their language's limit."""
    ws = Workspace(spark, "quality_verdict")
    # ids may be null or repeated: a verdict belongs to the id with its text and language
    marked = docs.withColumn("row_key", F.xxhash64("text", F.coalesce("lang", F.lit(""))))
    verdict = classify(spark, marked, read(spark, sf_dir, "labels"), keep=("doc_id", "row_key"))
    good = ws.save(verdict.filter("kept").select(F.col("doc_id").alias("good_id"), F.col("row_key").alias("good_key"))
                   .distinct(), "good")
    return marked.join(good, F.col("doc_id").eqNullSafe(F.col("good_id")) & (F.col("row_key") == F.col("good_key")),
                       "left_semi").select(*COLUMNS)


def near_duplicates(spark, docs, sf_dir):
    """Keeps the document with the smallest id of each group of near copies (one of them if all ids are null)."""
    ws = Workspace(spark, "near_duplicates")
    groups = ws.save(jaccard_components(spark, docs).filter("set_id is not null")
                     .select("doc_id", "component_id", "set_id", "component"), "groups")
    many = groups.groupBy("component").count().filter("count > 1")
    # only texts that may have a copy are moved to be compared
    copied = maybe_among(spark, ws.save(groups.join(many, "component", "left_semi").select("doc_id"), "copied"), "doc_id")
    keep = ws.save(groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id")) & copied(F.col("doc_id")))
                   .groupBy("component", "component_id").agg(F.min("set_id").alias("keep_set"))
                   .withColumnRenamed("component_id", "keep_id"), "keep")
    marked = shingle_profile(docs.filter(copied(F.col("doc_id"))), COLUMNS)
    kept = marked.join(keep, F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("cls") == F.col("keep_set")),
                       "left_semi")
    single = kept.dropDuplicates(["doc_id", "cls"]).select(*COLUMNS)
    return (docs.filter(~copied(F.col("doc_id"))).select(*COLUMNS).unionByName(single)
            .unionByName(marked.filter("cls is null").select(*COLUMNS)))  # without words: no group


def repeated_passages(spark, docs, sf_dir):
    """Cuts repeated 200-byte strings out of the texts; a text that was nothing else goes."""
    out = remove_repeats(spark, docs, COLUMNS, with_text=True)
    return (out.filter((F.col("n_removed") == 0) | F.col("kept_text").rlike(r"\S"))
            .withColumn("text", F.col("kept_text"))
            .withColumn("n_chars", F.char_length("kept_text").cast("long")).select(*COLUMNS))


def packing(spark, docs, sf_dir):
    """Sequences of 2048 token ids, one row per piece."""
    return pack(spark, docs, with_ids=True)


STAGES = [("language ID", language), ("quality classifier", quality), ("n-gram Jaccard join", near_duplicates),
          ("suffix-array dedup", repeated_passages), ("packing", packing)]
#: No stage but the n-gram join has an SQL form.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``."""
    ws = Workspace(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = ws.save(stage(spark, docs, sf_dir), f"stage_{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
