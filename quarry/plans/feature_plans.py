"""Registered feature and metric queries (relational TF-IDF, exact split,
class weights, label index, metrics of a fixed rule predictor)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as tx
from ..operators import features as fe
from ..operators import metrics as mt
from ..operators.profile import english_stop_words
from ..session import scratch_path
from ..sources.invoices import invoices, invoices_sql_cte
from ..sources.tables import table
from .profile_plans import CLEAN_SQL
from .sql import q

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


LABELS = ["de", "en", "es", "fr"]
A, B = fixed.SPLIT_FRACTIONS[0], fixed.SPLIT_FRACTIONS[0] + fixed.SPLIT_FRACTIONS[1]


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("lang").alias("label"), tx.clean_for_classifier("text").alias("text"))


def split_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fe.stratified_split(cleaned(spark, sf_dir), "label", "doc_id")


STOP_LIST = "[" + ", ".join(q(w) for w in english_stop_words()) + "]"
RANKED_SQL = f"""ranked AS (
  SELECT doc_id, lang AS label,
         row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR) || ':{fixed.SEED}')) - 1 AS rank,
         count(*) OVER (PARTITION BY lang) AS class_n
  FROM documents),
splits AS (
  SELECT doc_id, label, CASE WHEN rank / class_n < CAST({A!r} AS DOUBLE) THEN 'train'
                             WHEN rank / class_n < CAST({B!r} AS DOUBLE) THEN 'val' ELSE 'test' END AS split,
         CAST(rank % {fixed.CV_FOLDS} AS INTEGER) AS fold
  FROM ranked)"""
TERMS_SQL = f"""clean AS (SELECT doc_id, CASE WHEN sig = '' THEN body ELSE sig || ' ' || body END AS text FROM {CLEAN_SQL}),
toks AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\\pL\\pN_]{{2,}}'),
                                    lambda t: NOT list_contains({STOP_LIST}, t)) AS u FROM clean),
terms AS (SELECT doc_id, unnest(u || list_transform(range(1, len(u)), lambda i: u[i] || ' ' || u[i + 1])) AS term
          FROM toks),
tc AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term)"""
VOCAB_SQL = f"""vocab AS (
  SELECT term, df, cf, row_number() OVER (ORDER BY cf DESC, term) - 1 AS "index" FROM (
    SELECT term, count(*) AS df, sum(tf) AS cf FROM tc JOIN splits USING (doc_id) WHERE split = 'train'
    GROUP BY term HAVING count(*) >= {fixed.MIN_DF} ORDER BY cf DESC, term LIMIT {fixed.MAX_FEATURES})),
idf AS (SELECT term, "index", ln((1 + n) / (1 + df)) + 1 AS idf
        FROM vocab, (SELECT count(*) AS n FROM splits WHERE split = 'train'))"""


@register("tokens_ngrams", f"""
WITH {TERMS_SQL}
SELECT doc_id, CAST(len(u) AS INTEGER) AS n_unigrams, CAST(greatest(len(u) - 1, 0) AS INTEGER) AS n_bigrams,
       array_to_string(u || list_transform(range(1, len(u)), lambda i: u[i] || ' ' || u[i + 1]), '|') AS terms FROM toks""")
def q_tokens_ngrams(spark, sf_dir):
    d = cleaned(spark, sf_dir).select("doc_id", fe.unigrams("text").alias("u"))
    return d.select("doc_id", F.size("u").alias("n_unigrams"),
                    F.greatest(F.size("u") - 1, F.lit(0)).alias("n_bigrams"),
                    F.array_join(fe.with_bigrams(F.col("u")), "|").alias("terms"))


@register("stratified_split", f"WITH {RANKED_SQL} SELECT doc_id, label, split FROM splits")
def q_stratified_split(spark, sf_dir):
    return split_docs(spark, sf_dir).select("doc_id", "label", "split")


@register("stratified_folds", f"WITH {RANKED_SQL} SELECT doc_id, label, fold FROM splits")
def q_stratified_folds(spark, sf_dir):
    return fe.fold_ids(cleaned(spark, sf_dir), "label", "doc_id").select("doc_id", "label", "fold")


SPLITS = ("train", "val", "test")


@register("vocabulary", f"WITH {RANKED_SQL}, {TERMS_SQL}, {VOCAB_SQL} "
          "SELECT term, df, cf, CAST(\"index\" AS BIGINT) AS \"index\" FROM vocab")
def q_vocabulary(spark, sf_dir):
    train = split_docs(spark, sf_dir).where(F.col("split") == "train")
    return fe.vocabulary(fe.doc_terms(fe.doc_unigrams(train)))


@register("tfidf", f"""WITH {RANKED_SQL}, {TERMS_SQL}, {VOCAB_SQL},
w AS (SELECT doc_id, term, tf * idf AS w FROM tc JOIN idf USING (term))
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""")
def q_tfidf(spark, sf_dir):
    sp = split_docs(spark, sf_dir)
    # texts are cleaned and split once: the vocabulary and the weights both read
    # these tokens. A document may have rows in several splits: each counts its own terms
    path = scratch_path(spark, f"tokens-{uuid.uuid4().hex}")
    fe.doc_unigrams(sp, by="split", values=SPLITS).write.parquet(path)
    docs = spark.read.parquet(path)
    idf = fe.idf_table(fe.vocabulary(fe.doc_terms(docs)), sp.where(F.col("split") == SPLITS[0]))
    every = fe.doc_terms(docs, [f"u{i}" for i in range(len(SPLITS))])
    return fe.tfidf(every, idf).select("doc_id", "term", F.round("weight", 6).alias("weight"))


@register("append_synthetic_train", f"""WITH {RANKED_SQL}, {invoices_sql_cte('inv')}
SELECT doc_id, 'news' AS doc_type, false AS is_synthetic FROM splits WHERE split = 'train'
UNION ALL SELECT doc_id, 'invoice', true FROM inv""")
def q_append_synthetic_train(spark, sf_dir):
    train = split_docs(spark, sf_dir).where(F.col("split") == "train").select(
        "doc_id", F.lit("news").alias("doc_type"), F.lit(False).alias("is_synthetic"))
    synth = invoices(spark, sf_dir).select("doc_id", F.lit("invoice").alias("doc_type"),
                                          F.lit(True).alias("is_synthetic"))
    return train.unionByName(synth)


@register("class_weights", """
SELECT lang AS label, round(CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)), 6) AS weight
FROM documents GROUP BY lang""")
def q_class_weights(spark, sf_dir):
    w = fe.class_weights(table(spark, sf_dir, "documents").select(F.col("lang").alias("label")), "label")
    return w.select("label", F.round("weight", 6).alias("weight"))


@register("label_encode", """
SELECT lang AS label, row_number() OVER (ORDER BY lang) - 1 AS label_idx
FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)""")
def q_label_encode(spark, sf_dir):
    return fe.label_index(table(spark, sf_dir, "documents").select(F.col("lang").alias("label")), "label")


# -- metrics on a fixed rule predictor ---------------------------------------------------

def rule_predictions(spark, sf_dir) -> DataFrame:
    """A fixed, data-driven language guess (accent letters), used so that
    metric queries have an SQL oracle without a trained model."""
    t = F.col("text")
    pred = (F.when(t.rlike("[éèêç]"), "fr").when(t.rlike("[üßäö]"), "de")
            .when(t.rlike("[ñáíó]"), "es").otherwise("en"))
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("lang").alias("label"), pred.alias("prediction"))


PRED_SQL = """preds AS (
  SELECT doc_id, lang AS label,
         CASE WHEN regexp_matches(text, '[éèêç]') THEN 'fr' WHEN regexp_matches(text, '[üßäö]') THEN 'de'
              WHEN regexp_matches(text, '[ñáíó]') THEN 'es' ELSE 'en' END AS prediction
  FROM documents)"""
PER_CLASS_SQL = PRED_SQL + """,
classes AS (SELECT label AS cls FROM preds UNION SELECT prediction FROM preds),
pc AS (
  SELECT cls, count_if(p.label = cls) AS support, count_if(p.label = cls AND p.prediction = cls) AS tp,
         count_if(p.prediction = cls) AS n_pred
  FROM classes, preds p GROUP BY cls),
m AS (
  SELECT cls, support, tp, n_pred,
         coalesce(CAST(tp AS DOUBLE) / nullif(n_pred, 0), 0.0) AS precision,
         coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0.0) AS recall
  FROM pc),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
      FROM m)"""


@register("confusion_matrix", "WITH " + PRED_SQL + " SELECT label, " + ", ".join(
    f"count_if(prediction = '{lab}') AS {lab}" for lab in LABELS) + " FROM preds GROUP BY label")
def q_confusion_matrix(spark, sf_dir):
    return mt.confusion_matrix(rule_predictions(spark, sf_dir), LABELS)


SUMMARY_SQL = "WITH " + PER_CLASS_SQL + """,
s AS (SELECT round(CAST(sum(tp) AS DOUBLE) / sum(support), 4) AS accuracy, round(avg(f1), 4) AS macro_f1,
             round(sum(f1 * support) / sum(support), 4) AS weighted_f1 FROM f)"""


@register("accuracy", SUMMARY_SQL + " SELECT accuracy FROM s")
def q_accuracy(spark, sf_dir):
    return mt.summary(rule_predictions(spark, sf_dir)).select("accuracy")


@register("macro_f1", SUMMARY_SQL + " SELECT macro_f1 FROM s")
def q_macro_f1(spark, sf_dir):
    return mt.summary(rule_predictions(spark, sf_dir)).select("macro_f1")


@register("weighted_f1", SUMMARY_SQL + " SELECT weighted_f1 FROM s")
def q_weighted_f1(spark, sf_dir):
    return mt.summary(rule_predictions(spark, sf_dir)).select("weighted_f1")


@register("classification_report", "WITH " + PER_CLASS_SQL + """
SELECT cls AS class, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1,
       support FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 4), round(avg(recall), 4), round(avg(f1), 4), sum(support) FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 4),
       round(sum(recall * support) / sum(support), 4), round(sum(f1 * support) / sum(support), 4),
       sum(support) FROM f""")
def q_classification_report(spark, sf_dir):
    return mt.classification_report(rule_predictions(spark, sf_dir))


@register("one_class_f1", "WITH " + PER_CLASS_SQL + " SELECT cls AS class, round(f1, 4) AS f1 FROM f WHERE cls = 'fr'")
def q_one_class_f1(spark, sf_dir):
    pcs = mt.per_class(rule_predictions(spark, sf_dir))
    return pcs.where(F.col("class") == "fr").select("class", F.round("f1", 4).alias("f1"))


@register("fold_mean_std", f"WITH {RANKED_SQL}, " + PRED_SQL + """,
fs AS (SELECT fold, avg(CAST(p.label = p.prediction AS DOUBLE)) AS accuracy
       FROM preds p JOIN splits s ON p.doc_id = s.doc_id GROUP BY fold)
SELECT 'lang_rule' AS model, round(avg(accuracy), 4) AS mean, round(stddev_pop(accuracy), 4) AS std,
       count(*) AS n_folds FROM fs""")
def q_fold_mean_std(spark, sf_dir):
    folds = fe.fold_ids(cleaned(spark, sf_dir), "label", "doc_id").select("doc_id", "fold")
    p = rule_predictions(spark, sf_dir).join(folds, "doc_id")
    scores = p.groupBy("fold").agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"))
    return mt.fold_mean_std(scores.withColumn("model", F.lit("lang_rule")), "accuracy")


# Integer widths as Spark returns them.
from . import sql as S  # noqa: E402

for _name, _types in {
    'vocabulary': {'cf': 'BIGINT'},
    'confusion_matrix': {'de': 'BIGINT', 'en': 'BIGINT', 'es': 'BIGINT', 'fr': 'BIGINT'},
    'classification_report': {'support': 'BIGINT'},
}.items():
    ORACLES[_name] = S.typed(ORACLES[_name], **_types)
