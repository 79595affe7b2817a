"""Modelling queries (EC24, IN5 helpers, M1-M19, T7-T12).

Training data is the e-commerce modelling table (label = review class 0/1/2) and
the documents table joined with its quality labels.  Fitted models are Spark ML
jobs; metrics are Spark aggregates over the predictions.  Randomness is seeded
(hash splits, model seeds), so every query returns the same rows on every run.
"""

from __future__ import annotations

import json
from dataclasses import replace
from functools import reduce

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.operators.boosting import Boosting, Prepared, importance
from ledgerline.operators.boosting import fit as boost
from ledgerline.operators.boosting import prepare
from ledgerline.operators.ml import (
    FOREST_NODES,
    accuracy,
    classification_report,
    confusion,
    cross_validate,
    forest_nodes,
    forest_scores,
    hard_label_auc,
    kfold,
    macro_roc,
    ovr_gbt,
    ovr_scores,
    random_forest,
    random_search,
    roc_auc,
    roc_curve,
    run_concurrently,
    score_frame,
    scores_of,
    stratified_folds,
    stratified_split,
)
from ledgerline.operators.orders import LEAD_COLUMNS
from ledgerline.operators.smote import smote, stored_smote
from ledgerline.operators.stepwise import forward
from ledgerline.operators.topics import class_terms, fit_topics, terms_of, topic_terms
from ledgerline.plans.orders import _model
from ledgerline.session import cut_lineage, drop_checkpoint
from ledgerline.sources.store import shared_table
from ledgerline.sources.tables import load_table

FEATURES = [
    *LEAD_COLUMNS,
    "total_payments_method",
    "total_payment_value",
    "number_of_items",
    "price",
    "product_description_lenght",
    "product_photos_qty",
    "product_weight_g",
    "volume_cm3",
    "state_is_equal",
    "num_of_installments",
    "is_boleto",
    "is_credit_card",
    "is_debit_card",
    "is_voucher",
]
SEED = 42


# --------------------------------------------------------------------------- data

def ml_rows(spark: SparkSession, d: str) -> DataFrame:
    """Modelling rows without NULLs (F7): ``row_id``, ``label`` (double), numeric features.
    ``row_id`` is deterministic: review id, a hash of the row, and a counter among identical
    rows (the item fan-out repeats rows; which of them gets which number makes no difference)."""
    m = _model(spark, d).select(
        "review_id",
        F.col("review_category").cast("double").alias("label"),
        *[F.col(c).cast("double").alias(c) for c in FEATURES],
    )
    known = [F.col(c).isNotNull() & ~F.isnan(c) for c in ("label", *FEATURES)]
    m = m.filter(reduce(lambda a, b: a & b, known, F.col("review_id").isNotNull()))
    h = F.xxhash64(*FEATURES)
    dup = F.row_number().over(W.partitionBy("review_id", h).orderBy(F.lit(1)))
    return m.withColumn("row_id", F.concat_ws("|", "review_id", h.cast("string"), dup.cast("string")))


def _split(spark, d):
    """The modelling rows with ``is_test``, written once and read pruned to a part, and ``features`` as a vector."""
    def build():
        return stratified_split(cut_lineage(ml_rows(spark, d)), "label", ["row_id"], 0.2, SEED)

    table = shared_table(spark, "ml_split", d, build, ["is_test"])
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table)


def _parts(spark, d) -> tuple[DataFrame, DataFrame]:
    s = _split(spark, d)
    return s.filter(~F.col("is_test")), s.filter(F.col("is_test"))


def _smoted(spark, d) -> DataFrame:
    """The training rows resampled to even classes, written once."""
    def build():
        train = _parts(spark, d)[0]
        return smote(train.select("row_id", "label", F.array(*FEATURES).alias("f")), "label", "row_id", "f", k=5, seed=SEED)

    return _with_features(shared_table(spark, "ml_smoted", d, build))


def _with_features(res: DataFrame) -> DataFrame:
    columns = [F.col("f")[i].alias(c) for i, c in enumerate(FEATURES)]
    return res.select("row_id", "label", "synthetic", *columns, array_to_vector("f").alias("features"))


def _report_both(model, train: DataFrame, test: DataFrame) -> DataFrame:
    a = classification_report(model.transform(train)).withColumn("split", F.lit("train"))
    b = classification_report(model.transform(test)).withColumn("split", F.lit("test"))
    return a.unionByName(b)


# --------------------------------------------------------------------------- splits and folds

def ml_split_class_counts(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d).groupBy("label", "is_test").agg(F.count(F.lit(1)).alias("n"))


def ml_fold_class_counts(spark: SparkSession, d: str) -> DataFrame:
    train = _parts(spark, d)[0]
    return stratified_folds(train, "label", ["row_id"], 5, SEED).groupBy("fold", "label").agg(
        F.count(F.lit(1)).alias("n"))


def ml_kfold_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows per fold of the plain shuffled folds."""
    return kfold(_parts(spark, d)[0], ["row_id"], 5, SEED).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


def ml_smote_class_counts(spark: SparkSession, d: str) -> DataFrame:
    return _smoted(spark, d).groupBy("label").agg(
        F.count_if(~F.col("synthetic")).alias("n_original"), F.count_if(F.col("synthetic")).alias("n_synthetic"),
        F.count(F.lit(1)).alias("n_total"))


# --------------------------------------------------------------------------- boosted trees, forest

# The source's first and tuned boosted models, and its forest.
INITIAL = Boosting(rounds=1000, max_depth=5, eta=0.01, subsample=0.8, seed=SEED)
TUNED = Boosting(rounds=180, max_depth=5, eta=0.13022300234864176, seed=SEED)
FOREST = {"num_trees": 500, "max_depth": 15, "min_instances": 2, "subset": "log2"}


#: Rows up to which a boosted model is fitted in one task: one alone, and each of several that are fitted side by side.
ALONE, BESIDE = 1 << 19, 1 << 21
#: Rows up to which a task grows trees of a forest on its own.
FOREST_ROWS = 1 << 22


def _boosted(p: Boosting, train: DataFrame | Prepared, one_task: int = ALONE):
    return boost(train, "label", FEATURES, ["row_id"], p, one_task)


def _side_by_side(folds: DataFrame) -> int:
    """How many models are fitted at a time: one per core if each takes one task."""
    return max(4, folds.sparkSession.sparkContext.defaultParallelism) if folds.count() <= BESIDE else 4


def _scored(model, rows: DataFrame) -> DataFrame:
    """Rows with ``label``, ``prediction`` and ``scores`` only."""
    if hasattr(model, "trees") and hasattr(model, "borders"):
        return model.transform(rows.select("label", *FEATURES)).select("label", "prediction", "scores")
    return model.transform(rows.select("label", "features")).select("label", "prediction", vector_to_array("probability").alias("scores"))


def ml_ovr_gbt_report(spark: SparkSession, d: str) -> DataFrame:
    train, test = _parts(spark, d)
    model = ovr_gbt(max_iter=20, max_depth=5, step_size=0.1, subsampling_rate=0.8).fit(train)
    return _report_both(model, train, test)


def ml_ovr_gbt_auc(spark: SparkSession, d: str) -> DataFrame:
    train, test = _parts(spark, d)
    model = ovr_gbt(max_iter=20, max_depth=5, step_size=0.1, subsampling_rate=0.8).fit(train)
    return _auc(ovr_scores(model.transform(test), 3).select("label", "scores"))


def _auc(scored: DataFrame) -> DataFrame:
    """One-vs-rest AUC per class and their mean (class -1)."""
    scored = cut_lineage(scored.select("label", "scores"))  # the model scores each row once
    stacked = scored.select("label", F.posexplode("scores").alias("cls", "score"))
    per = roc_auc(stacked, F.col("label") == F.col("cls"), F.col("score"), by=["cls"])
    macro = per.agg(F.lit(-1).alias("cls"), F.sum("n_pos").alias("n_pos"), F.sum("n_neg").alias("n_neg"),
                    F.avg("auc").alias("auc"))
    return per.unionByName(macro)


def _both(model, train: DataFrame, test: DataFrame) -> DataFrame:
    parts = [classification_report(_scored(model, rows)).withColumn("split", F.lit(name)) for name, rows in (("train", train), ("test", test))]
    return parts[0].unionByName(parts[1])


def ml_gbdt_tuned_report(spark: SparkSession, d: str) -> DataFrame:
    """The tuned boosted model of the source: 180 rounds for three classes, learning rate 0.13, depth 5."""
    train, test = _parts(spark, d)
    return _both(_boosted(TUNED, train), train, test)


def ml_boosted_initial_report(spark: SparkSession, d: str) -> DataFrame:
    """The source's first boosted model: 1000 rounds for three classes, learning rate 0.01, depth 5, subsample 0.8."""
    train, test = _parts(spark, d)
    return _both(_boosted(INITIAL, train), train, test)


def ml_gbdt_tuned_auc(spark: SparkSession, d: str) -> DataFrame:
    train, test = _parts(spark, d)
    return _auc(_scored(_boosted(TUNED, train), test))


def ml_random_forest_report(spark: SparkSession, d: str) -> DataFrame:
    """Forest on SMOTE-resampled training rows (500 trees, depth 15, leaf 2, log2), scored on untouched test rows."""
    scored = forest_scores(_smoted(spark, d), _split(spark, d).select("label", "is_test", "features"), **FOREST, seed=SEED, keys=["row_id"], one_task=FOREST_ROWS)
    scored = cut_lineage(scored.select("label", "is_test", "prediction"))  # both reports read it
    parts = [classification_report(scored.filter(F.col("is_test") == test)).withColumn("split", F.lit(name)) for name, test in (("train", False), ("test", True))]
    return parts[0].unionByName(parts[1])


def ml_feature_importance(spark: SparkSession, d: str) -> DataFrame:
    """Forest: splits, impurity decrease and rows per feature, from the node table of the saved trees."""
    model = random_forest(num_trees=50, max_depth=10, min_instances=2, subset="log2").fit(_parts(spark, d)[0])
    return importance(forest_nodes(model, FEATURES), FEATURES)


def ml_boosted_importance(spark: SparkSession, d: str) -> DataFrame:
    """Boosted trees: splits (weight), mean and total gain and cover per feature."""
    model = _boosted(replace(TUNED, rounds=60), _parts(spark, d)[0])
    return importance(model.node_table(spark), FEATURES)


# The source's search space, but 5 to 30 rounds for its 100 to 1000, with learning rates of 0.2 to 0.8 for its 0.01 to 0.06.
SEARCH_SPACE = {
    "rounds": ("int", 5, 30),
    "eta": ("uniform", 0.2, 0.6),
    "max_depth": ("int", 3, 7),
    "subsample": ("uniform", 0.5, 0.5),
    "gamma": [0, 2],
    "colsample": [0.3, 0.4, 0.5, 0.7],
}


def ml_random_search_gbt(spark: SparkSession, d: str) -> DataFrame:
    """Random search (20 draws, 3 stratified folds, macro recall) over boosted trees."""
    train = _parts(spark, d)[0]
    folds = cut_lineage(stratified_folds(train.select("row_id", "label", *FEATURES), "label", ["row_id"], 3, SEED))
    results = random_search(folds, "fold", 3, SEARCH_SPACE, 20, lambda p, rows: _boosted(Boosting(**p, seed=SEED), rows, BESIDE), "recall_macro", SEED,
                            parallelism=_side_by_side(folds), prepare=lambda rows: prepare(rows, "label", FEATURES, ["row_id"]))
    rows = [(i + 1, json.dumps(p, sort_keys=True), m, sd) for i, (p, m, sd) in enumerate(results)]
    return spark.createDataFrame(rows, "rank int, params string, mean_macro_recall double, std_macro_recall double")


def ml_cv_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Ten metrics over five stratified folds of the boosted model, per fold, with mean and deviation (M4)."""
    train = _parts(spark, d)[0]
    folds = cut_lineage(stratified_folds(train.select("row_id", "label", *FEATURES), "label", ["row_id"], 5, SEED))
    return score_frame(spark, cross_validate(folds, "fold", 5, lambda rows: _boosted(TUNED, rows, BESIDE), parallelism=_side_by_side(folds)))


def ml_kfold_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """Accuracy over five plain shuffled folds of the boosted model (M4)."""
    train = _parts(spark, d)[0]
    folds = cut_lineage(kfold(train.select("row_id", "label", *FEATURES), ["row_id"], 5, SEED))
    scores = cross_validate(folds, "fold", 5, lambda rows: _boosted(TUNED, rows, BESIDE), lambda p: {"accuracy": accuracy(p)}, parallelism=_side_by_side(folds))
    return score_frame(spark, scores)


def ml_smote_cv_macro_recall(spark: SparkSession, d: str) -> DataFrame:
    """3-fold CV with SMOTE applied inside each training part only."""
    train = _parts(spark, d)[0]
    folds = cut_lineage(stratified_folds(train.select("row_id", "label", *FEATURES), "label", ["row_id"], 3, SEED))

    def resample(rows):
        return _with_features(stored_smote(rows.select("row_id", "label", F.array(*FEATURES).alias("f")), "label", "row_id", "f", k=5, seed=SEED))

    def after(rows):
        drop_checkpoint(rows)
        spark.sparkContext._jvm.System.gc()  # shuffle files stay until the driver's collector has found them unused

    scores = cross_validate(folds, "fold", 3, lambda rows: _boosted(Boosting(rounds=30, max_depth=4, eta=0.3, seed=SEED), rows, BESIDE), resample=resample, after=after,
                            parallelism=3 if folds.count() <= BESIDE else 1)  # a fold's neighbours take several times its rows on disk
    return spark.createDataFrame([(i, s["recall_macro"]) for i, s in enumerate(scores)], "fold int, macro_recall double")


def ec24_model_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Three models on the same split, with and without SMOTE: ten metrics on the test rows each (EC24)."""
    train, test = _parts(spark, d)
    models = {
        "boosted": lambda rows: _boosted(replace(TUNED, rounds=60), rows, BESIDE),
        "boosted_ovr": lambda rows: ovr_gbt(max_iter=20, max_depth=5, step_size=0.1, subsampling_rate=0.8).fit(rows),
    }
    names = [*models, "forest"]
    sources = {"as_is": train, "smote": _smoted(spark, d)}

    def run(name, source):
        if name == "forest":
            pred = forest_scores(sources[source], test.select("label", "features"), 100, 15, nodes=FOREST_NODES // 2, seed=SEED, keys=["row_id"], one_task=FOREST_ROWS)  # two at a time
            return (name, source, scores_of(pred))
        model = models[name](sources[source])
        pred = _scored(model, test) if name != "boosted_ovr" else model.transform(test.select("label", "features")).select("label", "prediction")
        return (name, source, scores_of(pred))

    pairs = [(name, source) for name in names for source in sources]
    found = run_concurrently(spark, [lambda p=p: run(*p) for p in pairs], 3, "comparison")
    rows = [(name, source, metric, value) for name, source, scores in found for metric, value in scores.items()]
    return spark.createDataFrame(rows, "model string, training string, metric string, value double")


# --------------------------------------------------------------------------- metrics on a rule baseline

def _baseline(spark, d):
    """A fixed rule, scored over every line item: label = return flag, prediction from
    the discount band; one-vs-rest score = discount."""
    li = load_table(spark, d, "lineitem")
    pred = F.when(F.col("l_discount") < 0.04, "A").when(F.col("l_discount") < 0.07, "N").otherwise("R")
    return li.select(F.col("l_returnflag").alias("label"), pred.alias("prediction"),
                     F.col("l_discount").alias("score"))


def ml_baseline_confusion(spark: SparkSession, d: str) -> DataFrame:
    return confusion(_baseline(spark, d))


def ml_baseline_report(spark: SparkSession, d: str) -> DataFrame:
    return classification_report(_baseline(spark, d))


def ml_baseline_hard_auc(spark: SparkSession, d: str) -> DataFrame:
    return hard_label_auc(_baseline(spark, d))


def ml_baseline_score_auc(spark: SparkSession, d: str) -> DataFrame:
    return roc_auc(_one_vs_rest(spark, d), F.col("label") == F.col("cls"), F.col("score"), by=["cls"])


def _one_vs_rest(spark, d):
    b = _baseline(spark, d)
    return b.select("score", "label", F.explode(F.array(F.lit("A"), F.lit("N"), F.lit("R"))).alias("cls"))


def ml_baseline_macro_roc(spark: SparkSession, d: str) -> DataFrame:
    """Macro-average ROC of the baseline at 100 false-positive rates."""
    return macro_roc(_one_vs_rest(spark, d), F.col("label") == F.col("cls"), F.col("score"), by=["cls"])


def ml_baseline_roc_curve(spark: SparkSession, d: str) -> DataFrame:
    return roc_curve(_one_vs_rest(spark, d), F.col("label") == F.col("cls"), F.col("score"), by=["cls"])


# --------------------------------------------------------------------------- documents: logistic, topics

DOC_FEATURES = ["n_chars", "n_words", "n_lines", "digit_share", "upper_share", "punct_share", "mean_word_len",
                "is_en"]


def doc_table(spark: SparkSession, d: str) -> DataFrame:
    """Whole-text document features joined with the quality label."""
    docs = load_table(spark, d, "documents")
    labels = load_table(spark, d, "labels")
    t = F.col("text")
    n = F.greatest(F.length(t), F.lit(1))
    words = F.size(F.split(F.trim(t), r"\s+"))
    feats = docs.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        words.cast("double").alias("n_words"),
        F.size(F.split(t, "\n")).cast("double").alias("n_lines"),
        (F.length(F.regexp_replace(t, r"[^0-9]", "")) / n).alias("digit_share"),
        (F.length(F.regexp_replace(t, r"[^A-Z]", "")) / n).alias("upper_share"),
        (F.length(F.regexp_replace(t, r"[^\p{Punct}]", "")) / n).alias("punct_share"),
        (F.length(F.regexp_replace(t, r"\s", "")) / F.greatest(words, F.lit(1))).alias("mean_word_len"),
        (F.col("lang") == "en").cast("double").alias("is_en"),
    )
    return feats.join(labels.select("doc_id", F.col("quality").cast("double").alias("label")), "doc_id")


def _doc_split(spark, d):
    return cut_lineage(stratified_split(doc_table(spark, d), "label", ["doc_id"], 0.2, SEED))


def t7_stepwise_logit(spark: SparkSession, d: str) -> DataFrame:
    """Forward selection by score statistics; a feature stays if its refit lowers the AIC."""
    path = forward(cut_lineage(doc_table(spark, d)), "label", DOC_FEATURES)
    return spark.createDataFrame(path, "step int, added_feature string, aic double, score_statistic double")


def t8_odds_ratios(spark: SparkSession, d: str) -> DataFrame:
    """Odds ratios with 95 % Wald intervals from a binomial GLM on all features."""
    data = VectorAssembler(inputCols=DOC_FEATURES, outputCol="features").transform(cut_lineage(doc_table(spark, d)))  # read in every iteration
    m = GeneralizedLinearRegression(family="binomial", link="logit", maxIter=50).fit(data)
    se = m.summary.coefficientStandardErrors  # features first, intercept last
    coefs = list(m.coefficients) + [m.intercept]
    names = DOC_FEATURES + ["(intercept)"]
    rows = []
    for name, b, s in zip(names, coefs, se):
        z = 1.959963984540054
        with np.errstate(over="ignore"):  # a separated feature gives an infinite odds ratio, not an error
            rows.append((name, float(b), float(s), float(np.exp(b)), float(np.exp(b - z * s)), float(np.exp(b + z * s))))
    return spark.createDataFrame(rows, "feature string, coef double, std_error double, odds_ratio double, "
                                       "ci_low double, ci_high double")


def t9_logistic_report(spark: SparkSession, d: str) -> DataFrame:
    s = VectorAssembler(inputCols=DOC_FEATURES, outputCol="features").transform(_doc_split(spark, d))
    train, test = s.filter(~F.col("is_test")), s.filter(F.col("is_test"))
    model = LogisticRegression(maxIter=100).fit(train)
    return _report_both(model, train, test)


def _topics(spark, d, k: int = 5):
    """Topics over all terms of all documents, in a hashed term space."""
    words = terms_of(load_table(spark, d, "documents").select("doc_id", "text"))
    return words, *fit_topics(words, k, SEED)


def t10_topic_terms(spark: SparkSession, d: str) -> DataFrame:
    words, lda, _ = _topics(spark, d)
    return topic_terms(lda, words)


def t10_doc_topics(spark: SparkSession, d: str) -> DataFrame:
    docs = _topics(spark, d)[2]
    arr = vector_to_array("topicDistribution")
    return docs.select("doc_id", F.array_position(arr, F.array_max(arr)).cast("int").alias("dominant_topic"),
                       F.array_max(arr).alias("topic_weight"))


def t11_cluster_terms(spark: SparkSession, d: str, k: int = 6, min_token: int = 3, buckets: int = 1024) -> DataFrame:
    """Cluster all documents (k-means over hashed, normalised term counts of their own tokens) and describe each
    cluster by class-based TF-IDF (T11): ``tf(t, c) / words(c) * log(1 + mean words per cluster / total
    frequency of t)``; top 10 terms each. Tokens shorter than ``min_token`` letters are no terms."""
    docs = load_table(spark, d, "documents")
    tokens = F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+")
    docs = docs.select("doc_id", F.filter(tokens, lambda t: F.length(t) >= min_token).alias("tokens"))
    counted = HashingTF(inputCol="tokens", outputCol="counts", numFeatures=buckets).transform(docs)
    data = Normalizer(inputCol="counts", outputCol="features").transform(counted)
    clusters = KMeans(k=k, seed=SEED, maxIter=20).fit(data).transform(data)
    return class_terms(clusters.select(F.col("prediction").alias("cluster"), "tokens"), "cluster")


def t12_multimodal_compare(spark: SparkSession, d: str) -> DataFrame:
    """Logistic regression on document numerics alone vs numerics + topic weights."""
    # the topic fit leaves cores idle, which the features take
    docs, split = run_concurrently(spark, [lambda: _topics(spark, d)[2], lambda: _doc_split(spark, d)], 2, "inputs")
    topics = docs.select("doc_id", "topicDistribution")
    s = cut_lineage(split.join(topics, "doc_id"))  # both models read it

    def compared(name, cols):
        data = VectorAssembler(inputCols=cols, outputCol="features").transform(s)
        train, test = data.filter(~F.col("is_test")), data.filter(F.col("is_test"))
        pred = LogisticRegression(maxIter=100).fit(train).transform(test)
        acc = pred.agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("a"),
                       F.count(F.lit(1)).alias("n")).first()
        return (name, float(acc["a"]) if acc["a"] is not None else None, int(acc["n"]))

    models = (("numerics", DOC_FEATURES), ("numerics+topics", DOC_FEATURES + ["topicDistribution"]))
    rows = run_concurrently(spark, [lambda m=m: compared(*m) for m in models], 2, "models")
    return spark.createDataFrame(rows, "model string, accuracy double, n_test long")


QUERIES = {
    "ml_split_class_counts": ml_split_class_counts,
    "ml_fold_class_counts": ml_fold_class_counts,
    "ml_kfold_counts": ml_kfold_counts,
    "ml_ovr_gbt_report": ml_ovr_gbt_report,
    "ml_ovr_gbt_auc": ml_ovr_gbt_auc,
    "ml_gbdt_tuned_report": ml_gbdt_tuned_report,
    "ml_boosted_initial_report": ml_boosted_initial_report,
    "ml_gbdt_tuned_auc": ml_gbdt_tuned_auc,
    "ml_boosted_importance": ml_boosted_importance,
    "ml_cv_metrics": ml_cv_metrics,
    "ml_kfold_accuracy": ml_kfold_accuracy,
    "ec24_model_comparison": ec24_model_comparison,
    "ml_random_forest_report": ml_random_forest_report,
    "ml_feature_importance": ml_feature_importance,
    "ml_smote_class_counts": ml_smote_class_counts,
    "ml_random_search_gbt": ml_random_search_gbt,
    "ml_smote_cv_macro_recall": ml_smote_cv_macro_recall,
    "ml_baseline_confusion": ml_baseline_confusion,
    "ml_baseline_report": ml_baseline_report,
    "ml_baseline_hard_auc": ml_baseline_hard_auc,
    "ml_baseline_score_auc": ml_baseline_score_auc,
    "ml_baseline_roc_curve": ml_baseline_roc_curve,
    "ml_baseline_macro_roc": ml_baseline_macro_roc,
    "t7_stepwise_logit": t7_stepwise_logit,
    "t8_odds_ratios": t8_odds_ratios,
    "t9_logistic_report": t9_logistic_report,
    "t10_topic_terms": t10_topic_terms,
    "t10_doc_topics": t10_doc_topics,
    "t11_cluster_terms": t11_cluster_terms,
    "t12_multimodal_compare": t12_multimodal_compare,
}
