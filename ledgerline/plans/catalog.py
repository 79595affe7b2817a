"""The query catalog: every composite query as ``name -> (spark, sf_dir) -> DataFrame``,
and the DuckDB oracle SQL for those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.plans import claims, experiments, files, modelling, oracle, orders, trips, web_events, weekly_sales

QueryFn = Callable[[SparkSession, str], DataFrame]

# Iterative model fitting (many Spark jobs per query, time set by iteration counts).
MODEL_FITTING = (
    "ml_ovr_gbt_report",
    "ml_ovr_gbt_auc",
    "ml_gbdt_tuned_report",
    "ml_random_forest_report",
    "ml_feature_importance",
    "ml_boosted_initial_report",
    "ml_gbdt_tuned_auc",
    "ml_boosted_importance",
    "ml_cv_metrics",
    "ml_kfold_accuracy",
    "ec24_model_comparison",
    "ml_random_search_gbt",
    "ml_smote_cv_macro_recall",
    "in5_lda_confusion",
    "in5_lda_accuracy",
    "t7_stepwise_logit",
    "t8_odds_ratios",
    "t9_logistic_report",
    "t10_topic_terms",
    "t10_doc_topics",
    "t11_cluster_terms",
    "t12_multimodal_compare",
)


def queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {}
    for mod in _families():
        out.update(mod.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    q = queries()
    return {k: v for k, v in oracle.all_sql().items() if k in q}


def _families():
    return [weekly_sales, web_events, trips, orders, claims, experiments, files, modelling]
