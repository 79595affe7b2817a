"""Experiment read-outs (T1-T6, T13): arms, two-sample tests, rates, chi-square.

Stand-in experiment: every event of user u belongs to arm ``control`` (u even) or
``treatment`` (u odd); the metric is ``events.value``, segments are event types.
``assign_arms`` gives the hash-based assignment for real use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.ml import portable_hash
from ledgerline.operators.stats import (
    chi_square_independence,
    rate_difference,
    two_sample,
    with_chi2_p,
    with_p_values_and_power,
)
from ledgerline.plans import standins as S
from ledgerline.sources.tables import load_table

ARMS = ("control", "treatment")


def assign_arms(df: DataFrame, unit_col: str, seed: int = 1, treatment_share: float = 0.5) -> DataFrame:
    """Deterministic hash assignment of experiment units to arms (T4): the first 52 bits of the md5 of ``unit|seed`` as
    a number in [0, 1), so that any engine gives a unit the same arm."""
    u = portable_hash([unit_col], seed).cast("double") / float(2**52)
    return df.withColumn("arm", F.when(u < treatment_share, F.lit(ARMS[1])).otherwise(F.lit(ARMS[0])))


def _experiment(spark, d):
    e = load_table(spark, d, "events")
    return e.withColumn("arm", F.when(F.col("user_id") % 2 == 0, F.lit(ARMS[0])).otherwise(F.lit(ARMS[1])))


def t1_welch_by_segment(spark: SparkSession, d: str) -> DataFrame:
    return two_sample(_experiment(spark, d), "arm", ARMS, "value", by=["event_type"])


def t1_welch_overall(spark: SparkSession, d: str) -> DataFrame:
    return two_sample(_experiment(spark, d), "arm", ARMS, "value")


def t3_pvalues_power_by_segment(spark: SparkSession, d: str) -> DataFrame:
    return with_p_values_and_power(t1_welch_by_segment(spark, d)).select(
        "event_type", "t_welch", "df_welch", "p_welch", "p_pooled", "cohens_d", "achieved_power", "n_per_arm_needed"
    )


def t4_error_rate_by_arm(spark: SparkSession, d: str) -> DataFrame:
    e = _experiment(spark, d)
    outcome = F.col("event_type") == "error"
    return rate_difference(e, "arm", ARMS, outcome, cost=F.when(outcome, F.col("value")))


def t4_sample_ratio_pvalue(spark: SparkSession, d: str) -> DataFrame:
    r = t4_error_rate_by_arm(spark, d).withColumn("_dof", F.lit(1))
    return with_chi2_p(r, "srm_chi2", "_dof").select("n_a", "n_b", "srm_chi2", "p_value")


def t4_hash_assignment_balance(spark: SparkSession, d: str) -> DataFrame:
    """Units per arm under the hash assignment, with the sample-ratio chi-square."""
    users = load_table(spark, d, "events").select("user_id").distinct()
    a = assign_arms(users, "user_id", seed=1)
    g = a.agg(*[F.count_if(F.col("arm") == arm).alias(f"n_{arm}") for arm in ARMS])
    n = F.col(f"n_{ARMS[0]}") + F.col(f"n_{ARMS[1]}")
    chi2 = ((F.col(f"n_{ARMS[0]}") - n / 2) ** 2 + (F.col(f"n_{ARMS[1]}") - n / 2) ** 2) / (n / 2)
    return with_chi2_p(g.withColumn("srm_chi2", chi2).withColumn("_dof", F.lit(1)), "srm_chi2", "_dof").drop("_dof")


def t5_chi_square_flags(spark: SparkSession, d: str) -> DataFrame:
    return chi_square_independence(load_table(spark, d, "lineitem"), "l_returnflag", "l_linestatus")


def t5_chi_square_event_arm(spark: SparkSession, d: str) -> DataFrame:
    return chi_square_independence(_experiment(spark, d), "event_type", "arm")


def t5_chi_square_pvalues(spark: SparkSession, d: str) -> DataFrame:
    a = with_chi2_p(t5_chi_square_flags(spark, d)).withColumn("test", F.lit("returnflag_x_linestatus"))
    b = with_chi2_p(t5_chi_square_event_arm(spark, d)).withColumn("test", F.lit("event_type_x_arm"))
    return a.unionByName(b)


def t6_totalprice_by_status(spark: SparkSession, d: str) -> DataFrame:
    return two_sample(load_table(spark, d, "orders"), "o_orderstatus", ("F", "O"), "o_totalprice")


def t13_review_trend(spark: SparkSession, d: str) -> DataFrame:
    r = S.ec_reviews(spark, d)
    o = S.ec_orders(spark, d).select("order_id", "customer_id")
    c = S.ec_customers(spark, d).select("customer_id", F.trim("customer_state").alias("customer_state"))
    j = r.join(o, "order_id").join(c, "customer_id", "left")
    return j.groupBy(
        F.date_trunc("month", "review_creation_date").cast("date").alias("review_month"), "customer_state"
    ).agg(F.avg("review_score").alias("mean_score"), F.count(F.lit(1)).alias("n_reviews"))


QUERIES = {
    "t1_welch_by_segment": t1_welch_by_segment,
    "t1_welch_overall": t1_welch_overall,
    "t3_pvalues_power_by_segment": t3_pvalues_power_by_segment,
    "t4_error_rate_by_arm": t4_error_rate_by_arm,
    "t4_sample_ratio_pvalue": t4_sample_ratio_pvalue,
    "t4_hash_assignment_balance": t4_hash_assignment_balance,
    "t5_chi_square_flags": t5_chi_square_flags,
    "t5_chi_square_event_arm": t5_chi_square_event_arm,
    "t5_chi_square_pvalues": t5_chi_square_pvalues,
    "t6_totalprice_by_status": t6_totalprice_by_status,
    "t13_review_trend": t13_review_trend,
}
