"""Claim statistics queries (IN1-IN5) over the stand-in claims table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.operators.ml import confusion, portable_hash
from ledgerline.operators.profile import box_stats
from ledgerline.operators.stats import (
    canonical_scores,
    cca,
    corr_matrix,
    cov_by_group,
    hotelling_t2,
    lda_fit,
    lda_predict,
)
from ledgerline.plans.standins import claims, claims_recoded

NUMERIC = ["Age", "Engine_Capacity", "Vehicle_Age", "Car_Value", "Claim_Amount"]
X_VARS = ["Female", "Age"]
Y_VARS = ["Foreign_factor", "Engine_Capacity", "Vehicle_Age", "Car_Value"]
LOG_VARS = ["log_claim", "log_car_value"]
LDA_VARS = ["Female", "Age", "Engine_Capacity", "Vehicle_Age", "Car_Value", "Foreign_factor"]


def _logged(spark, d):
    """Log claim amount and car value; rows with a non-positive value are dropped first
    (R's log(0) is -Inf; Spark's ln(0) is NULL)."""
    c = claims_recoded(spark, d).filter((F.col("Claim_Amount") > 0) & (F.col("Car_Value") > 0))
    return c.withColumns({"log_claim": F.ln("Claim_Amount"), "log_car_value": F.ln("Car_Value")})


def in1_correlation_matrix(spark: SparkSession, d: str) -> DataFrame:
    return corr_matrix(claims(spark, d), NUMERIC)


def in2_claim_boxes(spark: SparkSession, d: str) -> DataFrame:
    c = claims(spark, d)
    stacked = c.select(
        "Claim_Amount",
        F.explode(F.array(
            F.struct(F.lit("Female").alias("grouping"), F.col("Female").cast("string").alias("group_value")),
            F.struct(F.lit("Vehicle_Make_Region").alias("grouping"), F.col("Vehicle_Make_Region").alias("group_value")),
            F.struct(F.lit("Claim_Amount_Indicator").alias("grouping"),
                     F.col("Claim_Amount_Indicator").cast("string").alias("group_value")),
        )).alias("_s"),
    ).select("Claim_Amount", "_s.*")
    return box_stats(stacked, "Claim_Amount", ["grouping", "group_value"])


def _cca(spark, d):
    c = claims_recoded(spark, d)
    return c, cca(c, X_VARS, Y_VARS)


def in3_cca_correlations(spark: SparkSession, d: str) -> DataFrame:
    _, fit = _cca(spark, d)
    rows = [(i + 1, float(r)) for i, r in enumerate(fit["cor"])]
    return spark.createDataFrame(rows, "component int, canonical_corr double")


def in3_cca_coefficients(spark: SparkSession, d: str) -> DataFrame:
    _, fit = _cca(spark, d)
    rows = []
    for side, names, coef, corr in (("x", X_VARS, fit["xcoef"], fit["corr_x"]), ("y", Y_VARS, fit["ycoef"], fit["corr_y"])):
        for i, v in enumerate(names):
            for k in range(coef.shape[1]):
                rows.append((k + 1, side, v, float(coef[i, k]), float(corr[i, k])))
    return spark.createDataFrame(rows, "component int, side string, variable string, coefficient double, loading double")


def in3_cca_score_correlation(spark: SparkSession, d: str) -> DataFrame:
    c, fit = _cca(spark, d)
    s = canonical_scores(c, X_VARS, Y_VARS, fit, 0)
    return s.agg(F.corr("eta", "psi").alias("corr_eta_psi"), F.count(F.lit(1)).alias("n"))


def in4_hotelling_gender(spark: SparkSession, d: str) -> DataFrame:
    return hotelling_t2(_logged(spark, d), "Female", (0, 1), LOG_VARS).drop("p_value")


def in4_hotelling_origin(spark: SparkSession, d: str) -> DataFrame:
    return hotelling_t2(_logged(spark, d), "Foreign_factor", (0, 1), ["log_car_value", "log_claim"]).drop("p_value")


def in4_hotelling_pvalues(spark: SparkSession, d: str) -> DataFrame:
    c = _logged(spark, d)
    a = hotelling_t2(c, "Female", (0, 1), LOG_VARS).withColumn("test", F.lit("Female"))
    b = hotelling_t2(c, "Foreign_factor", (0, 1), ["log_car_value", "log_claim"]).withColumn("test", F.lit("Foreign"))
    return a.unionByName(b)


def in4_group_covariances(spark: SparkSession, d: str) -> DataFrame:
    c = _logged(spark, d)
    stacked = c.select(
        *LOG_VARS,
        F.explode(F.array(
            F.concat(F.lit("Female="), F.col("Female").cast("string")),
            F.concat(F.lit("Foreign_factor="), F.col("Foreign_factor").cast("string")),
        )).alias("population"),
    )
    return cov_by_group(stacked, LOG_VARS, ["population"])


def in4_group_means(spark: SparkSession, d: str) -> DataFrame:
    c = _logged(spark, d)
    stacked = c.select(
        *LOG_VARS,
        F.explode(F.array(
            F.concat(F.lit("Female="), F.col("Female").cast("string")),
            F.concat(F.lit("Foreign_factor="), F.col("Foreign_factor").cast("string")),
        )).alias("population"),
    )
    return stacked.groupBy("population").agg(*[F.avg(v).alias(f"mean_{v}") for v in LOG_VARS])


def _lda(spark, d, test_rows: int = 1000, seed: int = 2):
    """Predictions for exactly ``test_rows`` rows, those of the smallest hashes of their keys; rows with equal keys are told
    apart by a counter in the order of their other columns."""
    keys = ["claim_order", "claim_line", "claim_part"]
    c = claims_recoded(spark, d).withColumn("label", F.col("Claim_Amount_Indicator"))
    c = c.withColumn("_copy", F.row_number().over(W.partitionBy(*keys).orderBy("label", "Claim_Amount", *LDA_VARS)))
    c = c.withColumn("_u", portable_hash([*keys, "_copy"], seed))
    order = ["_u", *keys, "_copy"]
    last = c.select(F.struct(*order).alias("_place")).orderBy("_place").limit(test_rows).agg(F.max("_place").alias("p")).first()["p"]
    if last is None:
        raise ValueError("no rows to draw from")
    drawn = F.struct(*order) <= F.struct(*[F.lit(last[k]).cast(c.schema[k].dataType).alias(k) for k in order])
    model = lda_fit(c.filter(~drawn), "label", LDA_VARS)
    return lda_predict(c.filter(drawn), LDA_VARS, model)


def in5_lda_confusion(spark: SparkSession, d: str) -> DataFrame:
    return confusion(_lda(spark, d), "label", "prediction")


def in5_lda_accuracy(spark: SparkSession, d: str) -> DataFrame:
    p = _lda(spark, d)
    return p.agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
                 F.count(F.lit(1)).alias("n_test"))


QUERIES = {
    "in1_correlation_matrix": in1_correlation_matrix,
    "in2_claim_boxes": in2_claim_boxes,
    "in3_cca_correlations": in3_cca_correlations,
    "in3_cca_coefficients": in3_cca_coefficients,
    "in3_cca_score_correlation": in3_cca_score_correlation,
    "in4_hotelling_gender": in4_hotelling_gender,
    "in4_hotelling_origin": in4_hotelling_origin,
    "in4_hotelling_pvalues": in4_hotelling_pvalues,
    "in4_group_covariances": in4_group_covariances,
    "in4_group_means": in4_group_means,
    "in5_lda_confusion": in5_lda_confusion,
    "in5_lda_accuracy": in5_lda_accuracy,
}
