"""The cross validations fit the tuned model with all of its rounds, in every fold."""

import pytest

from ledgerline.plans import modelling as M


@pytest.mark.parametrize("query", [M.ml_cv_metrics, M.ml_kfold_accuracy])
def test_cross_validation_fits_the_whole_model(spark, monkeypatch, query):
    """60 of the tuned model's 180 rounds were fitted."""
    rows = [(f"r{i}", float(i % 3), *[float(i + j) for j in range(len(M.FEATURES))]) for i in range(30)]
    train = spark.createDataFrame(rows, "row_id string, label double, " + ", ".join(f"{c} double" for c in M.FEATURES))
    fitted = []

    class Constant:
        def transform(self, df):
            return df.selectExpr("label", "0.0 as prediction")

    monkeypatch.setattr(M, "_parts", lambda spark, d: (train, train))
    monkeypatch.setattr(M, "_boosted", lambda p, *more: (fitted.append(p), Constant())[1])
    assert query(spark, "unused").first()["mean"] is not None
    assert [p.rounds for p in fitted] == [180] * 5 and set(fitted) == {M.TUNED}
