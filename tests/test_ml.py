"""Boosting over cells against Spark's boosting over the rows."""

import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tidewatch.operators import ml
from tidewatch.params import OFFER_TYPES, REASONS

SCHEMA = "retention_id string, offer_type string, churn_reason string, monthly_arpu_usd double, offer_cost_usd double, retained_clv_usd double"


def outcome(i, dice):
    offer, reason, arpu = dice.choice(OFFER_TYPES), dice.choice(REASONS), round(dice.uniform(20, 120), 2)
    return f"R{i}", offer, reason, arpu, 50.0 if offer == OFFER_TYPES[0] else round(arpu * dice.uniform(1, 3), 2), round(arpu * dice.uniform(0, 24), 2)


def test_the_trees_of_the_cells_are_those_of_the_rows(spark, monkeypatch):
    dice = random.Random(7)
    outcomes = spark.createDataFrame([outcome(i, dice) for i in range(6000)] * 2, SCHEMA)
    outcomes = outcomes.withColumn("retention_id", F.concat("retention_id", F.lit("-"), F.monotonically_increasing_id().cast("string"))).limit(9000).localCheckpoint()
    fitted, plain_fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, df: fitted.append(df.count()) or plain_fit(self, df))
    fit = ml.train(outcomes, max_iter=2)
    assert len(fitted) == 11 and max(fitted) < 6500  # 9,000 rows, 6,750 of them for the settings

    flags = [((F.col("offer_type") == o) & (F.col("churn_reason") == r)).cast("double").alias(f"{o}|{r}") for o in OFFER_TYPES for r in REASONS]
    rows = outcomes.select("*", *flags)
    names = ["monthly_arpu_usd", "offer_cost_usd", *[f"{o}|{r}" for o in OFFER_TYPES for r in REASONS]]
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(rows).withColumn("label", F.col("retained_clv_usd"))
    trees = fit.model.trees
    setting = {"maxIter": 2, "seed": 42, "maxDepth": trees.getMaxDepth(), "stepSize": trees.getStepSize()}
    wanted = {r.retention_id: r.prediction for r in plain_fit(GBTRegressor(**setting), vectors).transform(vectors).collect()}
    found = {r.retention_id: r.prediction for r in fit.model.transform(outcomes).collect()}
    assert found == pytest.approx(wanted, rel=1e-9)
    held = F.pmod(F.xxhash64("retention_id"), F.lit(4)) == 0
    model = plain_fit(GBTRegressor(**setting), vectors.filter(~held))
    rmse = model.transform(vectors.filter(held)).agg(F.sqrt(F.avg((F.col("label") - F.col("prediction")) ** 2))).first()[0]
    assert fit.rmse == pytest.approx(rmse, rel=1e-9)


def test_the_rows_of_a_fit_do_not_grow_with_the_outcomes(spark, monkeypatch):
    dice = random.Random(8)
    base = spark.createDataFrame([outcome(i, dice) for i in range(500)], SCHEMA)
    many = base.crossJoin(spark.range(60).withColumnRenamed("id", "copy")).select(
        F.concat_ws("-", "retention_id", "copy").alias("retention_id"), "offer_type", "churn_reason",
        (F.col("monthly_arpu_usd") + F.col("copy") / 1000).alias("monthly_arpu_usd"), "offer_cost_usd", "retained_clv_usd")
    fitted, plain_fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, df: fitted.append(df.count()) or plain_fit(self, df))
    fit = ml.train(many, max_iter=1)
    assert max(fitted) < 6000 and fit.rmse < fit.rmse_of_mean  # 30,000 rows


def test_cuts_are_between_few_values_and_share_many():
    assert ml.bin_cuts([3.0, 1.0, 3.0]) == [2.0] and ml.bin_cuts([]) == ml.bin_cuts([5.0, 5.0]) == []
    assert ml.bin_cuts([float(i) for i in range(320)]) == [9.5 + 10 * i for i in range(31)]
    assert len(ml.bin_cuts([0.0] * 1000 + [float(i) for i in range(1, 101)])) <= 31
