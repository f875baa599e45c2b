"""Boosting at its full size, on rows of equal features as one."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from millrace import catalog
from millrace.operators import encoding, models


def few_values(spark, n=4000):
    """Rows of which many have the same features, with targets of their own."""
    rng = random.Random(3)
    rows = [(rng.choice("aabbbc") if k % 50 else None, float(rng.randrange(12)), rng.choice([None, 1.0, 2.0])) for k in range(n)]
    rows = [(k, c, x, z, {"a": 1.0, "b": 2.5}.get(c, 4.0) + 0.3 * x * (z or 0.5) + rng.gauss(0, 1)) for k, (c, x, z) in enumerate(rows)]
    return spark.createDataFrame(rows, "id long, c string, x double, z double, y double").repartition(5, "id")


def test_registered_boosting_takes_the_defaults_of_its_family(spark, sf, monkeypatch):
    """All rounds of the family: no parameter of the query leaves any of them out."""
    seen, estimator = {}, models.estimator

    def short(family, params, rows, label):
        made = estimator(family, params, rows, label)
        seen.update(rounds=made.getMaxIter(), depth=made.getMaxDepth(), rate=made.getStepSize(), subsample=made.getSubsamplingRate())
        seen["rows"] = rows.agg(F.sum(models.WEIGHT)).first()[0]
        return made.setMaxIter(1)

    monkeypatch.setattr(models, "estimator", short)
    assert catalog.queries()["boosting"](spark, sf).first()["n"] > 0
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").where("l_partkey % 10 > 2").count()
    assert seen == {"rounds": 300, "depth": 6, "rate": 0.05, "subsample": 1.0, "rows": lines}


def test_rows_of_equal_features_count_as_many(spark, monkeypatch):
    """The trees of the merged rows are those of all rows."""
    train, features = few_values(spark), encoding.FeatureSet("f", "boosting", ("c",), ("x", "z"))
    size, seen, estimator = {"rounds": 12, "depth": 4, "rate": 0.3}, [], models.estimator
    monkeypatch.setattr(models, "estimator", lambda family, p, rows, label: seen.append((rows.count(), rows.agg(F.sum(models.WEIGHT)).first()[0])) or estimator(family, p, rows, label))
    merged = models.fit(train, features, "y", size)
    assert seen == [(train.select("c", "x", "z").distinct().count(), train.count())]
    # all 36 numbers have bins of their own, so no sample of rows decides on the thresholds
    made = encoding.feature_pipeline(train, features)
    plain = GBTRegressor(labelCol="y", maxIter=12, maxDepth=4, stepSize=0.3, seed=42).fit(made.transform(train))
    want = {r["id"]: r["prediction"] for r in plain.transform(made.transform(train)).select("id", "prediction").collect()}
    got = {r["id"]: r["log_prediction"] for r in merged.predict(train).collect()}
    assert got == pytest.approx(want, rel=1e-9)


def test_missing_targets_are_no_smaller_weight(spark):
    """A null target among equal rows is an error as it is by itself, and a sample of rows is drawn from all rows."""
    features = encoding.FeatureSet("f", "boosting", ("c",), ("x", "z"))
    holes = few_values(spark, 300).withColumn("y", F.when(F.col("id") != 7, F.col("y")))
    with pytest.raises(Exception, match="(?i)label"):
        models.fit(holes, features, "y", {"rounds": 1, "depth": 2})
    sampled = models.fit(few_values(spark, 300), features, "y", {"rounds": 2, "depth": 2, "subsample": 0.5})
    assert not sampled.model.isSet("weightCol")
