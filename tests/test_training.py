"""Training data, model, promotion, scoring."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from risklake.config import TrainingConfig
from risklake.operators import quality, training
from risklake.plans import jobs
from risklake.sources import lake

NOW = dt.datetime(2024, 6, 30)
SMALL = TrainingConfig(trees=3, depth=2)


@pytest.fixture(scope="module")
def records(spark):
    """2,000 records, 8 % fraud, classes apart; one text value and one missing key."""
    label = (F.col("id") % 100 < 8).cast("int")
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0
    features = F.create_map(
        F.lit("amount"), F.when(F.col("id") == 5, "n/a").otherwise((label * 400 + noise * 300).cast("string")),
        F.lit("geo_risk"), (label * 0.5 + noise * 0.4).cast("string"),
    )
    return spark.range(2000).select(
        F.concat(F.lit("r"), "id").alias("record_id"), F.concat(F.lit("t"), "id").alias("transaction_id"),
        label.alias("label"), F.lit("seed").alias("label_source"), F.to_json(features).alias("features"),
        F.lit(NOW - dt.timedelta(days=3)).alias("created_at"),
    )


def test_expand_and_split(records):
    assert training.feature_names(records) == ["amount", "geo_risk"]
    table = training.expand_features(records, ["amount", "geo_risk", "velocity_risk"])
    row = table.filter("record_id = 'r5'").first()
    assert row["amount"] is None and row["velocity_risk"] is None and row["geo_risk"] is not None
    learn, rest = training.split(table)
    again, _ = training.split(table.repartition(7))
    assert learn.count() + rest.count() == 2000 and 1500 < learn.count() < 1700
    assert learn.select("record_id").exceptAll(again.select("record_id")).isEmpty()
    assert training.class_balance(table).first()["scale_pos_weight"] == 11


def test_a_million_keys_do_not_reach_the_driver(spark):
    body = F.create_map(F.lit("often"), F.lit("1"), F.concat(F.lit("half"), F.col("id") % 2), F.lit("2"), F.concat(F.lit("k"), "id"), F.lit("3"))
    many = spark.range(1_000_000).select(F.to_json(body).alias("features"))
    assert training.feature_names(many, most=3) == ["half0", "half1", "often"]
    told = training.feature_keys(many, most=4)
    used = told.filter("used").orderBy("name").collect()
    assert [(r.name, r.records) for r in used] == [("half0", 500_000), ("half1", 500_000), ("k0", 1), ("often", 1_000_000)]
    assert told.filter("NOT used").count() == 999_999
    assert training.feature_names(many.limit(0)) == []


def test_gate(spark, records):
    assert quality.validate_training(records).first()["ok"]
    assert not quality.validate_training(records.limit(900)).first()["ok"]
    assert not quality.validate_training(records.withColumn("label", F.lit(1))).first()["ok"]
    assert not quality.validate_training(records.filter("false")).first()["ok"]
    assert lake.load_training_records(records, NOW).count() == 2000
    assert lake.load_training_records(records, NOW + dt.timedelta(days=40)).count() == 0


def test_retrain_promotes_a_good_model(records, tmp_path):
    path = str(tmp_path / "model")
    result = jobs.retrain(records, NOW, path, SMALL)
    assert result["promoted"] and result["roc_auc"] >= 0.9 and 0 < result["avg_precision"] <= 1
    table = training.expand_features(records, ["amount", "geo_risk"])
    scored = training.predict(table, path, ["amount", "geo_risk"])
    means = {r["label"]: r["p"] for r in scored.groupBy("label").agg(F.avg("fraud_probability").alias("p")).collect()}
    assert means[1] > 0.5 > means[0]
    with pytest.raises(ValueError):
        jobs.retrain(records.limit(10), NOW, path, SMALL)


def test_poor_model_is_not_promoted(records, tmp_path):
    assert not training.promote(None, {"roc_auc": 0.89}, str(tmp_path / "m"))
    assert not (tmp_path / "m").exists()


def test_learning_and_scoring_share_the_features(spark):
    """The scores are stored; reading them computes no features again."""
    from risklake.plans import catalog

    scores = catalog.queries()["model_scores"](spark, "/root/testdata/sf0.01")
    files = scores.inputFiles()
    assert files and all("/scores-" in f for f in files)
    assert scores.columns == ["record_id", "label", "fraud_probability"] and not scores.isEmpty()
