"""Training, judging and using the fraud classifier with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risklake.config import TrainingConfig

MAP = "map<string,string>"
TRAINING_FEATURES = (
    "amount", "hour_of_day", "tx_count_1h", "tx_count_24h", "amt_sum_1h", "amt_sum_24h",
    "unique_merchants_1h", "is_foreign", "geo_risk", "behavioral_deviation", "network_risk",
    "velocity_risk",
)


#: Most features that are looked for in records.
MOST_FEATURES = 500


def feature_keys(df: DataFrame, features: str = "features", most: int = MOST_FEATURES) -> DataFrame:
    """(name, records, used): every key of the JSON features, how many records have it, and whether it is among
    the ``most`` frequent ones; ties by name. The keys stay on the executors, however many there are."""
    counted = (
        df.select(F.explode(F.map_keys(F.from_json(features, MAP))).alias("name"))
        .groupBy("name").agg(F.count(F.lit(1)).alias("records"))
    )
    used = counted.orderBy(F.desc("records"), "name").limit(most).select("name", F.lit(True).alias("used"))
    return counted.join(F.broadcast(used), "name", "left").select("name", "records", F.coalesce("used", F.lit(False)).alias("used"))


def feature_names(df: DataFrame, features: str = "features", most: int = MOST_FEATURES) -> list[str]:
    """The names of the ``most`` frequent keys, which is all that comes to the driver; ``feature_keys`` tells the others."""
    used = feature_keys(df, features, most).filter("used").select("name")
    return sorted(row["name"] for row in used.collect())


def expand_features(
    df: DataFrame, names: Sequence[str] = TRAINING_FEATURES, features: str = "features"
) -> DataFrame:
    """JSON features -> one double column each; NULL where absent or not a number."""
    values = F.from_json(features, MAP)
    return (
        df.withColumn("_map", values)
        .withColumns({n: F.col("_map").getItem(n).try_cast("double") for n in names})
        .drop("_map", features, "transaction_id", "label_source")
    )


def split(df: DataFrame, cfg: TrainingConfig = TrainingConfig()) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the record id: the same rows on every run, cluster and engine."""
    digest = F.md5(F.concat_ws("|", F.col("record_id"), F.lit(cfg.seed)))
    in_train = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100 < cfg.train_share
    return df.filter(in_train), df.filter(~in_train)


def class_balance(df: DataFrame) -> DataFrame:
    """One row: ``fraud_rate`` and ``scale_pos_weight`` = whole part of negatives / positives."""
    positive = F.count_if(F.col("label") == 1)
    negative = F.count_if(F.col("label") == 0)
    return df.agg(
        F.avg(F.col("label").cast("double")).alias("fraud_rate"),
        F.floor(F.try_divide(negative, positive)).alias("scale_pos_weight"),
    )


def train(
    df: DataFrame, names: Sequence[str] = TRAINING_FEATURES, cfg: TrainingConfig = TrainingConfig()
) -> PipelineModel:
    """Boosted trees with the rarer class weighted up."""
    filled = df.fillna(0.0, subset=list(names))
    # One number leaves the executors: the ratio of the classes.
    weight = float(class_balance(filled).first()["scale_pos_weight"] or 1)
    weighted = filled.withColumn("_weight", F.when(F.col("label") == 1, weight).otherwise(1.0)).withColumn(
        "label", F.col("label").cast("double")
    )
    assembler = VectorAssembler(inputCols=list(names), outputCol="_vector")
    trees = GBTClassifier(
        featuresCol="_vector", labelCol="label", weightCol="_weight",
        maxIter=cfg.trees, maxDepth=cfg.depth, stepSize=cfg.learning_rate,
        subsamplingRate=cfg.subsample, seed=cfg.seed, checkpointInterval=10,
    )
    return Pipeline(stages=[assembler, trees]).fit(weighted)


def predict(
    df: DataFrame, model: PipelineModel | str, names: Sequence[str] = TRAINING_FEATURES
) -> DataFrame:
    """Add ``fraud_probability``. ``model`` may be the path of a promoted model."""
    if isinstance(model, str):
        model = PipelineModel.load(model)
    scored = model.transform(df.fillna(0.0, subset=list(names)))
    return scored.withColumn("fraud_probability", vector_to_array("probability")[1]).drop(
        "_vector", "rawPrediction", "probability", "prediction"
    )


def evaluate(model: PipelineModel, test: DataFrame, names: Sequence[str] = TRAINING_FEATURES) -> dict[str, float]:
    """``roc_auc`` and ``avg_precision`` (area under the precision-recall curve)."""
    scored = model.transform(
        test.fillna(0.0, subset=list(names)).withColumn("label", F.col("label").cast("double"))
    )
    return {
        name: BinaryClassificationEvaluator(labelCol="label", metricName=metric).evaluate(scored)
        for name, metric in (("roc_auc", "areaUnderROC"), ("avg_precision", "areaUnderPR"))
    }


def promote(
    model: PipelineModel, metrics: dict[str, float], path: str, cfg: TrainingConfig = TrainingConfig()
) -> bool:
    """Save the model where scoring jobs load it, if it is good enough."""
    if metrics["roc_auc"] < cfg.min_auc:
        return False
    model.write().overwrite().save(path)
    return True
