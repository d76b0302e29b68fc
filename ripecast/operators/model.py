"""Demand model: boosted regression trees on Spark, their metrics, importances and use as a policy scorer."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripecast import constants as K
from ripecast.operators import boosting
from ripecast.operators.selection import quantiles
from ripecast.session import checkpoint_dir, checkpoints

INDEXED = [f"{c}_idx" for c in K.CATEGORICAL_FEATURES]
INPUTS = [*K.NUMERIC_FEATURES, *INDEXED]
MISSING = -1.0

# The parameter set of the warehouse trainer, in GBTRegressor terms; ``validationTol`` is a progress rule, which stops at
# the first round that gains less than that share. The sets of the other trainers are in ``boosting``.
PRESETS = {
    "warehouse": dict(maxIter=600, maxDepth=8, subsamplingRate=0.8, stepSize=0.3, maxBins=256, validationTol=0.01),
}


def model_inputs(df: DataFrame) -> DataFrame:
    """Numeric features as doubles. Features are never negative, so -1 marks a missing one and trees can split on it."""
    present = [c for c in K.NUMERIC_FEATURES if c in df.columns]
    return df.withColumns(
        {
            **{c: F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in present},
            **{c: F.col(c).cast("string") for c in K.CATEGORICAL_FEATURES},
        }
    )


def vocabulary(train: DataFrame, column: str) -> DataFrame:
    """Distinct categories of the training rows."""
    return train.select(F.col(column).cast("string").alias(column)).distinct()


def _category_limit(train: DataFrame, max_categories: int | None) -> int:
    """Largest category count plus the unknown slot. Labels live on the driver, so a caller may bound their number."""
    sizes = train.agg(*[F.approx_count_distinct(c, 0.01).alias(c) for c in K.CATEGORICAL_FEATURES]).first()
    largest = max(sizes[c] for c in K.CATEGORICAL_FEATURES)
    if max_categories is not None and largest > max_categories:
        raise ValueError(f"a categorical feature has about {largest} values, more than {max_categories}")
    # head room for the estimate's error
    return int(largest * 1.1) + 3


def train(
    split: DataFrame,
    preset: str = "warehouse",
    seed: int = 42,
    early_stop: bool = True,
    max_categories: int | None = None,
    **overrides,
) -> PipelineModel:
    """Fit on the train rows; with ``early_stop`` the valid rows decide how many trees to keep.

    Boosting runs for hundreds of rounds, whose lineage is cut in the folder that the session names in
    ``spark.checkpoint.dir``; without one, training fails.
    """
    if not checkpoint_dir(split.sparkSession):
        raise ValueError("training needs a shared folder in spark.checkpoint.dir")
    rows = model_inputs(split.where(F.col("split").isin("train", "valid") & F.col(K.LABEL).isNotNull())).select(
        *K.NUMERIC_FEATURES,
        *K.CATEGORICAL_FEATURES,
        F.col(K.LABEL).cast("double").alias(K.LABEL),
        (F.col("split") == "valid").alias("is_valid"),
    )
    # several passes follow; a lost executor recomputes its part from the source
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit(rows, {**PRESETS[preset], **overrides}, seed, early_stop, max_categories)
    finally:
        rows.unpersist()


def _fit(rows: DataFrame, params: dict, seed: int, early_stop: bool, max_categories: int | None) -> PipelineModel:
    train_rows, valid_rows = rows.where(~F.col("is_valid")), rows.where("is_valid")
    params = {**params, "maxBins": max(params.get("maxBins", 32), _category_limit(train_rows, max_categories))}

    # the vocabulary comes from the train rows only; later categories take the unknown slot
    indexer = StringIndexer(
        inputCols=K.CATEGORICAL_FEATURES, outputCols=INDEXED, handleInvalid="keep", stringOrderType="alphabetAsc"
    ).fit(train_rows)
    assembler = VectorAssembler(inputCols=INPUTS, outputCol="features")
    gbt = GBTRegressor(
        featuresCol="features",
        labelCol=K.LABEL,
        predictionCol="predicted_unit_sales",
        seed=seed,
        checkpointInterval=10,
        **params,
    )
    ready = lambda part: assembler.transform(indexer.transform(part))
    # an empty validation part would stop training at once
    if not early_stop or valid_rows.isEmpty():
        trees = gbt.fit(ready(train_rows))
    else:
        trees = gbt.setValidationIndicatorCol("is_valid").fit(ready(rows))
    return PipelineModel([indexer, assembler, trees])


def scorer(model: PipelineModel | boosting.Booster) -> ModelScorer | boosting.Booster:
    """What a policy sweep scores with."""
    return model if isinstance(model, boosting.Booster) else ModelScorer(model)


def predict(model: PipelineModel | boosting.Booster, df: DataFrame) -> DataFrame:
    """The input columns plus predicted_unit_sales."""
    with_model = scorer(model)
    scored = with_model.score(with_model.prepare(df), "effective_price", "discount_pct", "predicted_unit_sales")
    return with_model.finish(scored)


def save(model: PipelineModel, path: str) -> None:
    """Write trees and vocabulary together."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def nodes(model: PipelineModel | boosting.Booster, spark: SparkSession) -> DataFrame:
    """tree, node, feature, left_child, right_child, value, gain, n_rows of every node; gain is the node's error less its
    children's, summed over its rows.

    A pipeline is stored in the checkpoint folder and its trees are read back as the table they are stored as.
    """
    if isinstance(model, boosting.Booster):
        return model.nodes(spark).drop("threshold")
    path = f"{checkpoints(spark)}/nodes-{uuid.uuid4().hex}"
    trees = model.stages[-1]
    trees.write().save(path)
    names = F.array(*[F.lit(n) for n in (*K.NUMERIC_FEATURES, *K.CATEGORICAL_FEATURES)])
    inner = F.col("nodeData.leftChild") >= 0
    only = lambda c: F.when(inner, c)
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        only(F.get(names, F.col("nodeData.split.featureIndex"))).alias("feature"),
        only(F.col("nodeData.leftChild")).alias("left_child"),
        only(F.col("nodeData.rightChild")).alias("right_child"),
        F.col("nodeData.prediction").alias("value"),
        F.when(inner, F.col("nodeData.gain") * F.col("nodeData.rawCount")).otherwise(0.0).alias("gain"),
        F.col("nodeData.rawCount").cast("bigint").alias("n_rows"),
    )


def feature_importance(model: PipelineModel | boosting.Booster, df: DataFrame) -> DataFrame:
    """feature, importance (normalised gain), gain, weight (splits) and cover (rows split), one row per model input.

    ``df`` only names the session. A pipeline's ``importance`` is the average of its trees' shares, as Spark defines it.
    """
    spark = df.sparkSession
    if isinstance(model, boosting.Booster):
        return boosting.importance(model.nodes(spark), boosting.INPUTS)
    names = [*K.NUMERIC_FEATURES, *K.CATEGORICAL_FEATURES]
    values = model.stages[-1].featureImportances.toArray()
    shares = spark.createDataFrame([(n, float(v)) for n, v in zip(names, values)], "feature string, importance double")
    counted = boosting.importance(nodes(model, spark), names).drop("importance")
    return shares.join(counted, "feature").select("feature", "importance", "gain", "weight", "cover")


class ModelScorer:
    """Scores with a fitted pipeline: categories are indexed once, then every price pair is a projection."""

    def __init__(self, model: PipelineModel):
        self.indexer, _, self.trees = model.stages
        self._kept: list[str] = []

    def prepare(self, df: DataFrame) -> DataFrame:
        """Add the model's own input columns beside the untouched ones."""
        numeric = [c for c in K.NUMERIC_FEATURES if c in df.columns and c not in ("effective_price", "discount_pct")]
        inputs = {f"_in_{c}": F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in numeric}
        inputs.update({f"_cat_{c}": F.col(c).cast("string") for c in K.CATEGORICAL_FEATURES})
        indexer = self.indexer.copy()
        indexer.setInputCols([f"_cat_{c}" for c in K.CATEGORICAL_FEATURES])
        indexer.setOutputCols([f"_in_{c}" for c in INDEXED])
        return indexer.transform(df.withColumns(inputs))

    def score(self, df: DataFrame, price: str, discount: str, output: str) -> DataFrame:
        chosen = {"effective_price": price, "discount_pct": discount}
        filled = {f"_p_{c}": F.coalesce(F.col(v).cast("double"), F.lit(MISSING)) for c, v in chosen.items()}
        columns = [f"_p_{c}" if c in chosen else f"_in_{c}" for c in INPUTS]
        vectors = VectorAssembler(inputCols=columns, outputCol="_vector").transform(df.withColumns(filled))
        trees = self.trees.copy()
        trees.setFeaturesCol("_vector").setPredictionCol(output)
        return trees.transform(vectors).drop("_vector", *filled)

    def finish(self, df: DataFrame) -> DataFrame:
        return df.drop(*[c for c in df.columns if c.startswith(("_in_", "_cat_"))])


def metrics(
    scored: DataFrame, label: str = K.LABEL, prediction: str = "predicted_unit_sales", accuracy: int = 10_000, exact: bool = False
) -> DataFrame:
    """Regression metrics in one pass. Squared logs are taken of values clamped at zero.

    The median comes from a sketch whose size is bounded by ``accuracy``: its rank is off by one part in ``accuracy`` of
    the rows at most, whatever their number. With ``exact`` it is the true one, found by passes of its own that run at
    once.
    """
    y, p = F.col(label), F.col(prediction)
    rows = scored.where(y.isNotNull() & p.isNotNull())
    error = y - p
    log_error = F.log1p(F.greatest(y, F.lit(0.0))) - F.log1p(F.greatest(p, F.lit(0.0)))
    mse = F.avg(error * error)
    median = F.percentile_approx(F.abs(error), 0.5, accuracy)
    if exact:
        median = F.lit(quantiles(rows, {"median": (F.abs(error), 0.5)})["median"]).cast("double")
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.abs(error)).alias("mean_absolute_error"),
        mse.alias("mean_squared_error"),
        F.sqrt(mse).alias("root_mean_squared_error"),
        F.avg(log_error * log_error).alias("mean_squared_log_error"),
        median.alias("median_absolute_error"),
        (F.lit(1.0) - F.try_divide(mse, F.var_pop(y))).alias("r2_score"),
        (F.lit(1.0) - F.try_divide(F.var_pop(error), F.var_pop(y))).alias("explained_variance"),
    )
