"""Second classifier: Spark ML logistic regression on TF-IDF features."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ledgerlens.functions.text import first_tokens


def fit_linear(train: DataFrame, max_seq_len: int, features: int = 1 << 14, max_iter: int = 20,
               column: str = "description") -> PipelineModel:
    """Fit on rows with `label_idx`. Gradients are tree-aggregated over tasks."""
    rows = train.select(first_tokens(F.col(column), max_seq_len).alias("words"), F.col("label_idx").cast("double"))
    stages = [
        HashingTF(inputCol="words", outputCol="tf", numFeatures=features),
        IDF(inputCol="tf", outputCol="features"),
        LogisticRegression(labelCol="label_idx", featuresCol="features", maxIter=max_iter, regParam=0.001),
    ]
    return Pipeline(stages=stages).fit(rows)


def predict_linear(df: DataFrame, model: PipelineModel, labels: list[str], max_seq_len: int,
                   column: str = "description") -> DataFrame:
    """Add predicted_category, confidence and all_scores. Stateless: also runs on a stream."""
    scored = model.transform(df.withColumn("words", first_tokens(F.col(column), max_seq_len)))
    names = F.array(*[F.lit(x) for x in labels])
    probs = vector_to_array("probability")
    return scored.withColumn("_p", probs).select(
        *df.columns,
        F.element_at(names, F.col("prediction").cast("int") + 1).alias("predicted_category"),
        F.array_max("_p").alias("confidence"),
        F.map_from_arrays(names, F.col("_p")).alias("all_scores"),
    )
