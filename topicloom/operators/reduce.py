"""Fewer dimensions for vectors, by principal components."""

from __future__ import annotations

from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.functions.vectors import unit

COMPONENTS = 5


def fit_components(posts: DataFrame, components: int = COMPONENTS) -> PCAModel:
    """Principal components of the unit vectors: a linear stand-in for the usual non-linear reduction.

    The covariance has one cell per pair of dimensions; it is summed in the tasks.
    """
    rows = posts.select(array_to_vector(unit(F.col("embedding"))).alias("v"))
    return PCA(k=components, inputCol="v", outputCol="reduced").fit(rows)


def reduce_dimensions(posts: DataFrame, model: PCAModel) -> DataFrame:
    """The table with ``embedding`` replaced by its principal components."""
    rows = posts.withColumn("v", array_to_vector(unit(F.col("embedding"))))
    return model.transform(rows).withColumn("embedding", vector_to_array("reduced")).drop("v", "reduced")
