"""Model features: eleven standardised numbers, one-hot month and weekday, and the holiday flag."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions.cyclic import CYCLIC_COLUMNS

# The order of the feature vector's parts.
NUMERIC_COLUMNS = ("latitude", "longitude", "year", *CYCLIC_COLUMNS)
ENCODED_COLUMNS = {"month": "encoded_month", "weekday": "encoded_weekday"}
FEATURES = "final_features"
LABELS = ("bike_demand", "dock_demand")


def feature_stages() -> Pipeline:
    """Unfitted feature stages. A NULL in any input raises, as a row must not lose features silently.

    Both categories share one encoder, so fitting takes two passes: scaler, then encoder.
    """
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(NUMERIC_COLUMNS), outputCol="numerical_features"),
            StandardScaler(
                inputCol="numerical_features", outputCol="scaled_features", withMean=True, withStd=True
            ),
            OneHotEncoder(inputCols=list(ENCODED_COLUMNS), outputCols=list(ENCODED_COLUMNS.values())),
            VectorAssembler(
                inputCols=["scaled_features", *ENCODED_COLUMNS.values(), "is_holiday"],
                outputCol=FEATURES,
            ),
        ]
    )


def fit_features(encoded: DataFrame) -> PipelineModel:
    """Fit on cyclic-encoded silver rows, reading only the columns the stages use."""
    return feature_stages().fit(encoded.select(*NUMERIC_COLUMNS, *ENCODED_COLUMNS, "is_holiday"))


def gold_rows(model: PipelineModel, encoded: DataFrame, *keys: str) -> DataFrame:
    """Feature vector and both labels, plus any ``keys`` to trace a row back by."""
    return model.transform(encoded).select(*keys, FEATURES, *LABELS)


def dense(df: DataFrame) -> DataFrame:
    """Rows to predict, their feature vectors with a place for each zero: at each node a tree then takes a value by its index, where it
    would search a sparse vector. For models alone, as fitting needs the vector's attributes, which go."""
    return df.withColumn(FEATURES, array_to_vector(vector_to_array(FEATURES)))


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column in one row: what the feature stages would refuse."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
