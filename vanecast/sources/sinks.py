"""Writers: tables inside, CSV for export; appends leave existing files alone."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanecast.functions.registry import FeatureSet
from vanecast.operators.clean import newer_than


def overwrite_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_csv(df: DataFrame, path: str) -> None:
    """CSV part files, each with its header."""
    df.write.mode("append").csv(path, header=True)


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, empty before the first append."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


LABELS = "exec_time timestamp, date_time timestamp, power double"


def label_increment(fresh: DataFrame, store: DataFrame, time: str, power: str) -> DataFrame:
    """Rows newer than the store, in the store's columns."""
    return newer_than(fresh, time, store, "date_time").select(
        F.current_timestamp().alias("exec_time"), F.col(time).cast("timestamp").alias("date_time"),
        F.col(power).cast("double").alias("power"),
    )


def append_labels(spark: SparkSession, fresh: DataFrame, path: str, time: str, power: str) -> None:
    append(label_increment(fresh, stored(spark, path, LABELS), time, power), path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def save_run(spark: SparkSession, path: str, model: PipelineModel, features: FeatureSet, classes: DataFrame | None = None) -> None:
    """All that scoring raw rows takes: the model, the fitted features and, for a classifier, the classes of its codes."""
    save_model(model, f"{path}/model")
    features.save(spark, f"{path}/features")
    if classes is not None:
        classes.write.mode("overwrite").parquet(f"{path}/classes")


def log_run(
    spark: SparkSession, path: str, seq: int, training_type: str, train_end: str, model_id: int, state: str, source: str = ""
) -> None:
    row = spark.range(1).select(
        F.lit(seq).cast("long").alias("seq"), F.lit(training_type).alias("training_type"),
        F.lit(train_end).alias("train_end_date"), F.lit(model_id).cast("long").alias("model_id"),
        F.current_timestamp().alias("exec_time"), F.lit(state).alias("state"), F.lit(source).alias("data_source"),
    )
    append(row, path)
