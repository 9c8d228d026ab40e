"""Readers: many files are one scan, times are parsed and NaN becomes NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanecast.functions.registry import FeatureSet
from vanecast.operators.clean import clean_names, nan_to_null, parse_time
from vanecast.operators.joins import missing_from
from vanecast.operators.ordered import OrderedRows
from vanecast.operators.weather import add_vintage_keys, unique_vintages
from vanecast.sources.schemas import TOWER, TRIAL_LOG, WEATHER

Paths = str | Sequence[str]


def read_csv(spark: SparkSession, paths: Paths, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).csv(paths if isinstance(paths, str) else list(paths), header=True)


def read_measurements(spark: SparkSession, paths: Paths, schema: T.StructType = TOWER, time: str = "datetime") -> DataFrame:
    """Tower or turbine files."""
    return nan_to_null(read_csv(spark, paths, schema).withColumn(time, parse_time(time)))


def read_vintages(spark: SparkSession, paths: Paths, schema: T.StructType = WEATHER) -> DataFrame:
    """Forecast files: issue and target times parsed, duplicates reduced to one row per pair."""
    rows = nan_to_null(read_csv(spark, paths, schema))
    keyed = add_vintage_keys(rows, "SC_DATE", "SC_TIME", "PRE_TIME").drop("SC_DATE", "SC_TIME", "PRE_DATE", "PRE_TIME")
    values = [c for c in keyed.columns if c not in ("issue", "target")]
    return unique_vintages(keyed, values)


def read_train_and_validation(spark: SparkSession, train: str, validation: str | None, schema: T.StructType) -> DataFrame:
    """Training folder, with the validation folder where there is one, marked by ``part``."""
    out = read_csv(spark, train, schema).withColumn("part", F.lit("train"))
    if validation:
        more = read_csv(spark, validation, schema).withColumn("part", F.lit("validation"))
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def as_frame(spark: SparkSession, data: DataFrame | Paths, schema: T.StructType) -> DataFrame:
    """A DataFrame as it is, or the files at a path or list of paths."""
    return clean_names(data if isinstance(data, DataFrame) else read_csv(spark, data, schema))


def read_trials(spark: SparkSession, paths: Paths) -> DataFrame:
    """Trial log: identifier, losses, learner and settings; the closing line of each file is left out."""
    rows = spark.read.schema(TRIAL_LOG).json(paths if isinstance(paths, str) else list(paths))
    # the closing line names the best trial and carries no record_id
    return rows.where(F.col("record_id").isNotNull()).select(
        "record_id", "learner", "logged_metric.val_loss", "logged_metric.train_loss", "validation_loss",
        "wall_clock_time", "sample_size", "config",
    )


def best_trial(trials: DataFrame) -> DataFrame:
    best = F.min(F.struct("validation_loss", "record_id", "learner"))
    return trials.agg(best.alias("b")).select("b.*")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the store that Spark reads."""
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def load_run(spark: SparkSession, path: str) -> tuple[PipelineModel, FeatureSet]:
    """Model and fitted features as ``save_run`` stored them."""
    return load_model(f"{path}/model"), FeatureSet.load(spark, f"{path}/features")


def latest_success(runs: DataFrame) -> DataFrame:
    """Newest successful run of the log."""
    return runs.where(F.col("state") == "success").agg(F.max_by(F.struct(*runs.columns), "seq").alias("r")).select("r.*")


def latest_valid_model(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("state") == "success").agg(F.max("model_id").alias("model_id"))


def numbered(runs: DataFrame, start: int = 0) -> DataFrame:
    """Run numbers in order of execution."""
    placed = OrderedRows(runs, [], ["exec_time", "model_id"]).positions("seq")
    return placed.withColumn("seq", F.col("seq") + start)


# -- folders watched for new files ------------------------------------------------------


def list_files(spark: SparkSession, folder: str, glob: str = "*.csv") -> DataFrame:
    """Paths below a folder; only file status is read, not the content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return files.load(folder).select("path", "length")


def new_file_paths(known: DataFrame, current: DataFrame) -> DataFrame:
    """Files not known before. A known file that has disappeared is an error."""
    if missing_from(known, current, ["path"]).limit(1).count():
        raise ValueError("files read earlier are missing from the folder")
    return missing_from(current, known, ["path"])
