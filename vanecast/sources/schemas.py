"""Schemas of the input files; explicit, so reading needs no inference pass."""

from pyspark.sql import types as T

# Height levels of the forecast variables, in metres.
LEVELS = (10, 30, 50, 60, 70, 80, 90, 100, 120, 130, 140, 160, 170)
VARIABLES = ("humidity", "pressure", "temperature", "direction", "speed")


def _doubles(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


TOWER = T.StructType(_strings("datetime") + _doubles("direction", "speed", "temperature", "pressure", "humidity", "power"))
WEATHER = T.StructType(
    _strings("SC_DATE", "SC_TIME", "PRE_DATE", "PRE_TIME") + _doubles(*[f"{v}{h}" for v in VARIABLES for h in LEVELS])
)
TRIAL_LOG = T.StructType(
    [
        T.StructField("record_id", T.LongType()),
        T.StructField("iter_per_learner", T.LongType()),
        T.StructField(
            "logged_metric",
            T.StructType(_doubles("val_loss", "train_loss", "pred_time")),
        ),
        *_doubles("trial_time", "wall_clock_time", "validation_loss"),
        T.StructField("config", T.MapType(T.StringType(), T.StringType())),
        T.StructField("learner", T.StringType()),
        T.StructField("sample_size", T.LongType()),
    ]
)
RUN_LOG = (
    "seq bigint, training_type string, train_end_date string, model_id bigint, exec_time timestamp, "
    "state string, data_source string"
)


def weather_schema(columns: list[str]) -> T.StructType:
    """Vintage schema with only some forecast columns."""
    return T.StructType(_strings("SC_DATE", "SC_TIME", "PRE_DATE", "PRE_TIME") + _doubles(*columns))
