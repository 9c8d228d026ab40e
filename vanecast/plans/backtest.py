"""Rolling-origin back-tests that train a ridge regression at every origin, in one pass.

A training row knows its features at its base time and its label a horizon later. Its
products of features and label are additive, so they are summed per (group, origin step)
and the sums up to an origin are all that its model needs: the data is read once however
many origins are trained, and every (group, origin) is one small linear system. A row
enters an origin's sums only if its label lies before the origin.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanecast.plans.forecast import QUARTER, Origins, targets


def _all_known(columns: Sequence[str]) -> Column:
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return known


def training_sums(
    rows: DataFrame, group: Sequence[str], time: str, features: Sequence[str], label: str, horizon: timedelta, origins: Origins,
    lookback: timedelta | None = None,
) -> DataFrame:
    """Per (group, origin ``number``): ``m`` labels and their sum ``t``, ``n`` complete rows and sums of products.

    ``p_i_j`` sums products of the columns 0 .. p, where 0 is the label and i the i-th
    feature, and ``s_i`` their values, all as differences from ``c_i``, a value of the group:
    a shift changes no fit, it saves the digits of a high level. Steps are central moments,
    which merge without loss. Rows count if their label's time is before the origin, and
    with ``lookback`` (a multiple of the step) not earlier than that before it.
    """
    columns = [label, *features]
    known, labelled = _all_known(columns), _all_known([label])
    micros = int(horizon.total_seconds()) * 1_000_000
    seen = rows.withColumn("__at", F.timestamp_micros(F.unix_micros(F.col(time).cast("timestamp")) + micros))
    seen = seen.select(
        *group, origins.number_after("__at").alias("number"), labelled.alias("__labelled"), known.alias("__known"),
        *[F.when(known, F.col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(columns)],
        F.when(labelled, F.col(label).cast("double")).alias("__y"),
    )
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    moments = {"m": F.count_if("__labelled"), "t": F.sum("__y"), "n": F.count_if("__known")}
    moments |= {f"a_{i}": F.avg(f"x{i}") for i in range(len(columns))}
    moments |= {f"q_{i}_{j}": F.covar_pop(f"x{i}", f"x{j}") for i, j in pairs}
    steps = seen.groupBy(*group, "number").agg(*[e.alias(n) for n, e in moments.items()]).withColumn("__wanted", F.lit(False))
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(origins.count - 1).cast("long")) if origins.count > 0 else F.array().cast("array<long>")
    nothing = [F.lit(None).cast(steps.schema[n].dataType).alias(n) for n in moments]
    wanted = rows.select(*group).distinct().select(*group, F.explode(numbers).alias("number"), *nothing, F.lit(True).alias("__wanted"))
    # one row per origin step: the windows are bounded by the time span
    in_order = Window.partitionBy(*group).orderBy("number")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shift = {f"c_{i}": F.coalesce(F.first(f"a_{i}", ignorenulls=True).over(whole), F.lit(0.0)) for i in range(len(columns))}
    both = steps.unionByName(wanted).withColumns(shift).withColumns({f"d_{i}": F.col(f"a_{i}") - F.col(f"c_{i}") for i in range(len(columns))})
    sums = {"m": F.col("m"), "t": F.col("t"), "n": F.col("n")}
    sums |= {f"s_{i}": F.col("n") * F.col(f"d_{i}") for i in range(len(columns))}
    sums |= {f"p_{i}_{j}": F.col("n") * (F.col(f"q_{i}_{j}") + F.col(f"d_{i}") * F.col(f"d_{j}")) for i, j in pairs}
    low = Window.unboundedPreceding if lookback is None else -(int(lookback / origins.step) - 1)
    before = in_order.rangeBetween(low, 0)
    total = both.select(*group, "number", "__wanted", *shift, *[F.coalesce(F.sum(e).over(before), F.lit(0)).alias(n) for n, e in sums.items()])
    return total.where("__wanted").drop("__wanted")


def solve_ridge(sums: DataFrame, group: Sequence[str], features: int, penalty: float = 0.0) -> DataFrame:
    """One ridge fit per row of ``training_sums``: ``n``, ``mean`` of the labels, ``intercept`` and ``weights``.

    The penalty counts against the sum of squares of the centred features; the intercept is
    free. Directions in which the training rows do not differ get no weight, so a fit exists
    from one row on; without any row, intercept and weights are NULL.
    """
    keep = [sums.schema[c] for c in (*group, "number")]
    schema = T.StructType(
        [*keep, T.StructField("n", T.LongType()), T.StructField("mean", T.DoubleType()), T.StructField("intercept", T.DoubleType()),
         T.StructField("weights", T.ArrayType(T.DoubleType()))]
    )
    pairs = list(combinations_with_replacement(range(features + 1), 2))

    def solve(stream):
        for batch in stream:
            get = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in batch.schema.names if c not in group}
            n, rows = np.maximum(get["n"], 1), batch.num_rows
            s = np.stack([get[f"s_{i}"] for i in range(features + 1)], axis=1)
            products = np.zeros((rows, features + 1, features + 1))
            for i, j in pairs:
                products[:, i, j] = products[:, j, i] = get[f"p_{i}_{j}"] - s[:, i] * s[:, j] / n
            squares = products[:, 1:, 1:] + penalty * np.eye(features)
            # inverse on unit scale, so that a feature's unit does not decide what counts as constant
            scale = np.sqrt(np.maximum(np.einsum("rii->ri", squares), 0))
            scale[scale == 0] = 1
            unit = squares / scale[:, :, None] / scale[:, None, :]
            inverse = np.linalg.pinv(unit, rcond=1e-10, hermitian=True)
            weights = np.einsum("rij,rj->ri", inverse, products[:, 1:, 0] / scale) / scale
            centers = np.stack([get[f"c_{i}"] for i in range(features + 1)], axis=1)
            means = centers + s / n[:, None]
            intercept = means[:, 0] - (weights * means[:, 1:]).sum(axis=1)
            none = get["n"] < 1
            mean = np.divide(get["t"], get["m"], out=np.zeros(rows), where=get["m"] > 0)
            out = [batch.column(c) for c in (*group, "number")]
            out += [pa.array(get["n"].astype(np.int64)), pa.array(mean, mask=get["m"] < 1), pa.array(intercept, mask=none)]
            out.append(pa.array([None if x else w.tolist() for x, w in zip(none, weights, strict=True)], pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(out, names=[f.name for f in schema.fields])

    return sums.mapInArrow(solve, schema)


def backtest_trained(
    rows: DataFrame,
    group: Sequence[str],
    time: str,
    features: Sequence[str],
    value: str,
    origins: Origins,
    steps: int,
    sub_origins: int = 1,
    lookback: timedelta | None = None,
    penalty: float = 0.0,
) -> DataFrame:
    """Forecasts of a ridge regression trained anew at each origin, joined with the actual values.

    ``rows`` is unique per group and time; ``features`` are known at ``time``. The model of an
    origin learns ``value`` a horizon (``steps`` quarters) after the features from labels
    before the origin only, and predicts the quarters from each sub-origin on, each from the
    features a horizon earlier, which are known by then. Where features are missing or
    nothing was learnt, the prediction is the mean of the labels before the origin.
    """
    minutes = steps * QUARTER
    horizon = timedelta(minutes=minutes)
    later = rows.select(*group, (F.col(time) - F.expr(f"INTERVAL '{minutes}' MINUTE")).alias(time), F.col(value).alias("__label"))
    training = rows.select(*group, time, *features).join(later, [*group, time], "full")
    sums = training_sums(training, group, time, features, "__label", horizon, origins, lookback)
    models = solve_ridge(sums, group, len(features), penalty)
    wanted = targets(models, origins, steps, sub_origins).withColumn("__base", F.col("date_time") - F.expr(f"INTERVAL '{minutes}' MINUTE"))
    known = rows.select(*group, F.col(time).alias("__base"), F.array(*[F.col(f).cast("double") for f in features]).alias("__x"))
    actual = rows.select(*group, F.col(time).alias("date_time"), F.col(value).alias("y_true"))
    product = F.aggregate(F.zip_with("weights", "__x", lambda a, b: a * F.nanvl(b, F.lit(None))), F.col("intercept"), lambda a, b: a + b)
    return (
        wanted.join(known, [*group, "__base"], "left")
        .join(actual, [*group, "date_time"], "left")
        .select(*group, "origin", "exec_point", "date_time", "n", F.coalesce(product, F.col("mean")).alias("y_pred"), "y_true")
    )
