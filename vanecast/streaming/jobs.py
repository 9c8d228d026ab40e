"""Structured Streaming: ingestion, aggregation, label append, monitoring, retraining."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vanecast.operators.drift import SCORE_THRESHOLD
from vanecast.operators.metrics import r2
from vanecast.session import broadcast_rows, sized

DELAY = "1 hour"


def new_files(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "csv", glob: str | None = None) -> DataFrame:
    """Stream of the rows in files not read before; the query's checkpoint is the list of known files."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder)


def event_time(df: DataFrame, time: str, delay: str = DELAY) -> DataFrame:
    """Watermarked time column; a zone-less timestamp is converted first."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def quarter_means(df: DataFrame, time: str, group: Sequence[str], value: str) -> DataFrame:
    """Mean and count per 15 minutes and group; the same code serves batch and stream."""
    return (
        df.groupBy(F.window(time, "15 minutes"), *group)
        .agg(F.avg(value).alias("mean"), F.count(value).alias("n"))
        .select(F.col("window.start").alias("start"), *group, "mean", "n")
    )


def sliding_means(df: DataFrame, time: str, group: Sequence[str], value: str, size: str = "4 hours", slide: str = "15 minutes") -> DataFrame:
    """Mean of the last hours at every step.

    Rows are first summed per step, so only one row per step and group is
    copied into the overlapping windows; batch and stream alike.
    """
    panes = df.groupBy(F.window(time, slide).alias("pane"), *group).agg(F.sum(value).alias("s"), F.count(value).alias("c"))
    return (
        panes.groupBy(F.window("pane", size, slide), *group)
        .agg(F.sum("s").alias("s"), F.sum("c").alias("n"))
        .select(F.col("window.end").alias("until"), *group, F.try_divide("s", "n").alias("mean"), "n")
    )


def run_available(query_writer, checkpoint: str) -> StreamingQuery:
    """Process everything available, then stop."""
    query = query_writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def to_table(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished rows to a parquet table; the sink's log makes each batch count once."""
    return run_available(df.writeStream.format("parquet").option("path", path).outputMode("append"), checkpoint)


def closing_row(schema: T.StructType, spark: SparkSession, time: str, at: Column) -> DataFrame:
    """The final delivery: one row at a time past every window, all its other columns NULL."""
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*empty).withColumn(time, at.cast(schema[time].dataType))


def with_closing(stream: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """The stream and what is delivered to ``folder`` when it has ended."""
    return stream.unionByName(new_files(spark, folder, stream.schema, "parquet"))


def to_table_closed(df: DataFrame, path: str, checkpoint: str, deliver: Callable[[], None]) -> None:
    """Write the windows closed so far, then have the final delivery made and write the rest.

    The delivered row moves the watermark past the end, so every window with rows of the
    stream closes; its own window never does and is not written.
    """
    to_table(df, path, checkpoint)
    deliver()
    to_table(df, path, checkpoint)


def label_stream(df: DataFrame, time: str, key: Sequence[str], power: str, delay: str = DELAY) -> DataFrame:
    """Labels in the store's columns, each (key, time) once; rows behind the watermark are dropped."""
    unique = event_time(df, time, delay).dropDuplicatesWithinWatermark([*key, time])
    return unique.select(*key, F.col(time).alias("date_time"), F.col(power).cast("double").alias("power"))


def append_once(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch overwrites its own partition, so a repeated batch does not add rows twice."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("exec_time", F.current_timestamp()).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return run_available(df.writeStream.foreachBatch(write), checkpoint)


def join_static(stream: DataFrame, vintages: DataFrame, time: str, minutes: int, issue: Column) -> DataFrame:
    """Fresh rows with their forecast: stream-static left join on (target, issue).

    The forecasts are counted; a small table is broadcast to every micro-batch.
    """
    right, rows = sized(vintages.withColumnsRenamed({"target": "__target", "issue": "__issue"}))
    right = F.broadcast(right) if rows <= broadcast_rows(stream.sparkSession) else right
    left = stream.withColumn("__target", F.col(time) + F.expr(f"INTERVAL '{minutes}' MINUTE")).withColumn("__issue", issue)
    return left.join(right, ["__target", "__issue"], "left").drop("__target", "__issue")


def score_monitor(stream: DataFrame, key: str, actual: str, predicted: str, threshold: float = SCORE_THRESHOLD) -> DataFrame:
    """Running R2 and drift flag per key.

    The state per key is a handful of sums held by the streaming aggregate, and
    every task reduces its rows first, so a hot key costs no more than others.
    """
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    known = stream.where(y.isNotNull() & p.isNotNull())
    scored = known.groupBy(key).agg(F.count(F.lit(1)).alias("n"), r2(y, p).alias("r2"))
    return scored.withColumn("drift", F.col("r2") < threshold)


# Sums of a key relative to its first actual value, so that a large level costs no digits.
_SUMS = "n long, base double, sy double, syy double, see double, ms long"
_STATUS = "n long, r2 double, drift boolean, expired boolean, ms long"


def _partial_sums(key: str, actual: str, predicted: str, time: str) -> Callable:
    """Per Arrow batch one row per key, so a hot key's group gets one row for thousands, and no task holds all keys."""

    def reduce_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            y, p = b[actual], b[predicted]
            base = y.groupby(b[key]).transform("first")
            d, e = y - base, y - p
            yield pd.DataFrame({
                key: b[key], "n": 1, "base": base, "sy": d, "syy": d * d, "see": e * e, "ms": b[time],
            }).groupby(key, as_index=False).agg({"n": "sum", "base": "first", "sy": "sum", "syy": "sum", "see": "sum", "ms": "max"})

    return reduce_batch


def _add_sums(held: tuple, n: int, base: float, sy: float, syy: float, see: float) -> tuple:
    """Held sums and others, the others moved to the held base."""
    if not held[0]:
        return n, base, sy, syy, see
    move = base - held[1]
    return held[0] + n, held[1], held[2] + sy + n * move, held[3] + syy + 2 * move * sy + n * move * move, held[4] + see


def score_monitor_until_idle(
    stream: DataFrame, key: str, time: str, actual: str, predicted: str, ttl: str = "7 days", delay: str = DELAY,
    threshold: float = SCORE_THRESHOLD,
) -> DataFrame:
    """Running R2 and drift flag per key; the state of a key goes when it has been idle for ``ttl``.

    Rows (key, n, r2, drift, expired, last). The watermark stays ``delay`` behind the newest row; once it is ``ttl`` past
    a key's own newest row, the key is reported as expired and forgotten, and starts anew when it returns. State is
    bounded by the keys seen within ``ttl`` and ``delay``. Rows lacking the key, the time or a value are left out.
    Rows of one key and task are late when all of them are behind the watermark.
    """
    wait = int(pd.Timedelta(ttl).total_seconds() * 1000)
    kind = stream.schema[key].dataType.simpleString()
    known = stream.select(key, F.unix_millis(F.col(time).cast("timestamp")).alias(time), *[F.col(c).cast("double").alias(c) for c in (actual, predicted)])
    known = known.dropna().where(~F.isnan(actual) & ~F.isnan(predicted))
    sums = known.mapInPandas(_partial_sums(key, actual, predicted, time), f"`{key}` {kind}, {_SUMS}")

    def update(keys: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            held = state.get
            state.remove()
            yield _status(keys, held, True)
            return
        held = state.get if state.exists else (0, 0.0, 0.0, 0.0, 0.0, 0)
        for part in parts:
            for row in part.itertuples(index=False):
                last = max(held[5], int(row.ms))
                held = (*_add_sums(held, int(row.n), float(row.base), float(row.sy), float(row.syy), float(row.see)), last)
        state.update(held)
        # a time behind the watermark cannot be set; then the key has been idle for that long already
        state.setTimeoutTimestamp(max(held[5] + wait, state.getCurrentWatermarkMs() + 1))
        yield _status(keys, held, False)

    def _status(keys: tuple, held: tuple, expired: bool) -> pd.DataFrame:
        n, _, sy, syy, see, last = held
        spread = syy - sy * sy / n
        share = 1 - see / spread if spread > 0 else None
        return pd.DataFrame({
            key: [keys[0]], "n": [n], "r2": pd.Series([share], dtype="float64"),
            "drift": pd.Series([None if share is None else share < threshold], dtype="boolean"), "expired": [expired], "ms": [last],
        })

    timed = sums.withColumn("last", F.timestamp_millis("ms")).withWatermark("last", delay)
    out = timed.groupBy(key).applyInPandasWithState(
        update, f"`{key}` {kind}, {_STATUS}", "n long, base double, sy double, syy double, see double, last long", "update",
        GroupStateTimeout.EventTimeTimeout,
    )
    return out.select(key, "n", "r2", "drift", "expired", F.timestamp_millis("ms").alias("last"))


# Batches between two snapshots of a status folder.
SNAPSHOT_EVERY = 20


def keep_status(
    df: DataFrame, path: str, checkpoint: str, key: str | None = None, every: int = SNAPSHOT_EVERY
) -> StreamingQuery:
    """Write the keys that a batch changed to a folder of their own; ``latest_status`` reads the current ones.

    Files that readers use are never replaced, and a repeated batch writes the same folder again. With ``key``, every
    ``every``-th batch also writes a snapshot of all current keys, without those that expired, and removes
    what lies before the last but one snapshot: the folder holds at most two snapshots and 2 x ``every`` batches.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
        if key is not None and (number + 1) % every == 0:
            spark = batch.sparkSession
            current = latest_status(spark, path, key, upto=number)
            if "expired" in current.columns:
                current = current.where(~F.col("expired"))
            current.write.mode("overwrite").parquet(f"{path}/snapshot={number}")
            _remove_before(spark, path, number - every)

    return run_available(df.writeStream.outputMode("update").foreachBatch(write), checkpoint)


def _folders(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """Numbers of the finished snapshot and batch folders, ascending."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str, list[int]] = {"snapshot": [], "batch": []}
    for entry in fs.listStatus(root) if fs.exists(root) else []:
        kind, _, number = entry.getPath().getName().partition("=")
        done = spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")
        if kind in found and fs.exists(done):
            found[kind].append(int(number))
    return {kind: sorted(numbers) for kind, numbers in found.items()}


def _remove_before(spark: SparkSession, path: str, number: int) -> None:
    """Batches up to ``number`` and snapshots before it: no reader that looks up the newest snapshot needs them."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = _folders(spark, path)
    old = [f"batch={n}" for n in found["batch"] if n <= number] + [f"snapshot={n}" for n in found["snapshot"] if n < number]
    for name in old:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(root, name), True)


def latest_status(spark: SparkSession, path: str, key: str, upto: int | None = None) -> DataFrame:
    """The newest row of every key: out of the last snapshot and the batches after it."""
    found = _folders(spark, path)
    held = [n for n in found["snapshot"] if upto is None or n < upto][-1:]
    after = [n for n in found["batch"] if n > (held[0] if held else -1) and (upto is None or n <= upto)]
    parts = [(f"{path}/snapshot={n}", n) for n in held] + [(f"{path}/batch={n}", n) for n in after]
    if not parts:
        raise FileNotFoundError(f"no status has been written to {path}")
    schema = spark.read.parquet(parts[-1][0]).schema
    rows = spark.read.schema(schema).parquet(*[p for p, _ in parts])
    at = F.regexp_extract(F.input_file_name(), r"(?:snapshot|batch)=(\d+)/[^/]*$", 1).cast("long")
    numbered = rows.select(*schema.names, at.alias("__batch"))
    newest = numbered.groupBy(key).agg(F.max_by(F.struct(*schema.names), "__batch").alias("__row"))
    return newest.select("__row.*")


def retrain_on_drift(
    stream: DataFrame, check: Callable[[DataFrame, int], DataFrame], train: Callable[[DataFrame, int], None], log: str, checkpoint: str
) -> StreamingQuery:
    """Check every batch for drift; log the outcome under the batch number and retrain when it drifted.

    ``check`` gets the batch and its number and compares with a stored summary, not with the rows of history.
    """

    def handle(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # read by the check and by the training
        try:
            drifted = bool(check(batch, number).where("drift").limit(1).count())
            if drifted:
                train(batch, number)
        finally:
            batch.unpersist()
        row = batch.sparkSession.range(1).select(
            F.lit(number).cast("long").alias("seq"), F.lit("incremental").alias("training_type"),
            F.lit("success" if drifted else "skipped").alias("state"), F.lit(drifted).alias("drift"),
        )
        row.write.mode("overwrite").parquet(f"{log}/batch={number}")

    return run_available(stream.writeStream.foreachBatch(handle), checkpoint)
