"""Source and sink queries: files are written from the given tables, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanecast.catalog.base import Q15, R, TS, events, query, r, rounded, table, ts
from vanecast.catalog.modelling import LINE, LINE_SQL, line, order_rows
from vanecast.operators import groupstat, metrics
from vanecast.operators.clean import floor_time
from vanecast.plans import model
from vanecast.session import scratch_path
from vanecast.sources import readers, schemas, sinks

TOWER = T.StructType(
    [T.StructField("datetime", T.StringType()), T.StructField("speed", T.DoubleType()), T.StructField("power", T.DoubleType())]
)
TOWER_SQL = f"SELECT {Q15('ts')} AS t, avg(user_id) AS speed, sum(value) AS power FROM events GROUP BY ALL"
_CUT = "t < TIMESTAMP '2024-01-16 00:00:00'"


def tower_rows(spark, sf_dir):
    e = events(spark, sf_dir)
    return e.groupBy(floor_time("ts").alias("t")).agg(F.avg("user_id").alias("speed"), F.sum("value").alias("power"))


def _as_file(df):
    """Times as text; midnight as a bare date, as raw files have it."""
    midnight = F.date_format("t", "HH:mm:ss") == "00:00:00"
    text = F.when(midnight, F.date_format("t", "yyyy-MM-dd")).otherwise(ts("t"))
    return df.select(text.alias("datetime"), *[c for c in df.columns if c != "t"])


def _two_folders(spark, sf_dir):
    rows = tower_rows(spark, sf_dir)
    paths = [scratch_path(spark, "tower"), scratch_path(spark, "tower")]
    sinks.overwrite_csv(_as_file(rows.where(_CUT)), paths[0])
    sinks.overwrite_csv(_as_file(rows.where(f"NOT ({_CUT})")), paths[1])
    return paths


def _shown(df):
    return df.select(ts("datetime").alias("datetime"), r("speed").alias("speed"), r("power", 4).alias("power"))


_SHOWN = f"SELECT {TS('t')} AS datetime, {R('speed')} AS speed, {R('power', 4)} AS power FROM ({TOWER_SQL})"


@query("s1_tower_scan", _SHOWN)
def s1_tower_scan(spark, sf_dir):
    return _shown(readers.read_measurements(spark, _two_folders(spark, sf_dir), TOWER))


@query("s2_turbine_scan", f"SELECT {TS('ts')} AS datetime, user_id AS rotor_speed, value AS pitch_1 FROM events")
def s2_turbine_scan(spark, sf_dir):
    schema = T.StructType(
        [T.StructField("datetime", T.StringType()), T.StructField("rotor_speed", T.LongType()), T.StructField("pitch_1", T.DoubleType())]
    )
    path = scratch_path(spark, "fans")
    sinks.overwrite_csv(events(spark, sf_dir).select(ts("ts").alias("datetime"), F.col("user_id").alias("rotor_speed"), F.col("value").alias("pitch_1")), path)
    return readers.read_measurements(spark, path, schema).withColumn("datetime", ts("datetime"))


# line items as forecasts: issued on the order date for the ship date, with many duplicates
_VINTAGE = """SELECT o_orderdate AS issue, l_shipdate AS target, l_quantity AS speed, l_extendedprice AS price
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


@query(
    "s3_vintage_scan",
    f"""SELECT {TS('issue')} AS issue, {TS('target')} AS target, speed, price FROM (SELECT *, row_number() OVER (PARTITION BY issue, target
    ORDER BY speed, price) AS rn FROM ({_VINTAGE})) WHERE rn = 1""",
)
def s3_vintage_scan(spark, sf_dir):
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    rows = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("SC_DATE"), F.date_format("o_orderdate", "HH:mm:ss").alias("SC_TIME"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("PRE_DATE"), ts("l_shipdate").alias("PRE_TIME"),
        F.col("l_quantity").alias("speed"), F.col("l_extendedprice").alias("price"),
    )
    path = scratch_path(spark, "weather")
    sinks.overwrite_csv(rows, path)
    out = readers.read_vintages(spark, path, schemas.weather_schema(["speed", "price"]))
    return out.withColumns({"issue": ts("issue"), "target": ts("target")})


@query("s4_folder_scan", f"SELECT CASE WHEN {_CUT} THEN 'train' ELSE 'validation' END AS part, count(*) AS n, {R('sum(power)', 4)} AS power FROM ({TOWER_SQL}) GROUP BY 1")
def s4_folder_scan(spark, sf_dir):
    train, validation = _two_folders(spark, sf_dir)
    rows = readers.read_train_and_validation(spark, train, validation, TOWER)
    return rows.groupBy("part").agg(F.count("*").alias("n"), r(F.sum("power"), 4).alias("power"))


@query("s5_file_list_scan", f"SELECT count(*) AS n, {R('sum(power)', 4)} AS power FROM ({TOWER_SQL})")
def s5_file_list_scan(spark, sf_dir):
    paths = _two_folders(spark, sf_dir)
    files = [f["path"] for p in paths for f in readers.list_files(spark, p).collect()]
    return readers.read_csv(spark, files, TOWER).agg(F.count("*").alias("n"), r(F.sum("power"), 4).alias("power"))


@query("s6_frame_or_path", f"SELECT 'frame' AS kind, count(*) AS n FROM ({TOWER_SQL}) UNION ALL SELECT 'path', count(*) FROM ({TOWER_SQL})")
def s6_frame_or_path(spark, sf_dir):
    paths = _two_folders(spark, sf_dir)
    frame = readers.as_frame(spark, tower_rows(spark, sf_dir), TOWER)
    path = readers.as_frame(spark, paths, TOWER)
    return frame.agg(F.lit("frame").alias("kind"), F.count("*").alias("n")).unionByName(path.agg(F.lit("path").alias("kind"), F.count("*").alias("n")))


def _trial_log(spark, sf_dir):
    """Parts as trials; the closing line of the log names one of them."""
    p = table(spark, sf_dir, "part")
    loss = F.col("p_retailprice") / 1000
    trials = p.select(
        F.col("p_partkey").alias("record_id"),
        F.struct(loss.alias("val_loss"), (loss / 2).alias("train_loss"), F.lit(0.1).alias("pred_time")).alias("logged_metric"),
        loss.alias("validation_loss"), F.col("p_size").cast("double").alias("wall_clock_time"),
        F.create_map(F.lit("max_leaves"), F.col("p_size").cast("string"), F.lit("type"), F.col("p_type")).alias("config"),
        F.col("p_brand").alias("learner"), F.lit(100).cast("long").alias("sample_size"),
    )
    path = scratch_path(spark, "trials")
    trials.write.json(path)
    p.agg(F.min("p_partkey").alias("curr_best_record_id")).write.mode("append").json(path)
    return readers.read_trials(spark, path)


@query(
    "s7_trial_log_scan",
    f"""SELECT p_partkey AS record_id, p_brand AS learner, {R('p_retailprice / 1000')} AS val_loss, {R('p_retailprice / 2000')} AS train_loss,
    CAST(p_size AS VARCHAR) AS max_leaves FROM part""",
)
def s7_trial_log_scan(spark, sf_dir):
    t = _trial_log(spark, sf_dir)
    return t.select("record_id", "learner", r("val_loss").alias("val_loss"), r("train_loss").alias("train_loss"), F.col("config")["max_leaves"].alias("max_leaves"))


@query("o8_best_trial", f"SELECT p_partkey AS record_id, p_brand AS learner, {R('p_retailprice / 1000')} AS validation_loss FROM part ORDER BY p_retailprice, p_partkey LIMIT 1")
def o8_best_trial(spark, sf_dir):
    return rounded(readers.best_trial(_trial_log(spark, sf_dir)), ["record_id", "learner"], ["validation_loss"])


@query("s8_folder_monitor", f"SELECT count(*) AS n, {R('sum(power)', 4)} AS power FROM ({TOWER_SQL}) WHERE NOT ({_CUT})")
def s8_folder_monitor(spark, sf_dir):
    """Files of the first half are known; the second half arrives; only its files are read."""
    rows, folder = tower_rows(spark, sf_dir), scratch_path(spark, "watched")
    sinks.append_csv(_as_file(rows.where(_CUT)), folder)
    known = readers.list_files(spark, folder)
    known_paths = spark.createDataFrame([(f["path"],) for f in known.collect()], "path string")
    sinks.append_csv(_as_file(rows.where(f"NOT ({_CUT})")), folder)
    new = readers.new_file_paths(known_paths, readers.list_files(spark, folder))
    fresh = readers.read_csv(spark, [f["path"] for f in new.collect()], TOWER)
    return fresh.agg(F.count("*").alias("n"), r(F.sum("power"), 4).alias("power"))


# -- sinks -------------------------------------------------------------------------------


@query("k1_overwrite_csv", _SHOWN)
def k1_overwrite_csv(spark, sf_dir):
    path, rows = scratch_path(spark, "export"), _as_file(tower_rows(spark, sf_dir))
    sinks.overwrite_csv(rows.where("power > 50"), path)
    sinks.overwrite_csv(rows, path)
    return _shown(readers.read_measurements(spark, path, TOWER))


@query("k2_append", f"SELECT {TS('t')} AS t, count(*) AS n FROM ({TOWER_SQL}) GROUP BY t")
def k2_append(spark, sf_dir):
    path, rows = scratch_path(spark, "appended"), tower_rows(spark, sf_dir)
    sinks.append(rows.where(_CUT), path)
    sinks.append(rows.where(f"NOT ({_CUT})"), path)
    out = spark.read.schema(rows.schema).parquet(path)
    return out.groupBy(ts("t").alias("t")).agg(F.count("*").alias("n"))


@query("k3_label_store", f"SELECT {TS('t')} AS date_time, {R('power', 4)} AS power FROM ({TOWER_SQL})")
def k3_label_store(spark, sf_dir):
    """The store holds the first half; appending all rows adds the second half only."""
    path, rows = scratch_path(spark, "labels"), tower_rows(spark, sf_dir)
    sinks.append_labels(spark, rows.where(_CUT), path, "t", "power")
    sinks.append_labels(spark, rows, path, "t", "power")
    sinks.append_labels(spark, rows, path, "t", "power")
    return sinks.stored(spark, path, sinks.LABELS).select(ts("date_time").alias("date_time"), r("power", 4).alias("power"))


_ERR = "l_extendedprice - l_quantity * 1500"


@query(
    "k4_metrics_table",
    f"""SELECT 'run-1' AS run, unnest(['mse', 'rmse', 'mae', 'r2']) AS metric, unnest([{R(f'avg(({_ERR}) ** 2)', 2)}, {R(f'sqrt(avg(({_ERR}) ** 2))', 2)},
    {R(f'avg(abs({_ERR}))', 2)}, {R(f'1 - sum(({_ERR}) ** 2) / (var_pop(l_extendedprice) * count(*))', 2)}]) AS value FROM lineitem""",
)
def k4_metrics_table(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_extendedprice", (F.col("l_quantity") * 1500).alias("p"))
    rows = metrics.as_rows(metrics.evaluate(li, "l_extendedprice", "p"), list(metrics.REGRESSION), "run-1")
    path = scratch_path(spark, "metrics")
    sinks.append(rows, path)
    return spark.read.schema("run string, metric string, value double").parquet(path).select("run", "metric", r("value", 2).alias("value"))


@query("k5_model_store", f"{LINE_SQL} SELECT l_orderkey, {LINE} AS y_pred FROM o, f")
def k5_model_store(spark, sf_dir):
    """A model saved twice (the second replaces the first) and loaded again gives the same predictions."""
    rows = order_rows(spark, sf_dir)
    path = scratch_path(spark, "model")
    sinks.save_model(line(rows.where("quantity > 50")), path)
    sinks.save_model(line(rows), path)
    return model.predict(readers.load_model(path), rows).select("l_orderkey", r("y_pred", 2).alias("y_pred"))


@query("s9_model_scan", f"{LINE_SQL} SELECT l_orderkey, {LINE} AS y_pred FROM o, f")
def s9_model_scan(spark, sf_dir):
    rows = order_rows(spark, sf_dir)
    path = scratch_path(spark, "model")
    sinks.save_model(line(rows), path)
    return model.predict(readers.load_model(path), rows).select("l_orderkey", r("y_pred", 2).alias("y_pred"))


@query("k6_validation_table", f"{LINE_SQL} SELECT l_orderkey, flag, quantity, {R('price', 2)} AS y_true, {LINE} AS y_pred FROM o, f")
def k6_validation_table(spark, sf_dir):
    """Stored with coded categories; the codes are turned back for the report."""
    rows = order_rows(spark, sf_dir)
    classes = groupstat.fit_labels(rows, "flag")
    coded = groupstat.encode_labels(rows, classes, "flag").withColumnRenamed("flag", "code")
    path = scratch_path(spark, "validation")
    sinks.append(model.predict(line(coded), coded), path)
    out = groupstat.decode_labels(spark.read.parquet(path), classes, "code", "flag")
    return out.select("l_orderkey", "flag", "quantity", r("price", 2).alias("y_true"), r("y_pred", 2).alias("y_pred"))


# one training run per day; days with few rows failed
_RUNS = """SELECT row_number() OVER (ORDER BY day) AS seq, strftime(day, '%Y-%m-%d') AS train_end_date, dayofyear(day) AS model_id,
    CASE WHEN n >= (SELECT avg(n) FROM d) THEN 'success' ELSE 'failed' END AS state FROM d"""
_D = "WITH d AS (SELECT date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY 1)"


def _runs(spark, sf_dir):
    days = events(spark, sf_dir).groupBy(F.date_trunc("day", "ts").alias("exec_time")).agg(F.count("*").alias("n"))
    mean = days.agg(F.avg("n").alias("mean"))
    runs = days.crossJoin(F.broadcast(mean)).select(
        F.lit("incremental").alias("training_type"), F.date_format("exec_time", "yyyy-MM-dd").alias("train_end_date"),
        F.dayofyear("exec_time").cast("long").alias("model_id"), "exec_time",
        F.when(F.col("n") >= F.col("mean"), "success").otherwise("failed").alias("state"), F.lit("events").alias("data_source"),
    )
    path = scratch_path(spark, "runs")
    sinks.append(readers.numbered(runs), path)
    return sinks.stored(spark, path, schemas.RUN_LOG)


@query("k7_run_log", f"{_D} {_RUNS}")
def k7_run_log(spark, sf_dir):
    return _runs(spark, sf_dir).select("seq", "train_end_date", "model_id", "state")


@query("o7_latest_success", f"{_D} SELECT * FROM ({_RUNS}) WHERE state = 'success' ORDER BY seq DESC LIMIT 1")
def o7_latest_success(spark, sf_dir):
    return readers.latest_success(_runs(spark, sf_dir)).select("seq", "train_end_date", "model_id", "state")
