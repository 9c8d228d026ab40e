"""Streams agree with their batch twins, and repeated or late input does not add rows."""

from pyspark.sql import functions as F

from vanecast.catalog import QUERIES
from vanecast.sources import sinks
from vanecast.streaming import jobs


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_streams_equal_the_batch_to_the_last_window(spark, sf_dir):
    for name in ("st2_quarter_means", "st3_sliding_means"):
        batch = QUERIES[name](spark, sf_dir)
        assert rows(QUERIES[f"{name}_stream"](spark, sf_dir)) == rows(batch)


def test_ingestion_reads_each_file_once(spark, tmp_path):
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = spark.range(0).schema
    for part in (spark.range(0, 10), spark.range(10, 25), spark.range(0)):
        sinks.append_csv(part, folder)
        jobs.to_table(jobs.new_files(spark, folder, schema), out, mark)
    assert sorted(r["id"] for r in spark.read.schema(schema).parquet(out).collect()) == list(range(25))


def test_late_labels_are_dropped(spark, tmp_path):
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    base = spark.range(1).select(F.lit(1).alias("k"), F.lit("2024-01-02 00:00:00").cast("timestamp").alias("t"), F.lit(5.0).alias("p"))
    late = base.withColumn("t", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    for part in (base, late, base.withColumn("t", F.lit("2024-01-02 00:15:00").cast("timestamp"))):
        sinks.append(part, folder)
        jobs.append_once(jobs.label_stream(jobs.new_files(spark, folder, base.schema, "parquet"), "t", ["k"], "p"), out, mark)
    stored = sorted(str(r["date_time"]) for r in spark.read.parquet(out).collect())
    assert stored == ["2024-01-02 00:00:00", "2024-01-02 00:15:00"]


def test_monitor_accumulates_over_batches(spark, tmp_path):
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    data = spark.range(200).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("y"), (F.col("id") + F.col("id") % 3).cast("double").alias("p"))
    for part in (data.where("y < 90"), data.where("y >= 90")):
        sinks.append(part, folder)
        jobs.keep_status(jobs.score_monitor(jobs.new_files(spark, folder, data.schema, "parquet"), "k", "y", "p"), out, mark)
    got = jobs.latest_status(spark, out, "k").first()
    assert spark.read.parquet(out).count() == 2  # a folder per batch, none replaced
    from vanecast.operators.metrics import evaluate, r2

    want = evaluate(data, "y", "p", {"r2": r2}).first()["r2"]
    assert got["n"] == 200 and abs(got["r2"] - want) < 1e-9 and not got["drift"]


def _deliver(spark, folder, key, day, n):
    data = spark.range(n).select(
        F.lit(key).alias("k"), (F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp") + F.make_dt_interval(secs=F.col("id"))).alias("t"),
        (F.col("id") + 1e6).alias("y"), (F.col("id") + 1e6 + F.col("id") % 3).alias("p"),
    )
    sinks.append(data, folder)
    return data


def test_idle_keys_vanish_and_start_anew(spark, tmp_path):
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    from vanecast.operators.metrics import evaluate, r2

    def run(key, day, n):
        data = _deliver(spark, folder, key, day, n)
        stream = jobs.new_files(spark, folder, data.schema, "parquet")
        jobs.keep_status(jobs.score_monitor_until_idle(stream, "k", "t", "y", "p", ttl="3 days"), out, mark, key="k")
        return {r["k"]: r for r in jobs.latest_status(spark, out, "k").collect()}, data

    got, data = run("a", 1, 200)
    want = evaluate(data, "y", "p", {"r2": r2}).first()["r2"]
    assert got["a"]["n"] == 200 and abs(got["a"]["r2"] - want) < 1e-6 and not got["a"]["expired"]
    got, _ = run("b", 2, 50)
    assert not got["a"]["expired"] and got["b"]["n"] == 50
    got, _ = run("b", 5, 50)  # moves the watermark three days past the last row of a
    assert got["a"]["expired"] and got["a"]["n"] == 200 and got["b"]["n"] == 100
    got, _ = run("a", 6, 10)  # the old sums are gone
    assert got["a"]["n"] == 10 and not got["a"]["expired"]


def test_status_folder_is_bounded(spark, tmp_path):
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for i in range(9):
        data = _deliver(spark, folder, f"k{i % 2}", 1, 20)
        jobs.keep_status(jobs.score_monitor(jobs.new_files(spark, folder, data.schema, "parquet"), "k", "y", "p"), out, mark, key="k", every=2)
    got = {r["k"]: r["n"] for r in jobs.latest_status(spark, out, "k").collect()}
    assert got == {"k0": 100, "k1": 80}
    found = jobs._folders(spark, out)
    assert len(found["snapshot"]) <= 2 and len(found["batch"]) <= 4


def test_a_repeated_batch_writes_the_same_snapshot(spark, tmp_path):
    out = str(tmp_path / "out")
    write = lambda name, rows: spark.createDataFrame(rows, "k string, n int, expired boolean").write.mode("overwrite").parquet(f"{out}/{name}")
    write("batch=0", [("a", 1, False), ("b", 1, True)])
    write("batch=1", [("a", 2, False)])
    for _ in range(2):
        current = jobs.latest_status(spark, out, "k", upto=1)
        assert rows(current) == {("a", 2, False), ("b", 1, True)}
        current.where("NOT expired").write.mode("overwrite").parquet(f"{out}/snapshot=1")
    write("batch=2", [("c", 1, False)])
    assert rows(jobs.latest_status(spark, out, "k")) == {("a", 2, False), ("c", 1, False)}
