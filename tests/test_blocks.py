"""Rolling features of groups cut into blocks: array operations that equal Spark's windows to the last bit."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vanecast.functions.registry import Feature, FeatureSet
from vanecast.operators import ordered, ranks, window
from vanecast.operators.window import ROLLING_OPS, Rolling, rolling_features


def rows(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=300) * 10.0 ** rng.integers(-3, 6, size=300)
    out = []
    for i in range(300):
        a = None if i % 17 == 3 else float("nan") if i % 41 == 5 else float("inf") if i == 99 else float(x[i]) if i % 3 else 2.0
        b = None if i % 23 == 4 else int(rng.integers(-3, 4)) if i % 5 else 2**60 + i
        out.append((None if i % 50 == 49 else "g" if i % 4 else "h", i, a, b))
    return spark.createDataFrame(out, "g string, t long, a double, b long").repartition(3)


def test_blocks_equal_windows(spark, monkeypatch):
    monkeypatch.setattr(window, "BLOCK_ROWS", 20)
    specs = {}
    for op in ROLLING_OPS:
        for n in (1, 2, 3, 5):
            if op in ("ts_cov", "ts_corr"):
                specs[f"{op}_{n}"] = Rolling(op, "a", n, "b")
            else:
                specs |= {f"{op}_a_{n}": Rolling(op, "a", n), f"{op}_b_{n}": Rolling(op, "b", n)}
    df = rows(spark)
    whole = rolling_features(df, ["g"], ["t"], specs, max_rows=10_000)
    monkeypatch.setattr(ordered.OrderedRows, "_blocks", lambda *a: pytest.fail("a window of Spark"))
    cut = rolling_features(df, ["g"], ["t"], specs, max_rows=40)
    assert cut.schema.simpleString() == whole.schema.simpleString()
    bits = lambda v: v.hex() if isinstance(v, float) else v
    got, want = ([[bits(v) for v in r] for r in d.orderBy("t").collect()] for d in (cut, whole))
    for c, *pairs in zip(whole.columns, *([*zip(g, w)] for g, w in zip(got, want, strict=True)), strict=True):
        assert not [p for p in pairs if p[0] != p[1]], c


def test_other_types_keep_their_windows(spark):
    df = spark.sql("SELECT id AS t, CAST(id * 1.25 AS DECIMAL(12,2)) AS x FROM range(100)")
    specs = {"m": Rolling("ts_max", "x", 3), "d": Rolling("diff", "x", 2)}
    cut, whole = (rolling_features(df, [], ["t"], specs, max_rows=n).orderBy("t").collect() for n in (20, 1000))
    assert cut == whole


def test_an_overflow_is_an_error_in_blocks_too(spark):
    df = spark.sql("SELECT id AS t, IF(id = 7, -9223372036854775807L, 9) AS x FROM range(30)")
    with pytest.raises(Exception, match="overflow"):
        rolling_features(df, [], ["t"], {"d": Rolling("diff", "x", 1)}, max_rows=10).collect()


def test_joins_do_not_copy_row_local_features(spark):
    df = rows(spark).withColumn("h", F.col("b") % 3)
    fitted = FeatureSet([Feature("log", ("a",)), Feature("aggmean", ("g", "a")), Feature("combine", ("g", "h")), Feature("pow", ("a",))]).fit(df)
    out = fitted._apply(df, fitted.levels[0], fitted.fitted[0])
    assert out.columns[-2:] == ["log__a", "pow__a"]
    assert out.columns[:5] == df.columns and set(out.columns[5:-2]) == {"aggmean__g__a", "combine__g__h"}


def test_only_distinct_values_are_put_in_order(spark, monkeypatch):
    """2,000 rows of three values and one of many: a sum of weights per value, ranks as before."""
    df = spark.range(2000).selectExpr("CAST(id % 3 AS DOUBLE) AS few", "CAST(id * 7 % 2000 AS DOUBLE) AS many", "CAST(id AS DOUBLE) AS y")
    sorted_ = []

    def argsort(x, *a, keep=np.argsort, **k):
        sorted_.append(len(x))
        return keep(x, *a, **k)

    packed = []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema, keep=type(df).mapInArrow: packed.append(f) or keep(self, f, schema))
    got = {r["i"]: r for r in ranks.rank_sums(df, "y", ["few", "many"]).collect()}
    assert {i: (r["n"], r["total"]) for i, r in got.items()} == {0: (2000, 1999000.0), 1: (2000, 1999000.0)}
    batch = pa.Table.from_pandas(df.selectExpr("y AS a", "few AS c0", "many AS c1").toPandas()).to_batches()
    monkeypatch.setattr(np, "argsort", argsort)
    assert len(list(packed[-1](iter(batch)))) == 1
    assert sorted(sorted_) == [3, 2000, 2000]  # few, many and the target
