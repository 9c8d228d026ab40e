"""The pipeline and the registered queries of this subpackage."""

import re

import pytest

import corpus_pipeline
from check import connect, rows_of
from vanecast.llm.queries import ORACLES, QUERIES
from vanecast.session import materialize


def test_names():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = connect(sf_dir).execute(ORACLES[name])
    assert got == rows_of([c[0] for c in cur.description], cur.fetchall())


def test_stages(spark, sf_dir):
    """What every stage takes away and leaves, against its operator's SQL or a plain search."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name)
        seen[name] = (before, docs)
        assert docs.count() > 0
        if name != "mixing":
            assert docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near", "benchmark", "mixing"]

    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").collect()}
    before, after = ({r.doc_id for r in x.select("doc_id").collect()} for x in seen["quality"])
    assert after <= before and len(good & after) >= 0.97 * len(good)

    for name, sql in (("lines", line_sql()), ("near", near_sql())):
        before, after = seen[name]
        con = connect(sf_dir)
        con.register("docs", before.toPandas())
        want = con.execute(sql).fetchall()
        assert sorted((r.doc_id, r.text) for r in after.collect()) == sorted(want)

    before, after = seen["benchmark"]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    plain = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    held = {r.doc_id for r in before.collect() if any(plain(i) in plain(r.text) for i in items)}
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == held

    before, after = seen["mixing"]
    assert {r.doc_id for r in after.collect()} < {r.doc_id for r in before.collect()}
    assert all(0 < r.p <= 1 for r in after.collect())


def line_sql():
    from vanecast.llm.queries import line_dedup_sql

    return line_dedup_sql("docs", "doc_id, left_over") + " WHERE n_removed = 0 OR n_removed < n_lines"


def near_sql():
    from vanecast.llm.queries import near_duplicates_sql

    return near_duplicates_sql("docs", "doc_id, text") + " WHERE component_id = doc_id"


EXTRA = "doc_id long, text string, lang string, source string, n_chars long, n_lines int not null, n_removed string, id array<int> not null, block long, rest struct<a: int>"


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_with_awkward_rows(spark, sf_dir, name):
    """Nulls, repeated rows, columns that may not be null or have the operators' names, too few labels, no rows."""
    from pyspark.sql import types as T

    stage = dict(corpus_pipeline.STAGES)[name]
    texts = [None, "", "one line here\none line here\nnew", "a long enough line of some ten words to be kept here", "ünï\n\n"]
    row = lambda i, t: (i, t, "en", "s", len(t) if t else None, 3, "x", [1], None, (1,))
    rows = [row(100_000_000 + i, t) for i, t in enumerate(texts)] + [row(None, "nobody's copy"), row(None, None)] + [row(100_000_003, texts[3])] * 2
    docs = spark.createDataFrame(rows, T.StructType.fromDDL(EXTRA))
    out = materialize(stage(spark, docs, sf_dir), name)
    if name != "mixing":
        assert out.columns == docs.columns
    kept = out.collect()
    assert {tuple(r.id) for r in kept} <= {(1,)} and {(r.n_lines, r.n_removed) for r in kept} <= {(3, "x")}
    count = {"quality": len(rows), "lines": len(rows), "near": len(rows), "benchmark": len(rows)}
    if name == "near":  # equal texts of one id are one document
        assert len(kept) >= len(rows) - 2
    elif name in count:
        assert len(kept) == count[name]
    if name == "lines":
        assert [(r.text, r.n_chars) for r in kept if r.doc_id == 100_000_002] == [("one line here\nnew", 17)]
    assert stage(spark, docs.limit(0), sf_dir).collect() == []
