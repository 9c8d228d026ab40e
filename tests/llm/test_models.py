"""Toxicity and quality: exact inference, held-out accuracy, awkward rows."""

import itertools
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vanecast.llm import quality as Q
from vanecast.llm import toxicity as T
from vanecast.llm.queries import QUERIES

AWKWARD = [(1, None), (2, ""), (3, " \n\n"), (4, "idiot"), (4, "idiot"), (None, "some words"), (6, "é " * 100_000), (7, "x" * 200_000)]


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5):
        gain, move = np.exp(rng.normal(size=n)), np.exp(rng.normal(size=(2, 2)))
        chains = T.Chains(np.array([0]), np.array([n]))
        total, ones = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=n):
            w = np.prod([gain[t] if y[t] else 1.0 for t in range(n)]) * np.prod([move[y[t - 1], y[t]] for t in range(1, n)])
            total, ones = total + w, ones + w * np.array(y)
        np.testing.assert_allclose(T.forward_backward(gain, chains, move)[2], ones / total)


def test_chain_learns():
    rng = np.random.default_rng(1)
    y = (rng.random(4000) < 0.1).astype(float)
    x = np.zeros((3, 4000))
    x[0] = y * 6 + rng.normal(0, 0.5, 4000)
    chains = T.Chains(np.arange(0, 4000, 40), np.full(100, 40))
    theta = T.fit_chain(x, y, chains)
    p = T.forward_backward(*T._weights(theta, x)[:1], chains, T._weights(theta, x)[1])[2]
    assert ((p > 0.5) == (y > 0.5)).mean() > 0.99


def test_long_lines_are_several_chains():
    from vanecast.llm.kernels import find_words, text_bytes

    raw, offsets = text_bytes(pa.array(["w " * 1000 + "\n a b", "", "c"]))
    words = find_words(raw, offsets)
    chains = T.lines_of(raw, offsets, words)
    assert chains.length.sum() == 1003 and chains.length.max() == T.CHAIN
    assert sorted(chains.start.tolist()) == [0, 256, 512, 768, 1000, 1002]


@pytest.mark.parametrize(("name", "label", "least"), [("op5_toxicity", "toxic", 0.5), ("op9_quality_classifier", "quality", 0.7)])
def test_held_out_accuracy(spark, name, label, least):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = QUERIES[name](spark, folder).cache()
    documents = spark.read.parquet(f"{folder}/documents.parquet").count()
    assert out.count() == documents and out.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert out.filter((F.col("score") >= least).cast("int") != F.col("predicted")).count() == 0
    held = out.filter("held_out").join(labels, "doc_id").groupBy(label, "predicted").count().collect()
    n = {(r[label], r["predicted"]): r["count"] for r in held}
    hits, false, missed = n.get((1, 1), 0), n.get((0, 1), 0), n.get((1, 0), 0)
    assert hits / (hits + missed) > 0.85 and hits / (hits + false) > 0.95
    out.unpersist()


def test_toxicity_rows(spark):
    words = "the cat sat on a mat and it was good to be there with them all day long".split()
    rng = np.random.default_rng(2)
    data = []
    for i in range(400):
        w = [str(x) for x in rng.choice(words, 30)]
        if i % 4 == 0:
            for k in rng.choice(30, 3, replace=False):
                w[k] = str(rng.choice(["idiot", "moron"]))
        data.append((i, " ".join(w), int(i % 4 == 0), "x"))
    labelled = spark.createDataFrame(data, "doc_id long, text string, toxic int, score string")
    model = T.fit_toxicity(labelled)
    assert len(model.words) == 2
    got = {r.doc_id: r for r in T.score_toxicity(labelled, model).collect()}
    assert all((got[i].score >= 0.5) == (y == 1) for i, _, y, _ in data)
    text = data[0][1]
    assert {text[s.start : s.end] for s in got[0].spans} and all(x in ("idiot", "moron") for s in got[0].spans for x in text[s.start : s.end].split())
    awkward = spark.createDataFrame([(*r, "z") for r in AWKWARD], "doc_id long, text string, id string")
    rows = T.score_toxicity(awkward, model).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    scores = {r.doc_id: r.score for r in rows}
    assert scores[4] >= 0.5 and scores[1] == scores[2] == scores[3] < 0.5
    assert T.score_toxicity(awkward.limit(0), model).collect() == []
    for some in (labelled.limit(0), labelled.filter("toxic = 1"), labelled.withColumn("toxic", F.lit(None).cast("int"))):
        model = T.fit_toxicity(some)
        assert all(0 <= r.score <= 1 for r in T.score_toxicity(awkward, model).collect())


def test_network_beats_the_mean_and_temperature_calibrates():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 6))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)  # no single layer can tell
    net = Q.train_network(x[:1500], y[:1500])
    p = net.score(x[1500:])
    assert ((p > 0.5) == (y[1500:] > 0.5)).mean() > 0.9
    logits = rng.normal(0, 3, 5000)
    truth = (rng.random(5000) < 1 / (1 + np.exp(-logits / 2))).astype(float)
    assert 1.8 < Q.fit_temperature(logits, truth) < 2.2
    again = Q.train_network(x[:1500], y[:1500])
    assert (again.w1 == net.w1).all() and again.temperature == net.temperature


def test_word_table_is_a_sum_over_all_texts(spark):
    docs = spark.createDataFrame([("a b a",), ("b!! c",), (None,), ("",)], "text string").repartition(3)
    table = Q.word_table(docs)
    from vanecast.llm.kernels import find_tokens, text_bytes

    place, sign = Q.index_vectors()
    want = np.zeros((Q.ROWS, Q.WIDTH))
    for text in ("a b a", "b!! c"):
        raw, offsets = text_bytes(pa.array([text]))
        rows = Q._rows(find_tokens(raw, offsets, Q.KINDS).hash)
        for i, r in enumerate(rows):
            for j in range(max(0, i - Q.REACH), min(len(rows), i + Q.REACH + 1)):
                if j != i:
                    np.add.at(want[r], place[rows[j]], sign[rows[j]])
    norm = np.linalg.norm(want, axis=1, keepdims=True)
    np.testing.assert_allclose(table, np.divide(want, norm, out=np.zeros_like(want), where=norm > 0), atol=1e-6)


def test_quality_rows(spark):
    good = [(i, " ".join(["plain", "words", "that", "say", "something"] * 5), 1, "x") for i in range(60)]
    bad = [(100 + i, " ".join(["bad***", "junk***"] * 8), 0, "x") for i in range(30)]
    labelled = spark.createDataFrame(good + bad, "doc_id long, text string, quality int, score string")
    awkward = spark.createDataFrame([(*r, "z") for r in AWKWARD], "doc_id long, text string, id string")
    model = Q.fit_quality(labelled, labelled)
    got = {r.doc_id: r.score for r in Q.score_quality(labelled, model).collect()}
    assert all((got[i] >= 0.7) == (y == 1) for i, _, y, _ in good + bad)
    rows = Q.score_quality(awkward, model).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    kept = Q.keep_quality(labelled, model)
    assert kept.columns == labelled.columns and kept.count() == 60
    assert Q.score_quality(awkward.limit(0), model).collect() == []
    empty = Q.fit_quality(awkward.limit(0), labelled.limit(0))
    assert {r.score for r in Q.score_quality(awkward, empty).collect()} == {0.5}


def test_pooling_holds_vectors_of_a_small_part_of_the_texts():
    text = " ".join(f"word{i % 977}" for i in range(1000))
    batch = pa.RecordBatch.from_arrays([pa.array([text] * 400)], names=["text"])  # 3 MB, 400,000 tokens
    table = np.random.default_rng(0).normal(size=(Q.ROWS, Q.WIDTH)).astype(np.float32)
    ((_, one),) = Q._pool_stream(iter([batch.slice(0, 1)]), table, 0)
    tracemalloc.start()
    ((_, x),) = Q._pool_stream(iter([batch]), table, 0)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert (x == one).all()
    assert peak < 40e6  # the vectors of all tokens take 51 MB
