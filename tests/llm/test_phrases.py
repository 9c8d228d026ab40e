"""Phrase collocations against counting every phrase in a dictionary."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from vanecast.llm.phrases import collocations, count_rows, from_planes, to_planes


def brute(rows, longest=3, least=10, top=2000, cover=50):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang, text = lang if lang is not None else "und", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, a in found.items():
            for m in range(2, len(p)):
                covered |= {p[i : i + m] for i in range(len(p) - m + 1) if 100 * a >= cover * counts[p[i : i + m]]}
        scored = []
        for p, a in found.items():
            if p not in covered:
                cuts = [(10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def drawn(seed, docs=120):
    draw = random.Random(seed)
    vocabulary = ["the", "The", "of", "é", "Ü", "na me", "-", "x1", "\U0001f600", "ss"] + [f"w{i}" for i in range(40)]
    rows = []
    for _ in range(docs):
        words = draw.choices(vocabulary, weights=[30, 5, 20, 10, 5, 5, 5, 5, 5, 5] + [1] * 40, k=draw.randrange(80))
        text = "".join(w + draw.choices([" ", "  ", "\t", ". ", "\n", ",", "\x0b", ";"], weights=[20, 2, 2, 1, 1, 1, 1, 1])[0] for w in words)
        rows.append((draw.choice(["en", "en", "en", "de", None, "und"]), text + draw.choice(["", "new york city. " * 3, "new york"])))
    return rows


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def result(spark, rows, **options):
    data = [(i % 7, lang, text, "x", 1) for i, (lang, text) in enumerate(rows)]
    docs = spark.createDataFrame(data, "doc_id long, lang string, text string, words string, f int").repartition(3)
    return sorted(tuple(r[c] for c in COLUMNS) for r in collocations(docs, **options).collect())


@pytest.mark.parametrize("options", [{}, {"budget": 60}, {"budget": 1}, {"top": 5, "least": 3}, {"longest": 4, "least": 2, "cover": 80}])
def test_against_counting(spark, options):
    """Also with words too frequent for a group (one at a budget of 60, all at 1) and deeper subtrees."""
    rows = drawn(1) + [(None, None), ("fr", ""), ("fr", " .\n"), ("es", "solo")]
    want = brute(rows, **{k: v for k, v in options.items() if k != "budget"})
    assert len(want) > 10 and result(spark, rows, **options) == want


def test_ties_repeats_and_long_texts(spark):
    rows = [("en", "b a. a b. é a. z a. " * 10)] * 2 + [("de", "ja " * 150_000 + "ja nein")]
    got = result(spark, rows)
    assert got == brute(rows)
    assert [r[2] for r in sorted(got) if r[0] == "en"] == ["z a", "é a", "a b", "b a"]


def test_empty(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations(docs).collect() == []
    assert collocations(spark.createDataFrame([("en", None), (None, "one two")], "lang string, text string")).collect() == []


def test_counted_rows():
    rng = np.random.default_rng(0)
    for top in (5, 1 << 40):  # numbers that fit one key, and too many for it
        n = 4_000 if top > 5 else 500
        rows = rng.integers(0, top, (3, n))
        if top > 5:
            rows = np.tile(np.arange(n) << 20, (3, 1))
            rows = np.concatenate([rows] + [rows + (k << 45) for k in range(1, 400)], axis=1)
        counts = rng.integers(1, 9, rows.shape[1])
        got, totals = count_rows(rows, counts)
        assert totals.sum() == counts.sum() and got.shape[1] == len(np.unique(rows, axis=1).T if top == 5 else set(rows[0].tolist()))
        order = np.lexsort(got[::-1])
        assert (order == np.arange(len(order))).all()
    for values in ([], [0], [1, 255, 256, 1 << 40]):
        assert from_planes(to_planes(np.array(values, np.int64))).tolist() == values
