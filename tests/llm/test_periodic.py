"""Periodic runs against the definition, on drawn strings, awkward rows and the given table."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vanecast.llm import periodic
from vanecast.llm.periodic import find_runs, periodic_runs, smaller_before, sort_suffixes
from vanecast.llm.queries import QUERIES, table


def brute_runs(w, least):
    """Every period on its own: stretches of words equal to the one a period later; the smallest period of a stretch."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_row(words, least=12):
    runs = brute_runs(words, least)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return runs, " ".join(x for k, x in enumerate(words) if k not in gone)


def test_suffix_array():
    rng = np.random.default_rng(3)
    for size, letters in [(1, 1), (2, 1), (50, 1), (200, 2), (300, 40)]:
        codes = rng.integers(0, letters, size)
        s = sort_suffixes(codes)
        want = sorted(range(size), key=lambda i: codes[i:].tolist())
        assert s.sa.tolist() == want
        for k in range(1, size):
            a, b = codes[want[k - 1] :].tolist(), codes[want[k] :].tolist()
            assert s.lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def test_smaller_before(monkeypatch):
    rng = np.random.default_rng(4)
    for work in (16, 0):  # pointer jumping, plain stack
        monkeypatch.setattr(periodic, "WORK", work)
        for _ in range(50):
            v = rng.integers(1, 6, 40)
            want = [max((j for j in range(k) if v[j] < v[k]), default=-1) for k in range(40)]
            assert smaller_before(v).tolist() == want


@pytest.mark.parametrize("chunk", [1 << 21, 7])
def test_runs_of_drawn_strings(chunk, monkeypatch):
    monkeypatch.setattr(periodic, "CHUNK", chunk)
    draw = random.Random(5)
    for _ in range(600):
        n, letters, least = draw.randrange(70), draw.choice([1, 2, 3, 6]), draw.choice([2, 5, 12])
        w = [draw.randrange(letters) for _ in range(n)]
        if n > 4 and draw.random() < 0.6:
            a, p = draw.randrange(n), draw.randrange(1, n // 2 + 1)
            w = [w[i if i < a else min(n - 1, a + (i - a) % p)] for i in range(n)]
        got = find_runs(np.array(w, np.int64), least)
        assert sorted(zip(*(x.tolist() for x in got), strict=True)) == brute_runs(w, least)


def test_long_repetitions_are_quick():
    start = time.time()
    for codes in (np.zeros(200_000, np.int64), np.arange(200_000) % 2, np.arange(200_000) % 66_000):
        s, n, q = find_runs(codes.astype(np.int64), 12)
        assert (s.tolist(), n.tolist()) == ([0], [200_000]) and q[0] in (1, 2, 66_000)
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 100_000:
        fib.append(fib[-1] + fib[-2])
    assert len(find_runs(np.array(fib[-1]), 2)[0]) == 2 * len(fib[-3]) - 3  # the known number of runs of a Fibonacci word
    assert time.time() - start < 60


AWKWARD = [
    "", None, " \t\n ", "a", "a a a a a a a a a a a a", "a " * 11, "x " + "a b " * 6 + "c", "a b c d e f " * 2, "a b c d e " * 2,
    "ha  ha\nha\tha ha ha ha ha ha ha ha ha-", "é ü " * 9 + "é", "A a " * 7, "a b a b a b a b a b a b a a b a b a b a b a b a b",
    "w " * 60_000, " ".join(f"w{i}" for i in range(5_000)) * 3,
]


def test_awkward_rows(spark):
    data = [(i, t, "r", "c") for i, t in enumerate(AWKWARD)] + [(None, AWKWARD[6], "x", None), (6, AWKWARD[6], "", "")]
    docs = spark.createDataFrame(data, "doc_id long, text string, runs string, collapsed string").repartition(3)
    rows = periodic_runs(docs).collect()
    assert len(rows) == len(data) and periodic_runs(docs.limit(0)).collect() == []
    got = {r.doc_id: r for r in rows}
    assert got[None].runs == got[6].runs and got[None].n_words == 14
    for i, text in enumerate(AWKWARD):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        assert got[i].n_words == len(words)
        if len(words) < 1_000:
            runs, collapsed = brute_row(words)
            assert ([tuple(r) for r in got[i].runs], got[i].collapsed) == (runs, collapsed)
    assert [tuple(r) for r in got[13].runs] == [(0, 60_000, 1)] and got[13].collapsed == "w"


def test_equal_texts_do_not_meet(spark):
    """Texts are sorted together but a text's runs are its own, however many copies stand beside it."""
    docs = spark.createDataFrame([(i, "a b c d e f") for i in range(300)], "doc_id long, text string").coalesce(1)
    assert periodic_runs(docs).filter(F.size("runs") > 0).count() == 0


def test_query(spark, sf_dir):
    """Query 11 against the contract, word by word."""
    rows = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, sf_dir).collect()}
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    with_runs = 0
    for d in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        h, n = zlib.crc32(str(d.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a, g = (h // 10) % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 1_500:  # the brute form takes the square of the words
            continue
        runs, collapsed = brute_row(words)
        r = rows[d.doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        with_runs += bool(runs)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        ordered = sorted(runs, key=lambda x: (x[0], x[2]))
        assert r.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in ordered))
        assert r.collapsed_sha256 == sha(collapsed)
    assert with_runs > 5
