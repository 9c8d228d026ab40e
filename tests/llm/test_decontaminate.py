"""Decontamination against exact alignment of every item with every text."""

import random
import re

import numpy as np
import pytest

from vanecast.llm.decontaminate import SHARE, Item, _item_words, align, contaminated, decontaminate, estimated_recall, repeats_for


def distance(item, text):
    row = [0] * (len(text) + 1)
    for x in item:
        new = [row[0] + 1]
        for j, y in enumerate(text):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


@pytest.fixture(scope="module")
def case():
    rng = random.Random(9)
    vocabulary = ["the", "of", "and"] + ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    line = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(line(rng.randint(12, 50)))) for k in range(25)] + [(25, "tiny item"), (26, ""), (27, None), (28, "Solo")]
    docs = []
    for k in range(120):
        w = line(rng.randint(0, 150))
        if k % 2 == 0:
            passage = items[rng.randrange(25)][1].split()
            for _ in range(rng.randint(0, int(len(passage) * SHARE) + 2)):
                at, kind = rng.randrange(len(passage)), rng.randrange(3)
                passage[at : at + (kind != 1)] = [rng.choice(vocabulary)] if kind else []
            at = rng.randint(0, len(w))
            w[at:at] = [x.upper() + "," if x.isascii() else x for x in passage]
        docs.append((k, " ".join(w)))
    docs += [(200, None), (201, ""), (None, items[3][1]), (0, docs[0][1]), (202, "filler " * 20_000 + items[4][1] + " end"), (203, "A tiny, item!")]
    return items, docs


def test_pairs(spark, case):
    items, docs = case
    frame = spark.createDataFrame([(*d, 1, "q") for d in docs], "doc_id long, text string, item long, item_id string").repartition(4)
    bench = spark.createDataFrame([(*i, 5) for i in items], "item_id long, text string, doc_id int")
    got = contaminated(frame, bench).collect()
    found = {}
    for r in got:
        found.setdefault((r.doc_id, r.item_id), []).append(r)
    want = {}
    for i, t in docs:
        w = words(t)
        for k, x in items:
            item = words(x)
            if item and w and (len(w) < 500 or k == 4):
                d = distance(item, w)
                if d <= int(len(item) * SHARE):
                    want[i, k] = d
    assert not set(found) - set(want)
    assert len(set(found)) >= 0.95 * len(want)
    assert {p for p, d in want.items() if d == 0} <= set(found)
    assert all(r.distance == want[p] for p, rs in found.items() for r in rs)
    texts = {i: words(t) for i, t in docs}
    for r in got:  # the place given has that distance
        part = texts[r.doc_id][r.first_word : r.last_word + 1]
        assert distance(words(dict(items)[r.item_id]), part) == r.distance
    assert len(found[0, next(k for i, k in found if i == 0)]) == 2  # repeated rows
    clean = decontaminate(frame, bench)
    held = {i for i, _ in found if i is not None}
    assert clean.columns == frame.columns
    assert sorted(r.doc_id or -1 for r in clean.collect()) == sorted(i or -1 for i, _ in docs if i not in held)
    for some, other in ((frame.limit(0), bench), (frame, bench.limit(0))):
        assert contaminated(some, other).collect() == []


def test_chunks_change_nothing(spark, case, monkeypatch):
    import vanecast.llm.decontaminate as module

    items, docs = case
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = {(r.doc_id, r.item_id) for r in contaminated(frame, bench).collect() if r.distance == 0}
    monkeypatch.setattr(module, "CHUNK_KEYS", 3000)
    parts = {(r.doc_id, r.item_id) for r in contaminated(frame, bench).collect() if r.distance == 0}
    assert parts == whole


def test_align_and_recall(case):
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = (rng.integers(0, 4, rng.integers(1, 8)).astype(np.uint64) for _ in range(2))
        assert align(a, b)[0] == distance(a.tolist(), b.tolist())
    items, _ = case
    own = [Item(k, w) for (k, _), w in zip(items, _item_words([t for _, t in items]), strict=True) if len(w) > 10]
    recalls = estimated_recall(own, 6)
    assert recalls == sorted(recalls) and recalls[-1] >= 0.97 and 1 <= repeats_for(own, 0.9) <= 6
