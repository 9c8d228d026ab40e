"""Line, substring and near-duplicate operators against brute force, with awkward rows."""

import random
import re
import tracemalloc

import pyarrow as pa
import pytest

from vanecast.llm.jaccard import near_duplicates, shingle_sets
from vanecast.llm.lines import line_dedup, within_one
from vanecast.llm.substring import substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = (1 << 63) - 1


@pytest.fixture(scope="module")
def rows():
    """Ids and texts: copies, near copies of three degrees, shared passages, short, empty, missing, long."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    passage = " ".join(word() for _ in range(60))
    base = [word() for _ in range(120)]
    out = []
    for k in range(40):
        text = "\n".join(" ".join(word() for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(1, 6)))
        out.append((k, text))
    for k in range(40, 90):  # a large group of near copies
        copy = list(base)
        for _ in range(rng.choice((0, 1, 2, 3, 6, 12))):
            copy[rng.randrange(len(copy))] = word() + "x"
        lines = [" ".join(copy[i : i + 20]) for i in range(0, 120, 20)]
        out.append((k, "\n".join(lines)))
    out += [(k, out[0][1]) for k in range(90, 100)]  # exact copies
    out += [(k, " ".join(word() for _ in range(15)) + " " + passage + "\n" + word()) for k in range(100, 110)]
    out += [(110, None), (111, ""), (112, " \n\t\n"), (113, "one"), (114, "one"), (115, "One two"), (116, "one two")]
    out += [(117, "w " * 9000), (118, "w " * 9000 + "v"), (5, out[5][1]), (None, out[6][1]), (None, "alone here")]
    rng.shuffle(out)
    return out


def frame(spark, rows):
    """More columns than an operator needs, with names that operators use themselves."""
    data = [(i, t, "x", 1, "y") for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, block string, n_lines int, id string").repartition(5)


def key(i):
    return LAST if i is None else i


def test_substring(spark, rows):
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - 12):
            at = tuple(w[k : k + 13])
            first[at] = min(first.get(at, LAST), key(i))
    want = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < key(i):
                gone[k : k + 13] = [True] * 13
        want.append((key(i), len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    got = [(key(r.doc_id), r.n_words, r.n_removed, r.text) for r in substring_dedup(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(want)


def test_lines(spark, rows):
    first = {}
    for i, t in rows:
        for n, line in enumerate((t or "").split("\n")):
            w = tuple(line.encode().split())
            if w:
                first[w] = min(first.get(w, (LAST, LAST)), (key(i), n))
    order = sorted(first, key=first.get)
    near = set()
    for a, x in enumerate(order):
        for y in order[:a]:
            if first[y] < first[x] and max(len(x), len(y)) >= 8 and within_one(list(x), list(y)):
                near.add(x)
                break
    want = []
    for i, t in rows:
        total, kept, gone = 0, [], 0
        for n, line in enumerate((t or "").split("\n")):
            w = tuple(line.encode().split())
            total += bool(w)
            if w and (w in near or first[w] < (key(i), n)):
                gone += 1
            else:
                kept.append(line)
        want.append((key(i), total, gone, "\n".join(kept)))
    got = [(key(r.doc_id), r.n_lines, r.n_removed, r.text) for r in line_dedup(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(want)
    assert near


def test_within_one_is_an_edit_distance():
    rng = random.Random(1)
    for _ in range(3000):
        a = [rng.choice("ab").encode() for _ in range(rng.randint(0, 5))]
        b = [rng.choice("ab").encode() for _ in range(rng.randint(0, 5))]
        row = list(range(len(b) + 1))
        for x in a:
            new = [row[0] + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
            row = new
        assert within_one(a, b) == (row[-1] <= 1)


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_near_duplicates(spark, rows):
    sets = [(i, shingles(t)) for i, t in rows]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = find(i), find(j)
                up[max(p, q)] = min(p, q)
    want = [(i is None, i or 0, len(s), None if i is None else find(i)) for i, s in sets]
    for rare in (2, 16):  # most shingles frequent, most shingles rare
        got = [(r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in near_duplicates(frame(spark, rows), rare=rare).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("operator", [substring_dedup, line_dedup, near_duplicates])
def test_empty_table(spark, operator):
    assert operator(frame(spark, [])).collect() == []


def test_missing_and_repeated_ids_part(spark, monkeypatch):
    """A third of the rows has no id, a third one id and text: no block holds more than a few, and results are whole."""
    from vanecast.llm import blocks as B

    monkeypatch.setattr(B, "BLOCK_BYTES", 4096)
    word = [f"w{k}" for k in range(40)]
    line = lambda rng: " ".join(rng.choice(word) for _ in range(9))
    rng = random.Random(9)
    common = [line(rng) for _ in range(4)]
    text = lambda: "\n".join(rng.choice((line(rng), rng.choice(common), rng.choice(common).replace("w1", "x", 1))) for _ in range(5))
    same = text()
    data = [(k, text()) for k in range(200)] + [(None, text()) for _ in range(200)] + [(7777, same)] * 200
    docs = frame(spark, data)
    dealt, how = B.deal_rows(docs.selectExpr("doc_id id", "text"), "id", "text")
    sizes = [r["count"] for r in dealt.groupBy("block").count().collect()]
    assert sum(sizes) == 600 and max(sizes) < 600 / how.blocks * 4
    first = {}
    for i, t in data:
        for n, x in enumerate(t.split("\n")):
            w = tuple(x.encode().split())
            first[w] = min(first.get(w, (LAST, LAST)), (key(i), n))
    order = sorted(first, key=first.get)
    near = {x for k, x in enumerate(order) for y in order[:k] if first[y] < first[x] and len(x) >= 8 and within_one(list(x), list(y))}
    want = []
    for i, t in data:
        left = [x for n, x in enumerate(t.split("\n")) if first[tuple(x.encode().split())] == (key(i), n) and tuple(x.encode().split()) not in near]
        want.append((key(i), 5, 5 - len(left), "\n".join(left)))
    got = [(key(r.doc_id), r.n_lines, r.n_removed, r.text) for r in line_dedup(docs).collect()]
    assert sorted(got) == sorted(want)
    out = substring_dedup(docs).collect()
    again = {(r.doc_id, r.text) for r in out if r.doc_id == 7777}
    assert len(out) == 600 and len(again) == 1
    monkeypatch.undo()
    assert sorted(map(str, substring_dedup(docs).collect())) == sorted(map(str, out))


def test_a_large_group_is_not_compared_in_pairs(spark, monkeypatch):
    """Copies with 1 to 6 words changed: most of them are no near copies of each other, and few pairs reach the comparison of sets."""
    from vanecast.llm import jaccard as J

    rng = random.Random(3)
    base = [f"w{k}" for k in range(150)]
    data = []
    for k in range(300):
        copy = list(base)
        for at in rng.sample(range(150), rng.randint(1, 6)):
            copy[at] = rng.choice("abcdefgh")
        data.append((k, " ".join(copy)))
    sets = [shingles(t) for _, t in data]
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, x in enumerate(sets):
        for b in range(a):
            if 100 * len(x & sets[b]) >= 80 * len(x | sets[b]):
                p, q = find(a), find(b)
                up[max(p, q)] = min(p, q)
    compared, verified = [], J._verified

    def counted(pairs, candidates):
        compared.append(pairs.count())
        return verified(pairs, candidates)

    monkeypatch.setattr(J, "_verified", counted)
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, data)).collect()}
    assert got == {k: find(k) for k in range(len(sets))}
    assert len(set(got.values())) > 1 and sum(compared) < 3 * len(sets)


def test_parity_bits_keep_all_similar_pairs():
    import numpy as np
    import pyarrow as pa

    from vanecast.llm import jaccard as J

    rng = np.random.default_rng(2)
    sets = []
    for size in (5, 60, 70, 300):  # widths 64 to 1,024; of 60 and 70 they differ
        base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        for k in range(30):
            gone, new = int(rng.integers(0, size // 4 + 1)), int(rng.integers(0, size // 4 + 1))
            sets.append(np.unique(np.concatenate([base[gone:], rng.integers(0, 1 << 63, new, dtype=np.uint64)])))
    n, ids = [len(s) for s in sets], list(range(len(sets)))
    bits = pa.array([J.parity_bits(s, len(s)) for s in sets], pa.binary())
    side = pa.table({"entry": [7] * len(ids), "part": [0] * len(ids), "id": ids, "n": n, "alone": [0] * len(ids), "component": ids, "bits": bits})
    met = J._met(side, side)
    met = set(zip(met["id"].to_pylist(), met["hub"].to_pylist(), strict=True))
    overlap = {(a, b): len(np.intersect1d(sets[a], sets[b])) for a in ids for b in ids if a != b}
    similar = {(a, b) for (a, b), both in overlap.items() if 100 * both >= 80 * (n[a] + n[b] - both)}
    assert len(similar) > 100 and similar <= met
    assert not any(overlap[pair] == 0 for pair in met)


@pytest.mark.parametrize("words_long", [6, 300_000])
def test_texts_are_read_in_small_pieces(words_long):
    """The arrays of a block's words are those of a part of its texts; the hashes do not depend on the parts."""
    words = ["x" * (words_long - 4) + f"{i:04d}" for i in range(max(40, 6000 // words_long))]
    text = " ".join(words)
    column = pa.array([text] * max(2, 8_000_000 // len(text)))
    (one,) = shingle_sets(column.slice(0, 1))
    tracemalloc.start()
    same = all((s == one).all() for s in shingle_sets(column))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert same and len(one) == len(words) - 4
    if words_long == 6:
        assert peak < 30e6
