"""Near-duplicate groups: exact set-similarity join on word shingles, Jaccard >= 0.8.

Token-combination prefixes.  A document's distinct shingles are ordered by their corpus
count, rarest first.  If a document shares at most D of its shingles less than all with any
partner, one of its first D + 1 is shared; so rare shingles are indexed singly.  Frequent
ones would give long lists; they are indexed as combinations of two neighbours in the order,
and the prefix is extended until enough of them must survive: of f frequent shingles, each
one that is not shared breaks two neighbour pairs and each foreign one of the partner breaks
one, so f > 2 * unshared + foreign + 1 leaves a common pair.  For Jaccard >= t the sum of the
breaks is at most (2a - b) - 3 * overlap, which is bounded by the size a alone.

Counts come from the partition sketches of ``blocks.py``; any order works as long as all
documents use the same one, and the sketch never undercounts, so a shingle that it counts
once is shared with nobody and needs no index entry.  Equal sets are merged before; only
documents whose prefix holds a shared shingle go on.

Lists are not expanded into pairs, and of lists with the same documents one is kept.  In a first
round all documents of a list are compared with one hub of it, the one with the smallest share of
unshared shingles.  After that only documents outside the largest component of their list are
hubs, up to 64 of a list, then 16 times as many in every round: what is left once they have met
everyone is one component.  Documents that are already connected are not compared; a list ends
when it holds one component.

Hubs and lists meet as arrays inside tasks, each a bounded part of the lists.  A pair becomes a row
only if its sizes and parity bits allow a similarity of 0.8: a set's shingles toggle the bits of a
field of at least twice its size, so two fields differ in no more bits than the sets in shingles.
Only these pairs are compared by their sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanecast.llm.blocks import Deal, add_up, deal, look_up, read_flags, sketch_rows
from vanecast.llm.graph import compact, components
from vanecast.llm.kernels import LOWER, batches, find_words, mix, text_bytes, window_hash
from vanecast.session import materialize

WIDTH = 5
RARE = 16  # a shingle counted more often is frequent
PART_ROWS = 4096  # rows of a list that meet its hubs at once
TASK_ROWS = 20_000  # rows of lists in a group of parts
PAIR_WORDS = 1 << 20  # pairs of rows, and words of their parity fields, compared at a time
MORE_HUBS = 16  # times as many in each round
_U = np.uint64


def shingle_sets(column, width: int = WIDTH):
    """Per text its distinct shingle hashes in order; a shorter text is one shingle, an empty one none."""
    raw, offsets = text_bytes(column)
    none = np.zeros(0, np.uint64)
    for a, b in batches(offsets):
        words = find_words(LOWER[raw[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a])
        windows = window_hash(words.hash, width)
        for s, e in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            if e - s >= width:
                yield np.unique(windows[s : e - width + 1])
            else:
                yield window_hash(words.hash[s:e], e - s) if e > s else none


def _signed(width: int):
    """Size and 128-bit signature of every document's set."""

    def run(stream):
        for batch in stream:
            sizes, one, two = [], [], []
            for s in shingle_sets(batch.column(2), width):
                sizes.append(len(s))
                one.append(np.sum(mix(s), dtype=np.uint64))
                two.append(np.sum(mix(s ^ _U(0xA0761D6478BD642F)), dtype=np.uint64))
            sums = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (one, two)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(sizes, pa.int64()), *sums], names=["id", "block", "n", "s1", "s2"])

    return run


def _chosen(part: pa.Table, flags: pa.Table, width: int):
    """(id, set) of the block's documents that stand for their set and can have partners."""
    mark = flags.filter(pa.array(flags.column("kind").to_numpy() == 0)) if flags.num_rows else flags
    copies = set(zip(mark.column("id").to_pylist(), mark.column("s1").to_pylist(), strict=True)) if mark.num_rows else set()
    for i, s in zip(part.column("id").to_pylist(), shingle_sets(part.column("text"), width), strict=True):
        if len(s) >= 4 and (i, int(np.sum(mix(s), dtype=np.uint64).astype(np.int64))) not in copies:
            yield i, s


def _sketch(width: int, how: Deal):
    def give(part: pa.Table, flags: pa.Table) -> pa.Table:
        if not part.num_rows:
            return sketch_rows(0, np.zeros(0, np.uint64), how)
        sets = [how.cells(s) for _, s in _chosen(part, flags, width)]
        return sketch_rows(part.column("block")[0].as_py(), np.concatenate(sets) if sets else np.zeros(0, np.uint64), how)

    return give


def prefix_signatures(hashes: np.ndarray, counts: np.ndarray, rare: int = RARE) -> np.ndarray:
    """Index entries of a set for t = 0.8; a count below 2 says that nobody shares the shingle."""
    a = len(hashes)
    order = np.lexsort((hashes, np.maximum(counts, 1)))
    hashes, counts = hashes[order], counts[order]
    single = int(np.searchsorted(counts > rare, True))  # rare ones come first
    most = a // 5  # shingles that a partner may lack
    if single > most:
        some = slice(0, most + 1)
        return hashes[some][counts[some] > 1]
    frequent = hashes[single : single + 2 * a // 5 - 2 * single + 2]
    pairs = mix(frequent[:-1] * _U(0x9E3779B97F4A7C15) + mix(frequent[1:]))
    return np.concatenate([hashes[:single][counts[:single] > 1], pairs])


def parity_bits(hashes: np.ndarray, n: int) -> bytes:
    """Which places hold an odd number of the hashes; a power of two of at least ``2 * n`` places."""
    width = max(64, 1 << (2 * n - 1).bit_length())
    odd = np.bincount((hashes & _U(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _candidates(width: int, how: Deal, rare: int):
    def give(part: pa.Table, flags: pa.Table) -> pa.Table:
        rows = []
        if part.num_rows and flags.num_rows:
            cells = read_flags(flags.filter(pa.array(flags.column("kind").to_numpy() == 1)), how)
            for i, s in _chosen(part, flags, width):
                counts = look_up(how.cells(s), *cells)
                entries = prefix_signatures(s, counts, rare)
                if len(entries):
                    shared = s[counts > 1]
                    rows.append((i, len(s), len(s) - len(shared), entries.view(np.int64), shared.tobytes(), parity_bits(shared, len(s))))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        return pa.table(dict(zip(("id", "n", "alone", "entries", "shared", "bits"), columns, strict=True)), _CANDIDATES)

    return give


_CANDIDATES = pa.schema(
    [("id", pa.int64()), ("n", pa.int64()), ("alone", pa.int64()), ("entries", pa.list_(pa.int64())), ("shared", pa.binary()), ("bits", pa.binary())]
)
_FLAGS = ("block long", "kind int", "slice long", "cells binary", "counts binary", "id long", "s1 long")


def _flags(df: DataFrame, kind: int, names: tuple[str, ...]) -> DataFrame:
    out = []
    for spec in _FLAGS:
        name, dtype = spec.split()
        out.append((F.lit(kind) if name == "kind" else F.col(name) if name in names else F.lit(None)).cast(dtype).alias(name))
    return df.select(*out)


class _Fields:
    """Parity fields of some rows; a field folds to half its width by adding its halves."""

    def __init__(self, column: pa.ChunkedArray):
        fields = [np.frombuffer(x.as_buffer(), "<u8") for x in column]
        self.words = np.array([len(x) for x in fields], np.int64)
        self.place = np.zeros(len(fields), np.int64)
        self.own = {}
        for w in np.unique(self.words).tolist():
            at = np.flatnonzero(self.words == w)
            self.place[at] = np.arange(len(at))
            self.own[w] = np.stack([fields[i] for i in at])

    def take(self, rows: np.ndarray, width: int) -> np.ndarray:
        """The fields of ``rows``, all of them ``width`` or twice as many words wide, as ``width`` words."""
        out = np.empty((len(rows), width), np.uint64)
        wide = self.words[rows] > width
        if not wide.all():
            out[~wide] = self.own[width][self.place[rows[~wide]]]
        if wide.any():
            both = self.own[2 * width][self.place[rows[wide]]]
            out[wide] = both[:, :width] ^ both[:, width:]
        return out


def _near(a: np.ndarray, b: np.ndarray, one: dict, two: dict) -> np.ndarray:
    """Which pairs (rows ``a`` of ``one``, ``b`` of ``two``) can reach 0.8."""
    total = one["n"][a] + two["n"][b]
    known = one["n"][a] - one["alone"][a], two["n"][b] - two["alone"][b]
    ok = np.flatnonzero((one["component"][a] != two["component"][b]) & (9 * np.minimum(*known) >= 4 * total))
    # sizes differ by a quarter at most, so widths by a factor of two at most
    widths = np.minimum(one["bits"].words[a[ok]], two["bits"].words[b[ok]])
    keep = [np.zeros(0, np.int64)]
    for w in np.unique(widths).tolist():
        same = ok[widths == w]
        for at in range(0, len(same), max(1, PAIR_WORDS // w)):
            some = same[at : at + max(1, PAIR_WORDS // w)]
            odd = np.bitwise_count(one["bits"].take(a[some], w) ^ two["bits"].take(b[some], w)).sum(axis=1, dtype=np.int64)
            keep.append(some[9 * (known[0][some] + known[1][some] - odd) >= 8 * total[some]])
    return np.concatenate(keep)


def _met(lists: pa.Table, hubs: pa.Table) -> pa.Table:
    """Distinct pairs (``id``, ``hub``) of some parts of lists that can be similar."""
    sides = []
    for table in (lists, hubs):
        table = table.sort_by([("entry", "ascending"), ("part", "ascending")])
        side = {c: table.column(c).to_numpy() for c in ("entry", "part", "id", "n", "alone", "component")}
        sides.append(side | {"bits": _Fields(table.column("bits"))})
    one, two = sides
    # a part is known by its rank among all parts, the same on both sides
    keys = [np.rec.fromarrays([x["entry"], x["part"]], names="entry,part") for x in sides]
    _, code = np.unique(np.concatenate(keys), return_inverse=True)
    own, other = code[: len(keys[0])], code[len(keys[0]) :]
    first, last = np.searchsorted(other, own, "left"), np.searchsorted(other, own, "right")
    ends = np.cumsum(last - first)
    found = [np.zeros((0, 2), np.int64)]
    at = 0
    while at < len(own):
        begin = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, begin + PAIR_WORDS, "right")))
        counts = (last - first)[at:stop]
        a = np.repeat(np.arange(at, stop), counts)
        b = np.arange(counts.sum()) - np.repeat(ends[at:stop] - counts - begin, counts) + first[a]
        keep = _near(a, b, one, two)
        found.append(np.unique(np.stack([one["id"][a[keep]], two["id"][b[keep]]], axis=1), axis=0))
        at = stop
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.table({"id": pairs[:, 0], "hub": pairs[:, 1]}, pa.schema([("id", pa.int64()), ("hub", pa.int64())]))


def _overlaps(stream):
    for batch in stream:
        both = []
        for x, y in zip(batch.column(4), batch.column(5), strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            small, large = (x, y) if len(x) < len(y) else (y, x)
            at = np.searchsorted(large, small)
            both.append(int((large[np.minimum(at, len(large) - 1)] == small).sum()) if len(large) else 0)
        n, m = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
        both = np.array(both, np.int64)
        keep = pa.array(100 * both >= 80 * (n + m - both), pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (``id``, ``hub``) that are similar; large sides are split by adaptive execution."""
    own = sets.select("id", "n", F.col("shared").alias("x"))
    other = sets.select(F.col("id").alias("hub"), F.col("n").alias("m"), F.col("shared").alias("y"))
    joined = pairs.join(own, "id").join(other, "hub")
    return joined.select("id", "hub", "n", "m", "x", "y").mapInArrow(_overlaps, "a long, b long")


def _distinct_lists(lists: DataFrame) -> DataFrame:
    """(``entry``, ``least``, ``parts``): one entry of all those with the same documents, without lists of one row."""
    hashes = F.xxhash64("id", "set"), F.xxhash64("set", "id", F.lit(1))
    halves = [x for h in hashes for x in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]  # sums of halves cannot overflow
    sums = [F.sum(x).alias(f"sum{k}") for k, x in enumerate(halves)]
    known = lists.groupBy("entry").agg(F.count("*").alias("size"), F.min("n").alias("least"), *sums).filter("size > 1")
    kept = known.groupBy("size", "sum0", "sum1", "sum2", "sum3").agg(F.min("entry").alias("entry"), F.min("least").alias("least"))
    return kept.select("entry", "least", F.ceil(F.col("size") / PART_ROWS).alias("parts"))


def link_components(candidates: DataFrame) -> DataFrame:
    """(``id``, ``component``) of all candidates that are similar to another one."""
    spark = candidates.sparkSession
    known = candidates.withColumn("set", F.xxhash64("shared"))  # tells apart rows of the same id
    lists = known.select(F.explode("entries").alias("entry"), "id", "set", "n", "alone")
    # aggregates are written out before they are joined, so that a join can split a long list
    shared = materialize(_distinct_lists(lists), "entries")
    # a document stays in a list only if some document of the list is small enough for it
    lists = lists.join(shared, "entry").filter("4 * least <= 5 * n - 9 * alone").drop("least").distinct()
    lists = lists.join(known.select("id", "set", "bits").dropDuplicates(["id", "set"]), ["id", "set"])
    columns = ["entry", "parts", "id", "set", "n", "alone", "bits", "component", "minor"]
    lists = materialize(lists.withColumns({"component": F.col("id"), "minor": F.lit(True)}).select(*columns), "lists")
    labels = spark.createDataFrame([], "id long, component long")
    buckets = 1
    rows = lists.count()
    left_rows = rows
    while rows:
        rank = F.struct((F.col("alone") / F.col("n")).alias("share"), "id", "set", "n", "alone", "component", "parts", "bits")
        bucket = F.pmod(F.xxhash64("id"), F.lit(buckets)).alias("bucket")
        hubs = lists.filter("minor").groupBy("entry", bucket).agg(F.min(rank).alias("hub"))
        hubs = materialize(compact(hubs.select("entry", "hub.*"), rows), "hubs")
        # hubs go to every part of their list
        group = F.pmod(F.xxhash64("entry", "part"), F.lit(max(8, left_rows // TASK_ROWS))).alias("group")
        wanted = ["entry", "part", "id", "n", "alone", "component", "bits", group]
        parted = lists.withColumn("part", F.pmod(F.xxhash64(F.lit(1), "id"), "parts")).select(*wanted)
        spread = hubs.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select(*wanted)
        pairs = parted.groupBy("group").cogroup(spread.groupBy("group")).applyInArrow(_met, "id long, hub long").distinct()
        found = materialize(_verified(materialize(pairs, "pairs"), candidates), "found")
        if not found.isEmpty():
            # known groups are stars; only new links join them
            labels = components(found.unionByName(labels.select(F.col("id").alias("a"), F.col("component").alias("b"))))
        # hubs have met everyone in their list; what is left of it is open while it has several components
        done = hubs.select("entry", "id", "set", F.lit(True).alias("__done"))
        left = lists.drop("component", "minor").join(done, ["entry", "id", "set"], "left").filter("__done IS NULL").drop("__done")
        left = materialize(compact(left.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id")), left_rows), "left")
        parts = left.groupBy("entry", "component").agg(F.count("*").alias("size"), F.min("n").alias("least"))
        open_ = parts.groupBy("entry").agg(F.count("*").alias("parts"), F.max(F.struct("size", "component")).alias("big"), F.min("least").alias("least"))
        open_ = materialize(compact(open_.filter("parts > 1").select("entry", "least", F.col("big.component").alias("big")), rows), "open")
        left = left.join(open_, "entry").filter("4 * least <= 5 * n - 9 * alone")
        left = left.withColumn("minor", F.col("component") != F.col("big"))
        lists = materialize(compact(left.select(*columns), left_rows), "lists")
        counts = lists.agg(F.count("*"), F.count(F.when(F.col("minor"), 1))).first()
        left_rows, rows = counts
        buckets = 64 if buckets == 1 else min(buckets * MORE_HUBS, 1 << 30)
    return labels


def near_duplicates(docs: DataFrame, width: int = WIDTH, rare: int = RARE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` (the smallest id reachable by links).

    A-Z are lower-cased, words are runs of non-space characters, a set holds the distinct
    runs of ``width`` words; a shorter text is one shingle.  Two documents link at a Jaccard
    similarity of 0.8 or more.  Texts that are missing or without words have no shingles and
    no links.  Rows with equal ids are one document with the links of all of them.  Rows
    without an id link with nothing and have no component.  Other columns are not read.
    """
    text = F.coalesce(F.col(text_column), F.lit("")).alias("text")
    plain = docs.select(F.col(id_column).cast("long").alias("id"), text)
    blocks, how = deal(plain, "id", "text", keys_per_byte=8)
    signed = materialize(blocks.select("id", "block", "text").mapInArrow(_signed(width), "id long, block long, n long, s1 long, s2 long"), "sets")
    known = signed.filter("id IS NOT NULL AND n > 0")
    groups = known.groupBy("s1", "s2").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
    groups = materialize(groups.select("s1", "s2", "first"), "groups")
    members = materialize(known.join(groups, ["s1", "s2"]).select("id", "block", "s1", "first"), "copies")
    copies = _flags(members.filter("id <> first"), 0, ("block", "id", "s1"))

    by_block = blocks.filter("id IS NOT NULL").groupBy("block")
    sketches = by_block.cogroup(copies.groupBy("block")).applyInArrow(_sketch(width, how), "slice long, block long, cells binary, counts binary")
    counted = sketches.groupBy("slice").applyInArrow(add_up(how, 2), "block long, slice long, cells binary, counts binary")
    flags = copies.unionByName(_flags(counted, 1, ("block", "slice", "cells", "counts")))
    candidates = by_block.cogroup(flags.groupBy("block")).applyInArrow(
        _candidates(width, how, rare), "id long, n long, alone long, entries array<long>, shared binary, bits binary"
    )
    similar = link_components(materialize(candidates, "candidates"))
    # equal sets link their documents to the first of them
    links = members.filter("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    reached = components(links.unionByName(similar.select(F.col("id").alias("a"), F.col("component").alias("b"))))
    out = signed.join(reached, "id", "left")
    return out.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
