"""Phrase collocations: counts of all phrases by vertical partitioning of word prefixes, then scores.

Every word position is a suffix, cut off after ``longest`` words, at the end of its piece or
at a word that is too rare to stand in a candidate.  Word prefixes are grouped so that the
suffixes of a group fit a memory budget; a word too frequent for any budget is extended to
prefixes of two and more words, each depth counted on its own.  A group's suffixes form a
subtree that one task builds without the others: sorted suffixes are its leaves, equal ones
add up to leaf totals, and the total of an inner node is the sum of its leaves.

Texts are read and split once, into *segments* of a few megabytes of one language: a list of
distinct words and the stream of their numbers.  Words meet in a join of segment lists with
the table of frequent words; suffixes leave a segment counted, in one row per group.  Once
there are as many groups as distinct suffixes in a segment, that is a row per suffix: the
shuffle stays in proportion to the text, though packing then saves nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vanecast.llm.kernels import LOWER, batches, find_tokens, mix, text_bytes
from vanecast.session import materialize

SEGMENT_BYTES = 8 << 20  # text split at a time; a longer text stands alone
BUDGET = 1 << 20  # suffixes a group may hold; the last word taken in may double it
MIN_GROUPS = 64
SHARD_WORDS = 1 << 20  # frequent words numbered by one task
MIN_SHARDS = 16
SALTS = 32  # parts of a language that are ranked before the language is

BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD = (~BREAK).astype(np.uint8)
WORD[[0x20, 0x09]] = 0

SEGMENTS = "segment long, lang string, code long, h long, n long, word string, stream binary"
SUFFIXES = "lang string, grp long, depth int, size long, words binary, counts binary"
NODES = "lang string, words array<long>, f long"


def to_planes(values: np.ndarray) -> bytes:
    """Numbers as byte planes, only as many as the largest needs (equal high bytes compress away)."""
    wide = values.astype("<u8").view(np.uint8).reshape(-1, 8)
    used = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([used]) + np.ascontiguousarray(wide[:, :used].T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    used = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(used, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :used] = planes.T
    return wide.reshape(-1).view("<i8")


def count_rows(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of ``rows`` (depth x suffixes, not negative) in order and their added counts."""
    depth, n = rows.shape
    if not n:
        return rows, counts
    ids, local = np.unique(rows, return_inverse=True)
    local, bits = local.reshape(rows.shape), int(len(ids)).bit_length()
    if depth * bits <= 63:
        key = local[0]
        for row in local[1:]:
            key = (key << bits) + row
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.append(True, key[1:] != key[:-1])
    else:
        order = np.lexsort(local[::-1])
        rows_in_order = local[:, order]
        new = np.append(True, (rows_in_order[:, 1:] != rows_in_order[:, :-1]).any(axis=0))
    lead = np.flatnonzero(new)
    return rows[:, order[lead]], np.add.reduceat(counts[order], lead)


def split_words(docs: DataFrame) -> DataFrame:
    """Segments of ``docs`` (lang, text): a row per distinct word with its number, and one with the stream of numbers, 0 between pieces."""

    def split(stream):
        task, made = TaskContext.get().partitionId(), 0
        for batch in stream:
            langs = batch.column(0).to_pylist()
            for lang in sorted(set(langs)):
                column = batch.column(1).filter(pa.array([x == lang for x in langs]))
                raw, offsets = text_bytes(column)
                for a, b in batches(offsets, SEGMENT_BYTES):
                    low, own = LOWER[raw[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a]
                    words = find_tokens(low, own, WORD)
                    if not len(words.hash):
                        continue
                    h, at, code, n = np.unique(words.hash, return_index=True, return_inverse=True, return_counts=True)
                    piece = np.cumsum(BREAK[low], dtype=np.int64)[words.start] + words.owner()
                    apart = np.cumsum(np.append(0, piece[1:] != piece[:-1]))
                    numbers = np.zeros(len(code) + int(apart[-1]), np.int64)
                    numbers[np.arange(len(code)) + apart] = code + 1
                    text = low.tobytes()
                    spans = zip(words.start[at].tolist(), words.end[at].tolist(), strict=True)
                    k, segment = len(h), (task << 32) + made
                    made += 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(k + 1, segment)), pa.array([lang] * (k + 1)), pa.array([*range(1, k + 1), None], pa.int64()),
                         pa.array([*h.view(np.int64).tolist(), None], pa.int64()), pa.array([*n.tolist(), None], pa.int64()),
                         pa.array([*(text[s:e].decode() for s, e in spans), None], pa.string()), pa.array([None] * k + [to_planes(numbers)], pa.binary())],
                        names=["segment", "lang", "code", "h", "n", "word", "stream"],
                    )

    return docs.mapInArrow(split, SEGMENTS)


def number_words(frequent: DataFrame, budget: int | None = None) -> tuple[DataFrame, int]:
    """``frequent`` (lang, h, word, f) with ``id`` from 1 and ``grp`` (null: too frequent for a group), and the number of groups of longer prefixes.

    Words are numbered and packed in shards: a group takes words of a shard, in order, until their counts reach the budget.
    """
    size = frequent.agg(F.count("*").alias("rows"), F.coalesce(F.sum("f"), F.lit(0)).alias("total")).first()
    budget = budget or max(1, min(BUDGET, size["total"] // MIN_GROUPS))
    shards = max(MIN_SHARDS, -(-size["rows"] // SHARD_WORDS))
    hot = F.col("f") > budget
    over = frequent.agg(F.coalesce(F.sum(F.when(hot, F.col("f"))), F.lit(0))).first()[0]
    in_order = Window.partitionBy("shard").orderBy("lang", "h")
    cold = F.when(hot, 0).otherwise(F.col("f"))
    before = F.sum(cold).over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - cold
    numbered = frequent.withColumn("shard", F.pmod(F.xxhash64("lang", "h"), F.lit(shards))).withColumns(
        {
            "id": F.row_number().over(in_order).cast("long") * shards + F.col("shard"),
            "grp": F.when(~hot, F.floor(before / budget) * shards + F.col("shard")),
        }
    )
    return numbered.drop("shard"), -(-over // budget)


def _suffixes(longest: int, spread: int):
    """A segment's suffixes, counted, one row per group; ``spread`` groups share those of longer prefixes."""

    def give(streams: pa.Table, known: pa.Table) -> pa.Table:
        out = {x: [] for x in ("lang", "grp", "depth", "size", "words", "counts")}

        def emit(lang: str, groups: np.ndarray, depth: int, rows: np.ndarray, counts: np.ndarray) -> None:
            order = np.argsort(groups, kind="stable")
            groups = groups[order]
            cuts = np.flatnonzero(np.diff(groups, prepend=-1, append=-1))  # groups are not negative: none of none
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                part = order[a:b]
                out["lang"].append(lang)
                out["grp"].append(int(groups[a]))
                out["depth"].append(depth)
                out["size"].append(b - a)
                out["words"].append(to_planes(rows[:, part].reshape(-1)))
                out["counts"].append(to_planes(counts[part]))

        if streams.num_rows and known.num_rows:
            numbers = from_planes(streams.column("stream")[0].as_py())
            ids, groups = np.zeros((2, int(numbers.max()) + 1), np.int64)
            code = known.column("code").to_numpy()
            ids[code] = known.column("id").to_numpy()
            grp = known.column("grp")
            groups[code] = np.where(grp.is_null().to_numpy(), -1, grp.fill_null(-1).to_numpy())
            seq = np.append(ids[numbers], np.zeros(longest, np.int64))
            at = np.flatnonzero((seq[:-1] > 0) & (seq[1:] > 0))
            rows = np.zeros((longest, len(at)), np.int64)
            alive = np.ones(len(at), bool)
            for d in range(longest):
                alive &= seq[np.minimum(at + d, len(seq) - 1)] > 0
                rows[d, alive] = seq[at[alive] + d]
            rows, counts = count_rows(rows, np.ones(len(at), np.int64))
            by_id = np.argsort(ids, kind="stable")
            own = groups[by_id[np.searchsorted(ids, rows[0], sorter=by_id)]]
            lang = streams.column("lang")[0].as_py()
            emit(lang, own[own >= 0], 0, rows[:, own >= 0], counts[own >= 0])
            hot_rows, hot_counts = rows[:, own < 0], counts[own < 0]
            for d in range(2, longest + 1):
                deep = hot_rows[d - 1] > 0
                part, n = count_rows(hot_rows[:d, deep], hot_counts[deep])
                key = np.zeros(part.shape[1], np.uint64)
                for row in part:
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + row.astype(np.uint64))
                emit(lang, (key % np.uint64(max(1, spread))).astype(np.int64), d, part, n)
        return pa.table(out, pa.schema([("lang", pa.string()), ("grp", pa.int64()), ("depth", pa.int32()), ("size", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())]))

    return give


def _subtree(longest: int, least: int):
    """Nodes of a group's subtree that reach ``least``: leaves are distinct suffixes, inner totals are sums of leaves."""

    def build(part: pa.Table) -> pa.Table:
        depth, lang = part.column("depth")[0].as_py(), part.column("lang")[0].as_py()
        width = depth or longest
        packed = [from_planes(x.as_py()).reshape(width, -1) for x in part.column("words")]
        counts = np.concatenate([from_planes(x.as_py()) for x in part.column("counts")])
        leaves, totals = count_rows(np.concatenate(packed, axis=1), counts)
        words, sizes, f = [], [], []
        for d in [depth] if depth else range(2, longest + 1):
            new = np.append(True, (leaves[:d, 1:] != leaves[:d, :-1]).any(axis=0))
            lead = np.flatnonzero(new)
            total = np.add.reduceat(totals, lead)
            keep = (total >= least) & (leaves[d - 1, lead] > 0)
            words.append(leaves[:d, lead[keep]].T.reshape(-1))
            sizes.append(np.full(keep.sum(), d))
            f.append(total[keep])
        offsets = np.append(0, np.cumsum(np.concatenate(sizes)))
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(words), pa.int64()))
        return pa.table({"lang": pa.array([lang] * len(lists), pa.string()), "words": lists, "f": pa.array(np.concatenate(f), pa.int64())})

    return build


def count_phrases(docs: DataFrame, longest: int = 3, least: int = 10, budget: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From ``docs`` (lang, text): all phrases of 1 to ``longest`` words found ``least`` times
    (lang, words as ids, f), the frequent words (lang, id, word), and the words of each language (lang, n)."""
    segments = materialize(split_words(docs), "segments")
    listed = segments.filter("stream IS NULL")
    totals = listed.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = listed.groupBy("lang", "h").agg(F.sum("n").alias("f"), F.min("word").alias("word")).filter(F.col("f") >= least)
    numbered, spread = number_words(materialize(frequent, "frequent"), budget)
    words = materialize(numbered, "words")
    known = listed.select(F.col("segment").alias("of"), "lang", "code", "h").join(words.select("lang", "h", "id", "grp"), ["lang", "h"])
    streams = segments.filter("stream IS NOT NULL").select("segment", "lang", "stream")
    suffixes = streams.groupBy("segment").cogroup(known.select("of", "code", "id", "grp").groupBy("of")).applyInArrow(_suffixes(longest, spread), SUFFIXES)
    nodes = materialize(suffixes.groupBy("lang", "grp", "depth").applyInArrow(_subtree(longest, least), NODES), "phrases")
    single = words.select("lang", F.array("id").alias("words"), "f")
    return single.unionByName(nodes), words.select("lang", "id", "word"), totals


def collocations(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    top: int = 2000,
    cover: int = 50,
    lang_column: str = "lang",
    text_column: str = "text",
    budget: int | None = None,
) -> DataFrame:
    """The best ``top`` phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a, l, r, n, score.

    ``a`` counts the phrase (at least ``least``), ``l`` and ``r`` the two parts of its weakest
    cut, ``n`` all words of the language; score = floor(10**6 * a * a / (l * r)) in exact
    arithmetic, the lowest of all cuts.  A phrase inside a longer one that has ``cover`` per
    cent of its count goes.  A-Z are lower-cased; pieces end at ``. , ; : ! ?`` and line
    breaks, words at space and tab.  A missing language is ``und``, a missing or empty text has
    no words, repeated rows count each, ids and other columns are not read.  Ties go by
    ``a``, then by the phrase's bytes.
    """
    plain = docs.select(F.coalesce(F.col(lang_column), F.lit("und")).alias("lang"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    phrases, words, totals = count_phrases(plain, longest, least, budget)
    found = phrases.filter(F.size("words") > 1)
    # parts of a candidate that are candidates themselves, with its count
    inside = F.expr(
        "flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), i -> slice(words, i, m))))"
    )
    longer = found.filter(F.size("words") > 2).select(F.explode(inside).alias("words"), "f").groupBy("words").agg(F.max("f").alias("longer"))
    left = found.join(longer, "words", "left").filter(F.coalesce(100 * F.col("longer") < cover * F.col("f"), F.lit(True)))
    # every cut of a candidate with the counts of its two parts
    cuts = left.select("lang", "words", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k"))
    cuts = cuts.withColumns({"first": F.expr("slice(words, 1, k)"), "rest": F.expr("slice(words, k + 1, size(words) - k)")})
    parts = phrases.filter(F.size("words") < longest)
    cuts = cuts.join(parts.select(F.col("words").alias("first"), F.col("f").alias("l")), "first")
    cuts = cuts.join(parts.select(F.col("words").alias("rest"), F.col("f").alias("r")), "rest")
    wide = {x: F.col(x).cast("decimal(15,0)") for x in ("a", "l", "r")}  # counts to 10**15: the products fit 38 digits
    score = F.expr("(CAST(1000000 AS DECIMAL(7,0)) * (wa * wa)) DIV (wl * wr)")
    cuts = cuts.withColumns({"wa": wide["a"], "wl": wide["l"], "wr": wide["r"]}).withColumn("score", score)
    scored = cuts.groupBy("lang", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = scored.select("lang", "words", "a", "cut.l", "cut.r", "cut.score")
    # candidates that can still be among the first of their language, ties included; only they need their words
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("words"), F.lit(SALTS)))
    ahead = F.rank().over(Window.partitionBy("lang", "salt").orderBy(F.desc("score"), F.desc("a")))
    best = salted.withColumn("ahead", ahead).filter(F.col("ahead") <= top).drop("ahead", "salt")
    each = best.select("words", F.posexplode("words").alias("place", "id")).join(words.select("id", "word"), "id")
    spelled = each.groupBy("words").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("s"))
    spelled = spelled.select("words", F.array_join(F.col("s.word"), " ").alias("phrase"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = best.join(spelled, "words").withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
