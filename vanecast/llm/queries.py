"""Registered queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORDS_SQL = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


# -- 6 ------------------------------------------------------------------------------

OP6_SQL = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {WORDS_SQL.format("coalesce(text, '')")} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
win AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS h FROM p),
least AS (SELECT h, min(doc_id) AS first FROM win GROUP BY h),
hit AS (SELECT doc_id, i FROM win JOIN least USING (h) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM hit),
lists AS (SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id),
kept AS (SELECT d.doc_id, len(w) AS n, coalesce(len(ks), 0) AS r,
                CASE WHEN ks IS NULL THEN w
                     ELSE list_filter(w, lambda x, k: NOT list_contains(ks, k)) END AS left_over
         FROM d LEFT JOIN lists USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(r AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(left_over, ' '), '')) AS kept_sha256
FROM kept
"""


@query("op6_substring_dedup", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Substring dedup over all documents: word counts and the digest of the kept words."""
    from vanecast.llm.substring import substring_dedup

    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


# -- 5 ------------------------------------------------------------------------------


def labelled(spark: SparkSession, sf_dir: str, label: str, docs: DataFrame | None = None) -> DataFrame:
    """Texts with one known label; a document with several labels of a kind counts by the smallest."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min(label).alias(label)).filter(F.col(label).isNotNull())
    docs = table(spark, sf_dir, "documents") if docs is None else docs
    return docs.select("doc_id", "text").join(labels, "doc_id")


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; rows with crc32(doc_id) mod 5 = 0 are held out."""
    from vanecast.llm.toxicity import fit_toxicity, fold, score_toxicity

    held = fold("doc_id", 5) == 0
    model = fit_toxicity(labelled(spark, sf_dir, "toxic").filter(~held))
    scored = score_toxicity(table(spark, sf_dir, "documents"), model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


# -- 8 ------------------------------------------------------------------------------


@query("op8_license_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels and base phrases of every document."""
    from vanecast.llm.licenses import license_scan

    out = license_scan(table(spark, sf_dir, "documents"))
    return out.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


# -- 9 ------------------------------------------------------------------------------


@query("op9_quality_classifier")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; rows with crc32(doc_id) mod 4 = 2 are held out."""
    from vanecast.llm.quality import fit_quality, score_quality
    from vanecast.llm.toxicity import fold

    docs = table(spark, sf_dir, "documents")
    held = fold("doc_id", 4) == 2
    model = fit_quality(docs, labelled(spark, sf_dir, "quality").filter(~held))
    scored = score_quality(docs, model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


# -- 10 -----------------------------------------------------------------------------


@query("op10_html_extraction")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from vanecast.llm.htmltext import extract_text

    return extract_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


# -- 4 ------------------------------------------------------------------------------

MIX_POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.5}
MIX_BUDGET = 0.5


def _mix_sql() -> str:
    from vanecast.llm.mixing import mixing_sql

    return mixing_sql("documents", MIX_POWERS, MIX_BUDGET, "doc_id, source, lang, topic, n_tokens, round(weight, 6) AS weight, round(p, 6) AS p")


@query("op4_source_mixing", _mix_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn so that tokens follow flattened source, language and topic shares."""
    from vanecast.llm.mixing import measure, mix_sources
    from vanecast.session import materialize

    slim = measure(table(spark, sf_dir, "documents")).select("doc_id", "source", "lang", "topic", "n_tokens")
    out = mix_sources(materialize(slim, "measured"), MIX_POWERS, MIX_BUDGET)
    return out.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("weight", 6).alias("weight"), F.round("p", 6).alias("p"))


# -- 3 ------------------------------------------------------------------------------


def line_dedup_sql(documents: str, columns: str) -> str:
    """Line dedup as SQL: ``columns`` may use doc_id, n_lines, n_removed, left_over and those of ``documents``."""
    return f"""
WITH d AS MATERIALIZED (SELECT *, string_split(coalesce(text, ''), chr(10)) AS ls FROM {documents}),
l AS MATERIALIZED (SELECT doc_id, n, {WORDS_SQL.format("x")} AS w FROM (SELECT doc_id, unnest(ls) AS x, unnest(range(len(ls))) AS n FROM d)),
s AS MATERIALIZED (SELECT doc_id, n, len(w) AS k, w, array_to_string(w, ' ') AS s FROM l WHERE len(w) > 0),
f AS MATERIALIZED (SELECT s, any_value(w) AS w, any_value(k) AS k, min((doc_id, n)) AS p FROM s GROUP BY s),
v AS MATERIALIZED (
  SELECT s, p, i, array_to_string(w[:i - 1] || w[i + 1:], ' ') AS v FROM (SELECT s, p, w, unnest(range(1, k + 1)) AS i FROM f WHERE k >= 8)
  UNION ALL SELECT s, p, 0, s FROM f WHERE k >= 7),
same AS (SELECT v, i, min(p) AS p FROM v GROUP BY v, i),
less AS (SELECT v, min(p) AS p FROM v WHERE i > 0 GROUP BY v),
near AS (
  SELECT v.s FROM v JOIN same ON v.v = same.v AND v.i = same.i WHERE same.p < v.p
  UNION SELECT v.s FROM v JOIN same ON v.v = same.v AND same.i = 0 AND v.i > 0 WHERE same.p < v.p
  UNION SELECT v.s FROM v JOIN less ON v.v = less.v AND v.i = 0 WHERE less.p < v.p),
gone AS (SELECT doc_id, list(n) AS ns FROM (SELECT s.doc_id, s.n FROM s JOIN f USING (s) LEFT JOIN near USING (s)
         WHERE near.s IS NOT NULL OR f.p < (s.doc_id, s.n)) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_lines FROM s GROUP BY doc_id)
SELECT {columns} FROM (
  SELECT d.*, coalesce(n_lines, 0) AS n_lines, CAST(coalesce(len(ns), 0) AS BIGINT) AS n_removed,
         CASE WHEN ns IS NULL THEN coalesce(text, '')
              ELSE coalesce(array_to_string(list_filter(ls, lambda x, k: NOT list_contains(ns, k - 1)), chr(10)), '') END AS left_over
  FROM d LEFT JOIN n USING (doc_id) LEFT JOIN gone USING (doc_id))
"""


@query("op3_line_dedup", line_dedup_sql("documents", "doc_id, n_lines, n_removed, sha256(left_over) AS kept_sha256"))
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal and nearly equal lines of all documents, the earliest kept: counts and the digest of what is left."""
    from vanecast.llm.lines import line_dedup

    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


# -- 7 ------------------------------------------------------------------------------


def near_duplicates_sql(documents: str, columns: str) -> str:
    """Near-duplicate groups as SQL: ``columns`` may use those of ``documents``, n_shingles and component_id."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT *, {WORDS_SQL.format(lower)} AS w FROM {documents}),
g AS MATERIALIZED (SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM g a JOIN g b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * o >= 80 * (p.n + q.n - o)),
u AS MATERIALIZED (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT x AS v, x AS c FROM u UNION SELECT r.v, u.y FROM r JOIN u ON r.c = u.x),
c AS (SELECT v, min(c) AS c FROM r GROUP BY v)
SELECT {columns} FROM (SELECT d.*, coalesce(n.n, 0) AS n_shingles, coalesce(c.c, d.doc_id) AS component_id
  FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.v = d.doc_id)
"""


@query("op7_ngram_jaccard_join", near_duplicates_sql("documents", "doc_id, n_shingles, component_id"))
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents at a shingle similarity of 0.8."""
    from vanecast.llm.jaccard import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


# -- 1 ------------------------------------------------------------------------------


@query("op1_benchmark_decontamination")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within a fifth of its words of edits, with the place."""
    from vanecast.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# -- 2 ------------------------------------------------------------------------------


OP2_SQL = """
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
g AS MATERIALIZED (SELECT vec_id, e FROM v WHERE len(e) = len(list_filter(e, lambda x: isfinite(x))) AND len(list_filter(e, lambda x: x <> 0)) > 0),
u AS MATERIALIZED (SELECT a.vec_id AS x, b.vec_id AS y FROM g a JOIN g b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT x AS v, x AS c FROM u UNION SELECT r.v, u.y FROM r JOIN u ON r.c = u.x),
c AS (SELECT v, min(c) AS c FROM r GROUP BY v), n AS (SELECT x, count(*) AS n FROM u GROUP BY x)
SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.c, vec_id) AS component_id, coalesce(c.c, vec_id) = vec_id AS kept
FROM v LEFT JOIN n ON n.x = vec_id LEFT JOIN c ON c.v = vec_id
"""


@query("op2_embedding_near_dedup", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all embeddings at a cosine of 0.95."""
    from vanecast.llm.embeddings import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


# -- 11 -----------------------------------------------------------------------------

# CRC-32 of the decimal id: bits shifted out of the reflected polynomial 0xEDB88320
CRC_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({}, ''), lambda s: ascii(s)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""

OP11_SQL = f"""
WITH c AS (SELECT doc_id, {WORDS_SQL.format("coalesce(text, '')")} AS w, {CRC_SQL.format("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
g AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g FROM c),
p AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM g),
t AS MATERIALIZED (SELECT doc_id, n, CASE WHEN a = n THEN w
  ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS w FROM p),
-- a run repeats at least six consecutive words one period later
x AS MATERIALIZED (SELECT doc_id, i, array_to_string(w[i + 1:i + 6], ' ') AS s FROM (SELECT doc_id, w, unnest(range(n - 5)) AS i FROM t WHERE n >= 7)),
e AS (SELECT a.doc_id, b.i - a.i AS q, a.i FROM x a JOIN x b ON a.doc_id = b.doc_id AND a.s = b.s AND a.i < b.i),
s AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e),
m AS (SELECT doc_id, q, min(i) AS i, count(*) + 5 + q AS l FROM s GROUP BY doc_id, q, island),
r AS MATERIALIZED (SELECT doc_id, i, l, min(q) AS q FROM m WHERE l >= greatest(12, 2 * q) GROUP BY doc_id, i, l),
best AS (SELECT doc_id, count(*) AS n_runs, min((-l, i, q)) AS b, string_agg(concat(i, ',', l, ',', q, chr(10)), '' ORDER BY i, q) AS runs FROM r GROUP BY doc_id),
gone AS (SELECT doc_id, list(DISTINCT k) AS ks FROM (SELECT doc_id, unnest(range(i + q, i + l)) AS k FROM r) GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, b[2] AS start, CAST(-b[1] AS BIGINT) AS length, b[3] AS period,
       CAST(1000 * -b[1] // b[3] AS BIGINT) AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
       sha256(coalesce(array_to_string(CASE WHEN ks IS NULL THEN w ELSE list_filter(w, lambda y, k: NOT list_contains(ks, k - 1)) END, ' '), '')) AS collapsed_sha256
FROM t LEFT JOIN best USING (doc_id) LEFT JOIN gone USING (doc_id)
"""


def with_periods(docs: DataFrame) -> DataFrame:
    """The input of query 11: every tenth text by crc32(doc_id) repeats a period from one of its words on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    word = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    split = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, word).alias("w"))
    n = F.nullif(F.size("w"), F.lit(0))
    drawn = split.withColumns({"n": n, "a": F.col("g") % n}).withColumn("p", F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1)
    places = F.expr("transform(sequence(0, n - 1), i -> get(w, cast(if(i < a, i, a + (i - a) % p) as int)))")
    return drawn.select("doc_id", F.when(F.col("n").isNotNull(), F.array_join(places, " ")).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document: their number, the longest, digests of all and of the text without repetitions."""
    from vanecast.llm.periodic import periodic_runs

    out = periodic_runs(with_periods(table(spark, sf_dir, "documents")))
    ranked = F.expr("transform(runs, r -> struct(-r.length as l, r.start as s, r.period as q))")
    best = F.array_min(ranked)
    lines = F.expr("transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n'))")
    return out.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.s").alias("start"),
        (-F.col("best.l")).alias("length"),
        F.col("best.q").alias("period"),
        F.expr("-1000 * best.l div best.q").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# -- 12 -----------------------------------------------------------------------------


@query("op12_personal_data")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base kinds, and all spans."""
    from vanecast.llm.personal import BASE_KINDS, find_personal

    out = find_personal(table(spark, sf_dir, "documents"))
    shown = "transform({}, s -> concat(s.kind, ':', s.start, ':', s.`end`))"
    base = f"filter(spans, s -> s.kind IN {BASE_KINDS})"
    return out.select(
        "doc_id",
        *(F.expr(f"CAST(size(filter(spans, s -> s.kind = '{kind}')) AS BIGINT) AS n_{kind}") for kind in BASE_KINDS),
        F.sha2(F.array_join(F.expr(shown.format(base)), ","), 256).alias("base_sha256"),
        F.array_join(F.expr(shown.format("spans")), ",").alias("spans"),
    )


# -- 13 -----------------------------------------------------------------------------

OP13_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM t),
x AS MATERIALIZED (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
g AS MATERIALIZED (SELECT lang, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM x),
n AS (SELECT lang, count(*) AS n FROM g GROUP BY lang),
f1 AS MATERIALIZED (SELECT lang, a, count(*) AS f FROM g GROUP BY ALL),
f2 AS MATERIALIZED (SELECT lang, a, b, count(*) AS f FROM g WHERE b IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS MATERIALIZED (SELECT lang, a, b, c, count(*) AS f FROM g WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
inside AS (SELECT lang, a, b, max(f) AS longer FROM (SELECT lang, a, b, f FROM f3 UNION ALL SELECT lang, b, c, f FROM f3) GROUP BY ALL),
cuts AS (
  SELECT f2.lang, f2.a || ' ' || f2.b AS phrase, f2.f AS a, 1 AS k, l.f AS l, r.f AS r
  FROM f2 LEFT JOIN inside USING (lang, a, b) JOIN f1 l ON l.lang = f2.lang AND l.a = f2.a JOIN f1 r ON r.lang = f2.lang AND r.a = f2.b
  WHERE coalesce(100 * longer < 50 * f2.f, true)
  UNION ALL
  SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c, f3.f, 1, l.f, r.f
  FROM f3 JOIN f1 l ON l.lang = f3.lang AND l.a = f3.a JOIN f2 r ON r.lang = f3.lang AND r.a = f3.b AND r.b = f3.c
  UNION ALL
  SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c, f3.f, 2, l.f, r.f
  FROM f3 JOIN f2 l ON l.lang = f3.lang AND l.a = f3.a AND l.b = f3.b JOIN f1 r ON r.lang = f3.lang AND r.a = f3.c),
s AS (SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
m AS (SELECT lang, phrase, a, min((score, k, l, r)) AS c FROM s GROUP BY ALL),
o AS (SELECT lang, phrase, a, c[1] AS score, c[3] AS l, c[4] AS r, row_number() OVER (PARTITION BY lang ORDER BY c[1] DESC, a DESC, phrase) AS rank FROM m)
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000
"""


@query("op13_phrase_collocations", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of two and three words of each language by their weakest cut."""
    from vanecast.llm.phrases import collocations

    return collocations(table(spark, sf_dir, "documents"))
