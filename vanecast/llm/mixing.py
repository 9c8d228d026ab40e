"""Mixing sources to target weights: iterative proportional fitting and a calibrated draw.

Tokens are added up per cell (source, language, topic).  Every round rakes the cells' weights
to one marginal after the other: a cell is multiplied by the target share of its value over
the value's present share.  A weight then becomes an inclusion probability min(1, c * weight)
with the one constant c for which the expected tokens meet the budget, and a document stays
if the hash of its id falls below the probability of its cell.  Built-in expressions,
aggregates and joins only; documents are read, never shuffled, unless the cells are too many
to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanecast.llm.graph import compact
from vanecast.operators.joins import lookup_join
from vanecast.session import materialize

ROUNDS = 12
CALIBRATION_ROUNDS = 12
SEED = "mix"

# fixed values: the topic rules, the first that holds; shares are of the words
TOPICS = (("legal", ("icense", "opyright", "ights reserved")), ("contact", ("@",)))
SIGNS = (("table", "|", 0.05), ("loud", "!!", 0.2), ("markup", "***", 0.05))


def word_count(text: Column) -> Column:
    """Number of runs of non-space characters."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def topic_of(text: Column, words: Column) -> Column:
    """Topic of a whole text by fixed marks: legal, contact, table, loud, markup, or prose."""
    whole = F.coalesce(text, F.lit(""))
    out = F.lit("prose")
    for name, sign, share in reversed(SIGNS):
        places = (F.length(whole) - F.length(F.replace(whole, F.lit(sign), F.lit("")))) / len(sign)
        out = F.when((words > 0) & (places >= share * words), name).otherwise(out)
    for name, marks in reversed(TOPICS):
        found = F.lit(False)
        for mark in marks:
            found = found | F.contains(whole, F.lit(mark))
        out = F.when(found, name).otherwise(out)
    return out


def measure(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` (words) and ``topic``; a missing text has no words and is prose."""
    words = docs.withColumn("n_tokens", word_count(F.col(text_column)))
    return words.withColumn("topic", topic_of(F.col(text_column), F.col("n_tokens")))


def cell_tokens(measured: DataFrame, dims: list[str], tokens: str = "n_tokens") -> DataFrame:
    """Tokens per cell; a missing value is a category of its own, the empty text."""
    keys = [F.coalesce(F.col(d).cast("string"), F.lit("")).alias(d) for d in dims]
    return measured.select(*keys, F.col(tokens)).groupBy(*dims).agg(F.sum(tokens).cast("double").alias("tokens"))


def flattened(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """Target shares of a dimension: its token shares raised to ``power`` and brought to sum 1."""
    sums = cells.groupBy(dim).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("target"))
    return sums.crossJoin(F.broadcast(sums.agg(F.sum("target").alias("__all")))).select(dim, (F.col("target") / F.col("__all")).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` with ``weight``, so that weighted token shares follow every target.

    ``targets`` maps a dimension to a table (dimension, ``target``) of shares that sum to 1.
    Values without a target get share 0; values without tokens keep their weight.
    """
    total = F.lit(cells.agg(F.sum("tokens")).first()[0] or 0.0)
    goal = cells
    for dim, target in targets.items():
        goal = goal.join(target.select(dim, F.col("target").alias(f"__{dim}")), dim, "left").fillna(0.0, [f"__{dim}"])
    now = materialize(goal.withColumn("weight", F.lit(1.0)), "cells")
    size = now.count()
    for _ in range(rounds):
        for dim in targets:  # written out each time: the next step reads the cells twice
            mass = now.groupBy(dim).agg(F.sum(F.col("weight") * F.col("tokens")).alias("__mass"))
            now = now.join(mass, dim).withColumn("weight", F.when(F.col("__mass") > 0, F.col("weight") * F.col(f"__{dim}") * total / F.col("__mass")).otherwise(F.col("weight"))).drop("__mass")
            now = materialize(compact(now, size), "cells")
    return now.drop(*[f"__{d}" for d in targets])


def calibrate(cells: DataFrame, budget: float, rounds: int = CALIBRATION_ROUNDS) -> DataFrame:
    """``cells`` with ``p`` = min(1, c * weight), where the expected tokens are ``budget`` of all.

    c is raised until the cells that reach probability 1 no longer change; a budget beyond
    what the weighted cells hold gives probability 1 to all of them.
    """
    kept = materialize(cells, "weights")
    wanted = (kept.agg(F.sum("tokens")).first()[0] or 0.0) * budget
    c = 0.0
    for _ in range(rounds):
        full = F.col("weight") * F.lit(c) >= 1.0
        sums = kept.agg(
            F.sum(F.when(full, F.col("tokens")).otherwise(0.0)).alias("full"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight") * F.col("tokens"))).alias("rest"),
        ).first()
        if not sums["rest"]:
            break
        raised = max(c, (wanted - sums["full"]) / sums["rest"])
        if raised == c:
            break
        c = raised
    return kept.withColumn("p", F.least(F.lit(1.0), F.lit(c) * F.col("weight")))


def draw(id_column: str, seed: str = SEED) -> Column:
    """A number in [0, 1) from the id: the first 13 hex digits of its MD5."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix_sources(
    measured: DataFrame,
    powers: dict[str, float],
    budget: float = 0.5,
    id_column: str = "doc_id",
    targets: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Rows of ``measured`` that are drawn, with the ``weight`` and ``p`` of their cell.

    ``measured`` has ``n_tokens`` and the columns of ``powers``; their targets are the token
    shares raised to the power, unless ``targets`` gives shares.  ``budget`` is the share of
    all tokens to expect.  Missing values are a category of their own.  Equal ids are drawn
    alike, a missing id like the empty text; documents without words follow their cell.  An
    empty table gives an empty table.  Other columns pass through, but for ones named
    ``weight`` and ``p``, which are replaced.
    """
    dims = list(powers)
    cells = materialize(cell_tokens(measured, dims), "tokens")
    goals = {d: (targets or {}).get(d) for d in dims}
    goals = {d: flattened(cells, d, powers[d]) if t is None else t for d, t in goals.items()}
    chances = calibrate(rake(cells, goals), budget)
    keys = {d: f"__cell_{d}" for d in dims}
    lookup = chances.select(*[F.col(d).alias(k) for d, k in keys.items()], "weight", "p")
    rows = measured.drop("weight", "p").withColumns({k: F.coalesce(F.col(d).cast("string"), F.lit("")) for d, k in keys.items()})
    # narrow columns first: every document of a cell with p = 1 stays, whatever its draw
    joined = lookup_join(rows, lookup, list(keys.values()))
    return joined.filter(draw(id_column) < F.col("p")).drop(*keys.values())


def mixing_sql(documents: str, powers: dict[str, float], budget: float, columns: str) -> str:
    """The same computation as SQL for DuckDB, rounds written out; ``documents`` is a relation."""
    dims = list(powers)
    n = r"CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT)"
    whole = "coalesce(text, '')"
    topic = "CASE "
    for name, marks in TOPICS:
        topic += "WHEN " + " OR ".join(f"contains({whole}, '{m}')" for m in marks) + f" THEN '{name}' "
    for name, sign, share in SIGNS:
        topic += f"WHEN n_tokens > 0 AND (length({whole}) - length(replace({whole}, '{sign}', ''))) / CAST({len(sign)} AS DOUBLE) >= {share} * n_tokens THEN '{name}' "
    topic += "ELSE 'prose' END"
    keys = ", ".join(f"coalesce(CAST({d} AS VARCHAR), '') AS {d}" for d in dims)
    parts = [
        f"n0 AS MATERIALIZED (SELECT *, {n} AS n_tokens FROM {documents})",
        f"m AS MATERIALIZED (SELECT *, {topic} AS topic FROM n0)",
        f"cells AS MATERIALIZED (SELECT {', '.join(dims)}, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM (SELECT {keys}, n_tokens FROM m) GROUP BY ALL)",
    ]
    goals = ""
    for d, power in powers.items():
        parts.append(f"g_{d} AS MATERIALIZED (SELECT {d}, t / sum(t) OVER () AS goal_{d} FROM (SELECT {d}, pow(sum(tokens), {power}) AS t FROM cells GROUP BY {d}))")
        goals += f" JOIN g_{d} USING ({d})"
    parts.append(f"r0 AS MATERIALIZED (SELECT *, CAST(1 AS DOUBLE) AS weight, sum(tokens) OVER () AS total FROM cells{goals})")
    k = 0
    for _ in range(ROUNDS):
        for d in dims:
            mass = f"sum(weight * tokens) OVER (PARTITION BY {d})"
            parts.append(f"r{k + 1} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN {mass} > 0 THEN weight * goal_{d} * total / {mass} ELSE weight END AS weight) FROM r{k})")
            k += 1
    parts.append("c0 AS MATERIALIZED (SELECT CAST(0 AS DOUBLE) AS c)")
    for j in range(CALIBRATION_ROUNDS):
        parts.append(
            f"c{j + 1} AS MATERIALIZED (SELECT coalesce(greatest(max(c), (max(total) * {budget} - sum(CASE WHEN weight * c >= 1 THEN tokens ELSE 0 END)) / "
            f"nullif(sum(CASE WHEN weight * c >= 1 THEN 0 ELSE weight * tokens END), 0)), max(c)) AS c FROM r{k}, c{j})"
        )
    parts.append(f"chances AS MATERIALIZED (SELECT {', '.join(f'{d} AS cell_{d}' for d in dims)}, weight, least(1.0, c * weight) AS p FROM r{k}, c{CALIBRATION_ROUNDS})")
    on = " AND ".join(f"coalesce(CAST(m.{d} AS VARCHAR), '') = cell_{d}" for d in dims)
    u = f"CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / CAST({1 << 52} AS DOUBLE)"
    return f"WITH {', '.join(parts)} SELECT {columns} FROM m JOIN chances ON {on} WHERE {u} < p"
