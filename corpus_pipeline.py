"""A corpus from raw documents: quality filter, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before kept;
all but the last return the columns of ``documents``.  ``run`` writes every stage's result
to the shared folder and reads it again for the next.

In every stage a missing or empty text holds no word and no line, so it repeats nothing and
holds no benchmark item; a missing doc_id is nobody's copy and stays; repeated rows stay
repeated unless the stage drops their kind; an empty table stays empty; other columns
come through as they are, whatever their names and types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanecast.llm.decontaminate import decontaminate
from vanecast.llm.jaccard import near_duplicates
from vanecast.llm.lines import line_dedup
from vanecast.llm.mixing import measure, mix_sources
from vanecast.llm.quality import fit_quality, keep_quality
from vanecast.llm.queries import MIX_BUDGET, MIX_POWERS, labelled
from vanecast.llm.toxicity import fold
from vanecast.session import materialize

LEAST_QUALITY = 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.7 or more; it learns from the labels outside its held-out fold.

    Without ten labelled documents or with labels of one kind nothing can be learnt, and all stay.
    """
    known = labelled(spark, sf_dir, "quality", docs).filter(fold("doc_id", 4) != 2)
    model = fit_quality(docs, known)
    return keep_quality(docs, model, LEAST_QUALITY) if model.network.w2.any() else docs


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier; those of which no word is left go.

    ``n_chars`` follows a text that has lost lines; a missing text becomes an empty one.
    """
    carried = {c: f"carry_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}  # names of no one else
    out = line_dedup(docs.withColumnsRenamed(carried), carry=tuple(carried.values()))
    out = out.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    if "n_chars" in carried:
        changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col(carried["n_chars"]))
        out = out.withColumn(carried["n_chars"], changed)
    return out.select(*[F.col(carried.get(c, c)).alias(c) for c in docs.columns])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group, the one with the smallest id."""
    groups = near_duplicates(docs)
    dropped = materialize(groups.filter("component_id <> doc_id").select("doc_id").distinct(), "dropped")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A draw of about half the tokens with flattened source, language and topic shares.

    Adds the operator's columns; ``n_tokens`` and ``topic`` replace columns of these names.
    """
    return mix_sources(measure(docs), MIX_POWERS, MIX_BUDGET)


STAGES = [("quality", quality), ("lines", lines), ("near", near), ("benchmark", benchmark), ("mixing", mixing)]

# the first stage is a trained model, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
