"""The corpus pipeline: five of the corpus operators, one after the other.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. All stages but
the last return the columns of ``documents``; the last adds what it decided.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.decontaminate import find_contamination
from blotter.llm.jaccard_join import jaccard_join, with_class
from blotter.llm.line_dedup import line_dedup
from blotter.llm.mixing import with_mix
from blotter.llm.quality import CUT, score_quality, train
from blotter.llm.shared import read_table, shared_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it learns from the stage's own documents."""
    model = train(docs, read_table(spark, sf_dir, "labels"), "quality")
    return score_quality(docs, model, score_col="__score").filter(F.col("__score") >= CUT).select(docs.columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more hold go from all of them; every document stays."""
    out = line_dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents one row stays, one with the group's smallest id.

    Rows are told apart by id and text: rows of one id in different groups don't
    meet. Rows without an id, or without words to link by, stay.
    """
    found = jaccard_join(docs)
    alone = F.col("doc_id").isNull() | ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rows = found.classes.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0)).groupBy("doc_id", "node").agg(
        F.count(F.lit(1)).alias("rows"))
    least = rows.groupBy("node").agg(F.min(F.struct("doc_id", "node", "rows")).alias("least"))
    first = shared_table(least.join(found.comp, "node", "left").groupBy(F.coalesce("comp", "node")).agg(
        F.min("least").alias("least")).select("least.*"), "jaccard-first", small=True)
    first = first.withColumnsRenamed({"doc_id": "__keep", "node": "__class"})
    kept = with_class(docs.filter(~alone), "__node")
    kept = kept.join(first, (kept["doc_id"] == first["__keep"]) & (kept["__node"] == first["__class"]), "left_semi")
    if not first.filter("rows > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "__node"])
    return kept.select(docs.columns).unionByName(docs.filter(alone))


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item (or a whole shorter item) go."""
    found = find_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.filter(F.col("n_hit") == 0).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how many of their words it takes, repeats counted."""
    return with_mix(docs).filter(F.col("taken") > 0)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", repeated_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", contaminated),
    ("mixing sources to target weights", mix),
]

#: Trained trees have no SQL form; tests hold the stages against plain Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
