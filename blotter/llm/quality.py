"""Quality classifier: boosted trees over document statistics.

Training reads at most ``max_rows`` labelled documents (those with the least
hash of their id, equal texts of one id once) and ``max_bytes`` of their text, never one whose
``crc32`` remainder holds it out; this bound is the only sample. Scoring reads every whole text and only the text.

Rows: null or empty texts have all-zero statistics and a score like any other.
Labels that are null or have no document are ignored; several labels of one
document count as their mean, rounded up from one half. Without labels, or with
labels of one kind only, every score is their share (0.5 without any), kept
within 0.001 and 0.999.
Repeated rows score alike. Other columns are carried through by the caller.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .boosted_trees import FlatTrees, fit
from .doc_stats import document_stats
from .shared import arrow_map, received, send

MAX_TRAINING_ROWS = 20_000
MAX_TRAINING_BYTES = 1 << 30
CUT = 0.5
FOLDS, HELD_OUT_FOLD = 3, 1


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept out of training; false for a null id, which has no label."""
    fold = F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(FOLDS))
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))


def training_labels(labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """(doc_id, y) of at most ``max_rows`` labelled documents that aren't held out.

    Those with the least hash of their id: a share of the hashes that holds
    about nine tenths of ``max_rows`` is cut out first, so that hardly more
    rows than are kept meet in the task that bounds them.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    mean = known.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    share = 0.9 * max_rows / max(1, mean.count())
    place = F.xxhash64("doc_id") / 2.0 ** 64 + 0.5
    return mean.filter(place < share).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, max_bytes: int = MAX_TRAINING_BYTES) -> DataFrame:
    """(doc_id, text, y) of the training sample: at most ``max_rows`` rows and ``max_bytes`` of text.

    Equal texts of one id are one row. The ids, bounded by ``max_rows``, are broadcast; rows are
    taken in the order of their id's hash, an id's in that of their texts' hash, while both bounds hold.
    Only hashes and sizes are ordered in one task, at most ``max_rows`` of them from each other task.
    """
    ids = F.broadcast(training_labels(labels, label, max_rows))
    rows = docs.select("doc_id", "text").join(ids, "doc_id").withColumns(
        {"__h": F.xxhash64("doc_id"), "__t": F.sha2("text", 256), "__b": F.coalesce(F.octet_length("text"), F.lit(0))})
    rows = rows.dropDuplicates(["doc_id", "__t"])
    order = ["__h", "doc_id", "__t"]
    first = rows.select("__h", "doc_id", "__t", "__b").orderBy(*order).limit(max_rows)
    so_far = F.sum("__b").over(Window.orderBy(*order))
    first = first.withColumn("__so_far", so_far).filter(F.col("__so_far") <= max_bytes).select(
        F.col("doc_id").alias("__id"), F.col("__t").alias("__text"))
    taken = (F.col("doc_id") == F.col("__id")) & F.col("__t").eqNullSafe(F.col("__text"))
    return rows.join(F.broadcast(first), taken, "left_semi").select("doc_id", "text", "y")


def _training_rows(batches):
    for batch in batches:
        x = document_stats(batch, "text")
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("y"), pa.array([r.tobytes() for r in x], pa.binary())],
            ["doc_id", "y", "x"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality",
          max_rows: int = MAX_TRAINING_ROWS) -> FlatTrees:
    """Fit on the bounded sample's statistics (about 150 bytes a row come to the driver)."""
    rows = arrow_map(labelled_texts(docs, labels, label, max_rows), _training_rows,
                     "doc_id long, y int, x binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["x"])))
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in rows]) if rows else np.zeros((0, 1), np.float32)
    return fit(x, np.array([r["y"] for r in rows], float))


def _score(model, text_col: str, score_col: str):
    def run(batches):
        trees = received(model)
        for batch in batches:
            score = trees.probability(document_stats(batch, text_col))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, score_col])

    return run


def score_quality(docs: DataFrame, model: FlatTrees, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col`` (replaced if it exists)."""
    docs = docs.drop(score_col)
    sent = send(docs.sparkSession, model)
    schema = T.StructType(docs.schema.fields + [T.StructField(score_col, T.DoubleType())])
    return arrow_map(docs, _score(sent, text_col, score_col), schema)
