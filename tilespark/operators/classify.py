"""A linear classifier over embeddings, its probabilities, and reports on its predictions.

The model is one small row: an array of labels, of weight vectors and of biases, at most a few thousand numbers a
class. It is read once, when a plan is made, and goes to the workers with the function that scores: a matrix product for
each batch of embeddings, without shuffle, whatever their number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DIGITS = 9


def class_means(embeddings: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """A stand-in model: each label's mean vector, without bias. One row: classes array<struct<label, w, b>>."""
    long = embeddings.select(label, F.posexplode(vector).alias("i", "v"))
    means = long.groupBy(label, "i").agg(F.round(F.avg(F.col("v").cast("double")), DIGITS).alias("m"))
    vectors = means.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("w"))
    return vectors.agg(F.array_sort(F.collect_list(F.struct(F.col(label).cast("string").alias("label"), "w", F.lit(0.0).alias("b")))).alias("classes"))


def model_from(labels: DataFrame, weights: DataFrame) -> DataFrame:
    """labels (idx, label), weights (idx, w, b) -> the model row, in the order of idx."""
    return labels.join(weights, "idx").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", F.col("label").cast("string").alias("label"), "w", "b"))), lambda s: s.dropFields("idx")).alias("classes"))


def load(spark: SparkSession, path: str | None, default: str) -> DataFrame:
    """The model kept as tables classes (idx, label) and weights (idx, w, b) in a folder; without a path, or where
    nothing is there, in the default one. If that is missing too, the reader's error tells."""
    for folder in [path, default] if path else [default]:
        try:
            return model_from(spark.read.parquet(f"{folder}/classes"), spark.read.parquet(f"{folder}/weights"))
        except AnalysisException as error:
            if folder == default or error.getCondition() != "PATH_NOT_FOUND":
                raise


def save(labels: DataFrame, weights: DataFrame, folder: str) -> None:
    labels.write.mode("overwrite").parquet(f"{folder}/classes")
    weights.write.mode("overwrite").parquet(f"{folder}/weights")


def _parameters(model: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Labels in order, a row of weights each, and biases. A table of several models isn't one."""
    rows = model.select("classes").take(2)
    if len(rows) != 1:
        raise ValueError(f"a model is one row; here are {'none' if not rows else 'several'}")
    classes = sorted(rows[0].classes or [], key=lambda c: c.label)
    return [c.label for c in classes], np.array([c.w for c in classes], float).reshape(len(classes), -1), np.array([c.b for c in classes], float)


def probabilities(z: np.ndarray) -> np.ndarray:
    """Softmax of each row, shifted by its maximum."""
    x = np.exp(z - z.max(1, keepdims=True)) if z.size else z
    return x / x.sum(1, keepdims=True) if z.size else x


SCORES = "array<struct<z:double,label:string,p:double>>"


def scored(embeddings: DataFrame, model: DataFrame, vector: str = "embedding") -> DataFrame:
    """Adds scores: array<struct<z, label, p>>, by falling z, then by label. An embedding of another length than the
    model's, or with a null, has null scores."""
    labels, weights, bias = _parameters(model)
    at, out = embeddings.columns.index(vector), StructType.fromDDL(f"scores {SCORES}")

    def run(batches):
        names = np.array(labels, object)
        for batch in batches:
            rows, n, k = batch.column(at), batch.num_rows, len(names)
            lengths = rows.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            values = rows.flatten().to_numpy(zero_copy_only=False).astype(float)
            fits = (lengths == weights.shape[1]) & (k > 0)
            begin = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
            x = values[begin[fits][:, None] + np.arange(weights.shape[1])] if fits.any() else np.zeros((0, weights.shape[1]))
            fits[fits] = ~np.isnan(x).any(1)
            z = np.round(x[~np.isnan(x).any(1)] @ weights.T + bias, DIGITS)
            p, order = probabilities(z), np.argsort(-z, axis=1, kind="stable")  # labels are in order, which breaks ties
            flat = [pa.array(a, t) for a, t in ((np.take_along_axis(z, order, 1).ravel(), pa.float64()), (names[order].ravel(), pa.string()), (np.take_along_axis(p, order, 1).ravel(), pa.float64()))]
            offsets = np.concatenate([[0], np.cumsum(np.where(fits, k, 0))]).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(flat, ["z", "label", "p"]), mask=pa.array(~fits))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "scores"])

    return embeddings.mapInArrow(run, StructType([*embeddings.schema.fields, *out.fields]))


def top(scores: DataFrame, k: int = 3) -> DataFrame:
    """A row a class of each embedding's best k: rank, organ, confidence."""
    best = scores.withColumn("_best", F.slice("scores", 1, k)).select("*", F.posexplode("_best").alias("_r", "_s"))
    return best.select(*[c for c in scores.columns if c != "scores"], (F.col("_r") + 1).alias("rank"), F.col("_s.label").alias("organ"), F.col("_s.p").alias("confidence"))


def predicted(scores: DataFrame) -> DataFrame:
    """Adds predicted_organ, confidence, top3_predictions and probabilities."""
    pair = lambda s: F.struct(s["label"].alias("organ"), s["p"].alias("confidence"))
    return (
        scores.withColumn("predicted_organ", F.col("scores")[0]["label"])
        .withColumn("confidence", F.col("scores")[0]["p"])
        .withColumn("top3_predictions", F.transform(F.slice("scores", 1, 3), pair))
        .withColumn("probabilities", F.map_from_entries(F.transform("scores", lambda s: F.struct(s["label"], s["p"]))))
        .drop("scores")
    )


def usable(vector: Column) -> Column:
    """An embedding that can be scored; the rest goes to a table of rejects."""
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, lambda v: v.isNull() | F.isnan(v))


def distribution(predictions: DataFrame, label: str = "predicted_organ") -> DataFrame:
    """Count and share of each label, of rows that have one; the most frequent first, then by label."""
    counts = predictions.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_all"))  # one row
    return counts.join(F.broadcast(total)).select(label, "n", F.round(F.lit(100.0) * F.col("n") / F.col("_all"), 1).alias("pct")).orderBy(F.desc("n"), label)


def mean_confidence(predictions: DataFrame, digits: int = 6) -> DataFrame:
    return predictions.filter(F.col("predicted_organ").isNotNull()).agg(F.round(F.avg("confidence"), digits).alias("mean_confidence"))
