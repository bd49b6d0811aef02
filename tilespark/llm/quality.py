"""Quality by importance resampling.

Two generative models of hashed word 1- and 2-grams are counted: one over the texts labelled good, one over all texts.
A text's log weight is the log of the ratio of its probabilities under the two: the sum over its n-grams. Adding unit
Gumbel noise, drawn from a hash of the id, to the log weights and keeping the k largest keys is sampling k texts without
replacement in proportion to their weights. k is the share of good texts among the labelled ones, of all texts. The
k-th largest key is found by histograms of the keys' bits, each refining one bucket of the one before: nothing is sorted.

Defined cases: null and empty texts, and those without words, have no weight: they are kept last, in the order of their
ids. Exactly k rows are kept: of those whose keys tie at the border, those of the least ids. Repeated rows have one key,
and each counts. Labels of rows with crc32(doc_id) mod 4 = 2 aren't used, which leaves a fold to measure on. Without
labels every text counts as good. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, materialise, slices, utf8
from .text_arrays import U, Words, mix
from .toxicity import held_out

BUCKETS = 1 << 16
#: Labelled good texts that the target model is counted on, by order of a hash of their id.
MAX_LABELLED = 20_000
LEVEL_BITS = 16
SMOOTHING = 0.5
_NULL_ID = U(0x5851F42D4C957F2D)


def _grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each n-gram, its text)."""
    h, owner = words.hashes, words.owner()
    pair = owner[1:] == owner[:-1]
    both = mix(h[:-1] * U(3) + h[1:])[pair] % U(BUCKETS)
    return np.concatenate([h % U(BUCKETS), both]).astype(np.int64), np.concatenate([owner, owner[1:][pair]])


def _count(batches):
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in slices(batches):
        grams, text = _grams(Words(*utf8(batch.column(0)), lower=True))
        good = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        raw += np.bincount(grams, minlength=BUCKETS)
        target += np.bincount(grams[good[text]], minlength=BUCKETS)
    seen = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(raw[seen], pa.int64()), pa.array(target[seen], pa.int64())], ["bucket", "raw", "target"])


def ratios(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """(log of the ratio of both models by bucket, share of good texts among the labelled ones).

    The models are BUCKETS numbers, which the driver holds; tasks count them before anything is shuffled.
    """
    known = labels.filter(~held_out() & F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    total, good = known.agg(F.count("*"), F.count_if(F.col("quality") > 0)).first()
    chosen = known.filter("quality > 0").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(MAX_LABELLED).select(F.col("doc_id").alias("_good"))
    marked = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_good"), "left")  # MAX_LABELLED ids at most
    counts = marked.select("text", F.col("_good").isNotNull().alias("good")).mapInArrow(_count, "bucket int, raw long, target long")
    rows = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[rows.bucket], target[rows.bucket] = rows.raw, rows.target
    if not good:
        return np.zeros(BUCKETS), 1.0
    model = lambda c: np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS))
    return model(target) - model(raw), good / total


def gumbel(ids: np.ndarray, known: np.ndarray, seed: int) -> np.ndarray:
    """Unit Gumbel noise that an id (known: it isn't null) and a seed fix."""
    bits = mix(mix(np.where(known, ids.astype(np.int64).view(np.uint64), _NULL_ID) + mix(np.array([seed], np.uint64))) + U(1))
    return -np.log(-np.log(((bits >> U(11)).astype(np.float64) + 0.5) / float(1 << 53)))


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Signed 64-bit integers in the order of doubles."""
    bits = (values + 0.0).view(np.int64)  # -0.0 counts as 0.0
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def weigh(docs: DataFrame, ratio: np.ndarray, seed: int) -> DataFrame:
    """docs (doc_id, text) -> doc_id, log_weight, gumbel_key (both null without words), key (gumbel_key's order as a long)."""
    shipped = docs.sparkSession.sparkContext.broadcast(ratio)  # BUCKETS numbers

    def run(batches):
        for batch in slices(batches):
            grams, text = _grams(Words(*utf8(batch.column(1)), lower=True))
            n = np.bincount(text, minlength=batch.num_rows)
            total = np.bincount(text, weights=shipped.value[grams], minlength=batch.num_rows).round(9)
            ids = batch.column(0)
            noise = gumbel(ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False), seed)
            keys = total + noise
            order = np.where(n > 0, ordered_bits(keys), np.iinfo(np.int64).min)
            yield pa.RecordBatch.from_arrays([ids, pa.array(total, pa.float64(), mask=n == 0), pa.array(keys, pa.float64(), mask=n == 0), pa.array(order, pa.int64())], ["doc_id", "log_weight", "gumbel_key", "key"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, log_weight double, gumbel_key double, key long")


def kth_largest(keys: DataFrame, k: int) -> tuple[int, int] | None:
    """Of a long column "key": the largest value that k rows reach, and how many of the k have just that value; None if
    there are fewer rows."""
    if k <= 0:
        return None
    prefix, left = None, k
    for shift in range(64 - LEVEL_BITS, -1, -LEVEL_BITS):
        inside = keys if prefix is None else keys.filter(F.shiftright("key", shift + LEVEL_BITS) == prefix)
        counts = inside.groupBy(F.shiftright("key", shift).alias("b")).agg(F.count("*").alias("n")).orderBy(F.desc("b")).toPandas()  # 2**LEVEL_BITS rows at most
        run = counts.n.cumsum().to_numpy()
        if not len(run) or run[-1] < left:
            return None
        at = int(np.searchsorted(run, left))
        left -= int(run[at - 1]) if at else 0
        prefix = int(counts.b[at])
    return prefix, left


def keep_largest(keyed: DataFrame, k: int) -> DataFrame:
    """keyed (doc_id, .., key): k rows of the largest keys; of those that tie at the border, those of the least ids. Rows
    of one id and key are equal."""
    border = kth_largest(keyed, k)
    if border is None:
        return keyed if k > 0 else keyed.limit(0)
    value, wanted = border
    rest = [c for c in keyed.columns if c != "doc_id"]
    ties = keyed.filter(F.col("key") == value).groupBy("doc_id").agg(F.count("*").alias("_n"), *(F.first(c).alias(c) for c in rest))
    first = ties.orderBy(F.col("doc_id").asc_nulls_last()).limit(wanted)  # each stands for a row at least
    before = F.coalesce(F.sum("_n").over(Window.orderBy(F.col("doc_id").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    some = first.withColumn("_n", F.greatest(F.lit(0), F.least(F.col("_n"), F.lit(wanted) - before))).withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_n").cast("int"))))
    return keyed.filter(F.col("key") > value).unionByName(some.select(*keyed.columns))


def resample(docs: DataFrame, labels: DataFrame, seed: int = 7) -> DataFrame:
    """The rows sampled: doc_id, log_weight, gumbel_key."""
    ratio, share = ratios(docs, labels)
    keyed = materialise(weigh(docs, ratio, seed))
    return keep_largest(keyed, round(share * keyed.count())).drop("key")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op3_quality": op3_quality}
SQL: dict[str, str] = {}
