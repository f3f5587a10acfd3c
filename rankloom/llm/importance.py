"""Quality classifier by importance resampling.

Two generative models over hashed one- and two-word features: one of target text, that is of labelled
good documents, one of the raw text of all documents. A document's weight is the mean log ratio of the
two over its features; the documents with the ``k`` largest values of weight / temperature plus Gumbel
noise are a sample without replacement by these weights. The k-th largest value is found exactly by
histograms, so nothing is sorted and no set of documents leaves the executors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, column_or_null, lower_ascii, roller, shingle_hashes, text_slices, word_bounds

#: Hashed features; the models have one number each, and each task reports as many counts at most.
FEATURES = 1 << 17
#: Labelled good documents, chosen by hash, that the target model is fitted on.
FIT_DOCUMENTS = 50_000
TEMPERATURE = 0.01
BINS = 4096
#: Values of the last histogram bin that the driver looks at.
LAST = 10_000


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature and text number of all words and pairs of words; a single word has no pair."""
    low = lower_ascii(data)
    starts, ends, first = word_bounds(low, offsets)
    roll = roller(1)
    words = roll.hashes(roll.sums(low), starts, ends)
    pairs, where = shingle_hashes(words, first, 2)
    texts = np.arange(len(offsets) - 1)
    of_words = np.repeat(texts, np.diff(first))
    of_pairs = np.repeat(texts, np.diff(where))
    real = np.diff(first)[of_pairs] > 1  # the shingle of a single word is that word
    both = np.concatenate([words, pairs[real]]) % np.uint64(FEATURES)
    return both.astype(np.int64), np.concatenate([of_words, of_pairs[real]])


def counts(batches):
    """Counts of features in all texts and in those of the target, once per task."""
    raw, target = np.zeros(FEATURES, np.int64), np.zeros(FEATURES, np.int64)
    for rows, data, offsets in text_slices(batches):
        feature, text = features(data, offsets)
        raw += np.bincount(feature, minlength=FEATURES)
        chosen = rows.column("target").to_numpy(zero_copy_only=False).astype(bool)
        if chosen.any():
            target += np.bincount(feature[chosen[text]], minlength=FEATURES)
    seen = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], ["feature", "raw", "target"]
    )


def weigher(ratios):
    """Arrow function from texts to mean log ratios, null where a text has no words."""

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for rows, data, offsets in text_slices([pa.RecordBatch.from_arrays([texts], ["text"])]):
            feature, text = features(data, offsets)
            n = np.bincount(text, minlength=rows.num_rows)
            sums = np.bincount(text, weights=ratios.value[feature], minlength=rows.num_rows)
            out.append(pa.array(sums / np.maximum(n, 1), mask=n == 0))
        return pa.concat_arrays(out) if out else pa.array([], pa.float64())

    return run


def gumbel(doc_id: Column, text: Column, seed: int) -> Column:
    """Gumbel noise that is fixed for a row: reruns and repeated tasks agree."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id, text), 11)
    uniform = (bits.cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def kth_largest(values: DataFrame, k: int) -> float:
    """The ``k``-th largest of the column ``key``; each round keeps the histogram bin that holds it."""
    inside = values.select("key")
    while True:
        low, high, n = inside.agg(F.min("key"), F.max("key"), F.count("*")).first()
        if low == high:
            return low
        if n <= LAST:
            return sorted((r[0] for r in inside.collect()), reverse=True)[k - 1]
        bin_ = F.floor((F.col("key") - low) / F.lit((high - low) / BINS))
        for b, size in inside.groupBy(bin_.alias("b")).count().orderBy(F.desc("b")).collect():
            if k <= size:
                inside = inside.filter(bin_ == b)
                break
            k -= size


class Importance:
    def __init__(self, docs: DataFrame, labels: DataFrame, seed: int = 0):
        """``labels(doc_id, quality, toxic)``: good are those of quality 1 that are never toxic."""
        self.spark, self.docs, self.seed = docs.sparkSession, docs, seed
        self.scratch = Scratch(self.spark)
        judged = labels.filter("doc_id is not null").groupBy("doc_id").agg(
            F.min("quality").alias("quality"), F.max("toxic").alias("toxic")
        )
        self.share = judged.agg(F.avg(F.col("quality").cast("double"))).first()[0]
        self.good = (
            judged.filter("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_DOCUMENTS)
        )

    def fit(self):
        """Broadcast log ratios, with one target document's worth of smoothing spread over all features."""
        texts = self.docs.select(
            column_or_null(self.docs, "doc_id", "bigint").alias("doc_id"),
            column_or_null(self.docs, "text", "string").alias("text"),
        )
        chosen = F.broadcast(self.good.withColumn("target", F.lit(True)))
        table = (
            texts.join(chosen, "doc_id", "left")
            .select("text", F.coalesce("target", F.lit(False)).alias("target"))
            .mapInArrow(counts, "feature bigint, raw bigint, target bigint")
            .groupBy("feature").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
            .toPandas()  # FEATURES rows at most
        )
        raw, target = np.zeros(FEATURES), np.zeros(FEATURES)
        raw[table["feature"]], target[table["feature"]] = table["raw"], table["target"]
        scale = raw.sum() / target.sum() if target.sum() else 0.0
        ratios = np.log((target * scale + scale) / (raw + scale)) if scale else np.zeros(FEATURES)
        return self.spark.sparkContext.broadcast(ratios)

    def select(self, keep_share: float | None = None) -> DataFrame:
        """All columns of ``docs`` and ``weight``, ``kept``."""
        weight = F.arrow_udf(weigher(self.fit()), "double")
        text = column_or_null(self.docs, "text", "string")
        doc_id = column_or_null(self.docs, "doc_id", "bigint")
        drawn = F.col("weight") / TEMPERATURE + gumbel(doc_id, text, self.seed)
        weighed = self.docs.withColumn("weight", weight(F.coalesce(text, F.lit(""))))
        keys = self.scratch.keep(weighed.select(drawn.alias("key")))
        n = keys.count()
        share = self.share if keep_share is None else keep_share
        k = min(math.ceil(n * (1.0 if share is None else share)), keys.filter("key is not null").count())
        if not k:
            return weighed.withColumn("kept", F.lit(False))
        least = kth_largest(keys.filter("key is not null"), k)
        return weighed.withColumn("kept", F.coalesce(drawn >= F.lit(least), F.lit(False)))


def resample(
    docs: DataFrame, labels: DataFrame, keep_share: float | None = None, seed: int = 0
) -> DataFrame:
    """``docs`` and ``weight`` (double), ``kept`` (boolean), which replace columns of these names.

    ``keep_share`` of all rows are kept, by default the share of quality 1 among the labelled documents.
    A text without words has no weight and is never kept; values equal to the k-th largest are all kept.
    Rows with a null doc_id are weighed too. With no labels at all every weight is 0. An empty table
    stays empty.
    """
    plain = docs.drop("weight", "kept")
    return Importance(plain, labels, seed).select(keep_share)
