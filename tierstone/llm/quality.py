"""Quality by importance resampling: hashed n-gram models of target and raw text."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.common import in_batches, python_values, share, small_batches, stored

#: Words and pairs of neighbouring words are hashed into so many buckets.
BUCKETS = 1 << 14
#: About so many documents labelled good make the target model.
TARGET_DOCUMENTS = 20_000
#: The part of the rows that is selected.
KEEP_SHARE = 0.5
#: Pseudo-count of every bucket.
SMOOTHING = 1.0


def buckets(text: str | None) -> np.ndarray:
    """Buckets of all words and word pairs of the whole lower-cased text."""
    words = text.lower().encode("utf-8", "replace").split() if text else []
    if not words:
        return np.empty(0, np.uint32)
    one = np.fromiter(map(zlib.crc32, words), np.uint32, count=len(words))
    two = one[:-1] * np.uint32(0x9E3779B1) + one[1:]
    both = np.concatenate((one, two ^ (two >> np.uint32(13))))
    return (both * np.uint32(0x85EBCA77)) >> np.uint32(32 - 14)


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """Counts per bucket over rows (text, good): all of them, and the good ones.

    Each task adds its texts up; the shuffle carries one row per task and bucket, the
    driver gets one per bucket.
    """
    schema = pa.schema([("bucket", pa.int32()), ("every", pa.int64()), ("good", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for text, good in python_values(batches):
            found = np.bincount(buckets(text), minlength=BUCKETS)
            counts[0] += found
            if good:
                counts[1] += found
        some = np.nonzero(counts[0])[0]
        return in_batches(zip(some.tolist(), *counts[:, some].tolist(), strict=True), schema, BUCKETS)

    summed = rows.mapInArrow(work, "bucket int, every long, good long").groupBy("bucket")
    total = np.zeros((2, BUCKETS), np.int64)
    for bucket, every, good in summed.agg(F.sum("every"), F.sum("good")).collect():
        total[:, bucket] = every, good
    return total


def log_ratios(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, sample: int = TARGET_DOCUMENTS) -> np.ndarray:
    """Per bucket, log of the target model over the raw model.

    The raw model counts every row. The target model counts documents labelled good,
    of which about `sample` are drawn by a hash of their id and sent to the tasks, so
    that no text is shuffled. Without good labels both models are the same.
    """
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("id")).distinct()
    rate = min(1.0, sample / max(1, good.count()))
    # Bounded by the sample size, whatever the tables hold.
    drawn = F.broadcast(good.where(share(F.col("id")) < rate).withColumn("good", F.lit(True)))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(drawn, "id", "left")
    every, target = bucket_counts(rows.select("text", "good"))
    if not target.sum():
        return np.zeros(BUCKETS)
    p = lambda c: np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS))
    return p(target) - p(every)


def log_weight(ratios: np.ndarray, text: Column) -> Column:
    """Log importance weight of whole texts: the sum over their n-grams, 0 without any."""
    @F.pandas_udf("double")
    def weigh(texts: pd.Series) -> pd.Series:
        return pd.Series([float(ratios[buckets(t)].sum()) for t in texts], dtype="float64")

    return weigh(text)


def resample(
    docs: DataFrame, labels: DataFrame, keep_share: float = KEEP_SHARE, temperature: float = 1.0,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, n_grams, log_weight, sampling_key and selected of every row.

    Selected are the `keep_share` of the rows with the greatest keys, a key being the
    log weight over `temperature` plus Gumbel noise: the rows of a draw without replacement
    in which each row's chance goes with its weight (at temperature 1, the default). The noise is a hash of id and text,
    so equal rows draw alike; of rows equal in key, those of smaller id go first, and rows
    equal in both share the last places by number (`selected` is then true for all of
    them or none). NULL and empty texts weigh 0. Other columns are left out.
    """
    small_batches(docs.sparkSession)
    ratios = log_ratios(docs, labels, doc_id, text)
    u = share(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit("")), F.lit("gumbel"))
    noise = -F.log(-F.log(u + 2.0**-54))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    weighed = rows.withColumn("log_weight", log_weight(ratios, F.col("text"))).withColumn("noise", noise).drop("text")
    keyed = stored(weighed.select("doc_id", "log_weight", (F.col("log_weight") / temperature + F.col("noise")).alias("sampling_key")), "keys")
    wanted = int(keyed.count() * keep_share)
    least = kth_greatest(keyed, "sampling_key", wanted)
    beyond = keyed.where(F.col("sampling_key") > least).count() if wanted else 0
    tied = keyed.where(F.col("sampling_key") == least).select("doc_id")
    # Few rows tie unless whole rows repeat; the rest of the places go to the smallest ids.
    last = kth_greatest(tied.select((-F.coalesce(F.col("doc_id"), F.lit(-(1 << 62)))).cast("double").alias("k")), "k", wanted - beyond) if wanted else 0.0
    order = (-F.coalesce(F.col("doc_id"), F.lit(-(1 << 62)))).cast("double")
    chosen = (F.col("sampling_key") > least) | ((F.col("sampling_key") == least) & (order >= last))
    return keyed.withColumn("selected", chosen if wanted else F.lit(False))


def kth_greatest(rows: DataFrame, column: str, k: int, cells: int = 4096) -> float:
    """The k-th greatest value of a column of finite doubles, exactly, without a sort.

    The range is cut into cells, the rows are counted per cell, and the cell that holds
    the k-th is cut again, until it holds one value. Each pass sends `cells` counts to
    the driver at most.
    """
    low, high = rows.agg(F.min(column), F.max(column)).first()
    while k > 0 and low is not None and low < high:
        width = (high - low) / cells
        if low + width <= low:  # neighbours in double precision
            width = high - low
        inside = rows.where(F.col(column).between(low, high))
        cell = F.floor((F.col(column) - low) / width).cast("int").alias("cell")
        counted = inside.groupBy(cell).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        for row in sorted(counted.collect(), reverse=True):
            if row["n"] >= k:
                low, high = row["low"], row["high"]
                break
            k -= row["n"]
    return low if low is not None else 0.0
