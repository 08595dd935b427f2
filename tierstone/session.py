"""Session construction and the runtime settings every plan relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that may be changed on a running session. Broadcast thresholds are
# left at Spark's own default: no plan here asks for a broadcast by hint, so a
# dimension is broadcast only when its size is under that threshold.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    # Files are compressed: count their rows at three times the file size when
    # judging whether a dimension is small enough to broadcast.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    # Merge small shuffle partitions up to the advisory size, but leave each core one: a
    # table that compresses well would else be written by a single task. None is
    # smaller than 4 MB, so a large cluster does not write thousands of tiny files.
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4m",
    # Hot join keys are split at run time, also where the split costs one more
    # exchange: a third of the rows in one task costs far more.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A reload replaces the whole table, not only the partitions it touches.
    "spark.sql.sources.partitionOverwriteMode": "static",
}

TARGET_SHUFFLE_BYTES = 128 * 1024 * 1024


def apply_runtime_settings(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shuffle_width(shuffle_bytes: int, cores: int) -> int:
    """Shuffle partitions so that one holds about 128 MB, and no core idles.

    AQE merges partitions that turn out small but only splits skewed ones, so
    a large job should start wide.
    """
    return max(2 * cores, -(-shuffle_bytes // TARGET_SHUFFLE_BYTES))


def build_session(
    app_name: str = "tierstone",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    shuffle_bytes: int | None = None,
) -> SparkSession:
    """A session with the settings above; master and sizing default to the cluster's.

    `shuffle_bytes`, the largest shuffle expected, sets the shuffle partitions for it
    where `shuffle_partitions` does not.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if shuffle_bytes and not shuffle_partitions:
        width = shuffle_width(shuffle_bytes, spark.sparkContext.defaultParallelism)
        spark.conf.set("spark.sql.shuffle.partitions", str(width))
    return apply_runtime_settings(spark)
