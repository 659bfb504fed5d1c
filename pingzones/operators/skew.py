"""Salted left join for keys of which a few may hold a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pingzones.operators.shared_folder import new_folder

# A key counts as hot from this many rows on.
ROWS_PER_TASK = 2_000_000
# Hot keys up to this number are broadcast.
BROADCAST_KEYS = 1_000_000
# Largest hash table that one task of a shuffled join is asked to hold.
HASH_TABLE_BYTES = 64 << 20


def hot_keys(df: DataFrame, keys: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys above the limit, whatever their share, with the number of salts each needs.

    The counts are combined map-side.  The keys are written, which makes both
    join sides use the same salts even if the input is read again; there are at
    most as many as the rows divided by the limit.
    """
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = df.filter(has_key).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    hot = counts.filter(F.col("n") > rows_per_task).select(
        *keys, F.ceil(F.col("n") / rows_per_task).cast("int").alias("salts")
    )
    folder = new_folder(df.sparkSession, "hot-keys")
    hot.write.parquet(folder)
    kept = df.sparkSession.read.schema(hot.schema).parquet(folder)
    return F.broadcast(kept) if kept.count() <= BROADCAST_KEYS else kept


def row_spread(df: DataFrame, buckets: Column) -> Column:
    """Bucket of a row, the same at every attempt of its task.

    Hashing the whole row spreads rows of one key; adding the partition number
    also spreads whole-row copies that come from different input splits.
    """
    return F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), buckets).cast("int")


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    rows_per_task: int = ROWS_PER_TASK,
    right_bytes: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """``left`` left-joined to ``right``, which has at most one row per key.

    Only hot keys are salted, and only their right rows are repeated, once per
    salt.  Left rows without a key cannot match; their salt spreads them instead
    of letting them meet in one partition.  When ``right_bytes`` shows that the
    right side's share of a partition fits in memory, a hash table is built from
    it and the left side need not be sorted.  ``hot`` are the hot keys, if known.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashable = right_bytes is not None and right_bytes / parts <= HASH_TABLE_BYTES
    if hot is None:
        hot = hot_keys(left, keys, rows_per_task)
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    spread = left.withColumn("_spread", row_spread(left, F.lit(1 << 30)))
    salted = spread.join(hot, keys, "left").withColumn(
        "_salt",
        F.when(has_key, F.col("_spread") % F.coalesce("salts", F.lit(1))).otherwise(
            # Negative: no right row carries it.
            -1 - F.col("_spread")
        ),
    )
    repeated = (
        right.join(hot, keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
        .drop("salts")
    )
    on = [salted[k] == repeated[k] for k in [*keys, "_salt"]]
    joined = salted.join(repeated.hint("shuffle_hash" if hashable else "merge"), on, "left")
    extra = [c for c in right.columns if c not in keys]
    return joined.select(*[salted[c] for c in left.columns], *[repeated[c] for c in extra])
