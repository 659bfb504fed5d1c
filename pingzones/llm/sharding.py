"""Contiguous shards of near-equal bytes, cut from global byte prefix sums.

Documents are put in the order (text hash, id).  Every partition of that order
adds up its own bytes; the sums of the partitions before it make the sums
global; equal targets cut the line.  Only one row per partition meets in one
place.  Equal texts lie side by side, so they share a shard unless a cut falls
between them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pingzones.llm.common import named, prefix_of_partitions, stored

# Bytes that a document takes besides its text.
ROW_BYTES = 8


def document_bytes(text: Column | str = "text") -> Column:
    """UTF-8 bytes of the text, none for null, plus ``ROW_BYTES``."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def _run_along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition number, and the bytes and rows before each row within it."""
    part, size, rows = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        sizes = batch.column("_size").to_numpy(zero_copy_only=False)
        before = size + np.cumsum(sizes) - sizes
        added = {
            "_part": np.full(len(sizes), part, np.int32),
            "_bytes_before": before,
            "_rows_before": rows + np.arange(len(sizes), dtype=np.int64),
        }
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *map(pa.array, added.values())], [*batch.schema.names, *added]
        )
        size, rows = int(size + sizes.sum()), rows + len(sizes)


def contiguous_shards(
    docs: DataFrame, shards: int, text: str = "text", key: str = "doc_id", carry: list[str] | None = None
) -> DataFrame:
    """``docs`` (only the columns ``carry``, which hold the key, when given) with ``size``, ``shard`` (from 0) and ``slot`` (gapless from 0 in its shard).

    A shard's bytes differ from the mean by less than the largest document.
    A null text counts as ``ROW_BYTES`` only; a null id sorts first; equal rows
    are interchangeable; an empty table gives no rows.  Columns of ``docs`` that
    bear one of the three new names are replaced.  The result is read from a written
    table, so it stays the same.
    """
    kept = [c for c in carry or docs.columns if c not in ("size", "shard", "slot")]
    # Columns go by their place, so that none clashes with those added here.
    places = [f"c{i}" for i in range(len(kept))]
    lined_up = (
        docs.select(
            *[named(c).alias(p) for c, p in zip(kept, places)], document_bytes(named(text)).alias("_size"),
            F.xxhash64(named(text)).alias("_hash"), named(key).alias("_key"),
        )
        .repartitionByRange("_hash", "_key")
        .sortWithinPartitions("_hash", "_key")
        .drop("_hash", "_key")
    )
    schema = T.StructType(
        [
            *lined_up.schema.fields,
            T.StructField("_part", T.IntegerType()),
            T.StructField("_bytes_before", T.LongType()),
            T.StructField("_rows_before", T.LongType()),
        ]
    )
    runs = stored(lined_up.mapInArrow(_run_along, schema), "shards")
    starts = prefix_of_partitions(runs.withColumn("_row", F.lit(1)), "_part", ["_size", "_row"])
    middle = 2 * (F.col("before__size") + F.col("_bytes_before")) + F.col("_size")
    placed = runs.join(F.broadcast(starts), "_part").withColumns(
        {
            "shard": F.least(
                F.lit(shards - 1), F.floor(middle * shards / (2 * F.col("all__size")))
            ).cast("int"),
            "_rank": F.col("before__row") + F.col("_rows_before"),
        }
    )
    # One row per shard: its first place in the line.
    first = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))
    return placed.join(F.broadcast(first), "shard").select(
        *places, F.col("_size").alias("size"), "shard", (F.col("_rank") - F.col("_first")).alias("slot")
    ).toDF(*kept, "size", "shard", "slot")
