"""SimHash near-duplicates: linked fingerprints by pivot distance tables.

A text's fingerprint is the bitwise majority of the hashes of its word
shingles.  Equal fingerprints are one row from then on.  Two fingerprints that
differ in few bits agree in some bands of bits, so they meet under a key made
of those bands.  There every fingerprint has a row of precomputed Hamming
distances to many reference fingerprints; by the triangle inequality, a pair
of which one coordinate differs by more than the limit cannot be near, and only
the pairs left are verified bit by bit.  Within a key, a fingerprint that has
joined a group is not compared again and a group is handed on as a star, so
dense groups take no pair for each two members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pingzones.llm.common import IDENTITY, identity, named_again, placed, stored
from pingzones.llm.components import components

BITS = 64
SEED = 42
# Reference fingerprints; each is the hash of its number.
PIVOTS = np.array([xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(24)], np.uint64)
# Fingerprints under one key that one task compares; a fuller key gets more bits.
KEY_ROWS = 4096
# Hashes whose bits are counted at once.
CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """Signed 64 bits; 0 without words, one shingle of all words if they are few."""
    found = text.lower().split()  # on bytes: A-Z only, and ASCII white space only
    if not found:
        return 0
    line = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: max(1, len(found) - shingle + 1)]
    ends = ends[min(shingle, len(found)) - 1 :]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, text: str, shingle: int, out: str = "_fp") -> DataFrame:
    """``docs`` without the text, with the fingerprint; null is like an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = batch.column(at).cast(pa.binary())
            prints = pa.array([fingerprint(t.as_py() or b"", shingle) for t in texts], pa.int64())
            kept = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), prints], [*(batch.schema.names[i] for i in kept), out]
            )

    fields = [f for f in docs.schema if f.name != text]
    return docs.mapInArrow(run, T.StructType([*fields, T.StructField(out, T.LongType())]))


def _mask(bits: list[int]) -> int:
    return int(np.uint64(sum(1 << b for b in bits)).astype(np.int64))


def _split(bits: list[int], parts: int) -> list[list[int]]:
    edges = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [bits[a:b] for a, b in zip(edges, edges[1:]) if b > a]


def band_masks(n: int, distance: int) -> list[int]:
    """Bits of which near fingerprints agree in at least one choice.

    ``distance`` changed bits leave enough of the bands untouched; more bands
    are kept fixed the more fingerprints there are, so keys stay short of rows.
    """
    kept = 1
    while kept * BITS / (distance + kept) < math.log2(max(n, 2)) and kept < 5:
        kept += 1
    bands = _split(list(range(BITS)), distance + kept)
    return [_mask(sum(chosen, [])) for chosen in combinations(bands, kept)]


def finer_masks(mask: int, distance: int) -> list[int]:
    """``mask`` with one more of distance + 1 parts of the other bits: one is untouched."""
    fixed = [b for b in range(BITS) if mask >> b & 1]
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [_mask(fixed + part) for part in _split(free, distance + 1)]


def _near(prints: np.ndarray, table: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Stars (centre, member) of the groups that near pairs form among the rows."""
    rest, stars = np.arange(len(prints)), []
    while rest.size > 1:
        centre, rest = rest[0], rest[1:]
        waiting = [centre]
        while waiting and rest.size:
            x = waiting.pop()
            # Pivot filter: the largest coordinate difference decides.
            kept = (np.abs(table[rest] - table[x]) <= distance).all(axis=1)
            kept[kept] = np.bitwise_count(prints[rest[kept]] ^ prints[x]) <= distance
            if kept.any():
                found = rest[kept].tolist()
                stars.extend((centre, f) for f in found)
                waiting.extend(found)
                rest = rest[~kept]
    return stars


def _links_of_keys(distance: int):
    names = ["a", "b"]

    def links(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        unsigned = prints.view(np.uint64)
        table = np.bitwise_count(unsigned[:, None] ^ PIVOTS[None, :]).astype(np.int8)
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        ends = np.r_[starts[1:], len(keys)]
        # Keys with two rows, the most, all at once.
        a = starts[ends - starts == 2]
        a = a[(np.abs(table[a] - table[a + 1]) <= distance).all(axis=1)]
        a = a[np.bitwise_count(unsigned[a] ^ unsigned[a + 1]) <= distance]
        pairs = [np.stack([a, a + 1], axis=1)]
        for s, e in zip(starts.tolist(), ends.tolist()):
            if e - s > 2 and (stars := _near(unsigned[s:e], table[s:e], distance)):
                pairs.append(np.array(stars) + s)
        found = prints[np.concatenate(pairs)]
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; the last key of a batch waits for the next one."""
        keys, prints = np.empty((0, 2), np.int64), np.empty(0, np.int64)
        for batch in batches:
            mask, key, fp = (batch.column(i).to_numpy() for i in range(3))
            keys = np.concatenate([keys, np.stack([mask, key], axis=1)])
            prints = np.concatenate([prints, fp])
            if not len(keys):
                continue
            cut = len(keys) - int((keys == keys[-1]).all(axis=1).sum())
            if cut:
                yield links(keys[:cut], prints[:cut])
                keys, prints = keys[cut:], prints[cut:]
        if len(keys):
            yield links(keys, prints)

    return run


def near_links(prints: DataFrame, distance: int, key_rows: int = KEY_ROWS) -> DataFrame:
    """Links (a, b) that connect what pairs at ``distance`` or less connect.

    ``prints`` has one column of distinct fingerprints.  A key with more than
    ``key_rows`` of them is split by more bits until it has no more; no pair is
    lost, as near pairs agree in one of the finer choices.
    """
    spark, (fp,) = prints.sparkSession, prints.columns
    masks, links = band_masks(prints.count(), distance), None
    pool = prints.select(F.col(fp).alias("fp"), F.explode(F.array(*map(F.lit, masks))).alias("mask"))
    while True:
        keyed = pool.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        counts = keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        pool = stored(keyed.join(counts, ["mask", "key"]), "simhash-keys")
        by_key = pool.filter(F.col("n") <= key_rows).select("mask", "key", "fp")
        by_key = by_key.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
        found = stored(by_key.mapInArrow(_links_of_keys(distance), "a long, b long").distinct(), "simhash-links")
        links = found if links is None else links.unionByName(found)
        full = pool.filter(F.col("n") > key_rows)
        if full.isEmpty():
            return links
        finer = {m: finer_masks(m, distance) for m in masks}
        masks = sorted({x for found in finer.values() for x in found})
        # At most ten times four per round: a small table.
        rows = spark.createDataFrame([(m, x) for m, xs in finer.items() for x in xs], "mask long, finer long")
        pool = full.join(F.broadcast(rows), "mask").select("fp", F.col("finer").alias("mask")).distinct()


def _labelled(docs: DataFrame, text: str, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """Rows with ``_fp``, and for every fingerprint its group (a fingerprint) ``_group``."""
    rows = stored(with_fingerprints(docs, text, shingle), "simhash-rows")
    prints = stored(rows.groupBy("_fp").agg(F.count(F.lit(1)).alias("_rows")), "simhash-prints")
    roots = components(near_links(prints.select("_fp"), distance))
    groups = prints.join(roots, F.col("_fp") == F.col("node"), "left").select(
        "_fp", F.coalesce("root", "_fp").alias("_group")
    )
    return rows, stored(groups, "simhash-groups")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, distance: int = 3, text: str = "text", id_: str = "doc_id"
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row.

    The component is the smallest id reachable over links, the row's own
    included; nulls are passed over, and it is null if all are.  Null and
    wordless texts have fingerprint zero and link like any other; equal rows
    each get a row; an empty table gives none.  Other columns are not read.
    """
    narrow = docs.select(F.col(id_).alias("doc_id"), F.col(text).alias("text"))
    rows, groups = _labelled(narrow, "text", shingle, distance)
    # Combined within each task first, so a large group is no large shuffle.
    firsts = rows.groupBy("_fp").agg(F.min("doc_id").alias("_first")).join(groups, "_fp")
    smallest = firsts.groupBy("_group").agg(F.min("_first").alias("component_id"))
    labels = stored(groups.join(smallest, "_group").select("_fp", "component_id"), "simhash-labels")
    return rows.join(labels, "_fp").select(
        "doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each_group(
    docs: DataFrame, shingle: int = 3, distance: int = 3, text: str = "text", id_: str = "doc_id"
) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their group, one of each group.

    Rows with a null id come last; among rows of one id the row's hash decides,
    and of equal rows any one stays.
    """
    whole = placed(docs, **identity(docs))
    id_, text = (F.col(f"c{docs.columns.index(c)}") for c in (id_, text))
    narrow = whole.select(id_.alias("doc_id"), F.struct(*IDENTITY).alias("_row"), text.alias("text"))
    rows, groups = _labelled(narrow, "text", shingle, distance)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"))
    per_print = rows.groupBy("_fp").agg(F.min(order).alias("_first")).join(groups, "_fp")
    chosen = per_print.groupBy("_group").agg(F.min("_first").alias("_first")).select("_first._row.*").distinct()
    of_equal = F.row_number().over(Window.partitionBy(*IDENTITY).orderBy("_unit"))
    kept = whole.join(stored(chosen, "simhash-chosen"), IDENTITY)
    return named_again(kept.withColumn("_copy", of_equal).filter("_copy = 1"), docs)
